"""Streaming forms of the router and of transition detection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakepnl.streaming.transitions import FEED_SCHEMA, just_succeeded, next_requests, route

STATE_KEYS = ["pk", "sk", "layer"]
EVENT_SCHEMA = "seq bigint, pk string, sk string, layer string, status string"
#: Days for which a delivered change is known.
KNOWN_DAYS = 400
#: Newest events of a run and layer among which a late one still finds its place.
RETAINED = 10_000
FILES_PER_BATCH = 256


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def read_feed(
    spark: SparkSession, path: str, schema: str = FEED_SCHEMA, files_per_batch: int | None = None
) -> DataFrame:
    """New files of a folder; a micro-batch takes at most so many, also of a long history."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch or FILES_PER_BATCH)
    return reader.parquet(path)


def requests_of(feed: DataFrame, known_days: int = KNOWN_DAYS) -> DataFrame:
    """Requests for every transition of a feed, each once, however late it comes again.

    A change is known by its run, layer and sequence. Spark's state store keeps these keys from the
    arrival of the change, or from its business date if that is later, for `known_days`, and
    then forgets them. A micro-batch looks up its own keys, and nothing that comes late is left out: it
    is the time of arrival that expires.
    """
    arrived = feed.withColumn("arrived", F.current_timestamp())
    found = just_succeeded(arrived, ("arrived",))
    day = F.to_timestamp(F.try_to_timestamp(F.col("business_date"), F.lit("yyyy-MM-dd")))
    dated = found.withColumn("arrived", F.greatest("arrived", day)).withWatermark("arrived", f"{known_days} days")
    once = dated.dropDuplicatesWithinWatermark(["pk", "batch_id", "layer", "seq"])
    return next_requests(route(once))


def start_router(
    spark: SparkSession,
    feed_path: str,
    out_path: str,
    checkpoint: str,
    every: str | None = None,
    files_per_batch: int | None = None,
    known_days: int = KNOWN_DAYS,
) -> StreamingQuery:
    """Writes the requests of a feed, by business date; see `requests_of`.

    A micro-batch that is done again after a failure gives the same requests, and readers see those
    of completed ones. `every` is the trigger interval; without it the stream takes what is there and ends.
    """
    fresh = requests_of(read_feed(spark, feed_path, files_per_batch=files_per_batch), known_days)
    writer = (
        fresh.withColumn("day", F.col("business_date"))
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .partitionBy("day")
        .outputMode("append")
    )
    return _trigger(writer, every).start(out_path)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """The requests that a router has written."""
    return spark.read.parquet(path).drop("day")


def transition_points(seq: np.ndarray, done: np.ndarray, before: bool) -> np.ndarray:
    """Sequences at which a status turns to succeeded; `before` is the one ahead of all."""
    return seq[done & ~np.concatenate(([before], done[:-1]))] if len(seq) else seq


def merge_events(
    state: tuple[np.ndarray, np.ndarray, int | None, bool], seq: np.ndarray, done: np.ndarray, retained: int
) -> tuple[tuple[np.ndarray, np.ndarray, int | None, bool], np.ndarray, np.ndarray]:
    """Puts events in their place among those of a key.

    Returns the new state, the transitions that are new, and those that are none any more. The state has
    the newest `retained` events in order, and of all before them the last sequence and whether it had
    succeeded; an event from before that changes nothing.
    """
    old_seq, old_done, floor, settled = state
    fresh = ~np.isin(seq, old_seq)
    if floor is not None:
        fresh &= seq > floor
    seq, first = np.unique(seq[fresh], return_index=True)
    every = np.concatenate((old_seq, seq))
    order = np.argsort(every, kind="stable")
    every, flags = every[order], np.concatenate((old_done, done[fresh][first]))[order]
    was, now = transition_points(old_seq, old_done, settled), transition_points(every, flags, settled)
    cut = max(0, len(every) - retained)
    if cut:
        floor, settled = int(every[cut - 1]), bool(flags[cut - 1])
    return (every[cut:], flags[cut:], floor, settled), np.setdiff1d(now, was), np.setdiff1d(was, now)


def _changes(retained: int):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.exists:
            seqs, flags, floor, settled = state.get
            kept = np.frombuffer(seqs, np.int64), np.frombuffer(flags, np.bool_), floor, settled
        else:
            kept = np.zeros(0, np.int64), np.zeros(0, np.bool_), None, False
        # Of an event only its number and whether it succeeded are held.
        seq, done = [], []
        for batch in batches:
            seq.append(batch["seq"].to_numpy(np.int64))
            done.append((batch["status"].fillna("").str.upper() == "SUCCEEDED").to_numpy(np.bool_))
        kept, added, removed = merge_events(kept, np.concatenate(seq), np.concatenate(done), retained)
        state.update((kept[0].tobytes(), kept[1].tobytes(), kept[2], kept[3]))
        if len(added) + len(removed):
            found = np.concatenate((added, removed))
            change = np.concatenate((np.ones(len(added), np.int32), np.full(len(removed), -1, np.int32)))
            yield pd.DataFrame({n: [v] * len(found) for n, v in zip(STATE_KEYS, key, strict=True)} | {"seq": found, "change": change})

    return run


def start_transitions(
    spark: SparkSession,
    events_path: str,
    out_path: str,
    checkpoint: str,
    every: str | None = None,
    files_per_batch: int | None = None,
    retained: int = RETAINED,
) -> StreamingQuery:
    """Transitions when the feed has only new statuses, no old image.

    The newest `retained` events of each run and layer are kept in order in the stream's state store, of
    which a micro-batch touches only the keys that it has events of. A late event finds its place
    among them: it may make a transition, and it may show that an earlier one was none. Rows are changes,
    1 for a transition and -1 for one that is taken back; `read_transitions` adds them up to what
    the whole log would give at once. An event that comes again changes nothing, and so does one from
    before the retained ones. A micro-batch that is done again gives the same rows.
    """
    events = read_feed(spark, events_path, EVENT_SCHEMA, files_per_batch).where("seq is not null")
    found = events.groupBy(*STATE_KEYS).applyInPandasWithState(
        _changes(retained),
        "pk string, sk string, layer string, seq long, change int",
        "seqs binary, flags binary, floor long, settled boolean",
        "append",
        GroupStateTimeout.NoTimeout,
    )
    writer = found.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(writer, every).start(out_path)


def read_transitions(spark: SparkSession, path: str) -> DataFrame:
    """The transitions that are left of all changes that a stream has written."""
    net = spark.read.parquet(path).groupBy(*STATE_KEYS, "seq").agg(F.sum("change").alias("net"))
    return net.where("net > 0").drop("net")
