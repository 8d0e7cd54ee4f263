"""Best-two-fit packing of token sequences.

A document becomes its token ids and one end id. Documents above the capacity are cut into
pieces of that length, the first piece taking the rest. A bin is filled greedily with the
longest piece that fits; then its smallest piece is taken out if two unpacked pieces fill
the gap left by it more tightly, again and again until none do. Small pieces are kept back for
the gaps that remain.

Equal lengths are interchangeable, so the plan is made on the number of pieces of each
length: at most `capacity` counts, whatever the size of the corpus. One filled bin is used
as often as the counts allow. Spark counts the lengths, ranks the pieces of a length
(within salts, so that a length that a third of all rows have is no single task) and looks
each rank up in the plan. Full pieces need no rank.

Null and empty texts are one end id. Repeated rows are packed as often as they come.
Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakepnl.llm.text import saved, slices, small_batches
from lakepnl.llm.tokens import encoder

CAPACITY = 1024
END = 2
ROWS_PER_SALT = 5_000
#: Shares of the capacity up to which pieces may count as small.
SMALL = (0.0, 1 / 6, 1 / 4, 1 / 3, 1 / 2)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length and ids (binary, four little-endian bytes each) of every piece."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for row, stop, data, offsets in slices(batch):
                ids, at = model.ids(data, offsets)
                rows = []
                for k, doc_id in enumerate(doc_ids[row:stop]):
                    own = np.append(ids[at[k] : at[k + 1]], np.uint32(end)).astype("<u4")
                    first = len(own) - (-(-len(own) // capacity) - 1) * capacity
                    edges = [0, *range(first, len(own) + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        rows.append((doc_id, piece, a, b - a, own[a:b].tobytes()))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


_PIECE = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())


def filled_bins(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how often) that use up the given number of pieces of each length.

    Small pieces wait until the others are packed and then go to the tightest gap. Which
    pieces are small is tried out; the plan with the fewest bins is taken.
    """
    plans = []
    for share in SMALL:
        small = {k: n for k, n in counts.items() if k <= capacity * share}
        bins = _two_fit({k: n for k, n in counts.items() if k not in small}, capacity)
        plans.append(_fill_gaps(bins, small, capacity))
    return min(plans, key=lambda bins: sum(times for _, times in bins))


def _two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    lengths = np.arange(capacity + 1)
    bins = []
    while left.any():
        free = left.copy()
        own: list[int] = []
        gap = capacity
        while gap:
            fits = np.flatnonzero(free[1 : gap + 1])
            if not len(fits):
                break
            own.append(int(fits[-1]) + 1)
            free[own[-1]] -= 1
            gap -= own[-1]
        while gap and (pair := _tighter_pair(free, lengths, gap + min(own), min(own))):
            gap += min(own) - sum(pair)
            free[min(own)] += 1
            own.remove(min(own))
            own += pair
            np.subtract.at(free, pair, 1)
        uses = Counter(own)
        times = min(int(left[length]) // n for length, n in uses.items())
        for length, n in uses.items():
            left[length] -= times * n
        bins.append((sorted(own, reverse=True), times))
    return bins


def _fill_gaps(bins: list[tuple[list[int], int]], small: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Puts the small pieces, longest first, into the smallest gaps that hold them, then into new bins."""
    by_gap: dict[int, list[tuple[list[int], int]]] = {}
    for own, times in bins:
        by_gap.setdefault(capacity - sum(own), []).append((own, times))
    for length in sorted(small, reverse=True):
        n = small[length]
        while n:
            gap = min((g for g, held in by_gap.items() if g >= length and held), default=None)
            if gap is None:
                each = min(n, capacity // length)
                by_gap.setdefault(capacity - each * length, []).append(([length] * each, n // each))
                n %= each
                continue
            own, times = by_gap[gap].pop()
            used = min(n, times)
            if used < times:
                by_gap[gap].append((own, times - used))
            by_gap.setdefault(gap - length, []).append(([*own, length], used))
            n -= used
    return [held for group in by_gap.values() for held in group]


def _tighter_pair(free: np.ndarray, lengths: np.ndarray, room: int, smallest: int) -> list[int] | None:
    """Two free lengths with the largest sum that fits in room and is above the smallest, if any."""
    largest = np.maximum.accumulate(np.where(free > 0, lengths, 0))
    one = np.flatnonzero(free[:room])
    other = largest[room - one]
    alone = (other == one) & (free[one] < 2)
    other[alone] = largest[np.maximum(one[alone] - 1, 0)]
    sums = np.where(other > 0, one + other, 0)
    if not len(sums) or sums.max() <= smallest:
        return None
    best = int(sums.argmax())
    return [int(one[best]), int(other[best])]


def _slots(bins: list[tuple[list[int], int]]) -> pd.DataFrame:
    """For each length and run of ranks: the first bin and the place in it."""
    rows, taken, sequence = [], Counter(), 0
    for own, times in bins:
        offset = 0
        for length in own:
            rows.append((length, taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and a length from 1 to capacity."""
    spark = pieces.sparkSession
    short = pieces.where(F.col("length") < capacity)
    counts = {r["length"]: r["n"] for r in short.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bins = filled_bins(counts, capacity)
    n_bins = sum(times for _, times in bins)
    slots = _slots(bins)
    at = spark.sparkContext.broadcast(
        {c: slots[c].to_numpy(np.int64) for c in slots.columns} | {"key": slots["length"].to_numpy(np.int64) << 44 | slots["rank"].to_numpy(np.int64)}
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        plan = at.value
        k = np.searchsorted(plan["key"], length.to_numpy(np.int64) << 44 | rank.to_numpy(np.int64), "right") - 1
        own = plan["sequence"][k] + rank.to_numpy(np.int64) - plan["rank"][k]
        return pd.DataFrame({"sequence_id": own, "offset": plan["offset"][k]})

    salts = max(64, sum(counts.values()) // ROWS_PER_SALT)
    others = [c for c in pieces.columns if c not in ("doc_id", "piece")]
    short = short.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = short.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    bases = bases.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", *[c for c in others if c != "length"])
    ranked = short.withColumn("_rank", F.row_number().over(within) - 1).join(bases, ["length", "_salt"])
    placed = ranked.withColumn("_place", place("length", F.col("_base") + F.col("_rank")))
    placed = placed.select(*pieces.columns, "_place.sequence_id", "_place.offset")
    full = pieces.where(F.col("length") == capacity)
    return placed.unionByName(
        full.withColumns({"sequence_id": F.lit(n_bins) + F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """Every piece of every document with its place; ids_crc32 stands for the ids unless they are asked for."""
    made = pieces(docs, tokenizer, capacity, end)
    if not ids:
        made = made.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(saved(made, "pieces"), capacity)
