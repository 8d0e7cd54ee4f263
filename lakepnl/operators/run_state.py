"""Run state: fold of an update log, layer gates, job events, archive.

An update has pk, sk, env_key, business_date, seq, t and kind. Kind `layer` carries
layer, status and error; kind `table` carries table_name, lane, status and s3_key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl.functions.casts import truthy
from lakepnl.functions.run_keys import (
    PROJECT,
    archive_key,
    job_layer,
    partition_key,
    script_layer,
    sort_key,
)
from lakepnl.operators.ordered import ROWS_PER_RANGE, position_in_order
from lakepnl.schemas import EXPECTED_RAW_TABLES, LAYERS, LEGACY_LAYER_KEYS, PREVIOUS_LAYER
from lakepnl.sources.layers import write_archive
from lakepnl.sources.published import current, is_published, publish, read_published, stage, upsert

LAYER_KEYS = (*LAYERS, *LEGACY_LAYER_KEYS.values())
ERROR_LENGTH = 2000
#: Parts of a day of stored items, by run: an upsert rewrites those that it has runs of.
ITEM_BUCKETS = 8
ITEM_PARTS = ["day", "bucket"]
LOOKUP_BUCKETS = 64


def _latest(value: Column, hit: Column) -> Column:
    """Value of the last update that hits; other updates have no sequence and lose."""
    return F.max_by(value, F.when(hit, F.col("seq")))


def last_updates(updates: DataFrame) -> DataFrame:
    """The last update of each layer and each table of a run, whatever their names.

    Names and sequences go through a hash aggregate; the long columns of an update, such as
    its error, are only fetched for the winners. An update that was delivered twice counts once.
    """
    names = ["pk", "sk", "kind", "name"]
    named = updates.withColumn(
        "name", F.when(F.col("kind") == "layer", F.col("layer")).otherwise(F.col("table_name"))
    )
    last = named.groupBy(*names).agg(F.max("seq").alias("seq"))
    same = [named[c].eqNullSafe(last[c]) for c in [*names, "seq"]]
    return named.join(last, same, "left_semi").dropDuplicates([*names, "seq"])


def fold(updates: DataFrame) -> DataFrame:
    """One item per run: the last write of each layer and of each table wins.

    A run's maps have one entry for each of its layers and tables, known or not. `error` is
    cut to the length of the run table's column; `full_error` is the whole text.
    """
    layer_doc = F.struct(
        F.col("status").alias("status"),
        F.col("t").alias("updated_at"),
        F.substring("error", 1, ERROR_LENGTH).alias("error"),
        F.col("error").alias("full_error"),
        F.col("seq").alias("seq"),
    )
    table_doc = F.struct(
        F.col("lane").alias("lane"),
        F.col("status").alias("status"),
        F.col("s3_key").alias("s3_key"),
        F.col("t").alias("updated_at"),
        F.col("seq").alias("seq"),
    )

    def entries(kind: str, doc: Column) -> Column:
        pairs = F.collect_list(F.when(F.col("kind") == kind, F.struct("name", doc.alias("doc"))))
        return F.map_from_entries(F.filter(pairs, lambda p: p["name"].isNotNull()))

    # Keys of a run are in its every update, so they need no pass over long rows.
    return (
        last_updates(updates)
        .groupBy("pk", "sk")
        .agg(
            F.max("env_key").alias("env_key"),
            F.max("business_date").alias("business_date"),
            F.max_by("t", "seq").alias("updated_at"),
            entries("layer", layer_doc).alias("layers"),
            entries("table", table_doc).alias("tables"),
        )
    )


def raw_layer_status(
    items: DataFrame, expected: tuple[str, ...] = EXPECTED_RAW_TABLES
) -> DataFrame:
    """SUCCEEDED once every expected table is validated, else PENDING with those awaited."""
    awaited = F.filter(
        F.array(*[F.lit(n) for n in expected]),
        lambda n: F.coalesce(F.try_element_at("tables", n)["status"], F.lit("")) != "validated",
    )
    return items.withColumn("awaiting_tables", awaited).withColumn(
        "raw_status", F.when(F.size("awaiting_tables") == 0, "SUCCEEDED").otherwise("PENDING")
    )


def with_raw_layer(items: DataFrame, expected: tuple[str, ...] = EXPECTED_RAW_TABLES) -> DataFrame:
    """Items whose layer `raw` is what their tables say, so that the next gate sees it."""
    judged = raw_layer_status(items, expected)
    # The run's own entry, if there is one, only gives way in status and time.
    doc = F.struct(
        F.col("raw_status").alias("status"),
        F.col("updated_at").alias("updated_at"),
        F.lit(None).cast("string").alias("error"),
        F.lit(None).cast("string").alias("full_error"),
        F.lit(None).cast("long").alias("seq"),
    )
    others = F.map_filter("layers", lambda name, _: name != "raw")
    layers = F.map_concat(others, F.create_map(F.lit("raw"), doc))
    return judged.withColumn("layers", layers).select(*items.columns)


def script_layers(results: DataFrame, scripts: dict[str, tuple[str, ...]]) -> DataFrame:
    """Status of each warehouse layer of a run, from the results of its scripts.

    Results have pk, sk, seq, script and status. A layer fails with the last result of
    any of its scripts, and succeeds only when all of them have; else it is PENDING.
    """
    names = [s for group in scripts.values() for s in group]
    last = results.groupBy("pk", "sk").agg(
        *[
            _latest(F.col("status"), F.col("script") == name).alias(f"_{i}")
            for i, name in enumerate(names)
        ]
    )
    columns = {}
    for layer, group in scripts.items():
        states = F.array(*[F.coalesce(f"_{names.index(s)}", F.lit("")) for s in group])
        columns[layer] = (
            F.when(F.array_contains(states, "FAILED"), "FAILED")
            .when(F.forall(states, lambda s: s == "SUCCEEDED"), "SUCCEEDED")
            .otherwise("PENDING")
        )
    return last.select("pk", "sk", *[c.alias(f"{n}_status") for n, c in columns.items()])


def execution_log(updates: DataFrame, rows: int = ROWS_PER_RANGE) -> DataFrame:
    """The log of each run as rows with their position: appended in sequence order.

    A run of any length stays distributed; see `position_in_order`.
    """
    return position_in_order(updates, ["pk", "sk"], "seq", "position", rows=rows)


def layer_status(layers: Column, layer: Column) -> Column:
    return F.upper(F.coalesce(F.try_element_at(layers, layer)["status"], F.lit("")))


def layer_succeeded(layers: Column, layer: Column) -> Column:
    """Whether a layer succeeded, under its key or under the key that older runs wrote."""
    legacy = F.lit(False)
    for key, old in LEGACY_LAYER_KEYS.items():
        legacy = legacy | ((layer == key) & (layer_status(layers, F.lit(old)) == "SUCCEEDED"))
    return (layer_status(layers, layer) == "SUCCEEDED") | legacy


def previous_layer(layer: Column) -> Column:
    expr = F
    for name, before in PREVIOUS_LAYER.items():
        expr = expr.when(layer == name, before)
    return expr


def gate(requests: DataFrame, items: DataFrame, skip_check: bool | str = False) -> DataFrame:
    """Adds previous_layer, allowed and reason to requests for a layer of a run.

    Requests carry layer, business_date, batch_id and env. The first layer and an
    unknown one have nothing to wait for. Items have one row per run, so the join
    keeps the requests' rows, and a run with very many requests is split by AQE.
    """
    run = requests.withColumns(
        {
            "pk": partition_key(F.lit(PROJECT), F.col("env"), F.col("business_date")),
            "sk": sort_key(F.col("batch_id")),
            "previous_layer": previous_layer(F.col("layer")),
        }
    )
    joined = run.join(items.select("pk", "sk", "layers"), ["pk", "sk"], "left")
    before = F.col("previous_layer")
    nameless = (F.coalesce("business_date", F.lit("")) == "") | (
        F.coalesce("batch_id", F.lit("")) == ""
    )
    reason = (
        F.when(F.lit(truthy(skip_check)) | before.isNull(), F.lit(None).cast("string"))
        .when(nameless, "business date and batch id are required")
        .when(
            ~F.coalesce(layer_succeeded(F.col("layers"), before), F.lit(False)),
            F.concat(
                before,
                F.lit(" is not SUCCEEDED but '"),
                F.coalesce(layer_status(F.col("layers"), before), F.lit("")),
                F.lit("'"),
            ),
        )
    )
    return (
        joined.withColumn("reason", reason)
        .withColumn("allowed", F.col("reason").isNull())
        .drop("layers")
    )


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _or(first: Column, second: Column) -> Column:
    return F.when(F.coalesce(first, F.lit("")) != "", first).otherwise(second)


def job_status(
    events: DataFrame, as_of: str, env: str = "dev", self_reports: bool | str = False
) -> DataFrame:
    """State changes of lake jobs as layer updates.

    Events carry job_name, run_id, state, business_date, batch_id and message. The
    business date defaults to `as_of`, the batch to glue- and the run id; `batch_label` is
    that batch with the head of the run id only.
    `skipped` says why an event counts for nothing; `recorded` is off for a success
    that the job has recorded itself.
    """
    layer = job_layer(F.col("job_name"))
    status = F.when(F.upper(_text("state")) == "SUCCEEDED", "SUCCEEDED").otherwise("FAILED")
    day = _or(F.col("business_date"), F.lit(as_of))
    batch = _or(F.col("batch_id"), F.concat(F.lit("glue-"), F.col("run_id")))
    label = _or(F.col("batch_id"), F.concat(F.lit("glue-"), F.substring("run_id", 1, 12)))
    return (
        events.withColumns(
            {
                "skipped": F.when(
                    (_text("job_name") == "") | (_text("run_id") == ""), "missing name or run id"
                ).when(layer.isNull(), "unknown job"),
                "layer": layer,
                "status": status,
                "pk": partition_key(F.lit(PROJECT), F.lit(env), day),
                "sk": sort_key(batch),
                "error": F.col("message"),
                "batch_label": label,
            }
        )
        .withColumn(
            "recorded",
            F.col("skipped").isNull()
            & ~((F.col("status") == "SUCCEEDED") & F.lit(truthy(self_reports))),
        )
        .withColumns(
            {
                c: F.when(F.col("skipped").isNull(), F.col(c))
                for c in ("layer", "status", "pk", "sk", "batch_label")
            }
        )
    )


def direct_chain(statuses: DataFrame, stream_chain: bool | str = False) -> DataFrame:
    """Requests for the second lake job after a success of the first, where no stream
    router does it."""
    done = (F.col("layer") == "lake_validated_to_standardized") & (F.col("status") == "SUCCEEDED")
    return statuses.where(done & F.lit(not truthy(stream_chain))).withColumn(
        "next_job", F.lit("standardized_to_silver")
    )


def run_context(requests: DataFrame) -> DataFrame:
    """Run of a script request: load date before session date, batch `default`.

    A blank but not empty load date hides the session date, and leaves no run.
    """
    first = _or(F.col("load_date"), _text("session_date"))
    day = F.nullif(F.trim(first), F.lit(""))
    batch = F.trim(_or(F.col("batch_id"), F.lit("default")))
    return requests.withColumns(
        {
            "business_date": day,
            "run_batch": F.when(
                day.isNotNull(), F.when(batch == "", "default").otherwise(batch)
            ),
            "has_run": day.isNotNull(),
        }
    )


def gate_scripts(
    requests: DataFrame, items: DataFrame, skip_check: bool | str = False
) -> DataFrame:
    """The gate for requests to run a warehouse script, by the layer the script builds.

    Requests carry script, env, load_date, session_date and batch_id. A request that
    names no run, or a script of no layer, has nothing to wait for.
    """
    asked = run_context(requests).withColumns(
        {"batch_id": F.col("run_batch"), "layer": script_layer(F.col("script"))}
    )
    return (
        gate(asked, items, skip_check)
        .withColumn("reason", F.when(F.col("has_run"), F.col("reason")))
        .withColumn("allowed", F.col("reason").isNull())
    )


def runs_before(items: DataFrame, env_key: str, business_date: str) -> DataFrame:
    """Runs of an environment before a business date; both are plain filters, and prune
    where the items are partitioned by business_date."""
    return items.where(
        (F.col("env_key") == env_key) & (F.col("business_date") < F.lit(business_date))
    )


def cutoff_date(as_of: str, retention_days: int = 30) -> Column:
    return F.date_format(F.date_sub(F.lit(as_of).cast("date"), retention_days), "yyyy-MM-dd")


def is_expired(env_key: str, as_of: str, retention_days: int = 30) -> Column:
    """Whether an item goes to the archive; an item without a date stays."""
    old = F.col("business_date") < cutoff_date(as_of, retention_days)
    return F.coalesce((F.col("env_key") == env_key) & old, F.lit(False))


def archive_errors(outcomes: DataFrame) -> DataFrame:
    """Every error of an archive run: pk, sk and its text."""
    return outcomes.where("error is not null").select(
        "pk", "sk", F.concat_ws(":", F.lit("s3_put"), "pk", "sk", "error").alias("text")
    )


def archive_summary(
    outcomes: DataFrame, as_of: str, retention_days: int = 30, sample: int = 20
) -> DataFrame:
    """Counters of an archive run and its limits, with the first errors by key for display.

    `outcomes` has pk, sk, error, which is NULL for an archived item, and deleted. All errors
    are rows of `archive_errors`; the sample is a top-n, so few texts are brought together.
    """
    totals = outcomes.agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("error").isNull()).alias("archived"),
        F.count_if(F.coalesce("deleted", F.lit(False))).alias("deleted"),
        F.count_if(F.col("error").isNotNull()).alias("error_count"),
    )
    first = (
        archive_errors(outcomes)
        .select("text")
        .orderBy("text")
        .limit(sample)
        .agg(F.sort_array(F.collect_list("text")).alias("errors"))
    )
    counters = ("processed", "archived", "deleted", "error_count")
    # Two single rows put into one.
    return (
        totals.unionByName(first, allowMissingColumns=True)
        .agg(
            *[F.max(c).alias(c) for c in counters],
            F.first("errors", ignorenulls=True).alias("errors"),
        )
        .withColumns({"cutoff_date": cutoff_date(as_of, retention_days), "retention_days": F.lit(retention_days)})
    )


def _stored_items(items: DataFrame) -> DataFrame:
    """Items with the columns of their place in the stored state: the day, and a part of it by run."""
    return items.withColumns(
        {"day": F.nullif("business_date", F.lit("")), "bucket": F.pmod(F.xxhash64("pk", "sk"), F.lit(ITEM_BUCKETS)).cast("int")}
    )


def read_items(spark: SparkSession, path: str, days: list[str] | None = None) -> DataFrame:
    """The stored run items, or those of some business dates."""
    keep = None if days is None else lambda part: (part.values[0] or "") in days
    return read_published(spark, path, keep).drop("day", "bucket")


def upsert_items(items: DataFrame, path: str) -> None:
    """Puts items in the place of stored ones of the same run, in one step.

    Only the parts, a day and bucket each, that hold one of the runs are read and written again.
    """
    upsert(_stored_items(items), path, ["pk", "sk"], ITEM_PARTS)


def write_lookup(items: DataFrame, table: str, path: str, buckets: int = LOOKUP_BUCKETS) -> None:
    """A catalog table of the items for gates and lookups: by environment and day, and in buckets by run.

    Joins on (pk, sk) read it bucket by bucket, so only the other side is shuffled, however many items
    there are; filters on env_key and day prune. It is replaced as a whole and follows the stored
    state, which stays the truth.
    """
    dealt = items.withColumn("day", F.nullif("business_date", F.lit(""))).repartition(buckets, "pk", "sk")
    (
        dealt.write.format("parquet")
        .mode("overwrite")
        .option("path", path)
        .partitionBy("env_key", "day")
        .bucketBy(buckets, "pk", "sk")
        .sortBy("pk", "sk")
        .saveAsTable(table)
    )


def merge_updates(updates: DataFrame, path: str, expected: tuple[str, ...] = EXPECTED_RAW_TABLES) -> None:
    """Folds updates into the stored items: an entry gives way to one with the same or a later sequence.

    Updates without a sequence come after all that is stored. Layer `raw` follows from the
    tables. Names that the updates do not mention stay as they are.
    """
    spark = updates.sparkSession
    fresh = fold(updates.withColumn("seq", F.coalesce("seq", F.lit(current(spark, path).number + 1).cast("long"))))
    if is_published(spark, path):
        days = [r[0] for r in fresh.select("business_date").distinct().collect()]
        stored = read_items(spark, path, [d or "" for d in days])
        old = stored.select("pk", "sk", *[F.col(c).alias(f"_{c}") for c in ("layers", "tables", "updated_at")])

        def together(name: str) -> Column:
            before = F.coalesce(F.col(f"_{name}"), F.map_filter(name, lambda k, v: F.lit(False)))
            latest = F.map_filter(F.col(name), lambda k, v: F.coalesce(v["seq"] >= F.try_element_at(before, k)["seq"], F.lit(True)))
            return F.map_concat(F.map_filter(before, lambda k, v: ~F.map_contains_key(latest, k)), latest)

        same = [fresh[k].eqNullSafe(old[k]) for k in ("pk", "sk")]
        fresh = fresh.join(old, same, "left").select(
            *[fresh[c] for c in ("pk", "sk", "env_key", "business_date")],
            F.greatest(fresh["updated_at"], F.col("_updated_at")).alias("updated_at"),
            together("layers").alias("layers"),
            together("tables").alias("tables"),
        )
    upsert_items(with_raw_layer(fresh, expected), path)


def archive_items(spark: SparkSession, path: str, archive: str, env_key: str, as_of: str, retention_days: int = 30) -> None:
    """Moves expired items of a stored run state to the archive, in two steps.

    First all of them are written to the archive, where each replaces itself; then one step
    leaves them out of the state. A run that stops before the second one has moved nothing, and done
    again it writes the same items over themselves. At no time is an item in neither place.
    """
    before = current(spark, path)
    if before.schema is None:
        return
    expired = is_expired(env_key, as_of, retention_days)
    old = read_published(spark, path, lambda p: (p.values[0] or "") < as_of, before).where(expired)
    keyed = old.drop(*ITEM_PARTS).withColumn("archive_key", archive_key(F.col("pk"), F.col("sk")))
    write_archive(keyed, archive)
    touched = {tuple(r) for r in old.select("day", F.col("bucket").cast("string")).distinct().collect()}
    if not touched:
        return
    rest = read_published(spark, path, lambda p: p.values in touched, before).where(~expired)
    schema, parts = stage(rest, path, ITEM_PARTS)
    publish(spark, path, ITEM_PARTS, schema, parts, lambda p: p.values in touched, before)
