"""Run state: fold, gates, routing, job events, archive and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl import fixtures as fx
from lakepnl.functions import run_keys as rk
from lakepnl.operators import run_state as rs
from lakepnl.operators.ordered import previous_in_order
from lakepnl.schemas import LAYER_SCRIPTS, LAYERS
from lakepnl.session import new_folder, stored
from lakepnl.streaming import router
from lakepnl.streaming import transitions as tr

AS_OF = "2024-02-10"
PROD = "PIPE#reporting#prod"
RANGE = 4096
#: Rows of a range of the log.
RUN_ROWS = 1000
SLICES = 4


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.fold(fx.run_updates(spark, sf_dir))


def run_state_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = F.col("layers")
    return items(spark, sf_dir).select(
        "pk",
        "sk",
        "env_key",
        "business_date",
        "updated_at",
        *[rs.layer_status(layers, F.lit(n)).alias(f"{n}_status") for n in rs.LAYER_KEYS],
        F.try_element_at(layers, F.lit("raw"))["updated_at"].alias("raw_updated_at"),
        F.length(F.try_element_at(layers, F.lit("gold"))["error"]).alias("gold_error_length"),
        F.length(F.try_element_at(layers, F.lit("gold"))["full_error"]).alias("gold_full_error_length"),
        F.try_element_at("tables", F.lit("trade_event"))["s3_key"].alias("trade_event_key"),
        F.size("tables").alias("tables_seen"),
    )


def run_state_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fold over layers and tables that no list knows, each update delivered twice."""
    extra = F.col("seq") % 3 == 0
    updates = fx.run_updates(spark, sf_dir).withColumns(
        {
            "layer": F.when(extra, F.concat(F.lit("new_"), "layer")).otherwise(F.col("layer")),
            "table_name": F.when(extra, F.concat(F.lit("new_"), "table_name")).otherwise(F.col("table_name")),
        }
    )
    folded = rs.fold(updates.unionByName(updates))

    def entries(column: str, kind: str) -> DataFrame:
        return folded.select("pk", "sk", F.explode(column).alias("name", "doc")).select(
            "pk", "sk", F.lit(kind).alias("kind"), "name", "doc.status", "doc.updated_at"
        )

    return entries("layers", "layer").unionByName(entries("tables", "table"))


def raw_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate of the first lake job, which waits for the raw tables of its run."""
    runs = items(spark, sf_dir)
    requests = runs.select(
        "business_date", rk.batch_of(F.col("sk")).alias("batch_id"), rk.env_of(F.col("pk")).alias("env")
    ).withColumn("layer", F.lit("lake_validated_to_standardized"))
    return rs.gate(requests, rs.with_raw_layer(runs)).select("pk", "sk", "allowed", "reason")


def raw_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.raw_layer_status(items(spark, sf_dir)).select(
        "pk", "sk", "raw_status", F.concat_ws(",", "awaiting_tables").alias("awaiting_tables")
    )


def execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.execution_log(fx.run_updates(spark, sf_dir), RUN_ROWS).select(
        "pk", "sk", "position", "seq", "t", "layer", "action", "status"
    )


def runs_by_env_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.runs_before(items(spark, sf_dir), PROD, "2024-01-16").select(
        "pk", "sk", "business_date"
    )


def retention_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items(spark, sf_dir).where(rs.is_expired(PROD, AS_OF)).select(
        "pk", "sk", "business_date", rs.cutoff_date(AS_OF).alias("cutoff_date")
    )


def script_layer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of the four warehouse scripts, by user, folded to their two layers."""
    names = [s for group in LAYER_SCRIPTS.values() for s in group]
    script = fx.pick(F.col("user_id") % 7 % 5, dict(enumerate(names)), "ddl/other.sql")
    results = fx.run_events(spark, sf_dir).select(
        "pk", "sk", "seq", script.alias("script"), "status"
    )
    return rs.script_layers(results, LAYER_SCRIPTS)


def run_archive_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived items as read back from the archive, and the stored items that stay.

    The items are stored, put once more in their own place, and archived twice over.
    """
    path, state = new_folder(spark, "archive"), new_folder(spark, "run-state")
    every = items(spark, sf_dir)
    for _ in range(2):
        rs.upsert_items(every, state)
        rs.archive_items(spark, state, path, PROD, AS_OF)
    names = ["pk", "sk", "business_date"]
    stored = (
        spark.read.schema(
            "pk string, sk string, business_date string, archive_key string, "
            "year string, month string, day string, item string"
        )
        .json(path)
        .select(
            *names,
            F.lit("archived").alias("outcome"),
            F.concat_ws("/", "year", "month", "day", "archive_key").alias("archive_key"),
        )
    )
    kept = rs.read_items(spark, state).select(
        *names, F.lit("kept").alias("outcome"), F.lit("").alias("archive_key")
    )
    return stored.unionByName(kept)


def archive_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.run_events(spark, sf_dir).select(
        "pk",
        F.concat_ws("-", "sk", "seq").alias("sk"),
        F.when(F.col("status") == "FAILED", F.concat(F.lit("failed at "), "t")).alias("error"),
        (F.col("status") == "SUCCEEDED").alias("deleted"),
    )


def archive_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.archive_summary(archive_outcomes(spark, sf_dir), AS_OF).select(
        "processed",
        "archived",
        "deleted",
        "error_count",
        F.concat_ws("|", "errors").alias("errors"),
        "cutoff_date",
        "retention_days",
    )


def archive_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.archive_errors(archive_outcomes(spark, sf_dir))


def gate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.run_events(spark, sf_dir)
    n = F.col("user_id") % 13
    return events.select(
        F.col("seq").alias("request_id"),
        "env",
        F.when(n == 1, F.date_add("business_date", 60).cast("string"))
        .when(n == 2, "")
        .otherwise(F.col("business_date"))
        .alias("business_date"),
        F.when(n == 3, F.lit(None).cast("string")).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(F.col("layer") == "redshift", "redshift_silver").otherwise(F.col("layer")).alias("layer"),
    )


def layer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.gate(gate_requests(spark, sf_dir), items(spark, sf_dir)).select(
        "request_id", "layer", "previous_layer", "allowed", "reason"
    )


def gate_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over the bucketed lookup table of the items."""
    table = f"run_items_{uuid.uuid4().hex}"
    rs.write_lookup(items(spark, sf_dir), table, new_folder(spark, "lookup"), 8)
    allowed = rs.gate(gate_requests(spark, sf_dir), spark.table(table))
    found = stored(allowed.select("request_id", "layer", "previous_layer", "allowed", "reason"), "gate")
    # Nothing of the trial stays in the catalog.
    spark.sql(f"DROP TABLE {table}")
    return found


def script_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for warehouse scripts, some of which name no run."""
    n = F.col("user_id") % 7
    requests = fx.run_events(spark, sf_dir).select(
        F.col("seq").alias("request_id"),
        "env",
        fx.pick(F.col("user_id") % 3, {0: "copy_s3_to_silver/a.sql", 1: "silver_to_gold/b.sql"}, "ddl/c.sql").alias("script"),
        F.when(n == 1, "").when(n != 2, F.col("business_date")).alias("load_date"),
        F.when(n == 2, F.col("business_date")).otherwise("").alias("session_date"),
        "batch_id",
    )
    return rs.gate_scripts(requests, items(spark, sf_dir)).select("request_id", "layer", "allowed", "reason")


def legacy_layer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = F.col("layers")
    return items(spark, sf_dir).select(
        "pk",
        "sk",
        *[rs.layer_succeeded(layers, F.lit(n)).alias(f"{n}_ok") for n in LAYERS],
    )


def transition_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = previous_in_order(
        fx.run_events(spark, sf_dir), ["pk", "sk", "layer"], "seq", "status", "before"
    )
    return events.where(
        (F.col("status") == "SUCCEEDED") & (F.coalesce("before", F.lit("")) != "SUCCEEDED")
    ).select("pk", "sk", "layer", "seq", "before")


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.just_succeeded(fx.change_feed(spark, sf_dir, RANGE))


def route_next_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.route(transitions(spark, sf_dir)).select("seq", "layer", "action", "target")


def next_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.next_requests(tr.route(transitions(spark, sf_dir)))


def execution_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Batch ids of every length, with characters that a name may not have.
    text = F.concat_ws(" ", "event_type", "props", F.repeat("event_type", 6))
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        rk.execution_name(
            F.lit("cp"),
            F.col("ts").cast("date").cast("string"),
            F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string")).otherwise(text),
            F.col("event_id").cast("string"),
        ).alias("execution_name"),
    )


def run_key_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("user_id") % 7
    rows = fx.run_events(spark, sf_dir).select(
        "seq",
        F.when(n == 1, "PIPE#other").otherwise(F.col("pk")).alias("pk"),
        F.when(n == 2, F.col("batch_id"))
        .when(n == 3, F.concat(F.lit("  "), "sk", F.lit(" ")))
        .when(n == 4, F.lit(None).cast("string"))
        .otherwise(F.col("sk"))
        .alias("sk"),
        F.when(F.col("user_id") % 2 == 0, F.lit(None).cast("string"))
        .when(n == 5, "  ")
        .otherwise(F.col("business_date"))
        .alias("business_date"),
    )
    return rows.select(
        "seq",
        rk.business_date_of(F.col("business_date"), F.col("pk")).alias("business_date"),
        rk.batch_of(F.col("sk")).alias("batch_id"),
    )


def classify_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    kind = F.col("event_type")
    user = F.col("user_id").cast("string")
    script = (
        F.when(kind == "error", F.concat(F.lit("copy_s3_to_silver/t"), user, F.lit(".sql")))
        .when(kind == "click", F.concat(F.lit("x\\COPY_S3_TO_SILVER\\"), user))
        .when(kind == "view", F.concat(F.lit("Silver_To_Gold/"), user))
        .when(kind == "signup", F.concat(F.lit("jobs/a_to_gold_"), user))
        .otherwise(F.concat(F.lit("ddl/"), user))
    )
    job = (
        F.when(kind == "error", F.concat(F.lit("dev_Validated_to_std_"), user))
        .when(kind == "click", F.concat(F.lit("PROD-STD-TO-SILVER-"), user))
        .when(kind == "view", F.concat(F.lit("std_to-silver"), user))
        .otherwise(F.concat(F.lit("report-"), user))
    )
    return events.select(
        "event_id",
        rk.script_layer(script).alias("script_layer"),
        rk.job_layer(job).alias("job_layer"),
    )


def job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id")
    name = (
        F.when(kind == "click", "dev_validated_to_std")
        .when(kind == "view", "DEV-STD-TO-SILVER")
        .when(kind == "signup", "other")
        .when(kind == "error", "x-validated_to_std-y")
    )
    return fx.run_events(spark, sf_dir).select(
        F.col("seq").alias("event_id"),
        name.alias("job_name"),
        F.when(user % 11 != 0, F.concat(F.lit("jr_0123456789"), "seq")).alias("run_id"),
        F.when(F.col("status") == "SUCCEEDED", F.when(user % 2 == 0, "Succeeded").otherwise("SUCCEEDED"))
        .when(F.col("status") == "PENDING", "TIMEOUT")
        .alias("state"),
        F.when(user % 3 != 0, F.col("business_date")).alias("business_date"),
        F.when(user % 4 != 0, F.col("batch_id")).alias("batch_id"),
        F.col("t").alias("message"),
    )


def job_event_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.job_status(job_events(spark, sf_dir), AS_OF, self_reports=True).select(
        "event_id", "skipped", "layer", "status", "pk", "sk", "batch_label", "recorded"
    )


def direct_chain_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rs.direct_chain(rs.job_status(job_events(spark, sf_dir), AS_OF)).select(
        "event_id", "next_job", "business_date", "batch_id"
    )


def run_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, user = F.col("user_id") % 5, F.col("user_id")
    requests = fx.run_events(spark, sf_dir).select(
        F.col("seq").alias("request_id"),
        F.when(n == 0, F.concat(F.lit(" "), "business_date"))
        .when(n == 1, "")
        .when(n == 2, "  ")
        .alias("load_date"),
        F.when(n != 4, F.lit("2024-03-01")).alias("session_date"),
        F.when(user % 3 == 0, F.concat(F.lit(" b"), "user_id"))
        .when(user % 3 == 1, " ")
        .alias("batch_id"),
    )
    return rs.run_context(requests).select(
        "request_id", "business_date", F.col("run_batch").alias("batch_id"), "has_run"
    )


def _slices(df: DataFrame, path: str) -> list[DataFrame]:
    """Rows written once, cut by sequence into slices that are delivered one by one."""
    last = df.agg(F.max("seq")).first()[0]
    piece = F.least(F.floor(F.col("seq") * SLICES / F.lit(last + 1)), F.lit(SLICES - 1))
    df.withColumn("slice", piece).write.partitionBy("slice").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    return [stored.where(F.col("slice") == i).drop("slice") for i in range(SLICES)]


def stream_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The router fed slice by slice, out of order and with one slice delivered twice."""
    feed, out = new_folder(spark, "feed"), new_folder(spark, "requests")
    checkpoint = new_folder(spark, "checkpoint")
    parts = _slices(fx.change_feed(spark, sf_dir, RANGE), new_folder(spark, "slices"))
    for part in [parts[0], parts[2], parts[1], parts[3], parts[1]]:
        part.write.mode("append").parquet(feed)
        router.start_router(spark, feed, out, checkpoint).awaitTermination()
    return router.read_requests(spark, out)


def stream_transition_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions from statuses alone, with the events of a key carried between micro-batches.

    Slices come out of order, one comes twice and one holds each event twice; what is left
    is what the whole log gives at once.
    """
    events, out = new_folder(spark, "events"), new_folder(spark, "transitions")
    checkpoint = new_folder(spark, "checkpoint")
    rows = fx.run_events(spark, sf_dir).select("seq", "pk", "sk", "layer", "status")
    parts = _slices(rows, new_folder(spark, "slices"))
    for part in [parts[2].unionByName(parts[2]), parts[0], parts[3], parts[0], parts[1]]:
        part.write.mode("append").parquet(events)
        router.start_transitions(spark, events, out, checkpoint).awaitTermination()
    return router.read_transitions(spark, out)


QUERIES = {
    "run_state_fold": run_state_fold,
    "run_state_names": run_state_names,
    "raw_completeness": raw_completeness,
    "raw_gate": raw_gate,
    "execution_log": execution_log,
    "runs_by_env_date": runs_by_env_date,
    "retention_candidates": retention_candidates,
    "script_layer_status": script_layer_status,
    "run_archive_split": run_archive_split,
    "archive_summary": archive_summary,
    "archive_errors": archive_errors,
    "layer_gate": layer_gate,
    "gate_lookup": gate_lookup,
    "legacy_layer_status": legacy_layer_status,
    "script_gate": script_gate,
    "transition_lag": transition_lag,
    "just_succeeded": transitions,
    "route_next_job": route_next_job,
    "next_requests": next_requests,
    "execution_name": execution_name,
    "run_key_parse": run_key_parse,
    "classify_layer": classify_layer,
    "job_event_status": job_event_status,
    "direct_chain_requests": direct_chain_requests,
    "run_context": run_context,
    "stream_router": stream_router,
    "stream_transition_state": stream_transition_state,
}

EVENTS = """
ev AS (
  SELECT event_id AS seq, user_id, event_type, value, props, user_id % 5 AS batch,
    CASE WHEN user_id % 5 < 2 THEN 'prod' ELSE 'dev' END AS env, strftime(ts, '%Y-%m-%d') AS business_date, ts,
    CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      ELSE rtrim(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0') END AS t,
    CASE event_type WHEN 'error' THEN 'raw' WHEN 'click' THEN 'lake_validated_to_standardized'
      WHEN 'view' THEN 'lake_standardized_to_silver' WHEN 'purchase' THEN 'gold'
      WHEN 'signup' THEN CASE WHEN user_id % 5 = 3 THEN 'redshift' ELSE 'redshift_silver' END END AS layer,
    CASE WHEN value > 20 THEN 'SUCCEEDED' WHEN value > 5 THEN 'PENDING' ELSE 'FAILED' END AS status
  FROM events
),
run_events AS (
  SELECT *, 'PIPE#reporting#' || env AS env_key, 'PIPE#reporting#' || env || '#BDATE#' || business_date AS pk,
    'RUN#' || batch AS sk FROM ev
)"""

LANE = "CASE WHEN value > 10 THEN 'validated' ELSE 'rejected' END"

STATE = f"""
layer_state AS (
  SELECT pk, sk, layer, max_by(status, seq) AS status, max_by(t, seq) AS updated_at,
    nullif(max_by(CASE WHEN value <= 5 THEN 2000 ELSE 0 END, seq), 0) AS error_length,
    nullif(max_by(CASE WHEN value <= 5 THEN 2500 ELSE 0 END, seq), 0) AS full_length
  FROM run_events GROUP BY pk, sk, layer
),
table_state AS (
  SELECT pk, sk, CASE WHEN user_id % 2 = 0 THEN 'price_history' ELSE 'trade_event' END AS table_name,
    max_by({LANE}, seq) AS status, max_by({LANE} || '/' || seq, seq) AS s3_key
  FROM run_events GROUP BY ALL
),
runs AS (
  SELECT pk, sk, any_value(env_key) AS env_key, any_value(business_date) AS business_date,
    max_by(t, seq) AS updated_at FROM run_events GROUP BY pk, sk
)"""


def _status(layer: str) -> str:
    return (
        f"coalesce((SELECT status FROM layer_state s WHERE s.pk = r.pk AND s.sk = r.sk "
        f"AND s.layer = '{layer}'), '')"
    )


def _table(column: str, name: str) -> str:
    return (
        f"(SELECT {column} FROM table_state s WHERE s.pk = r.pk AND s.sk = r.sk "
        f"AND s.table_name = '{name}')"
    )


def _ok(layer: str) -> str:
    if layer == "redshift_silver":
        return f"({_status(layer)} = 'SUCCEEDED' OR {_status('redshift')} = 'SUCCEEDED')"
    return f"{_status(layer)} = 'SUCCEEDED'"


PREVIOUS = """CASE layer WHEN 'lake_validated_to_standardized' THEN 'raw'
  WHEN 'lake_standardized_to_silver' THEN 'lake_validated_to_standardized'
  WHEN 'redshift_silver' THEN 'lake_standardized_to_silver' WHEN 'gold' THEN 'redshift_silver' END"""

LAGGED = """
lagged AS (
  SELECT *, lag(status) OVER (PARTITION BY pk, sk, layer ORDER BY seq) AS before FROM run_events
)"""

# The records that count: removals, foreign keys and images without layers drop out.
SUCCEEDED = """
succeeded AS (
  SELECT seq, pk, business_date, CAST(batch AS VARCHAR) AS batch_id, layer, env
  FROM lagged WHERE status = 'SUCCEEDED' AND coalesce(before, '') <> 'SUCCEEDED'
    AND user_id % 29 NOT IN (3, 7, 11)
)"""

ROUTED = """
routed AS (
  SELECT *, CASE WHEN layer IN ('raw', 'lake_validated_to_standardized') THEN 'StartJobRun' ELSE 'StartExecution' END
      AS action,
    CASE layer WHEN 'raw' THEN 'validated_to_standardized' WHEN 'lake_validated_to_standardized'
      THEN 'standardized_to_silver' WHEN 'lake_standardized_to_silver' THEN 'copy' ELSE 'gold' END AS target,
    CASE layer WHEN 'lake_standardized_to_silver' THEN 'cp' WHEN 'redshift_silver' THEN 'gd' END AS prefix
  FROM succeeded WHERE layer IN ('raw', 'lake_validated_to_standardized', 'lake_standardized_to_silver', 'redshift_silver')
)"""


def _sql(ctes: list[str], select: str) -> str:
    return f"WITH {','.join([EVENTS, *ctes])}\n{select}"


_REQUESTS = _sql(
    [LAGGED, SUCCEEDED, ROUTED],
    """SELECT seq, layer, action, target, business_date, batch_id, 'reporting' AS project, env AS environment,
  CASE WHEN prefix IS NOT NULL THEN business_date END AS load_date,
  CASE WHEN prefix IS NOT NULL THEN business_date END AS session_date,
  CASE WHEN prefix IS NOT NULL THEN prefix || '-' || business_date || '-' || batch_id || '-' ||
    sha256(pk || '|' || batch_id || '|' || layer || '|' || seq)[1:16] END AS execution_name
FROM routed""",
)

_JOBS = """
jobs AS (
  SELECT seq AS event_id, CASE event_type WHEN 'click' THEN 'lake_validated_to_standardized'
      WHEN 'error' THEN 'lake_validated_to_standardized' WHEN 'view' THEN 'lake_standardized_to_silver' END AS layer,
    CASE WHEN event_type = 'purchase' OR user_id % 11 = 0 THEN 'missing name or run id'
      WHEN event_type = 'signup' THEN 'unknown job' END AS skipped,
    CASE WHEN status = 'SUCCEEDED' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
    CASE WHEN user_id % 3 <> 0 THEN business_date END AS business_date,
    CASE WHEN user_id % 4 <> 0 THEN CAST(batch AS VARCHAR) END AS batch_id,
    'jr_0123456789' || seq AS run_id
  FROM run_events
)"""

_COMPARE = "SELECT pk, sk, layer, seq FROM lagged WHERE status = 'SUCCEEDED' AND coalesce(before, '') <> 'SUCCEEDED'"

ORACLES = {
    "run_state_fold": _sql(
        [STATE],
        f"""SELECT pk, sk, env_key, business_date,
  updated_at,
  {", ".join(f"{_status(n)} AS {n}_status" for n in rs.LAYER_KEYS)},
  (SELECT updated_at FROM layer_state s WHERE s.pk = r.pk AND s.sk = r.sk AND s.layer = 'raw') AS raw_updated_at,
  (SELECT error_length FROM layer_state s WHERE s.pk = r.pk AND s.sk = r.sk AND s.layer = 'gold') AS gold_error_length,
  (SELECT full_length FROM layer_state s WHERE s.pk = r.pk AND s.sk = r.sk AND s.layer = 'gold') AS gold_full_error_length,
  {_table('s3_key', 'trade_event')} AS trade_event_key,
  CAST((SELECT count(*) FROM table_state s WHERE s.pk = r.pk AND s.sk = r.sk) AS INTEGER) AS tables_seen
FROM runs r""",
    ),
    "raw_completeness": _sql(
        [STATE],
        f"""SELECT pk, sk, CASE WHEN te = 'validated' AND ph = 'validated' THEN 'SUCCEEDED' ELSE 'PENDING' END AS raw_status,
  concat_ws(',', CASE WHEN te <> 'validated' THEN 'trade_event' END, CASE WHEN ph <> 'validated' THEN 'price_history' END)
    AS awaiting_tables
FROM (SELECT pk, sk, coalesce({_table('status', 'trade_event')}, '') AS te,
  coalesce({_table('status', 'price_history')}, '') AS ph FROM runs r)""",
    ),
    "execution_log": _sql(
        [],
        f"""SELECT pk, sk, row_number() OVER (PARTITION BY pk, sk ORDER BY seq) - 1 AS position, seq, t, layer, action, status
FROM (SELECT pk, sk, seq * 2 AS seq, t, layer, 'layer_status' AS action, status FROM run_events
  UNION ALL SELECT pk, sk, seq * 2 + 1, t, 'raw', 'ingest_table', {LANE} FROM run_events)""",
    ),
    "runs_by_env_date": _sql(
        [STATE],
        f"SELECT pk, sk, business_date FROM runs WHERE env_key = '{PROD}' AND business_date < '2024-01-16'",
    ),
    "retention_candidates": _sql(
        [STATE],
        f"""SELECT pk, sk, business_date, '2024-01-11' AS cutoff_date FROM runs
WHERE env_key = '{PROD}' AND business_date < '2024-01-11'""",
    ),
    "script_layer_status": _sql(
        [
            """
results AS (
  SELECT pk, sk, user_id % 7 % 5 AS script, max_by(status, seq) AS status FROM run_events GROUP BY ALL
),
folded AS (
  SELECT pk, sk, script // 2 AS layer, count(*) FILTER (WHERE status = 'FAILED') AS failed,
    count(*) FILTER (WHERE status = 'SUCCEEDED') AS done FROM results WHERE script < 4 GROUP BY ALL
),
states AS (
  SELECT pk, sk, layer, CASE WHEN failed > 0 THEN 'FAILED' WHEN done = 2 THEN 'SUCCEEDED' ELSE 'PENDING' END AS status
  FROM folded
)""",
        ],
        """SELECT r.pk, r.sk, coalesce(max(status) FILTER (WHERE layer = 0), 'PENDING') AS redshift_silver_status,
  coalesce(max(status) FILTER (WHERE layer = 1), 'PENDING') AS gold_status
FROM (SELECT DISTINCT pk, sk FROM run_events) r LEFT JOIN states s ON r.pk = s.pk AND r.sk = s.sk GROUP BY r.pk, r.sk""",
    ),
    "run_archive_split": _sql(
        [STATE],
        f"""SELECT pk, sk, business_date, CASE WHEN old THEN 'archived' ELSE 'kept' END AS outcome,
  CASE WHEN old THEN replace(business_date, '-', '/') || '/' || replace(pk || '__' || sk, '#', '_') ELSE '' END AS archive_key
FROM (SELECT *, env_key = '{PROD}' AND business_date < '2024-01-11' AS old FROM runs)""",
    ),
    "archive_summary": _sql(
        [],
        """SELECT count(*) AS processed, count(*) FILTER (WHERE status <> 'FAILED') AS archived,
  count(*) FILTER (WHERE status = 'SUCCEEDED') AS deleted, '2024-01-11' AS cutoff_date, 30 AS retention_days,
  count(*) FILTER (WHERE status = 'FAILED') AS error_count,
  (SELECT string_agg(text, '|' ORDER BY text) FROM (
    SELECT 's3_put:' || pk || ':' || sk || '-' || seq || ':failed at ' || t AS text FROM run_events
    WHERE status = 'FAILED' ORDER BY text LIMIT 20)) AS errors
FROM run_events""",
    ),
    "archive_errors": _sql(
        [],
        """SELECT pk, sk || '-' || seq AS sk, 's3_put:' || pk || ':' || sk || '-' || seq || ':failed at ' || t AS text
FROM run_events WHERE status = 'FAILED'""",
    ),
    "run_state_names": _sql(
        [],
        f"""SELECT pk, sk, kind, name, max_by(status, seq) AS status, max_by(t, seq) AS updated_at FROM (
  SELECT pk, sk, 'layer' AS kind, CASE WHEN seq * 2 % 3 = 0 THEN 'new_' ELSE '' END || layer AS name, status, t, seq
  FROM run_events
  UNION ALL SELECT pk, sk, 'table', CASE WHEN (seq * 2 + 1) % 3 = 0 THEN 'new_' ELSE '' END ||
    CASE WHEN user_id % 2 = 0 THEN 'price_history' ELSE 'trade_event' END, {LANE}, t, seq FROM run_events)
GROUP BY ALL""",
    ),
    "raw_gate": _sql(
        [STATE],
        """SELECT r.pk, r.sk, coalesce(s.done, 0) = 2 AS allowed,
  CASE WHEN coalesce(s.done, 0) < 2 THEN 'raw is not SUCCEEDED but ''PENDING''' END AS reason
FROM runs r LEFT JOIN (SELECT pk, sk, count(*) FILTER (WHERE status = 'validated') AS done FROM table_state GROUP BY pk, sk) s
  ON r.pk = s.pk AND r.sk = s.sk""",
    ),
    "layer_gate": _sql(
        [
            STATE,
            f"""
asked AS (
  SELECT seq AS request_id, CASE WHEN layer = 'redshift' THEN 'redshift_silver' ELSE layer END AS layer, env,
    user_id % 13 AS n, pk, sk FROM run_events
),
requests AS (SELECT *, {PREVIOUS} AS previous_layer FROM asked),
found AS (
  SELECT q.*, coalesce(s.status, '') AS got, coalesce(o.status, '') AS legacy
  FROM requests q LEFT JOIN layer_state s ON q.n NOT IN (1, 2, 3) AND s.pk = q.pk AND s.sk = q.sk
      AND s.layer = q.previous_layer
    LEFT JOIN layer_state o ON q.n NOT IN (1, 2, 3) AND o.pk = q.pk AND o.sk = q.sk AND o.layer = 'redshift'
      AND q.previous_layer = 'redshift_silver'
),
judged AS (
  SELECT request_id, layer, previous_layer, CASE WHEN previous_layer IS NULL THEN NULL
    WHEN n IN (2, 3) THEN 'business date and batch id are required'
    WHEN got <> 'SUCCEEDED' AND legacy <> 'SUCCEEDED' THEN previous_layer || ' is not SUCCEEDED but ''' || got || ''''
    END AS reason FROM found
)""",
        ],
        "SELECT request_id, layer, previous_layer, reason IS NULL AS allowed, reason FROM judged",
    ),
    "script_gate": _sql(
        [
            STATE,
            """
asked AS (
  SELECT seq AS request_id, pk, sk, user_id % 7 = 1 AS no_run,
    CASE user_id % 3 WHEN 0 THEN 'redshift_silver' WHEN 1 THEN 'gold' END AS layer,
    CASE user_id % 3 WHEN 0 THEN 'lake_standardized_to_silver' WHEN 1 THEN 'redshift_silver' END AS before
  FROM run_events
),
found AS (
  SELECT a.*, coalesce(s.status, '') AS got, coalesce(o.status, '') = 'SUCCEEDED' AND before = 'redshift_silver' AS old
  FROM asked a LEFT JOIN layer_state s ON (s.pk, s.sk, s.layer) = (a.pk, a.sk, a.before)
    LEFT JOIN layer_state o ON (o.pk, o.sk, o.layer) = (a.pk, a.sk, 'redshift')
),
judged AS (
  SELECT request_id, layer, CASE WHEN NOT no_run AND before IS NOT NULL AND got <> 'SUCCEEDED' AND NOT old
    THEN before || ' is not SUCCEEDED but ''' || got || '''' END AS reason FROM found
)""",
        ],
        "SELECT request_id, layer, reason IS NULL AS allowed, reason FROM judged",
    ),
    "legacy_layer_status": _sql(
        [STATE],
        f"SELECT pk, sk, {', '.join(f'{_ok(n)} AS {n}_ok' for n in LAYERS)} FROM runs r",
    ),
    "transition_lag": _sql([LAGGED], _COMPARE.replace("seq FROM", "seq, before FROM")),
    "just_succeeded": _sql([LAGGED, SUCCEEDED], "SELECT seq, pk, business_date, batch_id, layer FROM succeeded"),
    "route_next_job": _sql(
        [LAGGED, SUCCEEDED, ROUTED], "SELECT seq, layer, action, target FROM routed"
    ),
    "next_requests": _REQUESTS,
    "execution_name": _sql(
        [],
        """SELECT seq AS event_id, regexp_replace('cp-' || business_date || '-' || CASE WHEN user_id % 2 = 0
  THEN CAST(user_id AS VARCHAR) ELSE event_type || ' ' || props || ' ' || repeat(event_type, 6) END,
  '[^0-9A-Za-z_-]', '-', 'g')[1:63] || '-' || sha256(CAST(seq AS VARCHAR))[1:16] AS execution_name FROM run_events""",
    ),
    "run_key_parse": _sql(
        [],
        """SELECT seq, CASE WHEN user_id % 2 <> 0 AND user_id % 7 <> 5 THEN business_date
    WHEN user_id % 7 = 1 THEN '' ELSE business_date END AS business_date,
  CASE WHEN user_id % 7 IN (2, 4) THEN '' ELSE CAST(batch AS VARCHAR) END AS batch_id FROM run_events""",
    ),
    "classify_layer": """SELECT event_id, CASE WHEN event_type IN ('error', 'click') THEN 'redshift_silver'
  WHEN event_type IN ('view', 'signup') THEN 'gold' END AS script_layer,
  CASE event_type WHEN 'error' THEN 'lake_validated_to_standardized' WHEN 'click' THEN 'lake_standardized_to_silver'
    WHEN 'view' THEN 'lake_standardized_to_silver' END AS job_layer
FROM events""",
    "job_event_status": _sql(
        [_JOBS],
        f"""SELECT event_id, skipped, CASE WHEN skipped IS NULL THEN layer END AS layer,
  CASE WHEN skipped IS NULL THEN status END AS status,
  CASE WHEN skipped IS NULL THEN 'PIPE#reporting#dev#BDATE#' || coalesce(business_date, '{AS_OF}') END AS pk,
  CASE WHEN skipped IS NULL THEN 'RUN#' || coalesce(batch_id, 'glue-' || run_id) END AS sk,
  CASE WHEN skipped IS NULL THEN coalesce(batch_id, 'glue-' || run_id[1:12]) END AS batch_label,
  skipped IS NULL AND status <> 'SUCCEEDED' AS recorded
FROM jobs""",
    ),
    "direct_chain_requests": _sql(
        [_JOBS],
        """SELECT event_id, 'standardized_to_silver' AS next_job, business_date, batch_id FROM jobs
WHERE skipped IS NULL AND layer = 'lake_validated_to_standardized' AND status = 'SUCCEEDED'""",
    ),
    "run_context": _sql(
        [],
        """SELECT request_id, business_date, CASE WHEN business_date IS NOT NULL THEN batch_id END AS batch_id,
  business_date IS NOT NULL AS has_run
FROM (SELECT seq AS request_id,
  CASE batch WHEN 0 THEN business_date WHEN 1 THEN '2024-03-01' WHEN 3 THEN '2024-03-01' END AS business_date,
  CASE WHEN user_id % 3 = 0 THEN 'b' || user_id ELSE 'default' END AS batch_id FROM run_events)""",
    ),
    "stream_router": _REQUESTS,
    "stream_transition_state": _sql(
        [
            """
lagged AS (
  SELECT *, lag(status) OVER (PARTITION BY pk, sk, layer ORDER BY seq) AS before FROM run_events
)""",
        ],
        _COMPARE,
    ),
}
ORACLES["gate_lookup"] = ORACLES["layer_gate"]
