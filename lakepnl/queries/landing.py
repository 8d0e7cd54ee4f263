"""Files: scans, lanes, layers, loads and table definitions.

Each query writes what it derives from the tables below the shared work folder and
reads it back through the operator under check.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl import fixtures as fx
from lakepnl.functions.run_keys import batch_of
from lakepnl.operators import contracts as ct
from lakepnl.operators import run_state as rs
from lakepnl.operators.conform import conform, violations
from lakepnl.plans import jobs, lake, marts
from lakepnl.plans.catalog import apply_tables, load_table, table_name
from lakepnl.plans.datasets import PRICE_HISTORY, TRADE_EVENT, lake_config
from lakepnl.plans.registry import job_input_check, sample_check, silver_load_check
from lakepnl.queries import cte
from lakepnl.queries.contracts import RECORDS, VERDICTS, verdicts
from lakepnl.queries.cte import sql
from lakepnl.queries.marts import REPORT
from lakepnl.schemas import (
    ETL_COLUMNS,
    FACT_PRICE_HISTORY,
    FACT_TRADE_EVENT,
    GOLD_PNL_DAILY,
    GOLD_REPORT_PNL,
    PRICE_HISTORY_CONTRACT,
    SILVER_PRICE_HISTORY,
    SILVER_TRADE_EVENT,
    STANDARDIZED_PRICE_HISTORY,
    STANDARDIZED_TRADE_EVENT,
    TRADE_EVENT_CONTRACT,
)
from lakepnl.session import FREES_SHUFFLES, new_folder, settings, stored
from lakepnl.sources import landing, layers
from lakepnl.sources.published import look, open_files
from lakepnl.sources.raw import (
    csv_file_rows,
    has_files,
    lane_path,
    lines_by_file,
    scan_csv,
    scan_json,
    with_landing_fields,
)

# A load date and a session date at once.
DAY = "1998-01-01"
#: Rows of a CSV file whose cells have line breaks, at most; such a file is one task.
FILE_ROWS = 50_000
#: Records of a JSON document, about.
DOCUMENT_RECORDS = 1000
TABLES = (
    STANDARDIZED_TRADE_EVENT,
    STANDARDIZED_PRICE_HISTORY,
    SILVER_TRADE_EVENT,
    SILVER_PRICE_HISTORY,
    FACT_TRADE_EVENT,
    FACT_PRICE_HISTORY,
    GOLD_PNL_DAILY,
    GOLD_REPORT_PNL,
)
CONFIG = {
    "dataset_order": ["trade_event", "price_history"],
    "raw_subprefix": "validated",
    "raw_formats": {
        "trade_event": {"format": "json", "flatten_payload": True},
        "price_history": {"format": "csv"},
    },
}


def _landed(records: DataFrame, dataset: str) -> DataFrame:
    return records.withColumns(
        {"dataset": F.lit(dataset), "ingestion_hour": F.date_format("ingestion_date", "HH")}
    )


def land_good_trades(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "raw")
    records = fx.good_trade_records(spark, sf_dir).withColumn("lane", F.lit("validated"))
    landing.write_lanes(_landed(records, "trade_event"), path)
    return path


def land_prices(spark: SparkSession, sf_dir: str, sep: str = ",") -> str:
    """Price files with their columns in one order, and closing prices in another one."""
    path = new_folder(spark, "prices")
    prices, closing = fx.raw_prices(spark, sf_dir), F.col("is_closing_price") == "true"
    backwards = prices.where(closing).select(F.lit("x").alias("note"), *reversed(prices.columns))
    for part in (prices.where(~closing), backwards):
        part.write.mode("append").option("header", True).option("sep", sep).option("compression", "gzip").csv(path)
    return path


def write_silver(spark: SparkSession, sf_dir: str, *datasets: str) -> str:
    base = new_folder(spark, "silver")
    frames = {"trade_event": fx.silver_trades, "price_history": fx.silver_prices}
    for name in datasets or frames:
        layers.write_layer(frames[name](spark, sf_dir), f"{base}/{name}", deal="look")
    return base


def scan_json_trade_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lane_path(land_good_trades(spark, sf_dir), "trade_event")
    raw = scan_json(spark, path, documents=False)
    return raw.select(
        *[
            F.col(n).try_cast("decimal(20,2)").alias(n) if kind == "number" else F.col(n)
            for n, kind in TRADE_EVENT_CONTRACT.fields.items()
        ]
    )


def scan_csv_price_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = land_prices(spark, sf_dir, "\t")
    return scan_csv(spark, path, list(PRICE_HISTORY_CONTRACT.columns), "tab")


def record_documents(records: DataFrame, size: int = DOCUMENT_RECORDS) -> DataFrame:
    """batch_id and value: lists of about `size` records of a batch, over many lines."""
    parts = records.groupBy("batch_id").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    part = F.pmod(F.xxhash64("batch_id", "pos"), "parts").alias("part")
    listed = F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("\n]"))
    dealt = records.join(stored(parts, "parts"), "batch_id").select("batch_id", part, "record")
    return dealt.groupBy("batch_id", "part").agg(listed.alias("value")).drop("part")


def scan_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of records over many lines, one to a file; their number grows with a batch, not their size."""
    path = new_folder(spark, "documents")
    documents = record_documents(fx.good_trade_records(spark, sf_dir))
    documents.write.partitionBy("batch_id").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    return scan_json(spark, path, infer=False).select("external_event_id", "session_date", "currency_code")


def contract_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of five shapes against the contract: their rows, the bad ones and one error."""
    base = new_folder(spark, "csv-files")
    prices = fx.raw_prices(spark, sf_dir)
    names = prices.columns
    shapes = {
        "plain": names,
        "backwards": names[::-1],
        "other_column": [F.lit("n").alias("note"), *names],
        "padded_name": [F.col(c).alias(" price ") if c == "price" else c for c in names],
        "line_break": [F.concat(c, F.lit("\nB")).alias(c) if c == "price_source_id" else c for c in names],
    }
    month = F.month(F.col("session_date").cast("date")) % len(shapes)
    parts = []
    for i, (shape, columns) in enumerate(shapes.items()):
        path, multi_line = f"{base}/{shape}", shape == "line_break"
        prices.where(month == i).select(*columns).write.option("header", True).option(
            "maxRecordsPerFile", FILE_ROWS if multi_line else 0
        ).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(path)
        rows = csv_file_rows(spark, path, PRICE_HISTORY_CONTRACT, multi_line=multi_line)
        checked = ct.check_csv_lines(rows, PRICE_HISTORY_CONTRACT).where("not is_header")
        parts.append(
            checked.agg(
                F.count(F.lit(1)).alias("records"),
                F.count_if(F.col("error").isNotNull()).alias("bad"),
                F.min("error").alias("error"),
            ).withColumn("shape", F.lit(shape))
        )
    return reduce(DataFrame.unionByName, parts)


def deliver_prices(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of prices as delivered, one batch a month; every fifth month has cells that are no numbers."""
    path, day = new_folder(spark, "incoming"), F.col("session_date").cast("date")
    bad = (F.month(day) % 5 == 2) & (F.substring("instrument_id", 5, 20).cast("long") % 3 == 0)
    prices = fx.raw_prices(spark, sf_dir)
    cells = prices.withColumn("price", F.when(bad, F.concat(F.lit("n/a "), "price")).otherwise(F.col("price")))
    batch = F.concat(F.lit("B-"), F.date_format(day, "yyyy-MM"))
    labelled = cells.withColumns({"ingestion_date": F.trunc(day, "month").cast("string"), "batch_id": batch})
    folders = ("ingestion_date", "batch_id")
    with settings(spark, FREES_SHUFFLES):
        labelled.hint("rebalance", *folders).write.partitionBy(*folders).option("header", True).option("compression", "gzip").csv(path)
    return path


def _ingest_all(spark: SparkSession, sf_dir: str, base: str) -> tuple[str, str]:
    raw, state = f"{base}/raw", f"{base}/state"
    jobs.ingest_json(spark, fx.trade_records(spark, sf_dir), TRADE_EVENT, raw, state)
    jobs.ingest_csv(spark, deliver_prices(spark, sf_dir), PRICE_HISTORY, raw, state)
    return raw, state


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered files in their lanes: rows as read there, and what the run state says of the batch."""
    base = new_folder(spark, "ingest")
    raw, state = f"{base}/raw", f"{base}/state"
    verdicts = jobs.ingest_csv(spark, deliver_prices(spark, sf_dir), PRICE_HISTORY, raw, state)
    parts = []
    for lane in landing.LANES:
        folders = landing.landed_folders(spark, raw, "price_history", lane)
        rows = scan_csv(spark, folders, list(PRICE_HISTORY_CONTRACT.columns)) if folders else None
        if rows is not None:
            batch = F.concat(F.lit("B-"), F.substring("session_date", 1, 7))
            parts.append(rows.groupBy(batch.alias("batch_id")).agg(F.count(F.lit(1)).alias("rows")).withColumn("lane", F.lit(lane)))
    landed = reduce(DataFrame.unionByName, parts)
    table = F.try_element_at("tables", F.lit("price_history"))
    stated = rs.read_items(spark, state).select(batch_of(F.col("sk")).alias("batch_id"), table["status"].alias("status"))
    judged = verdicts.select("batch_id", "records", "bad_records", (F.col("reason").isNull()).alias("ok"))
    return judged.join(landed, "batch_id").join(stated, "batch_id")


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the lane of their batch; they are checked once, however often they are landed."""
    judged = stored(verdicts(spark, sf_dir), "verdicts")
    return ct.route_to_lanes(fx.trade_records(spark, sf_dir), judged, ["batch_id"])


def landing_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that turn from one lane to the other and back; each is in one lane at the end."""
    path = new_folder(spark, "raw")
    routed = _routed(spark, sf_dir)
    other = F.when(F.col("lane") == "validated", "rejected").otherwise("validated")
    even = F.month("ingestion_date") % 2 == 0
    landing.write_lanes(_landed(routed, "trade_event"), path)
    landing.write_lanes(_landed(routed.where(even).withColumn("lane", other), "trade_event"), path)
    landing.write_lanes(_landed(routed.where(F.month("ingestion_date") % 4 == 0), "trade_event"), path)
    parts = []
    for lane in landing.LANES:
        folders = landing.landed_folders(spark, path, "trade_event", lane)
        lines = spark.read.option("recursiveFileLookup", True).text(folders)
        parts.append(with_landing_fields(lines).select("lane", "batch_id", F.col("value").alias("record")))
    # Nothing of a batch is left in the other lane either.
    every = spark.read.option("recursiveFileLookup", True).text([f"{path}/lane={x}" for x in landing.LANES])
    counted = lines_by_file(every).groupBy("batch_id").agg(F.sum("lines").alias("lines"))
    # One row per batch, of known size, so that no record is shuffled for it.
    counted = stored(counted, "counted")
    return reduce(DataFrame.unionByName, parts).join(counted, "batch_id")


def pipeline_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches with bad records and bad files through contract, lanes, run state and every gate to the report.

    A batch with a rejected table passes no gate, so nothing of it reaches the report, its good
    table neither.
    """
    base = new_folder(spark, "chain")
    std, silver, facts, gold = (f"{base}/{n}" for n in ("standardized", "silver", "facts", "gold"))
    raw, state = _ingest_all(spark, sf_dir, base)
    config = lake_config(CONFIG)
    first = lambda batches: jobs.validated_to_standardized(spark, config, raw, std, documents=False, batches=batches)
    for layer, job in (
        ("lake_validated_to_standardized", first),
        ("lake_standardized_to_silver", lambda _: jobs.standardized_to_silver(spark, config, std, silver)),
        ("redshift_silver", lambda _: jobs.load_facts(spark, silver, facts, load_mode="full")),
        ("gold", lambda _: jobs.build_gold(spark, facts, gold, DAY, load_mode="full")),
    ):
        jobs.run_layer(spark, layer, state, job)
    report = layers.read_loaded(spark, f"{gold}/gold_report_pnl").drop(*ETL_COLUMNS)
    done = rs.read_items(spark, state).where(rs.layer_succeeded(F.col("layers"), F.lit("gold")))
    counted = done.agg(F.count(F.lit(1)).cast("decimal(20,2)").alias("pnl_itd")).withColumn("book_id", F.lit("batches"))
    return report.select("session_date", "book_id", "instrument_id", "nominal_close", "pnl_itd").unionByName(
        counted, allowMissingColumns=True
    )


def conform_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts read as texts, fitted to their table with every rule on."""
    facts = fx.trade_facts(spark, sf_dir)
    texts = facts.select(*[F.col(c).cast("string").alias(c) for c in facts.columns])
    return conform(texts, FACT_TRADE_EVENT, strict=True).select(
        "external_event_id", "session_date", "fees", "net_amount", "currency_code"
    )


def scan_parquet_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = write_silver(spark, sf_dir, "trade_event")
    return layers.scan_layer(spark, f"{base}/trade_event").drop(*ETL_COLUMNS)


def scan_load_date_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = write_silver(spark, sf_dir, "trade_event")
    return layers.scan_for_load(spark, f"{base}/trade_event", "incremental", DAY).drop(
        *ETL_COLUMNS
    )


def _dataset_counts(spark: SparkSession, base: str) -> DataFrame:
    """One row per configured dataset; a dataset without files is skipped, not read."""
    parts = []
    for spec in lake_config(CONFIG).datasets:
        path = f"{base}/{spec.name}"
        found = has_files(spark, path)
        rows = layers.scan_layer(spark, path) if found else spark.range(0)
        parts.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(spec.name).alias("dataset"),
                F.lit(spec.format).alias("format"),
                F.lit("READ" if found else "SKIPPED").alias("status"),
                "rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def skip_empty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dataset_counts(spark, write_silver(spark, sf_dir, "price_history"))


def dataset_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dataset_counts(spark, write_silver(spark, sf_dir))


def _land_all(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "raw")
    routed = _routed(spark, sf_dir)
    for _ in range(2):
        landing.write_lanes(_landed(routed, "trade_event"), path)
    return path


def landing_path_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per path, from the files themselves."""
    lines = spark.read.option("recursiveFileLookup", True).text(_land_all(spark, sf_dir))
    fields = ["lane", "dataset", "ingestion_date", "ingestion_hour", "batch_id"]
    return lines_by_file(lines).groupBy(*fields).agg(F.sum("lines").alias("records"))


def landing_lane_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = spark.read.schema(
        "value string, lane string, dataset string, ingestion_date string, "
        "ingestion_hour string, batch_id string"
    ).text(_land_all(spark, sf_dir))
    return landed.withColumnRenamed("value", "record").drop("landing")


def dynamic_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "standardized")
    std = fx.standardized_trades(spark, sf_dir).select(
        "external_event_id", "session_date", "fees", "load_date"
    )
    layers.write_layer(std, path)
    # Loads of 1998 once more, with other fees; all other loads stay as they are.
    again = std.where(F.year("load_date") == 1998).withColumn(
        "fees", (F.col("fees") + 1).cast("decimal(20,2)")
    )
    layers.write_layer(again, path)
    return layers.scan_layer(spark, path)


def fact_replace_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, facts = write_silver(spark, sf_dir, "trade_event"), new_folder(spark, "fact")
    silver = f"{base}/trade_event"
    everything = layers.scan_for_load(spark, silver, "full")
    one_load = layers.scan_for_load(spark, silver, "incremental", DAY)
    # Every load twice, and the full one in a session that overwrites by partition.
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        layers.replace_load(marts.fact_trade_event(one_load), facts, DAY, deal="look")
        layers.replace_load(marts.fact_trade_event(everything), facts, DAY, "full", deal="look")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    for _ in range(2):
        layers.replace_load(marts.fact_trade_event(one_load), facts, DAY, deal="look")
    return layers.read_loaded(spark, facts).select(
        "external_event_id", "session_date", "book_id", "instrument_id", "net_amount"
    )


def mart_replace_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "gold")
    trades, prices = fx.trade_facts(spark, sf_dir), fx.price_facts(spark, sf_dir)
    layers.replace_load(marts.pnl_daily(trades, prices, DAY, "full"), path, DAY, "full")
    # The session again, now from closing prices only, and a second time: once is enough.
    one = marts.pnl_daily(trades, prices, DAY, price_rows="closing")
    layers.replace_load(one, path, DAY)
    layers.replace_load(one, path, DAY)
    return layers.read_loaded(spark, path).select(
        "session_date", "book_id", "instrument_id", "nominal_close", "pnl_mtd", "pnl_itd"
    )


def conform_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fx.trade_facts(spark, sf_dir)
    kind = F.col("event_type_id")
    broken = facts.withColumns(
        {
            "book_id": F.when(kind != "BUY", F.col("book_id")),
            "currency_code": F.when(kind == "SELL", F.repeat("currency_code", 4)).otherwise(
                F.col("currency_code")
            ),
            "fees": F.when(kind == "COUPON", "n/a").otherwise(F.col("fees").cast("string")),
        }
    )
    return violations(broken, FACT_TRADE_EVENT)


def schema_registry_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates all tables, loads them hop by hop, and applies the definitions again."""
    base, suffix = new_folder(spark, "tables"), f"_{uuid.uuid4().hex[:8]}"
    first = apply_tables(spark, base, suffix=suffix)
    second = apply_tables(spark, base, suffix=suffix)
    dry = apply_tables(spark, base, suffix=suffix, dry_run=True)

    def rows_of(table) -> DataFrame:
        return spark.table(table_name(table, suffix))

    def load(table, df: DataFrame, deal: str = "always") -> None:
        load_table(df, table, suffix, deal)

    # Standardized and silver tables have the same partitions, and so have both gold tables.
    load(STANDARDIZED_TRADE_EVENT, fx.standardized_trades(spark, sf_dir), "look")
    load(STANDARDIZED_PRICE_HISTORY, fx.standardized_prices(spark, sf_dir), "look")
    load(SILVER_TRADE_EVENT, lake.silver_trade_event(rows_of(STANDARDIZED_TRADE_EVENT)), "never")
    load(SILVER_PRICE_HISTORY, lake.silver_price_history(rows_of(STANDARDIZED_PRICE_HISTORY)), "never")
    load(FACT_TRADE_EVENT, marts.fact_trade_event(rows_of(SILVER_TRADE_EVENT)), "look")
    load(FACT_PRICE_HISTORY, marts.fact_price_history(rows_of(SILVER_PRICE_HISTORY)), "look")
    deal = look(rows_of(FACT_TRADE_EVENT), "session_date")
    daily = marts.pnl_daily(rows_of(FACT_TRADE_EVENT), rows_of(FACT_PRICE_HISTORY), DAY, "full", store=deal == "open")
    load(GOLD_PNL_DAILY, daily, deal)
    load(GOLD_REPORT_PNL, marts.gold_report_pnl(rows_of(GOLD_PNL_DAILY), DAY, "full"), "never")
    counts = reduce(
        DataFrame.unionByName,
        [
            rows_of(t).agg(F.count(F.lit(1)).alias("rows")).withColumn(
                "table_name", F.lit(t.full_name)
            )
            for t in TABLES
        ],
    )
    outcome = stored(
        first.withColumnRenamed("status", "first_status")
        .join(second.select("table_name", F.col("status").alias("second_status")), "table_name")
        .join(dry.select("table_name", F.col("status").alias("dry_status")), "table_name")
        .join(counts, "table_name"),
        "outcome",
    )
    # Nothing of the trial stays in the catalog.
    for database in {table_name(t, suffix).rpartition(".")[0] for t in TABLES}:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    return outcome


def gold_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed JSON and CSV files through all hops and loads, read back from the report."""
    base = new_folder(spark, "jobs")
    raw, std, silver = f"{base}/raw", f"{base}/standardized", f"{base}/silver"
    records = fx.good_trade_records(spark, sf_dir).withColumn("lane", F.lit("validated"))
    landing.write_lanes(_landed(records, "trade_event"), raw)
    prices = fx.raw_prices(spark, sf_dir)
    prices.write.option("header", True).option("compression", "gzip").csv(lane_path(raw, "price_history"))
    config = lake_config(CONFIG)
    jobs.validated_to_standardized(spark, config, raw, std, documents=False)
    jobs.standardized_to_silver(spark, config, std, silver)
    jobs.load_facts(spark, silver, f"{base}/facts", load_mode="full")
    jobs.build_gold(spark, f"{base}/facts", f"{base}/gold", DAY, load_mode="full")
    return layers.read_loaded(spark, f"{base}/gold/gold_report_pnl").drop(*ETL_COLUMNS)


def _broken_trades(spark: SparkSession, sf_dir: str, *some: str) -> dict[str, str]:
    """Folders of records with one fault each, by the fault: all faults, or some; `none` has no files.

    A record is made and searched for its price once, whatever is made of it.
    """
    good, base = fx.good_trade_records(spark, sf_dir), new_folder(spark, "faults")
    null, record, nulled = '"price":null,', F.col("record"), F.col("nulled")
    faults = {
        "good": record,
        "missing": F.replace(nulled, F.lit(null), F.lit("")),
        "null": nulled,
        "text": F.replace(nulled, F.lit(null), F.lit('"price":"1",')),
        "list": F.concat(F.lit("["), record, F.lit("]")),
    }
    names = some or tuple(faults)
    made = good.select(record, F.regexp_replace(record, '"price":[^,}]*,', null).alias("nulled"))
    values = F.array(*[F.struct(F.lit(n).alias("fault"), faults[n].alias("value")) for n in names])
    with open_files(spark):
        made.select(F.inline(values)).write.partitionBy("fault").option("compression", "gzip").option(
            "zlib.compress.level", "THREE"
        ).text(base)
    return {name: f"{base}/fault={name}" for name in (*names, "none")}


def sample_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of good and of broken inputs; the job column names the fault."""
    parts = [
        sample_check(spark, fault, "trade_event", path, TRADE_EVENT_CONTRACT, documents=False)
        for fault, path in _broken_trades(spark, sf_dir).items()
    ]
    prices, base = fx.raw_prices(spark, sf_dir), new_folder(spark, "faults")
    for fault, frame in (("good", prices), ("missing", prices.drop("price"))):
        frame.write.option("header", True).option("compression", "gzip").csv(f"{base}/{fault}")
        parts.append(sample_check(spark, fault, "price_history", f"{base}/{fault}", PRICE_HISTORY_CONTRACT))
    return reduce(DataFrame.unionByName, parts)


def registry_input_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inputs of both lake jobs: once good, once with a fault in every input."""
    trades, prices = _broken_trades(spark, sf_dir, "good", "list"), land_prices(spark, sf_dir)
    base = new_folder(spark, "standardized")
    layers.write_layer(fx.standardized_trades(spark, sf_dir), f"{base}/trade_event", deal="look")
    layers.write_layer(fx.standardized_prices(spark, sf_dir), f"{base}/price_history", deal="look")
    wrong = fx.standardized_trades(spark, sf_dir).withColumn("price", F.col("price").cast("string"))
    layers.write_layer(wrong, f"{base}/wrong", deal="look")
    first, second = "validated_to_standardized", "standardized_to_silver"
    good = job_input_check(
        spark, first, {"trade_event": trades["good"], "price_history": prices}, documents=False
    ).unionByName(job_input_check(spark, second, {n: f"{base}/{n}" for n in ("trade_event", "price_history")}))
    bad = job_input_check(
        spark, first, {"trade_event": trades["list"], "price_history": trades["none"]}, documents=False
    ).unionByName(job_input_check(spark, second, {"trade_event": f"{base}/wrong", "price_history": trades["none"]}))
    return good.withColumn("inputs", F.lit("good")).unionByName(bad.withColumn("inputs", F.lit("bad")))


def silver_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = write_silver(spark, sf_dir)
    return silver_load_check(spark, base, DAY).unionByName(
        silver_load_check(spark, base, "2010-01-01")
    )


QUERIES = {
    "scan_json_trade_raw": scan_json_trade_raw,
    "scan_csv_price_raw": scan_csv_price_raw,
    "scan_json_documents": scan_json_documents,
    "contract_csv_files": contract_csv_files,
    "csv_ingest": csv_ingest,
    "landing_turns": landing_turns,
    "pipeline_end_to_end": pipeline_end_to_end,
    "conform_strict": conform_strict,
    "scan_parquet_layer": scan_parquet_layer,
    "scan_load_date_pruned": scan_load_date_pruned,
    "skip_empty_source": skip_empty_source,
    "landing_path_fields": landing_path_fields,
    "dataset_row_counts": dataset_row_counts,
    "landing_lane_write": landing_lane_write,
    "dynamic_partition_overwrite": dynamic_partition_overwrite,
    "fact_replace_load": fact_replace_load,
    "mart_replace_insert": mart_replace_insert,
    "schema_registry_apply": schema_registry_apply,
    "conform_violations": conform_violations,
    "gold_from_files": gold_from_files,
    "sample_contract": sample_contract,
    "registry_input_check": registry_input_check,
    "silver_load_check": silver_checks,
}

_JSON_COLUMNS = ", ".join(
    f"CAST(doc->>'$.{n}' AS DECIMAL(20,2)) AS {n}" if kind == "number" else f"doc->>'$.{n}' AS {n}"
    for n, kind in TRADE_EVENT_CONTRACT.fields.items()
)
_LANDED = """SELECT lane, 'trade_event' AS dataset, strftime(ingestion_date, '%Y-%m-%d') AS ingestion_date,
  '00' AS ingestion_hour, batch_id, {0} FROM checked JOIN verdicts USING (batch_id)"""
_FACT = "external_event_id, session_date, book_id, instrument_id, net_amount"
_MART = "session_date, book_id, instrument_id, nominal_close, pnl_mtd, pnl_itd"
_SILVER_ALL = [*cte.TRADES, *cte.PRICES]
_RULES = [
    (c.name, rule)
    for c in FACT_TRADE_EVENT.columns
    for rule, applies in (
        ("not_null", c.required),
        ("max_length", c.max_length),
        ("type", c.type != "string"),
    )
    if applies
]
_VIOLATED = {
    ("book_id", "not_null"): "event_type_id = 'BUY'",
    ("currency_code", "max_length"): "event_type_id = 'SELL' AND length(currency_code) * 4 > 10",
    ("fees", "type"): "event_type_id = 'COUPON'",
}
_TABLE_ROWS = {
    "standardized.trade_event": "std_trades",
    "standardized.price_history": "std_prices",
    "silver.trade_event": "silver_trades",
    "silver.price_history": "silver_prices",
    "facts.fact_trade_event": "silver_trades",
    "facts.fact_price_history": "silver_prices",
    "gold.silver_pnl_daily": "pnl",
    "gold.gold_report_pnl": "pnl",
}
_MART_BASE = _SILVER_ALL


def _inputs(checks: list[tuple[str, str, str]], more: str = "") -> str:
    """Outcomes of checks over files that hold every row of a source."""
    return "\nUNION ALL\n".join(
        f"SELECT '{job}' AS job, '{name}' AS dataset, '{reason}' = '' AS ok, '{reason}' AS reason{more} "
        "FROM lineitem HAVING count(*) > 0"
        for job, name, reason in checks
    )


#: A cell of the delivered prices that is no number.
_BAD_PRICE = "month(CAST(session_date AS DATE)) % 5 = 2 AND CAST(substr(instrument_id, 5) AS BIGINT) % 3 = 0"
_NO_NUMBER = "price must be a number"
_FIRST, _SECOND = "validated_to_standardized", "standardized_to_silver"

ORACLES = {
    "scan_json_trade_raw": sql(
        [cte.RAW_TRADES, RECORDS, "docs AS (SELECT CAST(good AS JSON) AS doc FROM records)"],
        f"SELECT {_JSON_COLUMNS} FROM docs",
    ),
    "scan_csv_price_raw": sql([cte.RAW_PRICES], "SELECT * FROM raw_prices"),
    "scan_parquet_layer": sql(cte.TRADES, "SELECT * FROM silver_trades"),
    "scan_load_date_pruned": sql(
        cte.TRADES, f"SELECT * FROM silver_trades WHERE load_date = DATE '{DAY}'"
    ),
    "skip_empty_source": sql(
        cte.PRICES,
        """SELECT 'price_history' AS dataset, 'csv' AS format, 'READ' AS status, count(*) AS rows FROM silver_prices
UNION ALL SELECT 'trade_event', 'json', 'SKIPPED', 0""",
    ),
    "dataset_row_counts": sql(
        _SILVER_ALL,
        """SELECT 'price_history' AS dataset, 'csv' AS format, 'READ' AS status, count(*) AS rows FROM silver_prices
UNION ALL SELECT 'trade_event', 'json', 'READ', count(*) FROM silver_trades""",
    ),
    "landing_path_fields": sql(
        VERDICTS, f"{_LANDED.format('count(*) AS records')} GROUP BY ALL"
    ),
    "landing_lane_write": sql(VERDICTS, _LANDED.format("record")),
    "dynamic_partition_overwrite": sql(
        [cte.RAW_TRADES, cte.STD_TRADES],
        """SELECT external_event_id, session_date, load_date,
  CAST(CASE WHEN year(load_date) = 1998 THEN fees + 1 ELSE fees END AS DECIMAL(20,2)) AS fees FROM std_trades""",
    ),
    "fact_replace_load": sql(
        cte.TRADES,
        f"""SELECT {_FACT} FROM silver_trades WHERE session_date <> DATE '{DAY}'
UNION ALL SELECT {_FACT} FROM silver_trades WHERE load_date = DATE '{DAY}'""",
    ),
    "mart_replace_insert": sql(
        [
            *cte.TRADES,
            *cte.SOME_PRICES,
            cte.pnl_cte(DAY),
            cte.pnl_cte(DAY, f"session_date = DATE '{DAY}'", "closing", "is_closing_price"),
        ],
        f"""SELECT {_MART} FROM pnl WHERE session_date <> DATE '{DAY}' UNION ALL SELECT {_MART} FROM closing""",
    ),
    "schema_registry_apply": sql(
        [*_MART_BASE, cte.pnl_cte(DAY)],
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS table_name, '{"lake" if name[0] == "s" else "warehouse"}' AS target,
  'APPLIED' AS first_status, 'SKIPPED_EXISTS' AS second_status, 'DRY_RUN' AS dry_status, count(*) AS rows FROM {source}"""
            for name, source in _TABLE_ROWS.items()
        ),
    ),
    "conform_violations": sql(
        cte.TRADES,
        "\nUNION ALL\n".join(
            f"""SELECT 'facts.fact_trade_event' AS table_name, '{column}' AS column_name, '{rule}' AS rule,
  count(*) AS violations FROM silver_trades WHERE {_VIOLATED.get((column, rule), 'false')}"""
            for column, rule in _RULES
        ),
    ),
    "gold_from_files": sql(
        [
            cte.RAW_TRADES.replace("THEN 'eur' END", "THEN 'eur' ELSE 'gbp' END"),
            *_MART_BASE[1:],
            cte.pnl_cte(DAY),
        ],
        REPORT,
    ),
    "sample_contract": _inputs(
        [
            ("good", "trade_event", ""),
            ("missing", "trade_event", "missing field price"),
            ("null", "trade_event", _NO_NUMBER),
            ("text", "trade_event", _NO_NUMBER),
            ("list", "trade_event", "root must be an object, got array"),
            ("none", "trade_event", "no files"),
            ("good", "price_history", ""),
            ("missing", "price_history", "missing column price"),
        ]
    ),
    "registry_input_check": _inputs(
        [(job, name, "") for job in (_FIRST, _SECOND) for name in ("trade_event", "price_history")],
        ", 'good' AS inputs",
    )
    + "\nUNION ALL\n"
    + _inputs(
        [
            (_FIRST, "trade_event", "root must be an object, got array"),
            (_FIRST, "price_history", "no files"),
            (_SECOND, "trade_event", "columns with another type: price"),
            (_SECOND, "price_history", "no files"),
        ],
        ", 'bad' AS inputs",
    ),
    "scan_json_documents": sql(
        [cte.RAW_TRADES, RECORDS, "docs AS (SELECT CAST(good AS JSON) AS doc FROM records)"],
        """SELECT doc->>'$.external_event_id' AS external_event_id,
  doc->>'$.session_date' AS session_date, doc->>'$.currency_code' AS currency_code FROM docs""",
    ),
    "contract_csv_files": sql(
        [
            cte.RAW_PRICES,
            """shaped AS (SELECT CASE month(CAST(session_date AS DATE)) % 5 WHEN 0 THEN 'plain' WHEN 1 THEN 'backwards'
  WHEN 2 THEN 'other_column' WHEN 3 THEN 'padded_name' ELSE 'line_break' END AS shape FROM raw_prices)""",
        ],
        """SELECT shape, count(*) AS records, count(*) FILTER (WHERE shape = 'padded_name') AS bad,
  CASE WHEN shape = 'padded_name' THEN 'no value for column price' END AS error FROM shaped GROUP BY shape""",
    ),
    "conform_strict": sql(
        cte.TRADES,
        "SELECT external_event_id, session_date, fees, net_amount, currency_code FROM silver_trades",
    ),
    "csv_ingest": sql(
        [cte.RAW_PRICES],
        f"""SELECT 'B-' || substr(session_date, 1, 7) AS batch_id, count(*) AS records, count(*) AS rows,
  count(*) FILTER (WHERE {_BAD_PRICE}) AS bad_records, bad_records = 0 AS ok,
  CASE WHEN bad_records = 0 THEN 'validated' ELSE 'rejected' END AS lane, lane AS status
FROM raw_prices GROUP BY substr(session_date, 1, 7)""",
    ),
    "landing_turns": sql(
        VERDICTS,
        """SELECT batch_id, record, count(*) OVER (PARTITION BY batch_id) AS lines,
  CASE WHEN month(ingestion_date) % 4 <> 2 THEN lane WHEN lane = 'validated' THEN 'rejected' ELSE 'validated' END AS lane
FROM checked JOIN verdicts USING (batch_id)""",
    ),
    "pipeline_end_to_end": sql(
        [
            cte.RAW_TRADES.replace("raw_trades AS", "all_trades AS", 1).replace("THEN 'eur' END", "THEN 'eur' ELSE 'gbp' END"),
            cte.RAW_PRICES.replace("raw_prices AS", "all_prices AS", 1).replace("raw_trades", "all_trades"),
            f"""lanes AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS batch,
    count(*) FILTER (WHERE month(o_orderdate) % 3 = 0 AND (l_orderkey * 7 + l_partkey) % 97 BETWEEN 1 AND 13) AS bad
  FROM all_trades GROUP BY ALL
),
allowed AS (
  SELECT batch FROM lanes WHERE bad = 0 INTERSECT
  SELECT substr(session_date, 1, 7) FROM all_prices GROUP BY ALL HAVING count(*) FILTER (WHERE {_BAD_PRICE}) = 0
),
raw_trades AS (
  SELECT * FROM all_trades WHERE strftime(o_orderdate, '%Y-%m') IN (SELECT batch FROM allowed)
),
raw_prices AS (
  SELECT * FROM all_prices WHERE substr(session_date, 1, 7) IN (SELECT batch FROM allowed)
)""",
            *[x for x in _MART_BASE[1:] if x != cte.RAW_PRICES],
            cte.pnl_cte(DAY),
        ],
        """SELECT session_date, book_id, instrument_id, nominal_close, pnl_itd FROM pnl
UNION ALL SELECT NULL, 'batches', NULL, NULL, CAST(count(*) AS DECIMAL(20,2)) FROM allowed""",
    ),
    "silver_load_check": sql(
        _SILVER_ALL,
        "\nUNION ALL\n".join(
            f"""SELECT '{table}' AS table_name, '{day}' AS load_date, count(*) AS rows, count(*) > 0 AS ok
FROM {source} WHERE load_date = DATE '{day}'"""
            for table, source in (
                ("trade_event", "silver_trades"),
                ("price_history", "silver_prices"),
            )
            for day in (DAY, "2010-01-01")
        ),
    ),
}
