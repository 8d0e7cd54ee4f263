"""Trades, prices, raw files and run events derived from the given tables.

FIXTURES.md describes each derivation; every row of the source tables takes part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl.functions.run_keys import PROJECT, env_key, partition_key, sort_key
from lakepnl.operators.ordered import previous_in_order
from lakepnl.plans.lake import (
    silver_price_history,
    silver_trade_event,
    standardize_price_history,
    standardize_trade_event,
)
from lakepnl.plans.marts import fact_price_history, fact_trade_event
from lakepnl.schemas import TRADE_EVENT_CONTRACT
from lakepnl.session import FREES_SHUFFLES, new_folder, settings, work_root
from lakepnl.sources.published import list_names

EVENT_TYPES = ("BUY", "SELL", "MATURITY", "DIVIDEND", "COUPON", "PRICE_UPDATE", "FX_REVALUATION")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_kept: dict[tuple[str, str, str], str] = {}


def kept(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """An input that is derived once in an application and stored in the shared folder, as landed files are.

    Queries then time and test their operators, not the joins that make their input.
    """
    key = (work_root(spark), sf_dir, name)
    if key not in _kept or "_SUCCESS" not in list_names(spark, _kept[key]):
        path = new_folder(spark, f"input-{name}")
        with settings(spark, FREES_SHUFFLES):
            build().write.parquet(path)
        _kept[key] = path
    return spark.read.parquet(_kept[key])


def prepare(spark: SparkSession, sf_dir: str) -> None:
    """Stores all inputs that are derived by joins."""
    for build in (trade_lines, raw_prices):
        build(spark, sf_dir)


def pick(selector: Column, choices: dict[int, object], default: object = None) -> Column:
    """CASE selector WHEN n THEN value ...; columns and plain values may be mixed."""
    expr = F
    for n, value in choices.items():
        expr = expr.when(selector == n, value if isinstance(value, Column) else F.lit(value))
    if default is None:
        return expr
    return expr.otherwise(default if isinstance(default, Column) else F.lit(default))


def month_start(c: str) -> Column:
    return F.trunc(c, "month")


def text_time(c: Column) -> Column:
    return c.cast("timestamp_ntz").cast("string")


def trade_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its order, part, supplier and nation.

    Orders grow with the data, so that side is merged, never broadcast; the others
    are broadcast only while Spark's size check allows it.
    """
    orders = table(spark, sf_dir, "orders").hint("merge")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )


def trade_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What trades and their records are made of, joined once; the texts are made where they are read."""
    names = (
        "l_orderkey l_linenumber l_partkey l_suppkey l_quantity l_returnflag l_linestatus l_tax l_shipdate "
        "o_orderdate p_retailprice n_name"
    )
    return kept(spark, sf_dir, "trade_lines", lambda: trade_base(spark, sf_dir).select(*names.split()))


def trade_columns() -> dict[str, Column]:
    line = F.col("l_linenumber")
    quantity = F.col("l_quantity")
    return {
        "external_event_id": F.concat(
            F.lit("EV-"),
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
        ),
        "session_date": month_start("l_shipdate").cast("string"),
        "event_datetime": text_time(F.col("o_orderdate")),
        "settlement_datetime": text_time(F.col("l_shipdate") + F.expr("INTERVAL '2' DAY")),
        "book_id": (F.col("l_suppkey") % 5).cast("string"),
        "instrument_id": F.concat(F.lit("INS-"), "l_partkey"),
        "event_type_id": pick(line, dict(enumerate(EVENT_TYPES[:-1], 1)), EVENT_TYPES[-1]),
        "custody_country": F.col("n_name"),
        "nominal_delta": F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity),
        "price": F.col("p_retailprice"),
        "fees": F.when(F.col("l_linestatus") == "F", F.col("l_tax")),
        "fx_rate": pick(line % 4, {0: 1.0, 1: 2.0, 2: 4.0}),
        "currency_code": pick(line % 3, {0: "usd", 1: "eur"}),
        "source_file": F.lit("fixture"),
        "ingestion_ts": text_time(F.trunc("o_orderdate", "year").cast("timestamp")),
    }


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades as read from raw files: texts and doubles, some of them missing."""
    return trade_lines(spark, sf_dir).select(*[c.alias(name) for name, c in trade_columns().items()])


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices as read from raw files, all texts: an opening and a closing row per key."""
    return kept(spark, sf_dir, "raw_prices", lambda: _raw_prices(spark, sf_dir))


def _raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = (
        table(spark, sf_dir, "lineitem")
        .select(
            month_start("l_shipdate").alias("session"),
            F.col("l_partkey").alias("instrument"),
        )
        .distinct()
        .withColumn("session_date", F.col("session").cast("string"))
    )
    midnight = F.concat("session_date", F.lit(" 00:00:00"))
    closing = F.col("is_closing_price")
    return keys.withColumn(
        "is_closing_price", F.explode(F.array(F.lit(True), F.lit(False)))
    ).select(
        "session_date",
        F.concat(F.lit("INS-"), "instrument").alias("instrument_id"),
        midnight.alias("price_datetime"),
        F.when(closing, "101.25").otherwise("99.50").alias("price"),
        F.lit("usd").alias("currency_code"),
        F.lit("SRC1").alias("price_source_id"),
        closing.cast("string").alias("is_closing_price"),
        (~closing).cast("string").alias("is_opening_price"),
        text_time(F.trunc("session", "year").cast("timestamp")).alias("ingestion_ts"),
    )


def standardized_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_trade_event(raw_trades(spark, sf_dir))


def standardized_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_price_history(raw_prices(spark, sf_dir))


def silver_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_trade_event(standardized_trades(spark, sf_dir))


def silver_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_price_history(standardized_prices(spark, sf_dir))


def trade_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trade_event(silver_trades(spark, sf_dir))


def price_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices for joins with trades: every seventh instrument has none, so that some trades go without."""
    priced = F.substring("instrument_id", 5, 20).cast("long") % 7 != 0
    return fact_price_history(silver_prices(spark, sf_dir).where(priced))


def json_record(broken: Column) -> Column:
    """JSON text of a line's trade; `broken` numbers its defect, others are good."""
    columns = trade_columns()
    columns["fees"] = F.coalesce(columns["fees"], F.lit(0.0))
    columns["fx_rate"] = F.coalesce(columns["fx_rate"], F.lit(1.0))
    columns["currency_code"] = F.coalesce(columns["currency_code"], F.lit("gbp"))
    # Defects of one field; a NULL leaves the field out.
    changed = {
        "book_id": {1: F.lit(None).cast("string"), 6: "true"},
        "fees": {3: "null"},
        "price": {4: '"12.5"'},
        "currency_code": {5: "978"},
        "source_file": {10: "false"},
        "custody_country": {11: "null"},
        "fx_rate": {12: "[1]"},
        "instrument_id": {13: "{}"},
    }
    fields = []
    for name, kind in TRADE_EVENT_CONTRACT.fields.items():
        # Numbers have two decimals, which print the same on every engine.
        value = (
            F.concat(F.lit('"'), columns[name], F.lit('"'))
            if kind == "string"
            else columns[name].cast("decimal(20,2)").cast("string")
        )
        if name in changed:
            value = pick(broken, changed[name], value)
        fields.append(F.concat(F.lit(f'"{name}":'), value))
    fields.append(F.when(broken == 2, '"zz_note":"n","aa_note":1'))
    whole = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    return pick(broken, {7: "42", 8: "[]", 9: '{"external_event_id":'}, whole)


def defect() -> Column:
    """Defect number of a line: only orders of every third month have any."""
    number = (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 97
    return F.when(F.month("o_orderdate") % 3 == 0, number).otherwise(F.lit(0))


def _batch() -> Column:
    return F.concat(F.lit("B-"), F.date_format("o_orderdate", "yyyy-MM"))


def line_position() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def trade_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw JSON records with their batch and position; a batch is one order month."""
    return _records(spark, sf_dir, defect())


def good_trade_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir, F.lit(0))


def _records(spark: SparkSession, sf_dir: str, broken: Column) -> DataFrame:
    # The defect is a column, as every field asks for it, and a line without one has the plain text.
    lines = trade_lines(spark, sf_dir).withColumn("defect", broken)
    has_defect = F.col("defect").between(1, 13)
    return lines.select(
        _batch().alias("batch_id"),
        line_position().alias("pos"),
        F.trunc("o_orderdate", "month").alias("ingestion_date"),
        F.when(has_defect, json_record(F.col("defect"))).otherwise(json_record(F.lit(0))).alias("record"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload documents of every root shape, one per line."""
    record, good = F.col("record"), F.col("good")
    shape = F.col("l_linenumber")
    text = pick(
        shape,
        {
            1: record,
            2: F.concat(F.lit("["), good, F.lit(","), record, F.lit("]")),
            3: F.lit("[]"),
            4: F.concat(F.lit("["), record, F.lit("]")),
            5: F.lit("true"),
            6: F.lit('"text"'),
        },
        F.concat(F.lit("["), good, F.lit(",7,"), good, F.lit("]")),
    )
    # Each text is made once, and only for the shapes that show it; without a defect both are the same.
    return (
        trade_lines(spark, sf_dir)
        .withColumn("defect", F.coalesce(defect(), F.lit(0)))
        .withColumn("good", F.when(shape.isNull() | ~shape.isin(3, 5, 6), json_record(F.lit(0))))
        .withColumn(
            "record",
            F.when(shape.isin(1, 2, 4), F.when(F.col("defect").between(1, 13), json_record(F.col("defect"))).otherwise(F.col("good"))),
        )
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias(
                "payload_id"
            ),
            text.alias("payload"),
        )
    )


def quote_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw CSV price rows, all texts, one per line; some cells broken or missing."""
    day = F.trunc("l_shipdate", "month").cast("string")
    n = (F.col("l_orderkey") + F.col("l_partkey")) % 41
    price = F.col("l_extendedprice").cast("decimal(20,2)").cast("string")
    flag = F.when(F.col("l_linenumber") % 2 == 0, "true").otherwise("no")
    cells = {
        "session_date": day,
        "instrument_id": pick(n, {1: "   "}, F.concat(F.lit("INS-"), "l_partkey")),
        "price_datetime": F.concat(day, F.lit(" 00:00:00")),
        "price": pick(
            n,
            {
                2: "abc",
                3: "",
                4: "nan",
                5: "-Infinity",
                6: "1e5",
                7: " 2.5 ",
                8: "1_000",
                9: "1__0",
                10: ".5",
                11: "1.",
                12: "1.0d",
                13: "+7",
            },
            price,
        ),
        "currency_code": F.lit("usd"),
        "price_source_id": F.when(n == 14, F.lit(None).cast("string")).otherwise("SRC1"),
        "is_closing_price": pick(n, {15: "yes", 16: "0", 17: "TRUE", 18: "y", 19: "t"}, flag),
        "is_opening_price": pick(n, {20: " No ", 21: ""}, flag),
        "ingestion_ts": F.when(n == 22, F.lit(None).cast("string")).otherwise(
            F.concat(day, F.lit(" 00:00:00"))
        ),
    }
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("P-"), F.date_format("l_shipdate", "yyyy-MM")).alias("batch_id"),
        line_position().alias("pos"),
        *[c.alias(name) for name, c in cells.items()],
    )


LAYER_OF_EVENT = {
    "error": "raw",
    "click": "lake_validated_to_standardized",
    "view": "lake_standardized_to_silver",
    "signup": "redshift_silver",
    "purchase": "gold",
}


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as layer updates of runs: a run is a day and one of five batches.

    Batches 0 and 1 belong to prod; batch 3 writes the warehouse layer under its old key.
    """
    batch = F.col("user_id") % 5
    kind, value = F.col("event_type"), F.col("value")
    layer = F
    for name, target in LAYER_OF_EVENT.items():
        layer = layer.when(
            kind == name,
            F.when(batch == 3, "redshift").otherwise(target) if name == "signup" else target,
        )
    env = F.when(batch < 2, "prod").otherwise("dev")
    day = F.col("ts").cast("date").cast("string")
    return table(spark, sf_dir, "events").select(
        partition_key(F.lit(PROJECT), env, day).alias("pk"),
        sort_key(batch.cast("string")).alias("sk"),
        env_key(F.lit(PROJECT), env).alias("env_key"),
        env.alias("env"),
        day.alias("business_date"),
        batch.cast("string").alias("batch_id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("string").alias("t"),
        layer.alias("layer"),
        F.when(value > 20, "SUCCEEDED").when(value > 5, "PENDING").otherwise("FAILED").alias(
            "status"
        ),
        F.when(value <= 5, F.repeat(F.lit("e"), 2500)).alias("error"),
        "user_id",
        "event_type",
        "value",
    )


def run_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The update log: each event writes a layer, and every third event a raw table too."""
    events = run_events(spark, sf_dir)
    common = ["pk", "sk", "env_key", "business_date", "t"]
    lane = F.when(F.col("value") > 10, "validated").otherwise("rejected")
    layers = events.select(
        *common,
        (F.col("seq") * 2).alias("seq"),
        F.lit("layer").alias("kind"),
        "layer",
        "status",
        "error",
        F.lit("layer_status").alias("action"),
    )
    tables = events.select(
        *common,
        (F.col("seq") * 2 + 1).alias("seq"),
        F.lit("table").alias("kind"),
        F.lit("raw").alias("layer"),
        lane.alias("status"),
        F.lit("ingest_table").alias("action"),
        F.when(F.col("user_id") % 2 == 0, "price_history")
        .otherwise("trade_event")
        .alias("table_name"),
        lane.alias("lane"),
        F.concat_ws("/", lane, "seq").alias("s3_key"),
    )
    return layers.unionByName(tables, allowMissingColumns=True)


def change_feed(spark: SparkSession, sf_dir: str, width: int | None = None) -> DataFrame:
    """Old and new image of each event's layer, with malformed and foreign records.

    Statuses come in mixed case; some images have no date, no run or no layers, and
    some records are removals.
    """
    events = previous_in_order(
        run_events(spark, sf_dir), ["pk", "sk", "layer"], "seq", "status", "before", width
    )
    n = F.col("user_id") % 29
    status = "struct<status:string>"

    def layers(value: str) -> Column:
        doc = F.struct(
            F.when(n == 5, F.lower(value)).otherwise(F.col(value)).alias("status")
        ).cast(status)
        return F.create_map("layer", doc)

    missing = F.lit(None).cast(f"map<string,{status}>")

    def image(layers_of: Column) -> Column:
        return F.struct(
            "pk",
            F.when(n == 7, F.lit("X")).otherwise(F.col("sk")).alias("sk"),
            F.when(n == 9, " ")
            .when(n == 10, F.lit(None).cast("string"))
            .otherwise(F.col("business_date"))
            .alias("business_date"),
            layers_of.alias("layers"),
        )

    has_before = F.col("before").isNotNull()
    return events.select(
        "seq",
        F.when(n == 3, "REMOVE")
        .when(has_before, "MODIFY")
        .otherwise("INSERT")
        .alias("event_name"),
        image(F.when(n == 11, missing).otherwise(layers("status"))).alias("new_image"),
        F.when(has_before, image(layers("before"))).alias("old_image"),
    )
