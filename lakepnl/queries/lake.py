"""Lake hops, scalar conversions and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl import fixtures as fx
from lakepnl.functions import casts
from lakepnl.plans.lake import lift_payload, trade_amounts
from lakepnl.plans.marts import for_load_mode
from lakepnl.queries import cte
from lakepnl.queries.cte import sql
from lakepnl.schemas import ETL_COLUMNS, REALIZED_TYPES, UNREALIZED_TYPES

SESSION = "1998-06-01"


def std_trade_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.standardized_trades(spark, sf_dir).drop(*ETL_COLUMNS)


def std_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.standardized_prices(spark, sf_dir).drop(*ETL_COLUMNS)


def silver_trade_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.silver_trades(spark, sf_dir).drop(*ETL_COLUMNS)


def silver_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.silver_prices(spark, sf_dir).drop(*ETL_COLUMNS)


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.raw_trades(spark, sf_dir)
    # Records of both forms, side by side.
    nested = F.crc32("external_event_id") % 2 == 0
    mixed = raw.select(
        *[F.when(~nested, F.col(c)).alias(c) for c in raw.columns],
        F.when(nested, F.struct(*raw.columns)).alias("payload"),
    )
    return lift_payload(mixed)


def load_mode_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = fx.silver_trades(spark, sf_dir)
    parts = [
        for_load_mode(trades, SESSION, mode).select(
            F.lit(mode).alias("load_mode"), "session_date", "net_amount"
        )
        for mode in ("incremental", "full")
    ]
    return (
        parts[0]
        .unionByName(parts[1])
        .groupBy("load_mode", "session_date")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.sum("net_amount").cast("decimal(20,2)").alias("net_amount"),
        )
    )


def event_type_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type_id")
    return (
        fx.silver_trades(spark, sf_dir)
        .select(
            F.when(kind.isin(*REALIZED_TYPES), "realized")
            .when(kind.isin(*UNREALIZED_TYPES), "unrealized")
            .otherwise("none")
            .alias("bucket"),
            kind,
            "net_amount",
        )
        .groupBy("bucket", "event_type_id")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.sum("net_amount").cast("decimal(20,2)").alias("net_amount"),
        )
    )


def _line_key() -> list:
    return ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def fn_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    text = fx.pick(
        F.col("l_linenumber"),
        {
            1: day,
            2: F.concat(day, F.lit(" 10:20:30")),
            3: F.concat(day, F.lit("T10:20:30Z")),
            4: F.concat(F.lit("  "), day, F.lit(" ")),
            5: F.lit("not a date"),
            6: F.concat(F.substring(day, 1, 7), F.lit("-32")),
        },
        "",
    )
    rows = fx.table(spark, sf_dir, "lineitem").select(*_line_key(), text.alias("text"))
    return rows.select(
        *_line_key(),
        casts.as_date(F.col("text")).alias("as_date"),
        casts.as_timestamp(F.col("text")).cast("string").alias("as_time"),
        casts.as_timestamp(F.col("text")).cast("date").alias("time_date"),
    )


def fn_decimal_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(20,2)").cast("string")
    text = fx.pick(
        F.col("l_linenumber"),
        {
            1: amount,
            2: F.concat(amount, F.lit("5")),
            3: F.concat(F.lit("-"), amount, F.lit("49999")),
            4: F.concat(amount, F.lit("00123456789")),
            5: F.concat(F.lit(" "), amount, F.lit(" ")),
            6: F.lit("12.3.4"),
        },
        F.concat(F.lit("9" * 19), amount),
    )
    rows = fx.table(spark, sf_dir, "lineitem").select(*_line_key(), text.alias("text"))
    return rows.select(
        *_line_key(),
        *[casts.as_decimal(F.col("text"), s).alias(f"scale_{s}") for s in (2, 6, 8)],
    )


def fn_bool_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = fx.pick(
        F.col("l_linenumber"),
        {1: "true", 2: "FALSE", 3: "1", 4: "0", 5: "yes", 6: "No"},
        F.col("l_returnflag"),
    )
    rows = fx.table(spark, sf_dir, "lineitem").select(*_line_key(), text.alias("text"))
    return rows.select(*_line_key(), "text", casts.as_boolean(F.col("text")).alias("flag"))


def fn_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.standardized_trades(spark, sf_dir).select(
        "external_event_id", "fees", "fx_rate", "currency_code"
    )


def fn_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    std = fx.standardized_trades(spark, sf_dir)
    # Rates of zero on one line number: no dollar amount, and no failed job.
    rate = F.when(F.col("event_type_id") == "BUY", F.lit(0).cast("decimal(20,8)")).otherwise(
        F.col("fx_rate")
    )
    amounts = trade_amounts(F.col("nominal_delta"), F.col("price"), F.col("fees"), rate)
    return std.select("external_event_id", *[c.alias(n) for n, c in amounts.items()])


def fn_date_trunc(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    anchor = F.lit(SESSION).cast("date")
    return fx.table(spark, sf_dir, "lineitem").select(
        *_line_key(),
        F.trunc(day, "month").alias("month_start"),
        F.trunc(day, "year").alias("year_start"),
        (F.trunc(day, "month") == F.trunc(anchor, "month")).alias("same_month"),
        (F.trunc(day, "year") == F.trunc(anchor, "year")).alias("same_year"),
    )


QUERIES = {
    "std_trade_event": std_trade_event,
    "std_price_history": std_price_history,
    "silver_trade_event": silver_trade_event,
    "silver_price_history": silver_price_history,
    "flatten_payload": flattened,
    "load_mode_filter": load_mode_filter,
    "event_type_buckets": event_type_buckets,
    "fn_dates": fn_dates,
    "fn_decimal_cast": fn_decimal_cast,
    "fn_bool_cast": fn_bool_cast,
    "fn_defaults": fn_defaults,
    "fn_amounts": fn_amounts,
    "fn_date_trunc": fn_date_trunc,
}

_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
_RAW_COLUMNS = """external_event_id, session_date, event_datetime, settlement_datetime, book_id, instrument_id,
 event_type_id, custody_country, nominal_delta, price, fees, CAST(fx_rate AS DOUBLE) AS fx_rate, currency_code,
 source_file, ingestion_ts"""

ORACLES = {
    "std_trade_event": sql([cte.RAW_TRADES, cte.STD_TRADES], "SELECT * FROM std_trades"),
    "std_price_history": sql([cte.RAW_PRICES, cte.STD_PRICES], "SELECT * FROM std_prices"),
    "silver_trade_event": sql(cte.TRADES, "SELECT * FROM silver_trades"),
    "silver_price_history": sql(cte.PRICES, "SELECT * FROM silver_prices"),
    "flatten_payload": sql([cte.RAW_TRADES], f"SELECT {_RAW_COLUMNS} FROM raw_trades"),
    "load_mode_filter": sql(
        cte.TRADES,
        f"""SELECT m.load_mode, session_date, count(*) AS trades, CAST(sum(net_amount) AS DECIMAL(20,2)) AS net_amount
FROM silver_trades JOIN (SELECT 'full' AS load_mode UNION ALL SELECT 'incremental') m
  ON m.load_mode = 'full' OR session_date = DATE '{SESSION}'
GROUP BY m.load_mode, session_date""",
    ),
    "event_type_buckets": sql(
        cte.TRADES,
        """SELECT CASE WHEN event_type_id IN ('SELL', 'MATURITY', 'DIVIDEND', 'COUPON') THEN 'realized'
  WHEN event_type_id IN ('PRICE_UPDATE', 'FX_REVALUATION') THEN 'unrealized' ELSE 'none' END AS bucket,
  event_type_id, count(*) AS trades, CAST(sum(net_amount) AS DECIMAL(20,2)) AS net_amount
FROM silver_trades GROUP BY ALL""",
    ),
    "fn_dates": f"""SELECT {_KEY},
  CASE WHEN l_linenumber <= 4 THEN CAST(l_shipdate AS DATE) END AS as_date,
  CASE WHEN l_linenumber IN (1, 4) THEN strftime(l_shipdate, '%Y-%m-%d 00:00:00')
    WHEN l_linenumber IN (2, 3) THEN strftime(l_shipdate, '%Y-%m-%d 10:20:30') END AS as_time,
  CASE WHEN l_linenumber <= 4 THEN CAST(l_shipdate AS DATE) END AS time_date
FROM lineitem""",
    "fn_decimal_cast": f"""WITH t AS (
  SELECT {_KEY}, CAST(CAST(l_extendedprice AS DECIMAL(20,2)) AS VARCHAR) AS amount FROM lineitem
), u AS (
  SELECT {_KEY}, CASE l_linenumber WHEN 1 THEN amount WHEN 2 THEN amount || '5' WHEN 3 THEN '-' || amount || '49999'
    WHEN 4 THEN amount || '00123456789' WHEN 5 THEN ' ' || amount || ' ' WHEN 6 THEN '12.3.4'
    ELSE '{"9" * 19}' || amount END AS text FROM t
)
SELECT {_KEY}, TRY_CAST(text AS DECIMAL(20,2)) AS scale_2, TRY_CAST(text AS DECIMAL(20,6)) AS scale_6,
  TRY_CAST(text AS DECIMAL(20,8)) AS scale_8 FROM u""",
    "fn_bool_cast": f"""SELECT {_KEY}, text,
  CASE WHEN lower(text) IN ('true', '1', 'yes', 'y', 't') THEN true
    WHEN lower(text) IN ('false', '0', 'no', 'n', 'f') THEN false END AS flag
FROM (SELECT {_KEY}, CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN 'FALSE' WHEN 3 THEN '1' WHEN 4 THEN '0'
  WHEN 5 THEN 'yes' WHEN 6 THEN 'No' ELSE l_returnflag END AS text FROM lineitem)""",
    "fn_defaults": sql(
        [cte.RAW_TRADES, cte.STD_TRADES],
        "SELECT external_event_id, fees, fx_rate, currency_code FROM std_trades",
    ),
    "fn_amounts": sql(
        cte.TRADES,
        """SELECT external_event_id, gross_amount, net_amount,
  CASE WHEN event_type_id <> 'BUY' THEN net_amount_usd END AS net_amount_usd FROM silver_trades""",
    ),
    "fn_date_trunc": f"""SELECT {_KEY}, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
  CAST(date_trunc('year', l_shipdate) AS DATE) AS year_start,
  year(l_shipdate) = 1998 AND month(l_shipdate) = 6 AS same_month, year(l_shipdate) = 1998 AS same_year
FROM lineitem""",
}
