"""The daily P&L mart, its measures and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakepnl import fixtures as fx
from lakepnl.plans import marts
from lakepnl.plans.scripts import report_script, run_script
from lakepnl.queries import cte
from lakepnl.queries.cte import sql
from lakepnl.schemas import ETL_COLUMNS

SESSION = "1998-06-01"
KEYS = marts.POSITION_KEYS


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.pnl_daily(
        fx.trade_facts(spark, sf_dir), fx.price_facts(spark, sf_dir), SESSION, "full"
    )


def pnl_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily(spark, sf_dir).drop(*ETL_COLUMNS)


def gold_report_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.gold_report_pnl(daily(spark, sf_dir), SESSION, "full").drop(*ETL_COLUMNS)


def param_sql_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    incremental = marts.pnl_daily(
        fx.trade_facts(spark, sf_dir), fx.price_facts(spark, sf_dir), SESSION
    )
    return run_script(
        spark, report_script(), {"session_date": SESSION}, daily=incremental
    ).drop(*ETL_COLUMNS)


def trade_price_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = marts.with_prices(fx.trade_facts(spark, sf_dir), fx.price_facts(spark, sf_dir))
    return joined.select(
        "external_event_id",
        "session_date",
        "instrument_id",
        "net_amount",
        "price_rows",
        "join_rows",
        "market_price_close",
    )


def agg_max_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A highest text is the same however often its row is joined, so no price is read.
    return marts.positions(fx.trade_facts(spark, sf_dir)).select(
        *KEYS, "custody_country", "currency_code"
    )


def _measures(*names: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return daily(spark, sf_dir).select(*KEYS, *names)

    return query


MEASURES = {
    "agg_nominal_close": ("nominal_close",),
    "agg_closing_price": ("market_price_close",),
    "agg_market_value": ("market_value_close",),
    "agg_pnl_buckets": ("realized_pnl_session", "unrealized_pnl_session", "total_pnl_daily"),
    "agg_period_pnl": ("pnl_mtd", "pnl_ytd"),
    "agg_pnl_itd": ("pnl_itd",),
    "agg_fees": ("fees_session",),
}

QUERIES = {
    "pnl_daily": pnl_daily,
    "gold_report_pnl": gold_report_pnl,
    "param_sql_gold": param_sql_gold,
    "trade_price_left_join": trade_price_left_join,
    "agg_max_dims": agg_max_dims,
    **{name: _measures(*columns) for name, columns in MEASURES.items()},
}

_ALL = [*cte.TRADES, *cte.SOME_PRICES]
REPORT = """SELECT session_date, book_id, instrument_id, custody_country, currency_code, market_price_close,
  nominal_close, market_value_close, total_pnl_daily AS pnl_daily, pnl_mtd, pnl_ytd, pnl_itd,
  'position' AS row_type FROM pnl"""


def _mart(select: str) -> str:
    return sql([*_ALL, cte.pnl_cte(SESSION)], select)


ORACLES = {
    "pnl_daily": _mart("SELECT * FROM pnl"),
    "gold_report_pnl": _mart(REPORT),
    "param_sql_gold": sql(
        [*_ALL, cte.pnl_cte(SESSION, f"session_date = DATE '{SESSION}'")], REPORT
    ),
    "trade_price_left_join": sql(
        [
            cte.RAW_TRADES,
            cte.STD_TRADES,
            cte.SILVER_TRADES,
            *cte.SOME_PRICES,
            "numbered AS (SELECT *, row_number() OVER () AS row_id FROM silver_trades)",
        ],
        """SELECT any_value(e.external_event_id) AS external_event_id, any_value(e.session_date) AS session_date,
  any_value(e.instrument_id) AS instrument_id, any_value(e.net_amount) AS net_amount,
  count(p.instrument_id) AS price_rows, count(*) AS join_rows,
  max(CASE WHEN p.is_closing_price THEN p.price END) AS market_price_close
FROM numbered e LEFT JOIN silver_prices p ON e.session_date = p.session_date AND e.instrument_id = p.instrument_id
GROUP BY e.row_id""",
    ),
    "agg_max_dims": _mart(f"SELECT {', '.join(KEYS)}, custody_country, currency_code FROM pnl"),
    **{
        name: _mart(f"SELECT {', '.join(KEYS)}, {', '.join(columns)} FROM pnl")
        for name, columns in MEASURES.items()
    },
}
