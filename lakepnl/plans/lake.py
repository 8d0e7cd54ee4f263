"""The two lake hops: raw to standardized, standardized to silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepnl.functions.casts import (
    as_boolean,
    as_date,
    as_decimal,
    as_timestamp,
    integral_text,
    upper_or_blank,
)
from lakepnl.schemas import (
    SILVER_PRICE_HISTORY,
    SILVER_TRADE_EVENT,
    SOURCE_SYSTEM,
    STANDARDIZED_PRICE_HISTORY,
    STANDARDIZED_TRADE_EVENT,
    Table,
)


def _project(df: DataFrame, table: Table, computed: dict[str, Column]) -> DataFrame:
    """One select in table order; columns that are not computed pass through by name."""
    return df.select(
        *[computed.get(c.name, F.col(c.name)).alias(c.name) for c in table.columns]
    )


def _amount(c: Column) -> Column:
    return c.try_cast("decimal(20,2)")


def with_payload(schema: T.StructType) -> T.StructType:
    """Schema of records that have their fields at the root or in a `payload` object."""
    return T.StructType([*schema.fields, T.StructField("payload", schema)])


def lift_payload(df: DataFrame) -> DataFrame:
    """Fields of the payload object become those of the record, row by row.

    A fixed schema saves the pass over all files that inferring one would take. Records
    of both forms may be mixed: the payload counts where the root has no event id.
    """
    nested = F.col("external_event_id").isNull() & F.col("payload").isNotNull()
    names = [c for c in df.columns if c != "payload"]
    return df.select(
        *[F.when(nested, F.col(f"payload.{n}")).otherwise(F.col(n)).alias(n) for n in names]
    )


def standardize_trade_event(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        STANDARDIZED_TRADE_EVENT,
        {
            "session_date": as_date(F.col("session_date")),
            "event_datetime": as_timestamp(F.col("event_datetime")),
            "settlement_datetime": as_timestamp(F.col("settlement_datetime")),
            "book_id": integral_text(F.col("book_id")),
            "nominal_delta": as_decimal(F.col("nominal_delta"), 6),
            "price": as_decimal(F.col("price"), 8),
            "fees": F.coalesce(as_decimal(F.col("fees"), 2), F.lit(0).cast("decimal(20,2)")),
            "fx_rate": F.coalesce(
                as_decimal(F.col("fx_rate"), 8), F.lit(1).cast("decimal(20,8)")
            ),
            "currency_code": upper_or_blank(F.col("currency_code")),
            "ingestion_ts": as_timestamp(F.col("ingestion_ts")),
            "etl_standardized_at": F.current_timestamp(),
            "load_date": as_timestamp(F.col("ingestion_ts")).cast("date"),
        },
    )


def standardize_price_history(raw: DataFrame) -> DataFrame:
    return _project(
        raw,
        STANDARDIZED_PRICE_HISTORY,
        {
            "session_date": as_date(F.col("session_date")),
            "price_datetime": as_timestamp(F.col("price_datetime")),
            "price": as_decimal(F.col("price"), 8),
            "currency_code": upper_or_blank(F.col("currency_code")),
            "is_closing_price": as_boolean(F.col("is_closing_price")),
            "is_opening_price": as_boolean(F.col("is_opening_price")),
            "ingestion_ts": as_timestamp(F.col("ingestion_ts")),
            "etl_standardized_at": F.current_timestamp(),
            "load_date": as_timestamp(F.col("ingestion_ts")).cast("date"),
        },
    )


def trade_amounts(nominal: Column, price: Column, fees: Column, fx_rate: Column) -> dict[str, Column]:
    """Gross, net and net in dollars, each rounded half up to cents before the next step."""
    gross = _amount(F.try_multiply(nominal, price))
    total = F.try_add(gross, fees)
    return {
        "gross_amount": gross,
        "net_amount": _amount(total),
        "net_amount_usd": _amount(F.try_divide(total, fx_rate)),
    }


def silver_trade_event(standardized: DataFrame) -> DataFrame:
    return _project(
        standardized,
        SILVER_TRADE_EVENT,
        {
            **trade_amounts(
                F.col("nominal_delta"), F.col("price"), F.col("fees"), F.col("fx_rate")
            ),
            "source_system": F.lit(SOURCE_SYSTEM),
            "etl_loaded_at": F.current_timestamp(),
        },
    )


def silver_price_history(standardized: DataFrame) -> DataFrame:
    return _project(
        standardized,
        SILVER_PRICE_HISTORY,
        {"source_system": F.lit(SOURCE_SYSTEM), "etl_loaded_at": F.current_timestamp()},
    )
