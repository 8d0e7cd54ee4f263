"""Tables, contracts and the layer chain.

Names, types, lengths and orders in this module are fixed values of the data model.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    max_length: int | None = None
    required: bool = False

    @property
    def data_type(self) -> T.DataType:
        return T.StructType.fromDDL(f"c {self.type}")["c"].dataType


@dataclass(frozen=True)
class Table:
    layer: str
    name: str
    columns: tuple[Column, ...]
    partition: str

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.data_type) for c in self.columns])


def _text(name: str, length: int, required: bool = False) -> Column:
    return Column(name, "string", length, required)


def _date(name: str, required: bool = False) -> Column:
    return Column(name, "date", None, required)


def _ts(name: str, required: bool = False) -> Column:
    return Column(name, "timestamp", None, required)


def _dec(name: str, scale: int) -> Column:
    return Column(name, f"decimal(20,{scale})")


def _bool(name: str) -> Column:
    return Column(name, "boolean")


STANDARDIZED_TRADE_EVENT = Table(
    "standardized",
    "trade_event",
    (
        _text("external_event_id", 100),
        _date("session_date"),
        _ts("event_datetime"),
        _ts("settlement_datetime"),
        _text("book_id", 50),
        _text("instrument_id", 80),
        _text("event_type_id", 40),
        _text("custody_country", 60),
        _text("currency_code", 10),
        _dec("nominal_delta", 6),
        _dec("price", 8),
        _dec("fees", 2),
        _dec("fx_rate", 8),
        _text("source_file", 200),
        _ts("ingestion_ts"),
        _ts("etl_standardized_at"),
        _date("load_date"),
    ),
    "load_date",
)

STANDARDIZED_PRICE_HISTORY = Table(
    "standardized",
    "price_history",
    (
        _date("session_date"),
        _text("instrument_id", 80),
        _ts("price_datetime"),
        _dec("price", 8),
        _text("currency_code", 10),
        _text("price_source_id", 30),
        _bool("is_closing_price"),
        _bool("is_opening_price"),
        _ts("ingestion_ts"),
        _ts("etl_standardized_at"),
        _date("load_date"),
    ),
    "load_date",
)

SILVER_TRADE_EVENT = Table(
    "silver",
    "trade_event",
    (
        _text("external_event_id", 100),
        _date("session_date"),
        _ts("event_datetime"),
        _ts("settlement_datetime"),
        _text("book_id", 50),
        _text("instrument_id", 80),
        _text("event_type_id", 40),
        _text("custody_country", 60),
        _text("currency_code", 10),
        _dec("nominal_delta", 6),
        _dec("price", 8),
        _dec("gross_amount", 2),
        _dec("fees", 2),
        _dec("net_amount", 2),
        _dec("fx_rate", 8),
        _dec("net_amount_usd", 2),
        _text("source_system", 30),
        _ts("etl_loaded_at"),
        _date("load_date"),
    ),
    "load_date",
)

SILVER_PRICE_HISTORY = Table(
    "silver",
    "price_history",
    (
        _date("session_date"),
        _text("instrument_id", 80),
        _ts("price_datetime"),
        _dec("price", 8),
        _text("currency_code", 10),
        _text("price_source_id", 30),
        _bool("is_closing_price"),
        _bool("is_opening_price"),
        _ts("ingestion_ts"),
        _text("source_system", 30),
        _ts("etl_loaded_at"),
        _date("load_date"),
    ),
    "load_date",
)

FACT_TRADE_EVENT = Table(
    "facts",
    "fact_trade_event",
    (
        _text("external_event_id", 100, True),
        _date("session_date", True),
        _ts("event_datetime", True),
        _ts("settlement_datetime"),
        _text("book_id", 50, True),
        _text("instrument_id", 80, True),
        _text("event_type_id", 40, True),
        _text("custody_country", 60),
        _text("currency_code", 10),
        _dec("nominal_delta", 6),
        _dec("price", 8),
        _dec("gross_amount", 2),
        _dec("fees", 2),
        _dec("net_amount", 2),
        _dec("fx_rate", 8),
        _dec("net_amount_usd", 2),
        _text("source_system", 30),
        _ts("etl_loaded_at"),
    ),
    "session_date",
)

FACT_PRICE_HISTORY = Table(
    "facts",
    "fact_price_history",
    (
        _date("session_date", True),
        _text("instrument_id", 80, True),
        _ts("price_datetime", True),
        _dec("price", 8),
        _text("currency_code", 10),
        _text("price_source_id", 30),
        _bool("is_closing_price"),
        _bool("is_opening_price"),
        _text("source_system", 30),
        _ts("etl_loaded_at"),
    ),
    "session_date",
)

GOLD_PNL_DAILY = Table(
    "gold",
    "silver_pnl_daily",
    (
        _date("session_date", True),
        _text("book_id", 50, True),
        _text("instrument_id", 80, True),
        _text("custody_country", 60),
        _text("currency_code", 10),
        _dec("nominal_close", 6),
        _dec("market_price_close", 8),
        _dec("market_value_close", 2),
        _dec("realized_pnl_session", 2),
        _dec("unrealized_pnl_session", 2),
        _dec("total_pnl_daily", 2),
        _dec("pnl_mtd", 2),
        _dec("pnl_ytd", 2),
        _dec("pnl_itd", 2),
        _dec("fees_session", 2),
        _ts("etl_loaded_at"),
    ),
    "session_date",
)

GOLD_REPORT_PNL = Table(
    "gold",
    "gold_report_pnl",
    (
        _date("session_date", True),
        _text("book_id", 50, True),
        _text("instrument_id", 80, True),
        _text("custody_country", 60),
        _text("currency_code", 10),
        _dec("market_price_close", 8),
        _dec("nominal_close", 6),
        _dec("market_value_close", 2),
        _dec("pnl_daily", 2),
        _dec("pnl_mtd", 2),
        _dec("pnl_ytd", 2),
        _dec("pnl_itd", 2),
        _text("row_type", 20),
        _ts("etl_loaded_at"),
    ),
    "session_date",
)

# Tables in the order in which their definitions are applied, by target.
MANIFEST: dict[str, tuple[Table, ...]] = {
    "lake": (
        STANDARDIZED_TRADE_EVENT,
        STANDARDIZED_PRICE_HISTORY,
        SILVER_TRADE_EVENT,
        SILVER_PRICE_HISTORY,
    ),
    "warehouse": (
        FACT_TRADE_EVENT,
        FACT_PRICE_HISTORY,
        GOLD_PNL_DAILY,
        GOLD_REPORT_PNL,
    ),
}

ETL_COLUMNS = ("etl_standardized_at", "etl_loaded_at")


@dataclass(frozen=True)
class JsonContract:
    """Ordered field -> type; every field is required unless listed as optional."""

    fields: dict[str, str]
    optional: tuple[str, ...] = ()
    additional: bool = False

    @property
    def required(self) -> list[str]:
        return [name for name in self.fields if name not in self.optional]


@dataclass(frozen=True)
class CsvContract:
    columns: dict[str, str]
    delimiter: str = ","


TRADE_EVENT_CONTRACT = JsonContract(
    {
        "external_event_id": "string",
        "session_date": "string",
        "event_datetime": "string",
        "settlement_datetime": "string",
        "book_id": "number",
        "instrument_id": "string",
        "event_type_id": "string",
        "custody_country": "string",
        "nominal_delta": "number",
        "price": "number",
        "fees": "number",
        "fx_rate": "number",
        "currency_code": "string",
        "source_file": "string",
        "ingestion_ts": "string",
    }
)

PRICE_HISTORY_CONTRACT = CsvContract(
    {
        "session_date": "string",
        "instrument_id": "string",
        "price_datetime": "string",
        "price": "number",
        "currency_code": "string",
        "price_source_id": "string",
        "is_closing_price": "boolean",
        "is_opening_price": "boolean",
        "ingestion_ts": "string",
    }
)

# book_id is read as the text of its JSON number: the tables hold it as a string.
RAW_TRADE_EVENT = T.StructType(
    [
        T.StructField(
            name,
            T.DoubleType() if kind == "number" and name != "book_id" else T.StringType(),
        )
        for name, kind in TRADE_EVENT_CONTRACT.fields.items()
    ]
)


# Files may hold prices as texts or as JSON values; both are read as texts.
RAW_PRICE_HISTORY = T.StructType(
    [T.StructField(name, T.StringType()) for name in PRICE_HISTORY_CONTRACT.columns]
)

SOURCE_SYSTEM = "finanzas_api"

REALIZED_TYPES = ("SELL", "MATURITY", "DIVIDEND", "COUPON")
UNREALIZED_TYPES = ("PRICE_UPDATE", "FX_REVALUATION")

# Layer chain: each layer runs after the one before it.
LAYERS = (
    "raw",
    "lake_validated_to_standardized",
    "lake_standardized_to_silver",
    "redshift_silver",
    "gold",
)
PREVIOUS_LAYER = dict(zip(LAYERS[1:], LAYERS[:-1]))
# A layer key written by older runs, accepted in place of the current one.
LEGACY_LAYER_KEYS = {"redshift_silver": "redshift"}
EXPECTED_RAW_TABLES = ("trade_event", "price_history")


@dataclass(frozen=True)
class Route:
    layer: str
    action: str
    target: str
    name_prefix: str = ""


# What the success of a layer starts.
ROUTES: tuple[Route, ...] = (
    Route("raw", "StartJobRun", "validated_to_standardized"),
    Route("lake_validated_to_standardized", "StartJobRun", "standardized_to_silver"),
    Route("lake_standardized_to_silver", "StartExecution", "copy", "cp"),
    Route("redshift_silver", "StartExecution", "gold", "gd"),
)


@dataclass(frozen=True)
class Load:
    """A warehouse load and the lake table it reads."""

    script: str
    table: str
    contract: bool = True


LOADS: tuple[Load, ...] = (
    Load("copy_s3_to_silver/fact_trade_event.sql", "trade_event"),
    Load("copy_s3_to_silver/fact_price_history.sql", "price_history"),
)


# The scripts that make up each warehouse layer, in the order they run.
LAYER_SCRIPTS: dict[str, tuple[str, ...]] = {
    "redshift_silver": tuple(load.script for load in LOADS),
    "gold": (
        "silver_to_gold/pnl_daily.sql",
        "silver_to_gold/report_pnl.sql",
    ),
}


@dataclass(frozen=True)
class JobInputs:
    """The input contract that a job checks for each dataset before it runs."""

    job: str
    inputs: dict[str, JsonContract | CsvContract | Table] = field(default_factory=dict)


JOB_INPUTS: tuple[JobInputs, ...] = (
    JobInputs(
        "validated_to_standardized",
        {
            "trade_event": JsonContract(
                {
                    "external_event_id": "string",
                    "session_date": "string",
                    "event_datetime": "string",
                },
                additional=True,
            ),
            "price_history": CsvContract(
                {"session_date": "string", "instrument_id": "string", "price": "number"}
            ),
        },
    ),
    JobInputs(
        "standardized_to_silver",
        {
            "trade_event": STANDARDIZED_TRADE_EVENT,
            "price_history": STANDARDIZED_PRICE_HISTORY,
        },
    ),
)
