"""Contract checks, batch verdicts and lanes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl import fixtures as fx
from lakepnl.operators import contracts as ct
from lakepnl.queries import cte
from lakepnl.queries.cte import sql
from lakepnl.schemas import PRICE_HISTORY_CONTRACT, TRADE_EVENT_CONTRACT


def checked_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.check_json_records(fx.trade_records(spark, sf_dir), TRADE_EVENT_CONTRACT)


def contract_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked_trades(spark, sf_dir).select("batch_id", "pos", "error")


def contract_type_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and batches per type error."""
    records = ct.json_type_errors(fx.trade_records(spark, sf_dir), TRADE_EVENT_CONTRACT)
    return (
        records.select("batch_id", F.explode_outer("errors").alias("error"))
        .where("error is not null")
        .groupBy("error")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("batch_id").alias("first_batch"),
        )
    )


def contract_csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ct.check_csv_rows(fx.quote_rows(spark, sf_dir), PRICE_HISTORY_CONTRACT)
    return rows.select("batch_id", "pos", "error")


def contract_payload_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per payload: records, and the error of its root or else of its first bad record."""
    payloads = fx.payloads(spark, sf_dir)
    records = ct.check_json_records(ct.payload_records(payloads), TRADE_EVENT_CONTRACT)
    error = ct.with_prefix(F.col("error"), F.col("pos"))
    # An empty list has no record row: the payloads themselves are part of the union.
    seen = payloads.select(
        "payload_id",
        F.lit(None).cast("int").alias("pos"),
        F.lit(None).cast("string").alias("reason"),
        F.lit(0).alias("records"),
    )
    found = records.select(
        "payload_id",
        "pos",
        F.coalesce("root_error", error).alias("reason"),
        F.lit(1).alias("records"),
    )
    first = F.min(F.when(F.col("reason").isNotNull(), F.struct("pos", "reason")))
    return (
        seen.unionByName(found)
        .groupBy("payload_id")
        .agg(F.sum("records").alias("records"), first["reason"].alias("reason"))
    )


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.batch_verdicts(checked_trades(spark, sf_dir), ["batch_id"])


def batch_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = ct.check_csv_rows(fx.quote_rows(spark, sf_dir), PRICE_HISTORY_CONTRACT)
    return verdicts(spark, sf_dir).unionByName(ct.batch_verdicts(quotes, ["batch_id"]))


def lane_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = fx.trade_records(spark, sf_dir)
    return ct.route_to_lanes(records, verdicts(spark, sf_dir), ["batch_id"]).select(
        "batch_id", "pos", "record", "lane"
    )


def reject_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ct.reject_report(verdicts(spark, sf_dir), "trade_event").select(
        "dataset", "batch_id", "reason"
    )


QUERIES = {
    "contract_json_records": contract_json_records,
    "contract_type_errors": contract_type_errors,
    "contract_csv_rows": contract_csv_rows,
    "contract_payload_root": contract_payload_root,
    "batch_verdict": batch_verdict,
    "lane_routing": lane_routing,
    "reject_report": reject_report,
}


def _json_literal(name: str, kind: str) -> str:
    value = {
        "fees": "coalesce(fees, 0)",
        "fx_rate": "coalesce(fx_rate, 1)",
        "currency_code": "coalesce(currency_code, 'gbp')",
        "book_id": "CAST(book_id AS INTEGER)",
    }.get(name, name)
    if kind == "string":
        return f"""'"{name}":"' || {value} || '"'"""
    return f"""'"{name}":' || CAST(CAST({value} AS DECIMAL(20,2)) AS VARCHAR)"""


def _json_text(**changes: str | None) -> str:
    parts = []
    for name, kind in TRADE_EVENT_CONTRACT.fields.items():
        if name not in changes:
            parts.append(_json_literal(name, kind))
        elif changes[name] is not None:
            parts.append(f"""'"{name}":{changes[name]}'""")
    parts += [
        f"""'"{name}":{value}'""" for name, value in changes.items()
        if name not in TRADE_EVENT_CONTRACT.fields
    ]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


RECORDS = f"""
records AS (
  SELECT concat('B-', strftime(o_orderdate, '%Y-%m')) AS batch_id, l_orderkey * 10 + l_linenumber AS pos,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS ingestion_date,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS payload_id, l_linenumber,
    {_json_text()} AS good,
    CASE CASE WHEN month(o_orderdate) % 3 = 0 THEN (l_orderkey * 7 + l_partkey) % 97 ELSE 0 END
      WHEN 1 THEN {_json_text(book_id=None)}
      WHEN 2 THEN {_json_text(zz_note='"n"', aa_note='1')}
      WHEN 3 THEN {_json_text(fees='null')}
      WHEN 4 THEN {_json_text(price='"12.5"')}
      WHEN 5 THEN {_json_text(currency_code='978')}
      WHEN 6 THEN {_json_text(book_id='true')}
      WHEN 7 THEN '42' WHEN 8 THEN '[]' WHEN 9 THEN '{{"external_event_id":'
      WHEN 10 THEN {_json_text(source_file='false')}
      WHEN 11 THEN {_json_text(custody_country='null')}
      WHEN 12 THEN {_json_text(fx_rate='[1]')}
      WHEN 13 THEN {_json_text(instrument_id='{}')}
      ELSE {_json_text()} END AS record
  FROM raw_trades
)"""

_KIND = """CASE {0} WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string'
  WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END"""


def _field_type(name: str) -> str:
    """t_<field>, its JSON type or NULL where it is missing, and k_<field>, our word for it."""
    kind = f"json_type(doc, '$.{name}')"
    return f"{kind} AS t_{name}, {_KIND.format(kind)} AS k_{name}"


FIELD_TYPES = ", ".join(
    ["json_type(doc) AS root", *[_field_type(n) for n in TRADE_EVENT_CONTRACT.fields]]
)


def _type_error(name: str, kind: str) -> str:
    return f"""CASE WHEN t_{name} IS NULL THEN NULL WHEN k_{name} = 'null' THEN '{name}: null is not allowed'
      WHEN k_{name} <> '{kind}' THEN '{name}: expected {kind}, got ' || k_{name} END"""


def _record_error() -> str:
    fields = TRADE_EVENT_CONTRACT.fields
    names = ", ".join(f"'{n}'" for n in fields)
    missing = "\n".join(f"WHEN t_{n} IS NULL THEN 'missing field {n}'" for n in fields)
    types = ",\n".join(_type_error(n, k) for n, k in fields.items())
    extra = f"list_filter(json_keys(doc), lambda k: k NOT IN ({names}))"
    return f"""CASE WHEN doc IS NULL THEN 'not valid JSON'
    WHEN root <> 'OBJECT' THEN 'expected an object, got ' || {_KIND.format('root')}
    {missing}
    WHEN len({extra}) > 0 THEN 'field not allowed: ' || {extra}[1]
    ELSE coalesce({types}) END"""


DOCUMENTS = f"""
documents_in AS MATERIALIZED (
  SELECT *, CASE WHEN json_valid(record) THEN CAST(record AS JSON) END AS doc FROM records
),
parsed AS MATERIALIZED (SELECT *, {FIELD_TYPES} FROM documents_in)"""

CHECKED = f"""
checked AS MATERIALIZED (
  SELECT batch_id, pos, ingestion_date, record, {_record_error()} AS error FROM parsed
)"""

CHECKED_QUOTES = r"""
quotes AS (
  SELECT concat('P-', strftime(l_shipdate, '%Y-%m')) AS batch_id, l_orderkey * 10 + l_linenumber AS pos,
    (l_orderkey + l_partkey) % 41 AS n
  FROM lineitem
),
checked_quotes AS (
  SELECT batch_id, pos, CASE n
    WHEN 1 THEN 'instrument_id must be text that is not blank, got ''''' WHEN 2 THEN 'price must be a number, got ''abc'''
    WHEN 3 THEN 'price must be a number, got ''''' WHEN 9 THEN 'price must be a number, got ''1__0'''
    WHEN 12 THEN 'price must be a number, got ''1.0d''' WHEN 14 THEN 'no value for column price_source_id'
    WHEN 18 THEN 'is_closing_price must be a boolean, got ''y''' WHEN 19 THEN 'is_closing_price must be a boolean, got ''t'''
    WHEN 21 THEN 'is_opening_price must be a boolean, got ''''' WHEN 22 THEN 'no value for column ingestion_ts'
    END AS error
  FROM quotes
)"""


def verdict_select(source: str) -> str:
    return f"""SELECT batch_id, count(*) AS records, count(error) AS bad_records,
  CASE WHEN count(error) = 0 THEN 'validated' ELSE 'rejected' END AS lane,
  min_by('[' || pos || '] ' || error, (pos, error)) FILTER (WHERE error IS NOT NULL) AS reason
FROM {source} GROUP BY batch_id"""


_CHECK = [cte.RAW_TRADES, RECORDS, DOCUMENTS, CHECKED]
VERDICTS = [*_CHECK, f"verdicts AS ({verdict_select('checked')})"]

_PAYLOADS = """
payloads AS (
  SELECT payload_id, CASE l_linenumber WHEN 1 THEN record WHEN 2 THEN '[' || good || ',' || record || ']'
    WHEN 3 THEN '[]' WHEN 4 THEN '[' || record || ']' WHEN 5 THEN 'true' WHEN 6 THEN '"text"'
    ELSE '[' || good || ',7,' || good || ']' END AS payload
  FROM records
),
roots AS (
  SELECT payload_id, row_number() OVER () AS row_id, CASE WHEN json_valid(payload) THEN CAST(payload AS JSON) END AS root
  FROM payloads
),
items AS (
  SELECT payload_id, row_id, NULL AS pos, root AS doc FROM roots WHERE root IS NULL OR json_type(root) <> 'ARRAY'
  UNION ALL
  SELECT payload_id, row_id, pos - 1 AS pos, json_extract(root, '$[' || (pos - 1) || ']') AS doc
  FROM (SELECT payload_id, row_id, root, unnest(range(1, CAST(json_array_length(root) AS BIGINT) + 1)) AS pos
        FROM roots WHERE json_type(root) = 'ARRAY')
)"""

_TYPE_SELECTS = "\nUNION ALL\n".join(
    f"SELECT batch_id, {_type_error(n, k)} AS error FROM parsed"
    for n, k in TRADE_EVENT_CONTRACT.fields.items()
)

ORACLES = {
    "contract_json_records": sql(_CHECK, "SELECT batch_id, pos, error FROM checked"),
    "contract_type_errors": sql(
        [cte.RAW_TRADES, RECORDS, DOCUMENTS, f"errors AS ({_TYPE_SELECTS})"],
        """SELECT error, count(*) AS records, min(batch_id) AS first_batch
FROM errors WHERE error IS NOT NULL GROUP BY error""",
    ),
    "contract_csv_rows": f"WITH {CHECKED_QUOTES} SELECT batch_id, pos, error FROM checked_quotes",
    "contract_payload_root": sql(
        [
            cte.RAW_TRADES,
            RECORDS,
            _PAYLOADS,
            f"""
typed AS MATERIALIZED (SELECT *, {FIELD_TYPES} FROM items),
found AS (
  SELECT payload_id, row_id, pos, CASE
    WHEN pos IS NULL AND doc IS NULL THEN 'not valid JSON'
    WHEN pos IS NULL AND root <> 'OBJECT' THEN
      'payload must be an object or a list of objects, got ' || {_KIND.format('root')}
    WHEN pos IS NULL THEN {_record_error()}
    ELSE '[' || pos || '] ' || ({_record_error()}) END AS reason
  FROM typed
)""",
        ],
        """SELECT r.payload_id, CAST(count(f.row_id) AS BIGINT) AS records,
  min_by(f.reason, coalesce(f.pos, -1)) FILTER (WHERE f.reason IS NOT NULL) AS reason
FROM roots r LEFT JOIN found f ON r.row_id = f.row_id GROUP BY r.payload_id""",
    ),
    "batch_verdict": sql(
        [*_CHECK, CHECKED_QUOTES],
        f"{verdict_select('checked')} UNION ALL {verdict_select('checked_quotes')}",
    ),
    "lane_routing": sql(
        VERDICTS,
        "SELECT batch_id, pos, record, lane FROM checked JOIN verdicts USING (batch_id)",
    ),
    "reject_report": sql(
        VERDICTS,
        "SELECT 'trade_event' AS dataset, batch_id, reason FROM verdicts WHERE lane = 'rejected'",
    ),
}
