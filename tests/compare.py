"""Run a registered query and its check SQL side by side.

python tests/compare.py SF [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def oracle_rows(sf_dir: str, text: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(text)
    return [d[0] for d in cursor.description], cursor.fetchall()


def difference(spark, sf_dir: str, query, text: str | None) -> tuple[int, str]:
    """Number of rows, and what differs ('' when both sides agree)."""
    df = query(spark, sf_dir)
    got = df.collect()
    if text is None:
        return len(got), ""
    names, want = oracle_rows(sf_dir, text)
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} against {sorted(names)}"
    left, right = rows_of(df.columns, got), rows_of(names, want)
    if left == right:
        return len(got), ""
    return len(got), (
        f"rows {len(got)} against {len(want)}; only here {list((left - right).items())[:2]}; "
        f"only there {list((right - left).items())[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from lakepnl.session import local_session

    spark = local_session(8)
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            rows, problem = difference(spark, sf_dir, queries[name], oracles.get(name))
        except Exception as error:  # noqa: BLE001
            rows, problem = -1, f"{type(error).__name__} {str(error)[:1500]}"
        state = "DIFF" if problem else ("same" if name in oracles else "rows")
        print(f"{state} {name} {rows} {time.time() - start:.1f}s {problem[:2500]}", flush=True)


if __name__ == "__main__":
    main()
