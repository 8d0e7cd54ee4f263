"""Order within a key by ranges, against plain windows, with one key holding most rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakepnl.operators.ordered import position_in_order, previous_in_order, with_ranges


@pytest.fixture
def rows(spark):
    ids = F.col("id")
    return spark.range(3000).select(
        F.when(ids % 3 != 0, "hot").otherwise(F.concat(F.lit("k"), ids % 7)).alias("key"),
        (ids * 7 % 3001).alias("seq"),
        F.when(ids % 5 != 0, F.concat(F.lit("v"), ids % 4)).alias("value"),
    )


@pytest.mark.parametrize("width", [1, 50, 1000, 10**9])
def test_previous(rows, width):
    plain = rows.withColumn("prev", F.lag("value").over(Window.partitionBy("key").orderBy("seq")))
    got = previous_in_order(rows, ["key"], "seq", "value", "prev", width)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.select(got.columns).collect()))


@pytest.mark.parametrize("width", [1, 50, 1000, 10**9])
def test_position(rows, width):
    window = Window.partitionBy("key").orderBy("seq")
    plain = rows.withColumn("at", F.row_number().over(window) - 1)
    got = position_in_order(rows, ["key"], "seq", "at", width)
    columns = ["key", "seq", "at"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, plain.select(columns).collect())
    )


def test_ranges_of_very_large_numbers(spark):
    rows = spark.range(10).select(F.lit("k").alias("key"), (F.col("id") + (1 << 60)).alias("seq"))
    got = position_in_order(rows, ["key"], "seq", "at", 3).orderBy("seq").collect()
    assert [r["at"] for r in got] == list(range(10))


def test_sparse_numbers_and_null_keys(spark):
    """Nanoseconds on a hot key: ranges follow the rows, and a NULL key is a key."""
    ids = F.col("id")
    rows = spark.range(4000).select(
        F.when(ids % 4 != 0, "hot").when(ids % 8 == 0, "cold").alias("key"),
        (ids * 1_000_000_007 + (1 << 60)).alias("seq"),
        (ids % 3).cast("string").alias("value"),
    )
    ranged = with_ranges(rows, ["key"], "seq", 100).groupBy("key", "_range").count().collect()
    assert 30 <= len(ranged) <= 60 and max(r["count"] for r in ranged) <= 220
    window = Window.partitionBy("key").orderBy("seq")
    plain = rows.select("key", "seq", (F.row_number().over(window) - 1).alias("at"))
    for got in (position_in_order(rows, ["key"], "seq", "at", rows=100), position_in_order(rows, ["key"], "seq", "at")):
        assert sorted(map(str, got.select("key", "seq", "at").collect())) == sorted(map(str, plain.collect()))
    lagged = rows.withColumn("prev", F.lag("value").over(window))
    got = previous_in_order(rows, ["key"], "seq", "value", "prev", rows=70)
    assert sorted(map(str, got.collect())) == sorted(map(str, lagged.select(got.columns).collect()))
    assert position_in_order(rows.where("false"), ["key"], "seq", "at").count() == 0


def test_one_value_far_from_all_others(spark):
    """100,000 dense rows and one at 9e18 of the same key: ranges keep their size, and so do tasks."""
    ids = F.col("id")
    dense = spark.range(100_000).select(F.lit("hot").alias("key"), ids.alias("seq"), (ids % 3).cast("string").alias("value"))
    far = spark.sql("SELECT 'hot' AS key, 9000000000000000000L AS seq, 'far' AS value")
    rows = dense.unionByName(far).unionByName(dense.where("seq < 10").withColumn("key", F.lit("small")))
    sizes = [r["count"] for r in with_ranges(rows, ["key"], "seq", 1000).groupBy("key", "_range").count().collect()]
    assert max(sizes) <= 2000 and len(sizes) >= 90
    # More cuts than are compared one by one.
    assert max(r["count"] for r in with_ranges(rows, ["key"], "seq", 200).groupBy("key", "_range").count().collect()) <= 400
    ranged = with_ranges(rows, ["key"], "seq", 1000)
    low = ranged.groupBy("key", "_range").agg(F.min("seq").alias("low"), F.max("seq").alias("high")).orderBy("key", "_range").collect()
    assert all(a["high"] < b["low"] for a, b in zip(low, low[1:]) if a["key"] == b["key"])
    got = {r["seq"]: r["prev"] for r in previous_in_order(rows.where("key = 'hot'"), ["key"], "seq", "value", "prev", rows=1000).collect()}
    assert len(got) == 100_001 and got[0] is None and all(got[i] == str((i - 1) % 3) for i in range(1, 100_000))
    assert got[9_000_000_000_000_000_000] == "0"
    at = {r["seq"]: r["at"] for r in position_in_order(rows.where("key = 'hot'"), ["key"], "seq", "at", rows=1000).collect()}
    assert at == {**{i: i for i in range(100_000)}, 9_000_000_000_000_000_000: 100_000}
