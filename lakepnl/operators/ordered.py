"""Row order within a key, without ever sorting a whole key in one task.

A key with more rows than a task should sort is cut into ranges of about equal numbers of rows, at
quantiles of its own order column. So ranges follow the rows, however the values are spread: one
value far from all others makes no difference. Rows are sorted per key and range; only one row per
range, its count or its last value, is sorted per key. A key that holds a third of all rows is
spread over as many tasks as it has ranges, and keys of usual size are one range each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepnl.session import stored

ROWS_PER_RANGE = 1_000_000
#: Ranges of a key at most; beyond, they hold more rows each.
MOST_RANGES = 10_000
#: Cuts that are compared one by one; more are looked up in two steps.
STEP = 100


def _fixed(order: str, width: int) -> Column:
    """First order value of a row's range of equal width; whole numbers only, so it is exact at any size."""
    return F.col(order) - F.pmod(F.col(order), F.lit(width))


def range_cuts(df: DataFrame, keys: list[str], order: str, rows: int = ROWS_PER_RANGE) -> DataFrame | None:
    """Order values at which each large key is cut; one row per key of more than `rows` rows.

    There is one cut for `rows` rows in all, so this is small next to the rows. The quantiles come
    from sketches that are merged; they only have to rise, so they need not be exact.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    most = counts.agg(F.max("_rows")).first()[0]
    if most is None or most <= rows:
        return None
    large = stored(counts.where(F.col("_rows") > rows), "large-keys")
    n = min(-(-most // rows), MOST_RANGES)
    held = large.select(*[F.col(k).alias(f"_{k}") for k in keys], "_rows")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.lit(True))
    some = df.select(*keys, F.col(order).cast("long").alias("_order")).join(held, same)
    sketch = F.percentile_approx("_order", [i / n for i in range(1, n)] or [0.5], 20 * n)
    cuts = some.groupBy(*keys).agg(sketch.alias("_all"), F.first("_rows").alias("_rows"))
    # A key of fewer rows takes every so many of the quantiles.
    every = F.greatest(F.lit(1), F.floor(F.lit(n) * rows / F.col("_rows"))).cast("int")
    chosen = F.array_distinct(F.filter("_all", lambda c, i: (i + 1) % every == 0))
    made = cuts.select(*keys, chosen.alias("_cuts"))
    coarse = F.filter("_cuts", lambda c, i: i % STEP == 0)
    return stored(made.withColumn("_coarse", coarse), "cuts")


def _below(cuts: Column, order: str) -> Column:
    return F.size(F.filter(cuts, lambda c: c <= F.col(order).cast("long")))


def with_ranges(df: DataFrame, keys: list[str], order: str, rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Adds _range, the number of cuts of its key up to a row; 0 for keys of usual size."""
    cuts = range_cuts(df, keys, order, rows)
    if cuts is None:
        return df.withColumn("_range", F.lit(0))
    placed = df.join(cuts, _same(df, cuts, keys), "left").select(*[df[c] for c in df.columns], "_cuts", "_coarse")
    step = F.greatest(_below(F.col("_coarse"), order) - 1, F.lit(0)) * STEP
    here = step + _below(F.slice("_cuts", step + 1, F.lit(STEP)), order)
    return placed.withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(here)).drop("_cuts", "_coarse")


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equal keys, NULL being equal to NULL."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def previous_in_order(
    df: DataFrame, keys: list[str], order: str, value: str, out: str, width: int | None = None, rows: int = ROWS_PER_RANGE
) -> DataFrame:
    """Adds the value of the row before, per key; `order` is unique within a key.

    Ranges have about `rows` rows, for which keys are counted first; `width` gives ranges of equal
    width of the order column instead, without a pass of their own.
    """
    ranged = df.withColumn("_range", _fixed(order, width)) if width else with_ranges(df, keys, order, rows)
    rows = ranged.withColumn("_carried", F.lit(False))
    last = rows.groupBy(*keys, "_range").agg(
        F.max(order).alias(order), F.max_by(value, order).alias(value)
    )
    next_range = F.lead("_range").over(Window.partitionBy(*keys).orderBy("_range"))
    # The last row of a range also stands in front of the next range that has rows.
    carried = (
        last.withColumn("_next", next_range)
        .where("_next is not null")
        .select(*keys, F.col("_next").alias("_range"), order, value, F.lit(True).alias("_carried"))
    )
    within = Window.partitionBy(*keys, "_range").orderBy(order)
    return (
        rows.unionByName(carried, allowMissingColumns=True)
        .withColumn(out, F.lag(value).over(within))
        .where("not _carried")
        .drop("_range", "_carried")
    )


def position_in_order(
    df: DataFrame,
    keys: list[str],
    order: str,
    out: str,
    width: int | None = None,
    group: Column | None = None,
    rows: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Adds the 0-based position of each row within its key.

    `group` replaces the ranges of the order column by a grouping of one's own, whose
    values must rise along the order; for `width` and `rows` see `previous_in_order`.
    """
    if group is None and width:
        group = _fixed(order, width)
    rows = with_ranges(df, keys, order, rows) if group is None else df.withColumn("_range", group)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        rows.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    within = Window.partitionBy(*keys, "_range").orderBy(order)
    numbered = rows.withColumn("_at", F.row_number().over(within) - 1)
    return (
        numbered.join(offsets, _same(numbered, offsets, [*keys, "_range"]))
        .select(*[numbered[c] for c in df.columns], (F.col("_at") + F.col("_offset")).alias(out))
    )
