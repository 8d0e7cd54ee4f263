"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources in code point order, null last, have the weights 1, 2, 3, 1, ... and share the
words of all documents; a target stops at LIMIT times the words of its source, and the excess
goes to the others by weight, until no target is above its limit. The result is the level x for
which the sum of min(weight * x, limit) is all words; it is found by a few sums over the sources.

Expected copies. A document of a source is expected c * g(size) times, at most LIMIT times, where g
falls with the size (`damping`), so that one long document is repeated less than many short
ones, and c brings the source's expected words to its target. c is exact: sizes are put into
classes, and the few classes of a source are settled by running sums.

Sampling. The whole part of the expectation is allocated at once, to every document. The fraction p
is an inclusion probability, unequal between classes. Documents are ranked by random odds over
inclusion odds, u / (1 - u) : p / (1 - p), and taken in that order as long as they fit into the words
that are left for the source; a document that does not fit is passed over. So the sample is of fixed
size in words. At the end one document, the one nearest in size to what is still missing, is
taken once more if that brings the source nearer to its target.

No source is gathered in a task: ranks are cut into buckets, words are summed by bucket, and only the
bucket where a source's words run out is sorted. u is a hash of id, source and text, and of the number
among equal rows, so reruns agree, and equal rows are told apart. Null texts and texts
without words have size 0 and are never taken. A null id is an id of its own. An empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepnl.llm.text import saved
from lakepnl.operators.ordered import position_in_order
from lakepnl.session import ship_package

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
LIMIT = 3
DAMPING = 0.25
#: Classes of size for each doubling.
CLASSES = 4
#: Buckets of the rank for each unit; none holds more than a 2,000th of the rows of a class.
BUCKETS = 512
#: Shares of a source's rows that are dealt out apart from each other.
SALTS = 64
#: Probabilities stay this far from 0 and 1, so that odds are finite.
EDGE = 1e-9

SOURCE = ["no_source", "name"]
PLACE = ["rank", "draw", "copy"]


def sized(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """doc_id, source, size, class and a hash of the row; texts go no further."""
    size = F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.col(source).isNull().alias("no_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("name"),
        size.alias("size"),
        F.xxhash64(F.col(doc_id), F.col(source).cast("string"), F.col(text).cast("string")).alias("row"),
    )
    return rows.withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size") * CLASSES).cast("int")))


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """One row for each source: source_size, weight and target."""
    sums = rows.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    dealt = saved(sums.repartitionByRange(*SOURCE).withColumn("part", F.spark_partition_id()), "sources")
    # Positions follow the order of the ranges, so sources are never all in one task.
    order = F.struct(*SOURCE)
    numbered = position_in_order(dealt.withColumn("_order", order), [], "_order", "at", group=F.col("part"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("at") % len(weights) + 1).cast("int"))
    sources = saved(numbered.select(*SOURCE, "source_size", weight.cast("long").alias("weight")), "weights")
    cap = F.col("source_size") * limit
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, share, count = 0.0, (0, 1), -1
    while True:
        # A source whose cap lies below the level is full; the others share what is left.
        full = cap < F.col("weight") * F.lit(level)
        found = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)), F.count_if(full)
        ).first()
        rest, open_weight, n = int(total) - int(found[0]), int(found[1]), int(found[2])
        if n == count or not open_weight:
            break
        count, share, level = n, (rest, open_weight), rest / open_weight
    full = cap < F.col("weight") * F.lit(level)
    target = (F.col("weight").cast("double") * F.lit(float(share[0]))) / F.lit(float(share[1]))
    return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(target))


def expected_copies(rows: DataFrame, sources: DataFrame, limit: int = LIMIT, damping: float = DAMPING) -> DataFrame:
    """One row for each source and class: expected copies, their whole part and the fraction."""
    sums = rows.where("size > 0").groupBy(*SOURCE, "class").agg(F.sum("size").alias("words"))
    gain = F.pow(F.lit(2.0), F.col("class") * F.lit(-damping / CLASSES))
    by_class = Window.partitionBy(*SOURCE).orderBy("class")
    settled = F.coalesce(F.sum("words").over(by_class.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ahead = F.sum(F.col("words") * F.col("gain")).over(by_class.rowsBetween(0, Window.unboundedFollowing))
    # Short classes reach the limit first; c follows from the first class that stays below it.
    factor = (F.col("target") - F.lit(float(limit)) * settled) / ahead
    some = sums.withColumn("gain", gain).join(sources.select(*SOURCE, "target"), SOURCE).withColumn("factor", factor)
    below = F.when(F.col("factor") * F.col("gain") <= limit, F.struct("class", "factor"))
    chosen = F.min(below).over(Window.partitionBy(*SOURCE))
    expected = F.when((chosen["class"].isNull()) | (F.col("class") < chosen["class"]), F.lit(float(limit))).otherwise(
        F.least(F.lit(float(limit)), chosen["factor"] * F.col("gain"))
    )
    made = some.withColumn("expected", expected)
    whole = F.floor(F.col("expected") + EDGE).cast("long")
    return made.select(*SOURCE, "class", "words", "target", whole.alias("whole"), (F.col("expected") - whole).alias("fraction"))


def _rank(draw: Column, fraction: Column) -> Column:
    """Logarithm of random odds over inclusion odds, whose values spread evenly for any fraction."""
    u = (F.shiftrightunsigned(draw, 12).cast("double") + 0.5) / float(1 << 52)
    p = F.greatest(F.least(fraction, F.lit(1 - EDGE)), F.lit(EDGE))
    return F.log(u / (1 - u)) - F.log(p / (1 - p))


def _places(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows that may be taken once more, with their Pareto rank and its bucket."""
    some = rows.join(plan.where(F.col("fraction") > EDGE).select(*SOURCE, "class", "fraction"), [*SOURCE, "class"])
    ranked = some.withColumn("rank", _rank(F.col("draw"), F.col("fraction")))
    return ranked.select(*SOURCE, "size", *PLACE, F.floor(F.col("rank") * BUCKETS).cast("int").alias("bucket"))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with the columns of their source; the rows of a source are spread over SALTS keys."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("salt", F.pmod("draw", F.lit(SALTS)).cast("int"))
    return salted.join(sources.withColumn("salt", salts), [*SOURCE, "salt"])


def _fill(places: DataFrame, left: DataFrame) -> DataFrame:
    """One round: from `after` on, how far the documents of at most `words` words fit.

    `upto` is the place of the first that does not (null: all fit), `rest` the words left there.
    """
    place = F.struct(*PLACE)
    fits = _with_source(places, left).where((F.col("size") <= F.col("words")) & (F.col("after").isNull() | (place > F.col("after"))))
    sums = fits.groupBy(*SOURCE, "bucket").agg(F.sum("size").alias("held"), F.first("words").alias("words"))
    before = F.sum("held").over(Window.partitionBy(*SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    run = sums.withColumn("through", before)
    over = F.min(F.when(F.col("through") > F.col("words"), F.struct("bucket", (F.col("through") - F.col("held")).alias("before"))))
    totals = run.groupBy(*SOURCE).agg(over.alias("over"), F.max("through").alias("all"), F.first("words").alias("words"))
    last = totals.where("over is not null").select(*SOURCE, F.col("over.bucket").alias("bucket"), F.col("over.before").alias("before"))
    # Only the bucket in which the words run out is put in order.
    inside = fits.join(last, [*SOURCE, "bucket"]).withColumn(
        "through", F.col("before") + F.sum("size").over(Window.partitionBy(*SOURCE).orderBy(*PLACE))
    )
    first = inside.groupBy(*SOURCE).agg(
        F.min(F.when(F.col("through") > F.col("words"), F.struct(place.alias("upto"), (F.col("words") - F.col("through") + F.col("size")).alias("rest")))).alias("stop")
    )
    ended = totals.join(first, SOURCE, "left")
    rest = F.coalesce(F.col("stop.rest"), F.col("words") - F.col("all"))
    return ended.select(*SOURCE, F.col("stop.upto").alias("upto"), rest.alias("rest"))


def _rounds(places: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source the rounds of filling it: words at the start, first place behind, place of the stop."""
    place_type = places.select(F.struct(*PLACE).alias("p")).schema["p"].dataType
    left = saved(budgets.withColumn("after", F.lit(None).cast(place_type)), "left")
    rounds = []
    while True:
        state = left.join(_fill(places, left), SOURCE)
        state = saved(state.select(*SOURCE, "words", "after", "upto", "rest"), "round")
        rounds.append(state)
        left = state.where("upto is not null and rest > 0").select(*SOURCE, F.col("rest").alias("words"), F.col("upto").alias("after"))
        if left.isEmpty():
            break
    together = rounds[0]
    for state in rounds[1:]:
        together = together.unionByName(state)
    return together.groupBy(*SOURCE).agg(F.collect_list(F.struct("words", "after", "upto")).alias("rounds"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    limit: int = LIMIT,
    damping: float = DAMPING,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Every document with source_size, target, copies and taken, the words of its copies."""
    ship_package(docs.sparkSession)
    plain = saved(sized(docs, text, doc_id, source), "sizes")
    # Equal rows are numbered; which of them has which number makes no difference.
    number = F.monotonically_increasing_id()
    dealt = saved(plain.withColumns({"_part": F.spark_partition_id(), "_order": number}), "rows")
    rows = position_in_order(dealt, ["row"], "_order", "copy", group=F.col("_part")).withColumn("draw", F.xxhash64("row", "copy"))
    rows = saved(rows.drop("_part", "_order", "row"), "draws")
    sources = saved(source_targets(rows, weights, limit), "targets")
    plan = saved(expected_copies(rows, sources, limit, damping), "plan")
    places = saved(_places(rows, plan), "places")
    budget = F.floor(F.max("target") - F.sum(F.col("whole") * F.col("words")) + 0.5)
    budgets = plan.groupBy(*SOURCE).agg(budget.cast("long").alias("words")).where("words > 0")
    rounds = saved(_rounds(places, budgets), "rounds")
    place = F.struct(*PLACE)
    joined = (
        rows.join(sources.select(*SOURCE, "source_size", "target"), SOURCE)
        .join(plan.select(*SOURCE, "class", "whole", "fraction"), [*SOURCE, "class"], "left")
        .join(rounds, SOURCE, "left")
    )
    ranked = joined.withColumn("rank", _rank(F.col("draw"), F.col("fraction")))
    once = F.exists(
        "rounds",
        lambda r: (F.col("size") <= r["words"])
        & (r["after"].isNull() | (place > r["after"]))
        & (r["upto"].isNull() | (place < r["upto"])),
    )
    extra = F.when((F.col("fraction") > EDGE) & F.coalesce(once, F.lit(False)), 1).otherwise(0)
    copies = F.coalesce(F.col("whole"), F.lit(0)) + extra
    made = ["doc_id", "source", *SOURCE, "size", "source_size", "target", "draw"]
    filled = saved(ranked.select(*made, copies.cast("long").alias("copies")), "filled")
    closed = filled.join(_closing(filled, limit), [*SOURCE, "draw"], "left").withColumn(
        "copies", F.col("copies") + F.coalesce("once_more", F.lit(0))
    )
    return closed.select(
        "doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def _closing(filled: DataFrame, limit: int) -> DataFrame:
    """For each source the document of which one more copy comes nearest to the target, if any comes nearer."""
    words = F.floor(F.max("target") - F.sum(F.col("copies") * F.col("size")) + 0.5).cast("long")
    left = filled.groupBy(*SOURCE).agg(words.alias("words")).where("words > 0")
    off = F.abs(F.col("words") - F.col("size"))
    open_rows = _with_source(filled.where((F.col("copies") < limit) & (F.col("size") > 0)), left).where(off < F.col("words"))
    near = open_rows.groupBy(*SOURCE, "salt").agg(F.min(F.struct(off.alias("off"), F.col("size"), F.col("draw"))).alias("near"))
    best = near.groupBy(*SOURCE).agg(F.min("near").alias("best"))
    return best.select(*SOURCE, F.col("best.draw").alias("draw"), F.lit(1).alias("once_more"))
