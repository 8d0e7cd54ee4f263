"""Quality rules: base limits, then robust multivariate outliers per language and source.

Only DataFrame functions. Every text is turned into counts, and the counts into a vector of
five transformed statistics. For each (language, source) a minimum-covariance-determinant
estimate is made: from a start at medians and quartile ranges, concentration steps take the
half of the rows that is closest to the present estimate and estimate centre and covariance
from it again, which never raises the determinant. A document is rejected if its squared
Mahalanobis distance passes CUT. Groups below MIN_GROUP rows use the estimate of their
language, and languages below it that of all rows.

Rows of a group only ever meet in sums and in histograms of fixed width, which are combined
before each shuffle, so a group that holds a third of all rows is no single task. Estimates are
one small row for each group. SPREAD is added to the variances: statistics that are constant in
clean text (no symbols, no repeats) would have none.

Null and empty texts have no words and fail the base limits. Null language or source is a
group of its own. Repeated rows are judged alike. Columns named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepnl.llm.text import saved

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
VECTOR = ("log_words", "log_word_length", "root_symbols", "dup_line_share", "root_repeats")
SPREAD = (1.0, 0.1, 0.05, 0.12, 0.2)
#: Share of rows in the estimate, and the factor that makes its covariance that of a normal distribution of 5.
HALF, CONSISTENCY = 0.5, 1.92
#: Quantile 1 - 1e-6 of the chi-squared distribution of 5.
CUT = 35.9
MIN_GROUP, STEPS = 30, 3
KEYS_PER_FILE = 10_000
BIN = 1 / 128
_P = range(len(VECTOR))
_BLANK = "[\\x20\\x09-\\x0D]+"


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of every text and base_failed."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    df = docs.drop(*COUNTS, "base_failed").withColumns(
        {
            "_w": F.filter(F.split(whole, _BLANK), lambda w: w != ""),
            "_l": F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")),
            "n_symbols": F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"),
        }
    )
    df = df.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "_h": F.when(
                F.size("_w") >= 4,
                F.transform(
                    F.sequence(F.lit(0), F.size("_w") - 3),
                    lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)),
                ),
            ),
        }
    ).drop("_w", "_l")
    repeated = F.size(F.array_distinct("_h")) < F.size("_h")
    sorted_windows = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_s", F.when(repeated, sorted_windows)).drop("_h")

    def twice(j: Column) -> Column:
        own = F.get("_s", j)["h"]
        return (own == F.get("_s", j + 1)["h"]) | (own == F.get("_s", j - 1)["h"])

    at = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_s") - 1), twice),
        lambda j: F.array(F.get("_s", j)["i"], F.get("_s", j)["i"] + 1, F.get("_s", j)["i"] + 2),
    )
    covered = F.when(F.col("_s").isNotNull(), F.size(F.array_distinct(F.flatten(at)))).otherwise(0)
    df = df.withColumn("n_repeat_words", covered.cast("long")).drop("_s")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def vector() -> list[Column]:
    n = F.col("n_words")
    return [
        F.log(n),
        F.log(F.col("word_chars") / n),
        F.sqrt(F.col("n_symbols") / n),
        F.col("n_dup_lines") / F.col("n_lines"),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


def _key(*columns: str) -> Column:
    return F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in columns])


def _quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Upper edges of the bins in which the shares of a key's rows are reached."""
    bins = rows.groupBy(*keys, F.floor(F.col(value) / BIN).alias("_bin")).agg(F.count("*").alias("_n"))
    # Written first: else the counts would be dealt out by key alone, for the windows below.
    bins = saved(bins, "bins")
    up_to = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    bins = bins.withColumns({"_to": F.sum("_n").over(up_to), "_all": F.sum("_n").over(whole)})
    return bins.groupBy(*keys).agg(
        *[
            F.min(F.when(F.col("_to") >= share * F.col("_all"), (F.col("_bin") + 1) * BIN)).alias(name)
            for name, share in shares.items()
        ]
    )


def _with_factor(estimates: DataFrame, factor: float) -> DataFrame:
    """Adds the Cholesky factor l_ij of factor * covariance + spread."""
    for i in _P:
        for j in range(i + 1):
            value = factor * F.col(f"c{i}{j}") + (SPREAD[i] ** 2 if i == j else 0.0)
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(SPREAD[i] ** 2))) if i == j else value / F.col(f"l{j}{j}")
            estimates = estimates.withColumn(f"l{i}{j}", value)
    return estimates


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2 from x0.., the centre m0.. and the factor l00.. of the row."""
    for i in _P:
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            value = value - F.col(f"l{i}{k}") * F.col(f"y{k}")
        rows = rows.withColumn(f"y{i}", value / F.col(f"l{i}{i}"))
    total = sum((F.col(f"y{i}") * F.col(f"y{i}") for i in _P), F.lit(0.0))
    return rows.withColumn("d2", total).drop(*[f"y{i}" for i in _P])


def _covariance(rows: DataFrame) -> DataFrame:
    """Centre and covariance of each key's rows."""
    pairs = [(i, j) for i in _P for j in range(i + 1)]
    made = rows.groupBy("key").agg(
        F.count("*").alias("n"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in _P],
        *[F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in pairs],
    )
    spread = {f"c{i}{j}": F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") for i, j in pairs}
    return made.withColumns(spread).drop(*[f"s{i}{j}" for i, j in pairs])


def _files(n_keys: int) -> int:
    """Files for one row per key: few, as the size of many small ones hides how little they hold."""
    return 1 + n_keys // KEYS_PER_FILE


def estimates(vectors: DataFrame, n_keys: int, steps: int = STEPS) -> DataFrame:
    """MCD estimate (n, centre m, covariance c, factor l) of each key from rows key, x0, x1, ..."""
    files = _files(n_keys)
    long = vectors.select(
        "key", F.posexplode(F.array(*[F.col(f"x{i}") for i in _P])).alias("i", "x")
    )
    quarters = _quantiles(long, ["key", "i"], "x", {"low": 0.25, "mid": 0.5, "high": 0.75})
    start = quarters.groupBy("key").agg(
        *[F.max(F.when(F.col("i") == i, F.col("mid"))).alias(f"m{i}") for i in _P],
        *[F.max(F.when(F.col("i") == i, F.pow((F.col("high") - F.col("low")) / 1.349, 2))).alias(f"c{i}{i}") for i in _P],
    )
    off = {f"c{i}{j}": F.lit(0.0) for i in _P for j in range(i)}
    now = saved(_with_factor(start.withColumns(off), 1.0).repartition(files), "mcd")
    for step in range(steps):
        rows = _distance(vectors.join(now, "key")).withColumn("log_d2", F.log1p("d2"))
        limit = saved(_quantiles(rows, ["key"], "log_d2", {"limit": HALF}).repartition(files), "mcd-limit")
        half = rows.join(limit, "key").where("log_d2 <= limit")
        last = step == steps - 1
        found = _covariance(half.select("key", *[f"x{i}" for i in _P]))
        now = saved(_with_factor(found, CONSISTENCY if last else 1.0).repartition(files), "mcd")
    return now


def outliers(counted: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Adds distance (squared Mahalanobis, null where the base limits failed) and kept to counted texts."""
    levels = [_key(lang, source), _key(lang), F.lit("\x1d")]
    good = counted.where(~F.col("base_failed")).select(
        F.array(*levels).alias("keys"), *[x.cast("double").alias(f"x{i}") for i, x in enumerate(vector())]
    )
    vectors = saved(good.select(F.explode("keys").alias("key"), *[f"x{i}" for i in _P]), "vectors")
    sizes = saved(vectors.groupBy("key").agg(F.count("*").alias("size")), "sizes")
    n_keys = sizes.count()
    made = estimates(vectors, n_keys).drop("n", *[f"c{i}{j}" for i in _P for j in range(i + 1)])
    groups = counted.select(levels[0].alias("group"), levels[1].alias("lang_key")).distinct()
    groups = groups.join(sizes.select(F.col("key").alias("group"), F.col("size").alias("n_group")), "group", "left")
    groups = groups.join(sizes.select(F.col("key").alias("lang_key"), F.col("size").alias("n_lang")), "lang_key", "left")
    chosen = (
        F.when(F.col("n_group") >= MIN_GROUP, F.col("group"))
        .when(F.col("n_lang") >= MIN_GROUP, F.col("lang_key"))
        .otherwise(levels[2])
    )
    per_group = groups.select("group", chosen.alias("key")).join(made, "key").drop("key")
    per_group = saved(per_group.repartition(_files(n_keys)), "group-estimates")
    own = [c for c in counted.columns if c not in ("distance", "kept")]
    rows = counted.select(*own).withColumns({"group": levels[0]} | {f"x{i}": x for i, x in enumerate(vector_or_null())})
    rows = _distance(rows.join(per_group, "group", "left"))
    distance = F.when(~F.col("base_failed"), F.col("d2"))
    kept = ~F.col("base_failed") & (F.coalesce(F.col("d2"), F.lit(0.0)) <= CUT)
    return rows.select(*own, distance.alias("distance"), kept.alias("kept"))


def vector_or_null() -> list[Column]:
    """The statistics, null where the base limits failed (no word to divide by)."""
    return [F.when(~F.col("base_failed"), x) for x in vector()]


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns of every document with its counts, base_failed, distance and kept.

    The counts are written once, next to the kept columns, as estimates read them several times.
    """
    keep = keep or docs.columns
    needed = list(dict.fromkeys([*keep, "lang", "source"]))
    own = ("base_failed", "distance", "kept")
    needed = [c for c in needed if c not in (*COUNTS, *own)]
    counted = text_counts(docs).select(*needed, *COUNTS, "base_failed")
    return outliers(saved(counted, "counted"))
