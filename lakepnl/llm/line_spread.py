"""Line dedup by the number of sites that a line is found on.

A line is known by the hash of its trimmed text; every line that is not blank counts, whatever its
length or script. Equal texts count once, for the first of their sites, so that a document
that was copied from site to site does not make its lines boilerplate. Lines seen on
several sites get a HyperLogLog sketch of their sites, made on the map side and merged by
aggregation. Only where the estimate is near the threshold, within a band many times the
sketch's error, the different sites are counted exactly. Lines on `min_sites` sites or more
are cross-site boilerplate and are taken out of all documents.

`copied` marks documents that lose more than `copied_share` percent of their words, and decides nothing.

Texts are exploded once to hashes; a document's text is never grouped, only met again with
the few positions that leave it. Null and empty texts stay as they are. Null sites count as
one site. Rows are told apart by id and text: equal rows lose the same lines. Other columns
stay; columns named like the added ones are replaced.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepnl.llm.text import saved, small_batches

MIN_SITES, COPIED_SHARE = 5, 80
SKETCH_BITS = 12
ADDED = ("n_lines", "n_removed", "copied")
_TRIM = "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$"


def _words(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))


def lines(docs: DataFrame, text: str = "text", site: str = "source") -> DataFrame:
    """One row for each line that is not blank: row key, position, words, hash and site."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        *row_key(text),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"),
        F.posexplode(F.split(whole, "\n")).alias("position", "line"),
    )
    rows = rows.withColumn("line", F.regexp_replace("line", _TRIM, "")).where("line <> ''")
    return rows.select("_id", "_hash", "position", _words(F.col("line")).alias("words"), F.xxhash64("line").alias("line"), "site")


def row_key(text: str = "text") -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_hash"),
    ]


def _first_sites(found: DataFrame) -> DataFrame:
    """The lines with the first site of their text; only texts on several sites are looked up."""
    by_text = found.groupBy("_hash").agg(F.min("site").alias("_first"), F.max("site").alias("_last"))
    moved = saved(by_text.where("_first <> _last").select("_hash", "_first"), "copied-texts")
    return found.join(moved, "_hash", "left").select("line", F.coalesce("_first", "site").alias("site"))


def boilerplate(found: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes of lines on at least min_sites sites."""
    found = _first_sites(found)
    seen = found.select("line", F.xxhash64("site").alias("_site")).groupBy("line").agg(F.count("*").alias("n"), F.min("_site").alias("a"), F.max("_site").alias("b"))
    several = (F.col("n") >= min_sites) & (F.lit(min_sites < 2) | (F.col("a") != F.col("b")))
    wide = saved(seen.where(several).select("line"), "wide-lines")
    sites = found.select("line", "site").join(wide, "line", "left_semi")
    sketched = sites.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_BITS)).alias("sites"))
    sketched = saved(sketched, "sketched-lines")
    # The sketch errs by 1.04 / sqrt(2 ** 12), 1.6 percent; the band is a quarter and two sites.
    near = F.abs(F.col("sites") - min_sites) <= 2 + min_sites / 4
    exact = sites.join(sketched.where(near).select("line"), "line", "left_semi")
    exact = exact.distinct().groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return saved(sketched.where(~near & (F.col("sites") >= min_sites)).select("line").union(exact.select("line")), "boilerplate")


def without_boilerplate(
    docs: DataFrame,
    min_sites: int = MIN_SITES,
    copied_share: int = COPIED_SHARE,
    text: str = "text",
    site: str = "source",
) -> DataFrame:
    """The documents with their text rid of boilerplate, n_lines, n_removed (long) and copied (boolean)."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*ADDED)
    found = saved(lines(docs, text, site), "lines")
    out = found.join(boilerplate(found, min_sites), "line", "left_semi")
    out = out.groupBy("_id", "_hash").agg(F.collect_set(F.struct("position", "words")).alias("_gone"))
    out = out.select(
        "_id",
        "_hash",
        F.col("_gone.position").alias("_out"),
        F.aggregate("_gone.words", F.lit(0).cast("long"), lambda a, x: a + x).alias("_lost"),
    )

    @F.pandas_udf("string")
    def rest(texts: pd.Series, positions: pd.Series) -> pd.Series:
        made = []
        for whole, out in zip(texts, positions, strict=True):
            gone = None if out is None or whole is None else set(map(int, out))
            made.append(gone and "\n".join(x for k, x in enumerate(whole.split("\n")) if k not in gone))
        return pd.Series(made, dtype=object)

    own = [F.col(c) for c in docs.columns]
    rows = docs.select(*own, *row_key(text)).join(out, ["_id", "_hash"], "left")
    copied = F.coalesce(100 * F.col("_lost") > copied_share * _words(F.col(text)), F.lit(False))
    rows = rows.withColumn("copied", copied)
    cut = F.col("_out").isNotNull()
    n_lines = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    rows = rows.withColumns(
        {
            "n_lines": n_lines.cast("long"),
            "n_removed": F.when(cut, F.size("_out")).otherwise(0).cast("long"),
            "_text": F.when(cut, rest(F.col(text), F.col("_out"))).otherwise(F.col(text)),
        }
    )
    return rows.select(*[F.col("_text").alias(text) if c == text else F.col(c) for c in docs.columns], *ADDED)
