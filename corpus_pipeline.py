"""From raw documents to packed sequences: each stage is a table, written and read again.

Every stage gets all that the stage before kept, decides on it with one operator, and all but
the last return the columns of documents. Null texts go with the first stage. Documents without an
id pass near-duplicate removal; all others are told apart by id and text. Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl.llm import decontaminate, line_spread, packing, quality, simhash
from lakepnl.llm.queries import tokenizer_path
from lakepnl.llm.text import read_table, saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and are no outliers of their language and source."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sites share."""
    clean = line_spread.without_boilerplate(docs)
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    clean = clean if length is None else clean.withColumn("n_chars", length)
    return clean.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first by id and hash of the text, of each group of near-duplicates."""
    row = F.xxhash64(F.col("doc_id").cast("long"), F.xxhash64("text"))
    keyed = docs.withColumn("_row", row)
    found = simhash.near_duplicates(keyed, shingle=3, max_distance=2, doc_id="_row")
    found = found.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    ids = keyed.where("doc_id is not null").select("_row", F.struct("doc_id", F.xxhash64("text").alias("text"), "_row").alias("_first"))
    first = ids.join(found, "_row").groupBy("component_id").agg(F.min("_first")["_row"].alias("_row"))
    kept = keyed.join(first.select("_row"), "_row", "left_semi").dropDuplicates(["_row"])
    return kept.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a notable share of benchmark text."""
    found = decontaminate.overlaps(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated()).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Robust estimates and token ids have no SQL; tests/llm checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
