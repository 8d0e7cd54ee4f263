"""Input checks before a job or a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepnl.operators.contracts import check_json_sample, csv_header_error
from lakepnl.schemas import JOB_INPUTS, LOADS, CsvContract, JsonContract, Table
from lakepnl.sources.layers import scan_layer
from lakepnl.sources.raw import csv_cells, first_file, has_files


def _result(df: DataFrame, job: str, dataset: str) -> DataFrame:
    error = F.min("error")
    return df.agg(error.isNull().alias("ok"), F.coalesce(error, F.lit("")).alias("reason")).select(
        F.lit(job).alias("job"), F.lit(dataset).alias("dataset"), "ok", "reason"
    )


def sample_check(
    spark: SparkSession, job: str, dataset: str, path: str, contract, documents: bool = True
) -> DataFrame:
    """Checks the first file below a path by name; one row with the outcome.

    JSON: every record of that file; with `documents` the file is one object, else it
    has one record per line. CSV: its header. Parquet: that there is a file, and that
    the columns have the expected types.
    """
    suffix = ".parquet" if isinstance(contract, Table) else ""
    if not has_files(spark, path, suffix):
        return spark.range(1).select(
            F.lit(job).alias("job"),
            F.lit(dataset).alias("dataset"),
            F.lit(False).alias("ok"),
            F.lit("no files").alias("reason"),
        )
    if isinstance(contract, Table):
        got = {f.name: f.dataType for f in spark.read.parquet(path).schema.fields}
        wrong = [c.name for c in contract.columns if got.get(c.name) != c.data_type]
        text = f"columns with another type: {', '.join(wrong)}" if wrong else None
        return _result(spark.range(1).select(F.lit(text).alias("error")), job, dataset)
    name = first_file(spark, path)
    if isinstance(contract, JsonContract):
        text = spark.read.text(name, wholetext=documents)
        return _result(check_json_sample(text, contract, "value"), job, dataset)
    if isinstance(contract, CsvContract):
        # limit(1) of a text file is its first line: the header.
        header = spark.read.text(name).limit(1).select(
            csv_header_error(csv_cells("value", contract.delimiter), contract).alias("error")
        )
        return _result(header, job, dataset)
    raise TypeError(f"no sample check for {type(contract).__name__}")


def job_input_check(
    spark: SparkSession, job: str, paths: dict[str, str], documents: bool = True
) -> DataFrame:
    """Sample checks of all inputs of a registered job."""
    entry = next((j for j in JOB_INPUTS if j.job == job), None)
    if entry is None:
        raise ValueError(f"job {job} is not registered")
    checks = [
        sample_check(spark, job, name, paths[name], contract, documents)
        for name, contract in entry.inputs.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def silver_load_check(spark: SparkSession, base: str, load_date: str) -> DataFrame:
    """Rows per table for one load date, before a load; pruned to that date."""
    checks = []
    for load in LOADS:
        path = f"{base}/{load.table}"
        rows = (
            scan_layer(spark, path, load_date)
            if has_files(spark, path)
            else spark.range(0).select(F.col("id").alias("load_date"))
        )
        checks.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(load.table).alias("table_name"),
                F.lit(load_date).alias("load_date"),
                "rows",
                # A load without a contract may find nothing.
                ((F.col("rows") > 0) | F.lit(not load.contract)).alias("ok"),
            )
        )
    return reduce(DataFrame.unionByName, checks)
