"""SQL scripts with bound parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakepnl.schemas import GOLD_REPORT_PNL

DEFAULTS = {"load_mode": "incremental", "session_date": "", "load_date": ""}

# Columns of the report that the mart has under another name or not at all.
_MADE = {
    "pnl_daily": "total_pnl_daily",
    "row_type": "'position'",
    "etl_loaded_at": "current_timestamp()",
}


def report_script() -> str:
    """The report over {daily}, the mart, with its columns in the order of the table."""
    names = [c.name for c in GOLD_REPORT_PNL.columns]
    columns = ", ".join(f"{_MADE[n]} AS {n}" if n in _MADE else n for n in names)
    one_session = "session_date = try_cast(:session_date AS DATE)"
    return f"SELECT {columns} FROM {{daily}} WHERE {one_session} OR :load_mode = 'full'"


def run_script(
    spark: SparkSession, text: str, parameters: dict[str, str] | None = None, **frames: DataFrame
) -> DataFrame:
    """Run a script with :load_mode, :session_date and :load_date bound as values.

    The bound values are constants, so the load-mode test folds to one equality or
    to nothing. Frames fill the {name} slots of the text.
    """
    bound = {k: v for k, v in {**DEFAULTS, **(parameters or {})}.items() if f":{k}" in text}
    return spark.sql(text, args=bound, **frames)
