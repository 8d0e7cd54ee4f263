"""Layer transitions from a change feed; the same columns in batch and in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepnl.functions.run_keys import (
    batch_of,
    business_date_of,
    env_of,
    execution_name,
    project_of,
)
from lakepnl.operators.run_state import layer_status
from lakepnl.schemas import ROUTES

_DOC = "map<string,struct<status:string>>"
IMAGE = f"struct<pk:string,sk:string,business_date:string,layers:{_DOC}>"
FEED_SCHEMA = f"seq bigint, event_name string, new_image {IMAGE}, old_image {IMAGE}"


def just_succeeded(feed: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Layers that the new image shows as succeeded and the old image does not.

    Only inserts and changes count; an image without a date, a run or layers is skipped.
    Columns of the feed that are to be kept come last.
    """
    layers = F.col("new_image.layers")
    return (
        feed.where(F.col("event_name").isin("INSERT", "MODIFY"))
        .select(
            "*",
            business_date_of(F.col("new_image.business_date"), F.col("new_image.pk")).alias(
                "business_date"
            ),
            batch_of(F.col("new_image.sk")).alias("batch_id"),
            F.explode(F.map_keys(layers)).alias("layer"),
        )
        .where(
            (F.col("business_date") != "")
            & (F.col("batch_id") != "")
            & (layer_status(layers, F.col("layer")) == "SUCCEEDED")
            & (
                F.coalesce(layer_status(F.col("old_image.layers"), F.col("layer")), F.lit(""))
                != "SUCCEEDED"
            )
        )
        .select("seq", F.col("new_image.pk").alias("pk"), "business_date", "batch_id", "layer", *keep)
    )


def route(transitions: DataFrame) -> DataFrame:
    """Each transition with what it starts; layers without a route start nothing."""
    targets = F.create_map(
        *[
            part
            for r in ROUTES
            for part in (
                F.lit(r.layer),
                F.struct(
                    F.lit(r.action).alias("action"),
                    F.lit(r.target).alias("target"),
                    F.lit(r.name_prefix).alias("name_prefix"),
                ),
            )
        ]
    )
    found = transitions.withColumn("_route", F.try_element_at(targets, F.col("layer")))
    return found.where("_route is not null").select(*transitions.columns, "_route.*")


def next_requests(routed: DataFrame) -> DataFrame:
    """Arguments of the next step: the run with the project and environment of its key, and
    dates where a script needs them."""
    execution = F.col("action") == "StartExecution"
    day = F.col("business_date")
    name = execution_name(
        F.col("name_prefix"),
        day,
        F.col("batch_id"),
        F.concat_ws("|", "pk", "batch_id", "layer", "seq"),
    )
    return routed.select(
        "seq",
        "layer",
        "action",
        "target",
        "business_date",
        "batch_id",
        project_of(F.col("pk")).alias("project"),
        env_of(F.col("pk")).alias("environment"),
        F.when(execution, day).alias("load_date"),
        F.when(execution, day).alias("session_date"),
        F.when(execution, name).alias("execution_name"),
    )
