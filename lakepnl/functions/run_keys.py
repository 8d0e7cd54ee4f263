"""Keys of run-state items, and names derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROJECT = "reporting"
HASH_DIGITS = 16


def env_key(project: Column, env: Column) -> Column:
    return F.concat(F.lit("PIPE#"), project, F.lit("#"), env)


def partition_key(project: Column, env: Column, business_date: Column) -> Column:
    return F.concat(env_key(project, env), F.lit("#BDATE#"), business_date)


def project_of(pk: Column) -> Column:
    return F.regexp_extract(F.coalesce(pk, F.lit("")), "^PIPE#([^#]*)#", 1)


def env_of(pk: Column) -> Column:
    return F.regexp_extract(F.coalesce(pk, F.lit("")), "^PIPE#[^#]*#([^#]*)", 1)


def sort_key(batch_id: Column) -> Column:
    return F.concat(F.lit("RUN#"), batch_id)


def batch_of(sk: Column) -> Column:
    """Batch of a sort key; blank for a key that does not start with RUN#."""
    text = F.trim(F.coalesce(sk, F.lit("")))
    return F.when(text.startswith("RUN#"), F.substring(text, 5, 1 << 30)).otherwise("")


def business_date_of(business_date: Column, pk: Column) -> Column:
    """The item's business date, or else what follows the first BDATE# of its key."""
    own = F.trim(F.coalesce(business_date, F.lit("")))
    key = F.coalesce(pk, F.lit(""))
    at = F.locate("BDATE#", key)
    in_key = F.when(at > 0, F.substring(key, at + 6, F.length(key))).otherwise("")
    return F.when(own != "", own).otherwise(in_key)


def execution_name(prefix: Column, business_date: Column, batch_id: Column, salt: Column) -> Column:
    """prefix-date-batch-hash, only letters, digits, - and _, at most 80 characters.

    The hash is taken from the salt, so that the same request always gets the same name.
    A long name loses the end of its readable part and never a digit of the hash.
    """
    name = F.concat_ws("-", prefix, business_date, batch_id)
    readable = F.substring(F.regexp_replace(name, "[^0-9A-Za-z_-]", "-"), 1, 79 - HASH_DIGITS)
    return F.concat_ws("-", readable, F.substring(F.sha2(salt, 256), 1, HASH_DIGITS))


def archive_key(pk: Column, sk: Column) -> Column:
    """Name of an archived item: a key over 512 characters is cut and ends with its hash."""
    whole = F.concat(pk, F.lit("__"), sk)
    name = F.regexp_replace(whole, "[/#]", "_")
    cut = F.concat(F.substring(name, 1, 511 - HASH_DIGITS), F.lit("-"), F.substring(F.sha2(whole, 256), 1, HASH_DIGITS))
    return F.when(F.char_length(name) > 512, cut).otherwise(name)


def script_layer(script: Column) -> Column:
    """Layer that a warehouse script builds, by the folder or name in its path."""
    path = F.lower(F.replace(script, F.lit("\\"), F.lit("/")))
    gold = F.lit(False)
    for part in ("silver_to_gold", "silver_facts_to_gold", "to_gold_"):
        gold = gold | path.contains(part)
    return F.when(path.contains("copy_s3_to_silver"), "redshift_silver").when(gold, "gold")


def job_layer(job_name: Column) -> Column:
    """Layer that a lake job builds, by a part of its name; _ counts as -."""
    name = F.replace(F.lower(job_name), F.lit("_"), F.lit("-"))
    return F.when(name.contains("validated-to-std"), "lake_validated_to_standardized").when(
        name.contains("std-to-silver"), "lake_standardized_to_silver"
    )
