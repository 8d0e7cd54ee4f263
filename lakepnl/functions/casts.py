"""Lenient conversions: a value that does not convert becomes NULL, with ANSI mode left on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's float() grammar: single underscores between digits, signed inf/nan words,
# white space on both sides.
_DIGITS = r"\d+(?:_\d+)*"
PYTHON_FLOAT = (
    rf"(?iU)^\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)\s*$"
)
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")


def as_date(c: Column) -> Column:
    return c.cast("string").try_cast("date")


def as_timestamp(c: Column) -> Column:
    return c.cast("string").try_cast("timestamp")


def as_decimal(c: Column, scale: int) -> Column:
    return c.try_cast(f"decimal(20,{scale})")


def as_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def upper_or_blank(c: Column) -> Column:
    return F.upper(F.coalesce(c, F.lit("")))


def strip(c: Column) -> Column:
    """Both-sided strip of any white space, not only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def integral_text(c: Column) -> Column:
    """The text of a JSON number, without a fraction that is all zeros."""
    text = c.cast("string")
    return F.when(
        text.contains("."), F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1")
    ).otherwise(text)


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def is_float_text(c: Column) -> Column:
    return c.rlike(PYTHON_FLOAT)


def is_boolean_text(c: Column) -> Column:
    words = "|".join((*TRUE_WORDS, *FALSE_WORDS))
    return c.rlike(rf"(?iU)^\s*(?:{words})\s*$")


def truthy(switch: bool | str | None) -> bool:
    """A switch of the configuration: 1, true and yes mean on."""
    return switch is True or str(switch or "").lower() in TRUE_WORDS
