"""Column expressions shared by the operators that stay inside Spark's own functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def whole(text: str) -> Column:
    """A text column with missing texts as empty ones."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z as a-z; every other character stays, so both engines agree."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words_of(text: Column) -> Column:
    """The runs of characters that are not ASCII white space, in order."""
    inner = F.trim(text, F.lit(SPACES))
    none = F.array().cast("array<string>")
    return F.when(inner == "", none).otherwise(F.split(inner, r"[\x20\x09-\x0D]+"))
