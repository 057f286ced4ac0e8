"""Scalars over document text and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

GIB = 1024**3
TIB = 1024**4
INT32_MAX = 2_147_483_647


def checked_text(df: DataFrame, column: str = "text") -> Column:
    """The text column, refusing other types at planning and nulls at run time."""
    kind = df.schema[column].dataType
    if not isinstance(kind, T.StringType):
        raise TypeError(f"column {column} must hold strings, not {kind.simpleString()}")
    text = F.col(column)
    message = F.lit(f"column {column} must hold strings, found a null")
    return F.when(text.isNull(), F.raise_error(message).cast("string")).otherwise(text)


def checked_int32(count: Column) -> Column:
    """Cast a 64-bit count to the 32-bit output type, refusing values that do not fit."""
    message = F.lit("token count does not fit a 32-bit integer")
    return (
        F.when(count > F.lit(INT32_MAX), F.raise_error(message).cast("bigint"))
        .otherwise(count)
        .cast("int")
    )


def date_literal(year: int) -> Column:
    return F.lit(int(year)).cast("int")


def text_digest(text: Column | str) -> Column:
    return F.sha2(text, 256)


def text_chars(text: Column | str) -> Column:
    return F.length(text).cast("bigint")


def text_bytes(text: Column | str) -> Column:
    return F.octet_length(text).cast("bigint")


def approx_tokens(text: str) -> Column:
    """A realistic filler count where no tokenizer is wanted: a quarter of the characters."""
    return F.greatest(F.lit(1).cast("bigint"), F.expr(f"length({text}) div 4"))


def ratio(above: Column, below: Column) -> Column:
    """Double division that yields null instead of failing on zero."""
    return above.cast("double") / F.nullif(below.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def int_div(count: Column | str, size: int) -> Column:
    """Whole part of a division of integers, without going through doubles."""
    return F.call_function("div", count, F.lit(size))


def ceil_div(count: Column | str, size: int) -> Column:
    """Number of shards of ``size`` rows that ``count`` rows fill."""
    count = F.col(count) if isinstance(count, str) else count
    return int_div(count + F.lit(size - 1).cast("bigint"), size)


def gib(size: Column) -> Column:
    return size.cast("double") / F.lit(float(GIB))


def tib(size: Column) -> Column:
    return size.cast("double") / F.lit(float(TIB))
