"""Any typed column to the text form used for staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip


def _float_text(value: Column) -> Column:
    """Integral doubles as integer text, others as plain decimal text.

    Very small and very large magnitudes keep an exponent with two digits.
    """
    size = F.abs(value)
    shortest = value.cast("string")
    plain = F.regexp_replace(
        value.try_cast("decimal(38,18)").cast("string"), r"0+$", ""
    )
    power = F.regexp_replace(F.lower(F.replace(shortest, F.lit(".0E"), F.lit("E"))), r"e-(\d)$", "e-0$1")
    return (
        F.when(F.isnan(value), F.lit(None))
        .when(size == float("inf"), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(size % 1.0 == 0, F.coalesce(value.try_cast("decimal(38,0)").cast("string"), shortest))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(power)
    )


def staged_text(column: Column, kind: T.DataType) -> Column:
    """Staging text of a column of type ``kind``; blank text becomes null."""
    if isinstance(kind, T.BooleanType):
        return F.when(column, F.lit("1")).when(~column, F.lit("0"))
    if isinstance(kind, T.FloatType):
        return _float_text(column.cast("string").cast("double"))
    if isinstance(kind, T.DoubleType):
        return _float_text(column)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(column, "SSSSSS")
        return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))
    if isinstance(kind, T.StringType):
        return F.nullif(strip(column), F.lit(""))
    return column.cast("string")


def stage(df: DataFrame) -> DataFrame:
    """All columns of ``df`` as nullable text."""
    return df.select(
        *[staged_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    )
