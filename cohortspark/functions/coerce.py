"""Column functions that turn messy text into codes and numbers.

All of them are plain Catalyst expressions: no UDF, safe under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..spec import UNKNOWN, FieldSpec

# The texts that count as numbers.
_DECIMAL = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
_NUMBER_TEXT = rf"^ *({_DECIMAL}|(?i)(nan|[+-]?inf(inity)?)) *$"
_PLAIN_INTEGRAL = r"^[+-]?\d+(\.0*)?$|^[+-]?\.0+$"
_INF = float("inf")


def _text(column: Column) -> Column:
    return F.trim(column.cast("string"))


def to_number(column: Column) -> Column:
    """Text to double; malformed text becomes null, ``nan``/``inf`` keep meaning.

    The pattern guard is needed: a bare ``try_cast`` also accepts ``1d``, ``1f``
    and hexadecimal floats. Texts that begin and end like a plain number and have no
    ``x`` are none of these, so that most texts need no pattern.
    """
    text = column.cast("string")
    first = (text >= "+") & (text < ":")  # one of +,-./0123456789
    last = F.substring(text, -1, 1).between(".", "9")
    plain = first & last & ~text.contains("x") & ~text.contains("X")
    return F.when(plain | text.rlike(_NUMBER_TEXT), text.try_cast("double"))


def is_finite(number: Column) -> Column:
    """True for a double that is neither null, NaN nor infinite.

    NaN sorts above infinity, so one comparison rules out both.
    """
    return F.coalesce(F.abs(number) < _INF, F.lit(False))


def is_missing(column: Column) -> Column:
    """True for null, blank text and the text ``nan`` (a NaN double prints so)."""
    return F.coalesce(F.lower(_text(column)).isin("", "nan"), F.lit(True))


def code_literal(value: object) -> str | None:
    """Canonical text of one literal code given by the caller."""
    text = str(int(value)) if isinstance(value, bool) else str(value).strip()
    try:
        number = Decimal(text)
    except InvalidOperation:
        return text or None
    if number.is_nan():
        return None
    whole = number.is_finite() and number == number.to_integral_value()
    return str(int(number)) if whole else text


def _closed(code: Column, valid: Sequence[object] | None, unknown: str) -> Column:
    if valid is None:
        return code
    allowed = [text for text in map(code_literal, valid) if text is not None]
    return F.when(code.isin(*allowed), code).otherwise(F.lit(unknown))


def to_code(
    column: Column,
    valid: Sequence[object] | None = None,
    unknown: str = UNKNOWN,
    canonical: bool = False,
) -> Column:
    """Code text without a trailing ``.0``; blank is null.

    With ``valid`` every value outside the list, and null, becomes ``unknown``.
    ``canonical`` also reduces ``007``, ``+5``, ``1e2`` and ``-0.0`` to integer
    text and treats NaN as missing.
    """
    text = _text(column)
    if canonical:
        return _closed(_canonical(text), valid, unknown)
    short = F.when(text.contains(".0"), F.regexp_replace(text, r"^([+-]?\d+)\.0+$", "$1")).otherwise(text)
    if valid is None:
        return F.nullif(short, F.lit(""))
    return _closed(short, valid, unknown)


def _canonical(text: Column) -> Column:
    digits = F.replace(text, F.lit("_"), F.lit(""))
    whole = F.regexp_extract(digits, r"^[+-]?0*(\d*)", 1)
    magnitude = F.when(whole == "", F.lit("0")).otherwise(whole)
    negative = digits.startswith("-") & (magnitude != "0")
    plain = F.when(negative, F.concat(F.lit("-"), magnitude)).otherwise(magnitude)
    # Exponent forms go through a decimal; what does not fit stays as text.
    number = F.when(digits.rlike(f"^{_DECIMAL}$"), digits).try_cast("decimal(38,18)")
    integral = F.when(F.floor(number) == number, F.floor(number).cast("decimal(38,0)"))
    return (
        F.when((text == "") | F.lower(text).rlike("^[+-]?nan$"), F.lit(None))
        .when(digits.rlike(_PLAIN_INTEGRAL), plain)
        .otherwise(F.coalesce(integral.cast("string"), text))
    )


def typed(field: FieldSpec, column: Column, unknown: str = UNKNOWN) -> Column:
    """Typing rule of one field applied to its staged text."""
    if field.kind == "numeric":
        return to_number(column)
    if field.kind == "closed_code":
        return to_code(column, field.valid, unknown)
    if field.kind == "open_code":
        return F.coalesce(to_code(column), F.lit(unknown))
    if field.kind == "code":
        return to_code(column)
    return column


_EXACT_DOUBLES = (T.DoubleType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def number_of(df: DataFrame, name: str) -> Column:
    """``to_number`` that skips the text round trip for numeric columns."""
    if isinstance(df.schema[name].dataType, _EXACT_DOUBLES):
        return F.col(name).cast("double")
    return to_number(F.col(name))


def missing_of(df: DataFrame, name: str) -> Column:
    """``is_missing`` that skips text work where the type rules it out."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DoubleType):
        return F.col(name).isNull() | F.isnan(name)
    if isinstance(kind, (T.StringType, T.FloatType)):
        return is_missing(F.col(name))
    return F.col(name).isNull()
