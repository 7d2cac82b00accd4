"""Derived columns: durations, labels, residuals and value bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import UNKNOWN, require_columns
from .coerce import number_of

# Names of the quantile bands, lowest first, and their cuts.
BANDS = ("p0-p25", "p25-p50", "p50-p75", "p75-p95", "p95+")
BAND_PROBABILITIES = (0.25, 0.50, 0.75, 0.95)


def years_and_months(years: Column, months: Column) -> Column:
    """Composite duration in years; null when either part is null."""
    return years + months / F.lit(12.0)


def label_of(code: Column, labels: Mapping[str, str], unknown: str = UNKNOWN) -> Column:
    """Label of a code from a small in-plan dictionary."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(labels.items())])
    return F.coalesce(F.try_element_at(pairs, code), F.lit(unknown))


def join_labels(
    df: DataFrame,
    dictionary: DataFrame,
    code: str,
    dictionary_code: str,
    dictionary_label: str,
    alias: str,
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Label of a code from a dictionary table.

    No broadcast hint: the dictionary may be of any size, so the join strategy
    follows its measured size.
    """
    side = dictionary.select(
        F.col(dictionary_code).alias("__code"), F.col(dictionary_label).alias("__label")
    )
    return df.join(side, F.col(code) == F.col("__code"), "left").select(
        *df.columns, F.coalesce("__label", F.lit(unknown)).alias(alias)
    )


def with_residual(
    df: DataFrame,
    label: str,
    prediction: str = "prediction",
    alias: str = "residuo",
) -> DataFrame:
    """Adds real minus predicted: positive means under-prediction."""
    require_columns(df, [label, prediction], "with_residual")
    return df.withColumn(alias, number_of(df, label) - number_of(df, prediction))


def value_band(
    value: Column, cuts: Sequence[float | Column], names: Sequence[str] = BANDS
) -> Column:
    """Band of a value; upper bounds are inclusive, null and NaN go to the top."""
    if len(names) != len(cuts) + 1:
        raise ValueError("one more band name than cuts is needed")
    band = F.when(F.lit(False), F.lit(names[-1]))
    for cut, name in zip(cuts, names):
        bound = cut if isinstance(cut, Column) else F.lit(float(cut))
        band = band.when(value <= bound, F.lit(name))
    return band.otherwise(F.lit(names[-1]))


def band_rank(band: Column, names: Sequence[str] = BANDS) -> Column:
    """1-based position of a band in its natural order, for sorting."""
    ordered = F.array(*[F.lit(n) for n in names])
    return F.array_position(ordered, band).cast("int")
