"""Quantiles by group: a bounded sketch, or an exact distributed selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import null_safe_join, settle

#: Fixed value: sketch accuracy of the published tables.
ACCURACY = 10_000

#: The cuts of value bands.
BAND_CUTS = (0.25, 0.50, 0.75, 0.95)

_SMALLEST = 5e-324  # smallest positive double
_EXPONENT_SHIFT = 1100  # makes its exponent positive


def _with_digits(rows: DataFrame, value: str, groups: Sequence[str]) -> DataFrame:
    """Three keys that order doubles like the doubles themselves.

    Sign, binary exponent and 11 mantissa bits; then 20 more bits; then the value
    (at most 2**21 of them share the first two keys). Scaling by powers of two is
    exact, so equal values always get equal keys. Zero has the lowest exponent.
    """
    size = F.greatest(F.abs(value), F.lit(_SMALLEST))
    parts = rows.select(*groups, F.col(value).alias("__d2"), F.floor(F.log2(size)).alias("__e"))
    scaled = F.abs("__d2") / F.pow(F.lit(2.0), F.col("__e")) * 2048.0
    parts = parts.select(*groups, "__d2", "__e", scaled.alias("__m"))
    sign = F.when(F.col("__d2") < 0, F.lit(-1)).otherwise(F.lit(1))
    first = (F.col("__e") + _EXPONENT_SHIFT) * 4096 + F.floor("__m")
    second = F.floor((F.col("__m") - F.floor("__m")) * float(1 << 20))
    return parts.select(
        *groups, (sign * first).alias("__d0"), (sign * second).alias("__d1"), "__d2"
    )


def select_ranks(
    df: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact discrete quantiles: rows ``(*by, n, probability, value)``.

    Works like a radix search: count rows per leading key, find the key that
    holds the wanted rank, and look again only inside it. Every pass is a counting
    aggregate with a map-side combine; no group is ever gathered or sorted as a
    whole, whatever its size. ``value`` must be a finite double or null.
    """
    groups = list(by) or ["__all"]
    frame = df if by else df.withColumn("__all", F.lit(0))
    # written once: the three passes read the keys they need, not the source again
    data = settle(_with_digits(frame.where(F.col(value).isNotNull()), value, groups))
    targets, prefix, digits = None, list(groups), ["__d0", "__d1", "__d2"]
    while digits:
        digit = digits.pop(0)
        rows = data
        if targets is not None:
            rows = null_safe_join(data, targets.select(*prefix), prefix, "left_semi")
        counts = rows.groupBy(*prefix, digit).agg(F.count("*").alias("__n"))
        inside = Window.partitionBy(*prefix)
        upto = inside.orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
        ladder = counts.withColumn("__upto", F.sum("__n").over(upto))
        if targets is None:
            ladder = ladder.withColumn("n", F.sum("__n").over(inside))
            rank = F.col("n") - F.floor(F.col("n") - F.col("probability") * F.col("n"))
            ladder = ladder.withColumn(
                "probability", F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
            ).withColumn("__rank", F.greatest(rank, F.lit(1)))
        else:
            ladder = null_safe_join(ladder, targets, prefix)
        prefix.append(digit)
        targets = ladder.where(
            (F.col("__rank") <= F.col("__upto"))
            & (F.col("__rank") > F.col("__upto") - F.col("__n"))
        ).select(
            *prefix,
            "n",
            "probability",
            (F.col("__rank") - F.col("__upto") + F.col("__n")).alias("__rank"),
        )
        if digits:
            targets = settle(targets)
    return targets.select(*by, "n", "probability", F.col("__d2").alias("value"))


def exact_quantiles(
    df: DataFrame, value: str, columns: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Wide form of :func:`select_ranks`: ``(*by, n, one column per quantile)``."""
    ranks = select_ranks(df, value, list(columns.values()), by)
    picks = [
        F.max(F.when(F.col("probability") == F.lit(float(p)), F.col("value"))).alias(name)
        for name, p in columns.items()
    ]
    return ranks.groupBy(*by).agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *picks)


def sketch_quantiles(value: Column, probabilities: Sequence[float], accuracy: int = ACCURACY) -> Column:
    """One mergeable sketch that answers several quantiles."""
    if accuracy <= 0:
        raise ValueError("accuracy must be a positive integer")
    return F.percentile_approx(value, [float(p) for p in probabilities], accuracy)


def quantile_cuts(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float] = BAND_CUTS,
    relative_error: float = 0.001,
    exact: bool = False,
) -> list[float]:
    """A few scalar cuts of one column, to be used as literals."""
    if not exact:
        return df.approxQuantile(value, list(probabilities), relative_error)
    rows = select_ranks(df, value, probabilities).collect()  # one row per probability
    found = {row["probability"]: row["value"] for row in rows}
    return [found[float(p)] for p in probabilities] if found else []
