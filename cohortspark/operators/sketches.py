"""Mergeable states of numeric columns: stored by period, merged without the rows.

A state has the count, sum, squared deviations and range of the finite values, and a KLL
quantile sketch of bounded size. States of periods that were loaded before are never
computed again; those of any union of periods come from merging.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..presets import LABOUR_SURVEY
from ..spec import require_columns
from .profile import finite_of
from .relational import long_form

#: Size parameter of the sketches.
K = 2000
# Quantiles of the descriptive table.
CUTS = {"p25": 0.25, "mediana": 0.50, "p75": 0.75, "p95": 0.95}


def rank_error(k: int = K) -> float:
    """How far the rank of an answer may be from the wanted one, as a share of all values.

    Above the published 99 % bound of one sketch by a factor of two, for merged ones too.
    """
    return 4.6 / k**0.9723


def value_states(
    df: DataFrame, columns: Sequence[str] = LABOUR_SURVEY.profiled, by: Sequence[str] = (LABOUR_SURVEY.period,), k: int = K
) -> DataFrame:
    """One state for each group and column, in one pass with a combine before the shuffle."""
    require_columns(df, [*by, *columns], "value_states")
    long = long_form(df, {c: finite_of(df, c) for c in columns}, by, "variable", "__v")
    v = F.col("__v")
    return long.where(v.isNotNull()).groupBy(*by, "variable").agg(
        F.count(v).alias("n"),
        F.sum(v).alias("suma"),
        (F.var_pop(v) * F.count(v)).alias("desvios"),
        F.min(v).alias("minimo"),
        F.max(v).alias("maximo"),
        F.kll_sketch_agg_double(v, k).alias("bosquejo"),
    )


def merge_states(states: DataFrame, by: Sequence[str] = (), k: int = K) -> DataFrame:
    """States of larger groups from those of smaller ones.

    Squared deviations are taken from each state's own mean; the deviations of these means
    from the common one are added.
    """
    groups = [*by, "variable"]
    own_mean = F.col("suma") / F.col("n")
    return states.groupBy(*groups).agg(
        F.sum("n").alias("n"),
        F.sum("suma").alias("suma"),
        (F.sum("desvios") + _between(own_mean)).alias("desvios"),
        F.min("minimo").alias("minimo"),
        F.max("maximo").alias("maximo"),
        F.kll_merge_agg_double("bosquejo", k).alias("bosquejo"),
    )


def _between(mean: Column) -> Column:
    """Sum over states of n * (mean - common mean)^2, from the weighted variance."""
    n, total = F.col("n"), F.sum("n")
    centre = F.min(mean)  # near the means, which keeps the squares small
    squares, linear = F.sum(n * mean * mean), F.sum(n * mean)
    return F.greatest(squares - 2 * centre * linear + total * centre * centre - total * F.pow(linear / total - centre, 2), F.lit(0.0))


def described_states(states: DataFrame, by: Sequence[str] = (), cuts: dict[str, float] = CUTS) -> DataFrame:
    """The descriptive table of states, with quantiles of the sketches."""
    asked = F.array(*[F.lit(float(p)) for p in cuts.values()])
    answers = F.kll_sketch_get_quantile_double("bosquejo", asked)
    return states.select(
        *by, "variable", "n",
        (F.col("suma") / F.col("n")).alias("media"),
        F.when(F.col("n") > 1, F.sqrt(F.col("desvios") / (F.col("n") - 1))).alias("stddev"),
        F.col("minimo").alias("min"),
        *[F.get(answers, F.lit(i)).alias(name) for i, name in enumerate(cuts)],
        F.col("maximo").alias("max"),
    )


def rank_check(df: DataFrame, answers: DataFrame, columns: Sequence[str], by: Sequence[str], error: float, cuts: dict[str, float] = CUTS) -> DataFrame:
    """``(*by, variable, corte, n, dentro)``: whether the true rank of each answer, between
    the shares of smaller and of not larger values, is within the error of the wanted one."""
    long = long_form(df, {c: finite_of(df, c) for c in columns}, by, "variable", "__v").where(F.col("__v").isNotNull())
    joined = long.join(answers.select(*by, "variable", *cuts), [*by, "variable"])
    counts = [F.count_if(test).alias(f"__{kind}{i}") for i, c in enumerate(cuts) for kind, test in (
        ("b", F.col("__v") < F.col(c)), ("u", F.col("__v") <= F.col(c)))]
    seen = joined.groupBy(*by, "variable").agg(F.count("*").alias("n"), *counts)
    rows = [
        F.struct(
            F.lit(name).alias("corte"),
            ((F.col(f"__b{i}") / F.col("n") <= p + error) & (F.col(f"__u{i}") / F.col("n") >= p - error)).alias("dentro"),
        )
        for i, (name, p) in enumerate(cuts.items())
    ]
    return seen.select(*by, "variable", "n", F.inline(F.array(*rows)))
