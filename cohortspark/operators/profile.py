"""Descriptive statistics, medians, distributions and histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import is_finite, number_of
from ..presets import LABOUR_SURVEY
from ..spec import require_columns
from .quantiles import ACCURACY, exact_quantiles, sketch_quantiles
from .relational import long_form, null_safe_join, settle, with_share

# Quantiles of the descriptive table.
_QUANTILES = {"p25": 0.25, "mediana": 0.50, "p75": 0.75, "p95": 0.95}
_DESCRIBED = ("media", "mediana", "stddev", "min", "p25", "p75", "p95", "max")


def finite_of(df: DataFrame, name: str) -> Column:
    """Numeric value of a column, null unless finite."""
    number = number_of(df, name)
    return F.when(is_finite(number), number)


def descriptive_statistics(
    df: DataFrame,
    columns: Sequence[str] = LABOUR_SURVEY.profiled,
    *,
    accuracy: int = ACCURACY,
    by: Sequence[str] = (),
    exact: bool = False,
) -> DataFrame:
    """Count, mean, quantiles, deviation and range of finite values per column.

    The rows follow the order of ``columns``. ``exact`` replaces the sketch by
    the distributed selection.
    """
    names = list(columns)
    if not names:
        raise ValueError("at least one column is needed")
    if accuracy <= 0:
        raise ValueError("accuracy must be a positive integer")
    require_columns(df, [*by, *names], "descriptive_statistics")
    values = df.select(*by, *[finite_of(df, c).alias(f"__v{i}") for i, c in enumerate(names)])

    measures = []
    for i in range(len(names)):
        v = F.col(f"__v{i}")
        parts = [
            F.count(v).alias("n"),
            F.avg(v).alias("media"),
            F.stddev_samp(v).alias("stddev"),
            F.min(v).alias("min"),
            F.max(v).alias("max"),
        ]
        if not exact:
            parts.append(sketch_quantiles(v, list(_QUANTILES.values()), accuracy).alias("q"))
        measures.append(F.struct(*parts).alias(f"__s{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("__at"), F.lit(name).alias("variable"), F.col(f"__s{i}").alias("s")
            )
            for i, name in enumerate(names)
        ]
    )
    table = values.groupBy(*by).agg(*measures).select(*by, F.inline(rows))
    table = table.select(*by, "__at", "variable", "s.*")
    if exact:
        long = long_form(
            values, {n: F.col(f"__v{i}") for i, n in enumerate(names)}, by, "variable", "__x"
        )
        cuts = exact_quantiles(long, "__x", _QUANTILES, [*by, "variable"]).drop("n")
        table = null_safe_join(table, cuts, [*by, "variable"], "left")
    else:
        picks = {name: F.get("q", F.lit(i)).alias(name) for i, name in enumerate(_QUANTILES)}
        table = table.select("*", *picks.values())
    return table.orderBy(*by, "__at").select(*by, "variable", "n", *_DESCRIBED)


#: Names of published medians that do not follow the rule.
MEDIAN_NAMES = {LABOUR_SURVEY.target: "mediana_salario"}


def median_by_group(
    df: DataFrame,
    group_columns: str | Sequence[str],
    value_column: str = LABOUR_SURVEY.target,
    *,
    accuracy: int = ACCURACY,
    median_alias: str | None = None,
    exact: bool = False,
) -> DataFrame:
    """Count and median of finite values per group."""
    groups = [group_columns] if isinstance(group_columns, str) else list(group_columns)
    if not groups:
        raise ValueError("at least one group column is needed")
    require_columns(df, [*groups, value_column], "median_by_group")
    name = median_alias or MEDIAN_NAMES.get(value_column, f"mediana_{value_column}")
    finite = df.withColumn("__v", finite_of(df, value_column)).select(*groups, "__v").dropna(subset=["__v"])
    if exact:
        return exact_quantiles(finite, "__v", {name: 0.5}, groups)
    median = F.get(sketch_quantiles(F.col("__v"), [0.5], accuracy), F.lit(0))
    return finite.groupBy(*groups).agg(F.count("__v").alias("n"), median.alias(name))


def period_series(
    df: DataFrame,
    value_column: str = LABOUR_SURVEY.target,
    by: Sequence[str] = ("periodo_archivo", "trimestre_calendario"),
    exact: bool = False,
) -> DataFrame:
    """Rows and median of the target per period, in time order."""
    return median_by_group(
        df, list(by), value_column, median_alias="mediana_salario", exact=exact
    ).orderBy(*by)


def period_change(
    series: DataFrame, period: str = "periodo_archivo", value: str = "mediana_salario"
) -> DataFrame:
    """First and last period and the change of the value between them."""
    first, last = F.min_by(value, period), F.max_by(value, period)
    return series.agg(
        F.min(period).alias("periodo_inicial"),
        F.max(period).alias("periodo_final"),
        first.alias("valor_inicial"),
        last.alias("valor_final"),
        (last - first).alias("cambio"),
    )


def distributions(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Rows and share per category of several columns, in one scan (long form).

    Null is a category of its own. Ordered by rows, then category.
    """
    require_columns(df, [*by, *columns], "categorical_distribution")
    long = long_form(
        df, {c: F.col(c).cast("string") for c in columns}, by, "variable", "categoria"
    )
    counts = long.groupBy(*by, "variable", "categoria").agg(F.count("*").alias("n"))
    return with_share(counts, [*by, "variable"], "porcentaje").orderBy(
        *by, "variable", F.desc("n"), F.asc("categoria")
    )


def categorical_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and share per category of one column."""
    require_columns(df, [column], "categorical_distribution")
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return with_share(counts, [], "porcentaje").orderBy(F.desc("n"), F.asc(column))


def sparse_distributions(long: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Published wide layout: one category column per variable, others null.

    ``columns`` are the variables of ``long``, in the order to show them. The same rows as a null-filling union of the single distributions, without
    computing each of them again.
    """
    first, *others = [
        F.when(F.col("variable") == name, F.col("categoria")).alias(name) for name in columns
    ]
    position = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("variable"))
    return long.orderBy(position, F.desc("n"), F.asc("categoria")).select(
        first, "n", "porcentaje", "variable", *others
    )


def leading_category(long: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Most frequent category per variable, smallest category on ties."""
    best = F.min(F.struct((-F.col("n")).alias("__n"), "categoria", "n", "porcentaje"))
    return (
        long.groupBy(*by, "variable")
        .agg(best.alias("__b"))
        .select(*by, "variable", "__b.categoria", "__b.n", "__b.porcentaje")
        .orderBy(*by, "variable")
    )


def top_group(
    table: DataFrame, group: str, value: str, by: Sequence[str] = ()
) -> DataFrame:
    """Row with the largest value per ``by``; smallest group on ties."""
    rest = [c for c in table.columns if c not in (group, value, *by)]
    best = F.min(F.struct((-F.col(value)).alias("__v"), group, value, *rest))
    return table.groupBy(*by).agg(best.alias("__b")).select(
        *by, *[F.col(f"__b.{c}").alias(c) for c in (group, value, *rest)]
    )


def histogram(
    df: DataFrame,
    value_column: str = LABOUR_SURVEY.target,
    bins: int = 45,
    by: Sequence[str] = (),
    log: bool = False,
) -> DataFrame:
    """Counts in equal-width bins between the smallest and largest finite value.

    All rows are used, empty bins are listed and the last bin is closed. With
    ``log`` the bins are equally wide in the logarithm of positive values. Bin
    edges come from one small aggregate over the same columns.
    """
    if bins <= 0:
        raise ValueError("bins must be positive")
    require_columns(df, [*by, value_column], "histogram")
    value = finite_of(df, value_column)
    if log:
        value = F.log(F.when(value > 0, value))
    values = df.select(*by, value.alias("__v")).where("__v IS NOT NULL")
    edges = values.groupBy(*by).agg(F.min("__v").alias("__a"), F.max("__v").alias("__b"))
    # A single distinct value gets a unit-wide range around it.
    half = F.when(F.col("__a") == F.col("__b"), F.lit(0.5)).otherwise(F.lit(0.0))
    edges = settle(
        edges.where("__a IS NOT NULL").select(
            *by, (F.col("__a") - half).alias("__a"), (F.col("__b") + half).alias("__b")
        )
    )
    if by:
        placed = null_safe_join(values, edges, by)
    else:
        low, high = edges.first() or (None, None)
        placed = values.select("__v", F.lit(low).alias("__a"), F.lit(high).alias("__b"))
    step = (F.col("__b") - F.col("__a")) / F.lit(float(bins))
    place = F.floor((F.col("__v") - F.col("__a")) / (F.col("__b") - F.col("__a")) * bins)
    counts = placed.groupBy(*by, F.least(place, F.lit(bins - 1)).cast("int").alias("bin")).agg(
        F.count("*").alias("n")
    )
    slots = edges.select(
        *by, "__a", "__b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    scale = F.exp if log else (lambda c: c)
    return (
        null_safe_join(slots, counts, [*by, "bin"], "left")
        .select(
            *by,
            (F.col("bin") + 1).alias("bin"),
            scale(F.col("__a") + step * F.col("bin")).alias("desde"),
            scale(F.col("__a") + step * (F.col("bin") + 1)).alias("hasta"),
            F.coalesce("n", F.lit(0)).cast("long").alias("n"),
        )
        .orderBy(*by, "bin")
    )
