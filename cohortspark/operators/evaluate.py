"""Model errors: overall, by group, by value band, and across datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import number_of
from ..functions.derive import BANDS, band_rank, value_band, with_residual
from ..presets import LABOUR_SURVEY
from ..spec import UNKNOWN, require_columns
from .quantiles import ACCURACY, exact_quantiles
from .relational import long_form, null_safe_join

_TARGET = LABOUR_SURVEY.target
METRICS = ("MAE", "RMSE", "R2")


def stack_predictions(
    df: DataFrame, predictions: Mapping[str, str | Column], keep: Sequence[str]
) -> DataFrame:
    """Long frame ``(*keep, modelo, prediction)`` from one column per model.

    Every model scores the very same rows of a single scan.
    """
    columns = {
        name: F.col(c) if isinstance(c, str) else c for name, c in predictions.items()
    }
    return long_form(df, columns, keep, "modelo", "prediction")


def _error(df: DataFrame, label: str, prediction: str) -> tuple[Column, Column]:
    real = number_of(df, label)
    return real, real - number_of(df, prediction)


def _errors_by(
    rows: DataFrame, groups: Sequence[str], names: Sequence[str], *more: Column
) -> DataFrame:
    """Named measures of the error ``__e`` for each group, and further aggregates."""
    measures = {
        "n": F.count("*"),
        "MAE": F.avg(F.abs("__e")),
        "RMSE": F.sqrt(F.avg(F.col("__e") * F.col("__e"))),
        "error_medio": F.avg("__e"),
    }
    return rows.groupBy(*groups).agg(*[measures[n].alias(n) for n in names], *more)


def regression_metrics(
    predictions: DataFrame,
    label_col: str = _TARGET,
    prediction_col: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """MAE, RMSE and R2 over all rows, for all groups in one aggregate.

    R2 is null when the target does not vary.
    """
    require_columns(predictions, [*by, label_col, prediction_col], "evaluate_regression")
    real, error = _error(predictions, label_col, prediction_col)
    errors = predictions.select(*by, real.alias("__y"), error.alias("__e"))
    spread = F.var_pop("__y") * F.count("__y")
    explained = 1.0 - F.sum(F.col("__e") * F.col("__e")) / F.nullif(spread, F.lit(0.0))
    return _errors_by(errors, by, ("MAE", "RMSE"), explained.alias("R2"))


def evaluate_regression(
    predictions: DataFrame, label_col: str = _TARGET, prediction_col: str = "prediction"
) -> dict[str, float]:
    """The three metrics of one prediction frame as a dict."""
    return regression_metrics(predictions, label_col, prediction_col).first().asDict()


def grouped_error_metrics(
    predictions: DataFrame,
    group_col: str,
    *,
    label_col: str = _TARGET,
    prediction_col: str = "prediction",
    residual_col: str = "residuo",
    by: Sequence[str] = (),
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Rows, MAE and mean signed error per category; null is the unknown group.

    An existing residual column is used. ``by`` is typically the model.
    """
    require_columns(predictions, [*by, group_col], "grouped_error_metrics")
    known = residual_col in predictions.columns
    scored = predictions if known else with_residual(predictions, label_col, prediction_col, residual_col)
    category = F.trim(F.col(group_col).cast("string"))
    rows = scored.select(
        *by, F.coalesce(category, F.lit(unknown)).alias(group_col), F.col(residual_col).alias("__e")
    )
    table = _errors_by(rows, [*by, group_col], ("n", "MAE", "error_medio"))
    return table.orderBy(*by, F.col("n").desc(), group_col)


def error_cube(
    predictions: DataFrame,
    dimensions: Mapping[str, str | Column],
    *,
    label_col: str = _TARGET,
    prediction_col: str = "prediction",
    by: Sequence[str] = ("modelo",),
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Errors of all rows and of every category of each dimension, in one aggregate.

    Rows ``(*by, dimension, grupo)``; the rows without dimension are those over all
    categories. A null category is the unknown group.
    """
    require_columns(predictions, [*by, label_col, prediction_col], "error_cube")
    real, error = _error(predictions, label_col, prediction_col)
    names = list(dimensions)
    categories = [
        F.coalesce(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")), F.lit(unknown)).alias(f"__d{i}")
        for i, c in enumerate(dimensions.values())
    ]
    rows = predictions.select(
        *by, *categories, real.alias("__y"), number_of(predictions, prediction_col).alias("__p"), error.alias("__e")
    )
    slots = [f"__d{i}" for i in range(len(names))]
    sets = [list(by), *[[*by, slot] for slot in slots]]
    marks = [F.grouping(slot).alias(f"__g{i}") for i, slot in enumerate(slots)]
    measures = [
        F.count("*").alias("n"),
        F.avg("__y").alias("real_medio"),
        F.avg("__p").alias("prediccion_media"),
        F.avg(F.abs("__e")).alias("MAE"),
        F.sqrt(F.avg(F.col("__e") * F.col("__e"))).alias("RMSE"),
        F.avg("__e").alias("error_medio"),
    ]
    table = rows.groupingSets([[F.col(c) for c in s] for s in sets], *by, *slots).agg(*measures, *marks)
    dimension = group = F.lit(None).cast("string")
    for i, name in enumerate(names):
        here = F.col(f"__g{i}") == 0
        dimension = F.when(here, F.lit(name)).otherwise(dimension)
        group = F.when(here, F.col(f"__d{i}")).otherwise(group)
    return table.select(
        *by, dimension.alias("dimension"), group.alias("grupo"),
        "n", "real_medio", "prediccion_media", "MAE", "RMSE", "error_medio",
    )


def cube_laws(cube: DataFrame, by: Sequence[str] = ("modelo",)) -> DataFrame:
    """``(*by, dimension, n, cumple)``: whether the categories of a dimension, weighted by
    their rows, have the errors of all rows, and errors are differences of means."""
    total = cube.where("dimension IS NULL").select(*by, *[F.col(c).alias(f"__{c}") for c in ("n", "MAE", "RMSE", "error_medio")])

    def weighted(column: Column) -> Column:
        return F.sum(F.col("n") * column) / F.sum("n")

    def near(a: Column, b: Column, scale: Column) -> Column:
        return F.abs(a - b) <= 1e-9 * (1.0 + scale)

    gap = F.abs(F.col("error_medio") - (F.col("real_medio") - F.col("prediccion_media")))
    parts = cube.where("dimension IS NOT NULL").groupBy(*by, "dimension").agg(
        F.sum("n").alias("n"),
        weighted(F.col("MAE")).alias("a"),
        weighted(F.col("RMSE") * F.col("RMSE")).alias("s"),
        weighted(F.col("error_medio")).alias("m"),
        F.max(gap / (1.0 + F.abs("real_medio"))).alias("g"),
    )
    rmse = F.col("__RMSE")
    good = (
        (F.col("n") == F.col("__n")) & near(F.col("a"), F.col("__MAE"), F.col("__MAE"))
        & near(F.sqrt("s"), rmse, rmse) & near(F.col("m"), F.col("__error_medio"), rmse) & (F.col("g") <= 1e-9)
    )
    return null_safe_join(parts, total, by).select(*by, "dimension", "n", good.alias("cumple"))


def banded_error_metrics(
    predictions: DataFrame,
    cuts: Sequence[float],
    *,
    label_col: str = _TARGET,
    prediction_col: str = "prediction",
    by: Sequence[str] = ("modelo",),
    accuracy: int = ACCURACY,
    exact: bool = False,
) -> DataFrame:
    """Errors per band of the real value, bands in natural order."""
    require_columns(predictions, [*by, label_col, prediction_col], "banded_error_metrics")
    real, error = _error(predictions, label_col, prediction_col)
    rows = predictions.select(
        *by,
        value_band(real, cuts).alias("banda_salario"),
        real.alias("__y"),
        number_of(predictions, prediction_col).alias("__p"),
        error.alias("__e"),
    )
    groups = [*by, "banda_salario"]
    means = [F.avg("__y").alias("salario_medio"), F.avg("__p").alias("prediccion_media")]
    if not exact:
        means.append(F.percentile_approx("__y", 0.5, accuracy).alias("salario_mediano"))
    table = _errors_by(rows, groups, ("n", "MAE", "RMSE", "error_medio"), *means)
    if exact:
        medians = exact_quantiles(rows, "__y", {"salario_mediano": 0.5}, groups).drop("n")
        table = null_safe_join(table, medians, groups, "left")
    return table.select(
        *groups,
        "n",
        "salario_medio",
        "salario_mediano",
        "prediccion_media",
        "MAE",
        "RMSE",
        "error_medio",
        F.col("MAE").alias("error_medio_absoluto"),
    ).orderBy(*by, band_rank(F.col("banda_salario")))


def top_band_comparison(bands: DataFrame, by: Sequence[str] = ("modelo",)) -> DataFrame:
    """Top band against the plain mean of the lower bands, per model."""
    top = F.col("banda_salario") == BANDS[-1]
    mae = F.max(F.when(top, F.col("MAE")))
    lower = F.avg(F.when(~top, F.col("MAE")))
    error = F.max(F.when(top, F.col("error_medio")))
    return (
        bands.groupBy(*by)
        .agg(
            F.max(F.when(top, F.col("n"))).alias("n_p95_mas"),
            mae.alias("MAE_p95_mas"),
            lower.alias("MAE_promedio_bandas_inferiores"),
            (mae - lower).alias("delta_MAE_p95_mas_menos_inferiores"),
            error.alias("error_medio_p95_mas"),
            F.when(error > 0, F.lit("subestimación"))
            .otherwise(F.lit("sobreestimación"))
            .alias("direccion_error_p95_mas"),
        )
        .orderBy(*by)
    )


def worst_segment(errors: DataFrame, group_col: str, by: Sequence[str] = ("modelo",)) -> DataFrame:
    """Category with the largest MAE per model, smallest category on ties."""
    best = F.min(F.struct((-F.col("MAE")).alias("__m"), group_col, "n", "MAE"))
    return (
        errors.groupBy(*by)
        .agg(best.alias("__b"))
        .select(*by, f"__b.{group_col}", "__b.n", "__b.MAE")
        .orderBy(*by)
    )


def best_by(table: DataFrame, metric: str, by: Sequence[str] = (), tie: str = "modelo") -> DataFrame:
    """Row with the lowest metric per group, ties broken by name."""
    rest = [c for c in table.columns if c not in (metric, tie, *by)]
    best = F.min(F.struct(metric, tie, *rest)).alias("__b")
    return (
        table.where(F.col(metric).isNotNull())
        .groupBy(*by)
        .agg(best)
        .select(*[F.col(c) if c in by else F.col(f"__b.{c}").alias(c) for c in table.columns])
    )


def model_winners(metrics: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Winning model by RMSE and by MAE per dataset, ties broken by name."""

    def winner(metric: str) -> Column:
        return F.min(F.struct(metric, "modelo"))["modelo"]

    return metrics.groupBy(*by).agg(
        winner("RMSE").alias("mejor_RMSE"), winner("MAE").alias("mejor_MAE")
    )


def dataset_deltas(
    metrics: DataFrame, first: str, second: str, names: tuple[str, str] | None = None
) -> DataFrame:
    """Metrics of two datasets side by side with their change per model.

    The change is second minus first; ``direccion`` describes the RMSE. ``names``
    replaces the dataset tags in the column names.
    """
    early, late = names or (first, second)

    def pick(metric: str, dataset: str) -> Column:
        return F.max(F.when(F.col("dataset") == dataset, F.col(metric)))

    columns = []
    for metric in METRICS:
        columns += [
            pick(metric, first).alias(f"{metric}_{early}"),
            pick(metric, second).alias(f"{metric}_{late}"),
            (pick(metric, second) - pick(metric, first)).alias(f"delta_{metric}"),
        ]
    change = F.col("delta_RMSE")
    return (
        metrics.groupBy("modelo")
        .agg(*columns)
        .withColumn(
            "direccion",
            F.when(change > 0, F.lit("aumentó"))
            .when(change < 0, F.lit("disminuyó"))
            .otherwise(F.lit("no cambió")),
        )
        .orderBy("modelo")
    )
