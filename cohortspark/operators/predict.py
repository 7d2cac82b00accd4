"""Regression pipelines, configuration sweeps and holdout scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Model
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..presets import LABOUR_SURVEY
from ..spec import DatasetSpec, require_columns
from .evaluate import METRICS, best_by, regression_metrics, stack_predictions
from .forest import CellForestRegressor
from .quantiles import ACCURACY, select_ranks
from .relational import kept, settle
from .segment import SEED

# The compared configurations.
LR_CONFIGS = (
    {"modelo": "LR_1", "regParam": 0.0, "elasticNetParam": 0.0},
    {"modelo": "LR_2", "regParam": 0.01, "elasticNetParam": 0.0},
    {"modelo": "LR_3", "regParam": 0.01, "elasticNetParam": 0.5},
)
RF_CONFIGS = (
    {"modelo": "RF_1", "numTrees": 20, "maxDepth": 5},
    {"modelo": "RF_2", "numTrees": 40, "maxDepth": 7},
    {"modelo": "RF_3", "numTrees": 60, "maxDepth": 8},
)


def target_median(
    df: DataFrame, target: str = LABOUR_SURVEY.target, accuracy: int = ACCURACY, exact: bool = False
) -> float:
    """Median of the target, the constant of the baseline model."""
    if exact:
        return select_ranks(df, target, [0.5]).first()["value"]
    return df.agg(F.percentile_approx(target, 0.5, accuracy)).first()[0]


def with_baseline(
    df: DataFrame, median: float, prediction_col: str = "prediction"
) -> DataFrame:
    """Constant prediction learned on the training rows only."""
    return df.withColumn(prediction_col, F.lit(float(median)))


#: Estimator and fixed values of each kind of model; a configuration sets the rest.
#: With cached node ids, a level of a forest does not walk every tree from its root for
#: every row; the trees are the same.
KINDS = {
    "linear": (LinearRegression, {"maxIter": 100, "standardization": True}),
    "forest": (RandomForestRegressor, {"maxBins": 16, "maxMemoryInMB": 64, "cacheNodeIds": True, "seed": SEED}),
}

#: What fits a kind in its estimator's stead, with the same parameters and model: forests
#: are grown from the cells of the rows' bins.
FITTED_BY = {RandomForestRegressor: CellForestRegressor}


def encoder_stages(spec: DatasetSpec = LABOUR_SURVEY) -> list:
    """Unfitted stages from the predictors to one vector, ``features``.

    Labels are learned by ``fit``, hence on the training rows alone; null and
    unseen categories share the last slot of each variable.
    """
    if spec.target in {*spec.numeric, *spec.categorical}:
        raise ValueError(f"the target {spec.target} must not be a predictor")
    names = list(spec.categorical)
    places, slots = ([f"{column}__{kind}" for column in names] for kind in ("index", "ohe"))
    stages = [  # of all variables at once: their labels are counted in one scan
        StringIndexer(inputCols=names, outputCols=places, handleInvalid="keep"),
        OneHotEncoder(inputCols=places, outputCols=slots, handleInvalid="keep"),
    ]
    inputs = [*spec.numeric, *slots]
    return [*(stages if names else []), VectorAssembler(inputCols=inputs, outputCol="features")]


def model_pipeline(
    kind: str, settings: Mapping[str, object] | None = None, spec: DatasetSpec = LABOUR_SURVEY
) -> Pipeline:
    """Encoders and an estimator of one of ``KINDS``; settings are its parameters.

    Raise ``maxMemoryInMB`` of forests on large executors, so that more nodes are
    split per pass over the data.
    """
    estimator, fixed = KINDS[kind]
    chosen = {"labelCol": spec.target, **fixed, **(settings or {})}
    return Pipeline(stages=[*encoder_stages(spec), FITTED_BY.get(estimator, estimator)(**chosen)])


def pipeline_for(config: Mapping[str, object], spec: DatasetSpec = LABOUR_SURVEY, **options) -> Pipeline:
    """Pipeline of one configuration of a sweep."""
    settings = {k: v for k, v in config.items() if k != "modelo"} | options
    return model_pipeline("forest" if "numTrees" in config else "linear", settings, spec)


def score_models(df: DataFrame, models: Mapping[str, Model], keep: Sequence[str]) -> DataFrame:
    """Long frame ``(*keep, modelo, prediction)``; one scan scores every model."""
    scored, columns = df, {}
    for i, (name, model) in enumerate(models.items()):
        columns[name] = f"__p{i}"
        scored = model.transform(scored).withColumnRenamed("prediction", f"__p{i}")
        scored = scored.select(*df.columns, *columns.values())
    return stack_predictions(scored, columns, keep)


def sweep(
    train: DataFrame,
    validation: DataFrame,
    configs: Sequence[Mapping[str, object]],
    spec: DatasetSpec = LABOUR_SURVEY,
    **options,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Validation metrics of every configuration, best RMSE first, and the models.

    The encoders do not depend on the configuration: they are learned once on the
    training rows, and only the encoded features are kept while the estimators
    are fitted. Every model scores the same validation rows in one scan.
    """
    pipelines = {c["modelo"]: pipeline_for(c, spec, **options) for c in configs}
    shared = next(iter(pipelines.values())).getStages()[:-1]
    encoder = Pipeline(stages=shared).fit(train)
    encoded = [
        encoder.transform(df).select(spec.target, "features") for df in (train, validation)
    ]
    with kept(encoded[0]) as (features,):
        fitted = {n: p.getStages()[-1].fit(features) for n, p in pipelines.items()}
    # trees look features up by their place, in a sparse vector by a search
    dense = encoded[1].withColumn("features", array_to_vector(vector_to_array("features")))
    long = score_models(dense, fitted, [spec.target])
    metrics = settle(regression_metrics(long, spec.target, by=["modelo"]))
    models = {n: PipelineModel([*encoder.stages, m]) for n, m in fitted.items()}
    names = [n for n in configs[0] if n != "modelo"]
    kinds = {n: "int" if isinstance(configs[0][n], int) else "double" for n in names}
    settings = train.sparkSession.createDataFrame(
        [tuple(c[n] for n in ("modelo", *names)) for c in configs],
        "modelo string, " + ", ".join(f"{n} {k}" for n, k in kinds.items()),
    )
    table = settings.join(metrics, "modelo").select("modelo", *names, *METRICS)
    return table.orderBy("RMSE", "modelo"), models


def best_config(
    metrics: DataFrame, configs: Sequence[Mapping[str, object]], metric: str = "RMSE"
) -> Mapping[str, object]:
    """Configuration with the lowest metric, ties broken by name."""
    name = best_by(metrics, metric).first()["modelo"]
    return next(c for c in configs if c["modelo"] == name)


def feature_importance_table(
    model, transformed: DataFrame, *, features_col: str = "features"
) -> DataFrame:
    """Rows ``(indice, feature, importancia)``, most important first.

    Names come from the vector metadata; a slot without one keeps its position.
    """
    require_columns(transformed, [features_col], "feature_importance_table")
    described = transformed.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    slots = pd.DataFrame([slot for kind in described.values() for slot in kind], columns=["idx", "name"])
    table = pd.DataFrame({"importancia": model.featureImportances.toArray().astype(float)})
    table["indice"] = table.index.astype("int32")
    table["feature"] = table["indice"].map(slots.dropna().set_index("idx")["name"])
    table["feature"] = table["feature"].fillna("feature_" + table["indice"].astype(str))
    frame = transformed.sparkSession.createDataFrame(
        table[["indice", "feature", "importancia"]], "indice int, feature string, importancia double"
    )
    return frame.orderBy(F.desc("importancia"), F.asc("indice"))


def importance_by_column(importances: DataFrame) -> DataFrame:
    """Importance rolled up to the predictor each slot comes from."""
    column = F.regexp_extract("feature", r"^(.*?)(__ohe.*)?$", 1)
    return (
        importances.groupBy(column.alias("columna"))
        .agg(F.sum("importancia").alias("importancia"))
        .orderBy(F.desc("importancia"), "columna")
    )
