"""The whole labour-survey study: extracts in, result tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.derive import label_of, with_residual
from ..operators.audited import ELIGIBLE, write_audited
from ..operators.evaluate import (
    METRICS,
    banded_error_metrics,
    dataset_deltas,
    grouped_error_metrics,
    regression_metrics,
    top_band_comparison,
)
from ..operators.predict import (
    LR_CONFIGS,
    RF_CONFIGS,
    best_config,
    feature_importance_table,
    pipeline_for,
    score_models,
    sweep,
    target_median,
    with_baseline,
)
from ..operators.profile import (
    descriptive_statistics,
    distributions,
    median_by_group,
    period_series,
    sparse_distributions,
)
from ..operators.quality import duplicate_summary, require_rows
from ..operators.quantiles import quantile_cuts
from ..operators.relate import correlation_matrix
from ..operators.relational import kept, settle
from ..operators.sample import SAMPLE_ROWS, deterministic_sample, hash_split
from ..operators.segment import (
    best_k,
    kmeans_sweep,
    prepare_kmeans_features,
    segment_composition,
    segment_profile,
)
from ..presets import EXPECTED_PERIODS, LABOUR_SURVEY
from ..sources.extracts import load_study
from ..sources.sinks import MAX_ROWS, save_model, write_small_table

# Tags and names of the published tables.
LABEL = "categoria_ocupacional_etiqueta"
MODELS = ("Baseline", "Linear Regression", "Random Forest")
TRAINING, HOLDOUT = "2025", "2026T1"
VALIDATION, TEST = "validation_2025", "test_2026"
SPEC = LABOUR_SURVEY


def load_and_audit(
    spark: SparkSession, roots: str | Sequence[str], work: str, periods: Sequence[str]
) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Prepared rows, written under ``work`` by period, and the quality tables."""
    raw = load_study(spark, roots, periods)
    tag = F.when(F.col(SPEC.period) == periods[-1], F.lit(HOLDOUT)).otherwise(F.lit(TRAINING))
    raw = raw.withColumn("conjunto", tag)
    # the one pass over the extracts: writes all rows, counts what the tables need
    done = write_audited(raw, f"{work}/prepared", by="conjunto", tags=(TRAINING, HOLDOUT), periods=periods)
    label = label_of(F.col("categoria_ocupacional"), SPEC.labels["categoria_ocupacional"])
    prepared = done.prepared.withColumn(LABEL, label)
    require_rows(
        training=prepared.where(F.col("conjunto") == TRAINING),
        holdout=prepared.where(F.col("conjunto") == HOLDOUT),
    )
    return prepared, {
        "missing_summary": done.missing,
        "filter_audit": done.audit,
        "prepared_counts_by_period": done.eligible_by_period,
        "duplicate_key_audit": duplicate_summary(done.rows.drop(ELIGIBLE), by=["conjunto"]),
    }


def describe(training: DataFrame) -> dict[str, DataFrame]:
    """Descriptive, distribution, median and correlation tables."""
    shown = [LABEL, "nivel_educativo", "dominio"]
    return {
        "descriptive_stats": descriptive_statistics(training),
        "categorical_distributions_2025": sparse_distributions(
            distributions(training, shown), shown
        ),
        "median_salary_by_education": median_by_group(training, "nivel_educativo").orderBy(
            "nivel_educativo"
        ),
        "median_salary_by_occupation": median_by_group(training, "categoria_ocupacional").orderBy(
            "categoria_ocupacional"
        ),
        "quarterly_count_and_median_salary": period_series(training),
        "correlation_matrix": correlation_matrix(training),
    }


def segment(training: DataFrame) -> dict[str, DataFrame]:
    """Silhouettes, profiles of the best segmentation and its composition."""
    features, _ = prepare_kmeans_features(training)
    scores, models = kmeans_sweep(features)
    segmented = models[best_k(scores)].transform(features)
    tables = {"kmeans_scores": scores, "cluster_profiles": segment_profile(segmented)}
    shown = ["nivel_educativo", LABEL, "dominio"]
    parts = settle(segment_composition(segmented, shown))
    for column in shown:
        tables[f"cluster_{column}_summary"] = (
            parts.where(F.col("variable") == column)
            .withColumnRenamed("categoria", column)
            .select("cluster", column, "n", "n_cluster", "porcentaje_cluster")
            .orderBy("cluster", F.desc("n"), column)
        )
    return tables


def _stacked(
    rows: DataFrame, models: Mapping[str, object], median: float, dataset: str
) -> DataFrame:
    """Predictions of the baseline and the fitted models on the same rows."""
    keep = [*SPEC.keys, "nivel_educativo", "dominio", SPEC.target]
    baseline = with_baseline(rows, median).select(
        *keep, F.lit(MODELS[0]).alias("modelo"), "prediction"
    )
    return baseline.unionByName(score_models(rows, models, keep)).withColumn(
        "dataset", F.lit(dataset)
    )


def model(
    training: DataFrame, holdout: DataFrame, folder: str | None = None
) -> dict[str, DataFrame]:
    """Sweeps on a split of the training rows, one final evaluation on the holdout."""
    train, validation = hash_split(training, SPEC.keys)
    require_rows(train=train, validation=validation)
    swept = {}
    for name, configs in (("lr", LR_CONFIGS), ("rf", RF_CONFIGS)):
        metrics, models = sweep(train, validation, configs)
        metrics = settle(metrics).orderBy("RMSE", "modelo")
        best = best_config(metrics, configs)
        swept[name] = metrics, best, models[best["modelo"]]
    chosen = dict(zip(MODELS[1:], (swept["lr"][2], swept["rf"][2])))
    validated = _stacked(validation, chosen, target_median(train), VALIDATION)

    with kept(training) as (rows,):
        final = {
            name: pipeline_for(swept[kind][1]).fit(rows)
            for name, kind in zip(MODELS[1:], ("lr", "rf"))
        }
        median = target_median(rows)
    if folder:
        for kind, name in (("linear_regression", MODELS[1]), ("random_forest", MODELS[2])):
            save_model(chosen[name], f"{folder}/{kind}_best")
            save_model(final[name], f"{folder}/{kind}_final")

    tested = _stacked(holdout, final, median, TEST)
    by = ["modelo", "dataset"]
    both = settle(
        regression_metrics(validated, by=by).unionByName(regression_metrics(tested, by=by))
    )
    # Errors by group and band describe the fitted models only.
    errors = settle(with_residual(tested.where(F.col("modelo") != MODELS[0]), SPEC.target))
    cuts = quantile_cuts(holdout, SPEC.target)
    bands = banded_error_metrics(errors, cuts)
    sample = deterministic_sample(holdout)
    points = score_models(sample, final, [*SPEC.keys, SPEC.target])
    forest = swept["rf"][2]
    return {
        "lr_validation_metrics": swept["lr"][0],
        "rf_validation_metrics": swept["rf"][0],
        "rf_feature_importances": feature_importance_table(
            forest.stages[-1], forest.transform(validation)
        ),
        "model_comparison_validation": both.where(F.col("dataset") == VALIDATION).orderBy("RMSE"),
        "model_comparison_test_2026": both.where(F.col("dataset") == TEST).orderBy("RMSE"),
        "validation_vs_test": dataset_deltas(
            both, VALIDATION, TEST, ("validacion_2025", TEST)
        ),
        "model_comparison_validation_vs_test": both.select(*by, *METRICS).orderBy(*by),
        "errors_by_education": grouped_error_metrics(errors, "nivel_educativo", by=["modelo"]),
        "errors_by_domain": grouped_error_metrics(errors, "dominio", by=["modelo"]),
        "errors_by_salary_band": bands,
        "high_salary_comparison": top_band_comparison(bands),
        "prediction_points": with_residual(points, SPEC.target),
    }


def run_study(
    spark: SparkSession,
    roots: str | Sequence[str],
    work: str,
    tables: str | Path,
    periods: Sequence[str] = EXPECTED_PERIODS,
) -> list[Path]:
    """Every result table as a CSV report; the last period is the holdout.

    ``work`` is a folder all executors can reach; ``tables`` is local to the
    driver and receives bounded reports only.
    """
    prepared, results = load_and_audit(spark, roots, work, periods)
    training = prepared.where(F.col("conjunto") == TRAINING)
    holdout = prepared.where(F.col("conjunto") == HOLDOUT)
    results |= describe(training) | segment(training)
    results |= model(training, holdout, f"{work}/models")
    # the points are bounded by the sample and the number of models, other tables by default
    bounds = {"prediction_points": SAMPLE_ROWS * len(MODELS)}
    return [
        write_small_table(df, Path(tables) / f"{name}.csv", max_rows=bounds.get(name, MAX_ROWS)) for name, df in results.items()
    ]
