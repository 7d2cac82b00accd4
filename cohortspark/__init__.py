"""Cohort analysis of large tabular extracts on Spark."""

from .functions.coerce import is_finite, is_missing, to_code, to_number
from .functions.derive import band_rank, label_of, value_band, with_residual, years_and_months
from .functions.staging import stage
from .functions.text import check_period, detect_period, fold, squeeze
from .operators.evaluate import (
    banded_error_metrics,
    best_by,
    dataset_deltas,
    evaluate_regression,
    grouped_error_metrics,
    model_winners,
    regression_metrics,
    stack_predictions,
    top_band_comparison,
    worst_segment,
)
from .operators.predict import (
    best_config,
    feature_importance_table,
    importance_by_column,
    model_pipeline,
    score_models,
    sweep,
    target_median,
    with_baseline,
)
from .operators.profile import (
    categorical_distribution,
    descriptive_statistics,
    distributions,
    histogram,
    leading_category,
    median_by_group,
    period_change,
    period_series,
    sparse_distributions,
    top_group,
)
from .operators.quality import (
    apply_filters_with_audit,
    duplicate_keys,
    duplicate_summary,
    filter_with_audit,
    key_differences,
    metrics_finite,
    missing_summary,
    period_counts,
    require_rows,
    require_same_rows,
)
from .operators.quantiles import exact_quantiles, quantile_cuts, select_ranks
from .operators.relate import correlation_long, correlation_matrix, strongest_correlation
from .operators.sample import deterministic_sample, hash_split, random_sample
from .operators.segment import (
    best_k,
    kmeans_sweep,
    prepare_kmeans_features,
    scaled_columns,
    segment_composition,
    segment_profile,
)
from .presets import EXPECTED_PERIODS, LABOUR_SURVEY, OCCUPATION_LABELS
from .sources.extracts import (
    detect_period_from_filename,
    find_person_files,
    harmonised_union,
    header_audit,
    load_extracts,
    load_person_period,
    load_study,
    manifest,
    read_header,
    require_complete,
    sparse_union,
    standardise,
)
from .sources.sinks import load_model, save_model, table_from_rows, write_prepared, write_small_table
from .spec import Cascade, DatasetSpec, FieldSpec, FilterStep, PeriodNaming, RequiredColumnsError

__all__ = sorted(name for name in dir() if not name.startswith("_"))
