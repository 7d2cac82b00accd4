"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import (
    LABOUR_SURVEY,
    banded_error_metrics,
    categorical_distribution,
    check_period,
    correlation_long,
    correlation_matrix,
    dataset_deltas,
    descriptive_statistics,
    detect_period,
    deterministic_sample,
    distributions,
    duplicate_keys,
    duplicate_summary,
    exact_quantiles,
    feature_importance_table,
    fold,
    grouped_error_metrics,
    harmonised_union,
    hash_split,
    header_audit,
    histogram,
    importance_by_column,
    is_finite,
    is_missing,
    key_differences,
    kmeans_sweep,
    label_of,
    leading_category,
    manifest,
    median_by_group,
    metrics_finite,
    missing_summary,
    model_winners,
    period_change,
    period_counts,
    period_series,
    prepare_kmeans_features,
    random_sample,
    regression_metrics,
    scaled_columns,
    score_models,
    segment_composition,
    segment_profile,
    sparse_distributions,
    sparse_union,
    squeeze,
    stack_predictions,
    stage,
    strongest_correlation,
    sweep,
    target_median,
    to_code,
    to_number,
    top_band_comparison,
    top_group,
    with_residual,
    worst_segment,
    write_prepared,
)
from ..functions.derive import join_labels
from ..operators.predict import LR_CONFIGS, RF_CONFIGS, best_config, pipeline_for
from ..operators.quantiles import BAND_CUTS, select_ranks
from ..operators.relational import kept, settle
from ..operators.sample import hash_unit
from ..operators.segment import best_k
from ..sources.extracts import select_extracts
from .views import (
    CHARGES,
    ROMAN,
    charges,
    customer_orders,
    spark_sql,
    survey_audit,
    survey_prepared,
    survey_raw,
    survey_text,
    table,
    work_folder,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of additions does not show."""
    return df.select(
        *[
            F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema.fields
        ]
    )


# --- names, headers and staging ------------------------------------------------

_Y = "CAST(year(o_orderdate) + 25 AS {S})"
_Q = "CAST(quarter(o_orderdate) AS {S})"
_R = ROMAN.format(q="quarter(o_orderdate)")

#: A file name per order, in turn of every known style.
FILE_NAMES = f"""CASE o_orderkey % 12
    WHEN 0 THEN 'Base-de-datos-Personas-ENEIC-' || {_R} || '-' || {_Y} || '.xlsx'
    WHEN 1 THEN 'Personas_T' || {_Q} || '-' || {_Y} || '.csv'
    WHEN 2 THEN 'Personas ' || {_Y} || 'T' || {_Q} || '.csv'
    WHEN 3 THEN 'Personas-' || CASE quarter(o_orderdate) WHEN 1 THEN 'Primer' WHEN 2 THEN 'Segundo'
        WHEN 3 THEN 'Tercer' ELSE 'Cuarto' END || '-Trimestre-' || {_Y} || '.csv'
    WHEN 4 THEN 'Personas-' || CASE quarter(o_orderdate) WHEN 1 THEN '1er' WHEN 2 THEN '2do'
        WHEN 3 THEN '3er' ELSE '4to' END || '-trimestre-' || {_Y} || '.csv'
    WHEN 5 THEN 'Personas-Trimestre-' || {_Q} || '-' || {_Y} || '.csv'
    WHEN 6 THEN 'Personas-ENEIC-' || {_Y} || '.csv'
    WHEN 7 THEN 'Personas-ENEIC-' || {_R} || '.csv'
    WHEN 8 THEN 'Personas-ENEIC-' || {_R} || '-' || {_Y} || '-2099.csv'
    WHEN 9 THEN 'Personas-ENEIC-' || {_R} || '-' || {_Y} || '-T'
        || CAST(quarter(o_orderdate) % 4 + 1 AS {{S}}) || '.csv'
    WHEN 10 THEN 'datos/' || {_Y} || '/Personas Q' || {_Q} || ' ' || {_Y} || '.parquet'
    ELSE 'Trimestre ' || {_Q} || ' de ' || {_Y} || ', personás.CSV' END"""

#: A path per order, wanted or not.
EXTRACT_PATHS = f"""CASE o_orderkey % 8
    WHEN 0 THEN 'raw/Personas-' || {_R} || '-' || {_Y} || '.csv'
    WHEN 1 THEN 'raw/Hogares-ENEIC-' || {_R} || '-' || {_Y} || '.csv'
    WHEN 2 THEN 'raw/Hogares/Personas-' || {_R} || '-' || {_Y} || '.csv'
    WHEN 3 THEN 'raw/Diccionario-Personas-' || {_R} || '-' || {_Y} || '.csv'
    WHEN 4 THEN 'raw/Boleta-Personas-' || {_R} || '-' || {_Y} || '.csv'
    WHEN 5 THEN 'raw/Personas-' || {_R} || '-' || {_Y} || '.txt'
    WHEN 6 THEN 'raw/vivienda/Personas-' || {_R} || '-' || {_Y} || '.csv'
    ELSE 'raw/PERSÓNAS ' || {_Y} || 'T' || {_Q} || '.Parquet' END"""


@query
def period_from_name(spark: SparkSession, sf: str) -> DataFrame:
    named = table(spark, sf, "orders").select("o_orderkey", spark_sql(FILE_NAMES).alias("path"))
    period = detect_period(F.col("path"), LABOUR_SURVEY.naming)
    return named.select("o_orderkey", period.alias("p")).select("o_orderkey", "p.*")


@query
def extract_selection(spark: SparkSession, sf: str) -> DataFrame:
    listing = table(spark, sf, "orders").select("o_orderkey", spark_sql(EXTRACT_PATHS).alias("path"))
    return select_extracts(listing).drop("path")


@query
def period_metadata_check(spark: SparkSession, sf: str) -> DataFrame:
    """Supplied metadata: right, contradicting, incomplete or malformed in turn."""
    style = F.col("o_orderkey") % 7
    year, quarter = F.year("o_orderdate") + 25, F.quarter("o_orderdate")
    period = F.concat(year.cast("string"), F.lit("T"), quarter.cast("string"))
    named = F.concat(F.lit("Personas "), period, F.lit(".csv"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(style < 2, named).otherwise(F.lit("Personas.csv")).alias("path"),
        F.when(style == 4, F.lit("2025-1")).otherwise(period).alias("periodo"),
        F.when(style == 1, F.lit("1999"))
        .when(style == 6, F.lit("abc"))
        .when(style != 3, year.cast("string"))
        .alias("anio"),
        F.when(style == 5, F.lit("9")).otherwise(quarter.cast("string")).alias("trimestre"),
    )
    detected = detect_period(F.col("path"), LABOUR_SURVEY.naming)
    status = check_period(F.col("periodo"), F.col("anio"), F.col("trimestre"), detected)
    return rows.select("o_orderkey", status.alias("estado"))


@query
def extract_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the shipping quarters against quarters expected a year later."""
    style = "CASE WHEN l_linestatus = 'F' AND year(l_shipdate) = 1997 THEN 'b/Personas ' || {p} "
    style += "|| '.csv' ELSE 'a/' || {f} END"
    from .views import FILE_TEXT, PERIOD_TEXT

    path = style.format(p=PERIOD_TEXT, f=FILE_TEXT)
    files = table(spark, sf, "lineitem").select(spark_sql(path).alias("path")).distinct()
    expected = table(spark, sf, "orders").select(
        F.expr(
            "CAST(year(o_orderdate) + 26 AS STRING) || 'T' || CAST(quarter(o_orderdate) AS STRING)"
        ).alias("periodo")
    )
    return manifest(expected.distinct(), select_extracts(files))


HEADER_NAME = """' P' || CAST(l_linenumber AS {S}) || '   ' || l_returnflag
    || CASE WHEN l_tax > 0.05 THEN ' ' ELSE '' END"""
HEADER_FILE = "CAST(year(l_shipdate) AS {S}) || '-' || CAST(month(l_shipdate) AS {S})"
REQUIRED_HEADERS = ("P1 A", "P2 N", "P7 R", "P9 Z")


@query
def schema_audit(spark: SparkSession, sf: str) -> DataFrame:
    headers = table(spark, sf, "lineitem").select(
        F.expr("CAST(year(l_shipdate) AS STRING)").alias("periodo"),
        spark_sql(HEADER_FILE).alias("archivo"),
        spark_sql(HEADER_NAME).alias("columna"),
    )
    return header_audit(headers.distinct(), REQUIRED_HEADERS)


@query
def text_staging(spark: SparkSession, sf: str) -> DataFrame:
    return stage(table(spark, sf, "lineitem"))


@query
def standard_load(spark: SparkSession, sf: str) -> DataFrame:
    """Standard typed table; non-finite numbers shown as null for comparison."""
    raw = survey_raw(spark, sf)
    return raw.select(
        *[
            F.when(is_finite(F.col(f.name)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else f.name
            for f in raw.schema.fields
        ]
    )


@query
def harmonised_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three slices with different column orders stacked by name."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    lines = table(spark, sf, "lineitem").withColumn("l_shipdate", day)
    names = lines.columns
    slices = [
        lines.where(F.col("l_returnflag") == flag).select(*order)
        for flag, order in (("A", names), ("N", names[::-1]), ("R", sorted(names)))
    ]
    return harmonised_union(slices)


@query
def sparse_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of two dimensions stacked with absent columns null."""
    orders = table(spark, sf, "orders")
    return sparse_union(
        [
            orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")),
            orders.groupBy("o_orderpriority").agg(F.count("*").alias("n")),
        ]
    )


@query
def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{work_folder(spark)}/prepared"
    return period_counts(write_prepared(survey_prepared(spark, sf), path))


# --- coercion --------------------------------------------------------------------

CODE_TEXT = """CASE event_id % 10
    WHEN 0 THEN CAST(event_id % 7 AS {S})
    WHEN 1 THEN CAST(event_id % 7 AS {S}) || '.0'
    WHEN 2 THEN ' ' || CAST(event_id % 7 AS {S}) || '.00 '
    WHEN 3 THEN '00' || CAST(event_id % 7 AS {S})
    WHEN 4 THEN '+' || CAST(event_id % 7 AS {S})
    WHEN 5 THEN CAST(event_id % 7 AS {S}) || 'e2'
    WHEN 6 THEN '-0.0'
    WHEN 7 THEN CAST(event_id % 7 AS {S}) || '.5'
    WHEN 8 THEN 'nan'
    ELSE CASE WHEN event_id % 20 = 9 THEN NULL ELSE '  ' END END"""

NUMBER_TEXT = """CASE o_orderkey % 12
    WHEN 0 THEN NULL
    WHEN 1 THEN '  '
    WHEN 2 THEN 'NaN'
    WHEN 3 THEN CAST(o_orderkey AS {S}) || 'd'
    WHEN 4 THEN '-inf'
    WHEN 5 THEN '+Infinity'
    WHEN 6 THEN ' ' || CAST(o_orderkey AS {S}) || '. '
    WHEN 7 THEN '-.' || CAST(o_orderkey % 10 AS {S})
    WHEN 8 THEN CAST(o_orderkey AS {S}) || 'E2'
    WHEN 9 THEN '1,' || CAST(o_orderkey AS {S})
    WHEN 10 THEN '0x1p3'
    ELSE '+' || CAST(o_orderkey AS {S}) || '.5' END"""

EVENT_LABELS = {"view": "1 - visita", "click": "2 - clic", "purchase": "3 - compra"}


@query
def code_normalize(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "events").select("event_id", spark_sql(CODE_TEXT).alias("x"))
    x = F.col("x")
    return text.select(
        "event_id",
        to_code(x).alias("codigo"),
        to_code(x, canonical=True).alias("canonico"),
        to_code(x, valid=[1, "2", 3.0, "4"]).alias("cerrado"),
    )


@query
def numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "orders").select("o_orderkey", spark_sql(NUMBER_TEXT).alias("x"))
    numbers = text.select("o_orderkey", "x", to_number(F.col("x")).alias("v"))
    finite = is_finite(F.col("v"))
    state = (
        F.when(F.col("v").isNull(), F.lit("nulo"))
        .when(finite, F.lit("finito"))
        .when(F.isnan("v"), F.lit("nan"))
        .otherwise(F.lit("infinito"))
    )
    return numbers.select(
        "o_orderkey",
        F.when(finite, F.col("v")).alias("valor"),
        state.alias("estado"),
        is_missing(F.col("x")).alias("faltante"),
    )


@query
def label_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "event_type", label_of(F.col("event_type"), EVENT_LABELS).alias("etiqueta")
    )


#: Nations of region 0 get codes that no customer has.
NATION_CODE = "CASE WHEN n_regionkey = 0 THEN n_nationkey + 1000 ELSE n_nationkey END"


@query
def dictionary_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Labels from a dictionary table that lacks some codes."""
    nations = table(spark, sf, "nation").withColumn("code", F.expr(NATION_CODE))
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return join_labels(customers, nations, "c_nationkey", "code", "n_name", "pais")


@query
def text_fold(spark: SparkSession, sf: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", fold(text).alias("plegado"), squeeze(text).alias("compacto")
    )


# --- quality -----------------------------------------------------------------------


@query
def filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return survey_audit(spark, sf)


@query
def eligible_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows an audit lets through."""
    return survey_prepared(spark, sf).select(
        *LABOUR_SURVEY.keys, *LABOUR_SURVEY.profiled, *LABOUR_SURVEY.categorical, "conjunto"
    )


@query
def missing_typed(spark: SparkSession, sf: str) -> DataFrame:
    return missing_summary(survey_raw(spark, sf), by=["conjunto"])


@query
def missing_staged(spark: SparkSession, sf: str) -> DataFrame:
    text = survey_text(spark, sf)
    return missing_summary(text, LABOUR_SURVEY.source_columns, by=["conjunto"])


@query
def duplicate_key_audit(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_summary(survey_raw(spark, sf), by=["conjunto"])


@query
def duplicate_key_detail(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(survey_raw(spark, sf))


@query
def duplicate_copies(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with exact and changed copies of some of them."""
    orders = table(spark, sf, "orders")
    copies = orders.where("o_orderstatus = 'F'")
    changed = orders.where("o_orderstatus = 'P'").withColumn(
        "o_orderpriority", F.lit(None).cast("string")
    )
    stacked = harmonised_union([orders, copies, changed])
    return duplicate_summary(stacked, ["o_orderkey"])


@query
def raw_period_counts(spark: SparkSession, sf: str) -> DataFrame:
    groups = ["archivo_origen", "periodo_archivo"]
    return period_counts(survey_raw(spark, sf), groups, "filas_originales")


@query
def eligible_period_counts(spark: SparkSession, sf: str) -> DataFrame:
    return period_counts(survey_prepared(spark, sf))


@query
def row_set_differences(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("clave"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("clave"))
    return key_differences(orders, lines, ["clave"])


# --- profile -----------------------------------------------------------------------


@query
def descriptive_stats(spark: SparkSession, sf: str) -> DataFrame:
    prepared = survey_prepared(spark, sf)
    return rounded(descriptive_statistics(prepared, by=["conjunto"], exact=True))


@query
def descriptive_stats_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return descriptive_statistics(survey_prepared(spark, sf), by=["conjunto"])


@query
def median_by_groups(spark: SparkSession, sf: str) -> DataFrame:
    groups = ["c_mktsegment", "o_orderpriority"]
    return median_by_group(customer_orders(spark, sf), groups, "o_totalprice", exact=True)


@query
def median_by_group_sketch(spark: SparkSession, sf: str) -> DataFrame:
    return median_by_group(survey_prepared(spark, sf), "nivel_educativo").orderBy("nivel_educativo")


@query
def highest_median_group(spark: SparkSession, sf: str) -> DataFrame:
    medians = median_by_group(survey_prepared(spark, sf), "nivel_educativo", exact=True)
    return top_group(medians, "nivel_educativo", "mediana_salario")


@query
def period_median(spark: SparkSession, sf: str) -> DataFrame:
    return period_series(survey_prepared(spark, sf), exact=True)


@query
def period_first_to_last(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(period_change(period_series(survey_prepared(spark, sf), exact=True)))


_DISTRIBUTED = ("categoria_ocupacional_etiqueta", "nivel_educativo", "dominio")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    code = F.col("categoria_ocupacional")
    label = label_of(code, LABOUR_SURVEY.labels["categoria_ocupacional"])
    return survey_prepared(spark, sf).withColumn(_DISTRIBUTED[0], label)


@query
def categorical_distributions(spark: SparkSession, sf: str) -> DataFrame:
    return distributions(_labelled(spark, sf), _DISTRIBUTED, by=["conjunto"])


@query
def categorical_distributions_sparse(spark: SparkSession, sf: str) -> DataFrame:
    return sparse_distributions(distributions(_labelled(spark, sf), _DISTRIBUTED), _DISTRIBUTED)


@query
def document_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return categorical_distribution(table(spark, sf, "documents"), "source")


@query
def leading_categories(spark: SparkSession, sf: str) -> DataFrame:
    return leading_category(distributions(table(spark, sf, "documents"), ["lang", "source"]))


@query
def order_value_cuts(spark: SparkSession, sf: str) -> DataFrame:
    cuts = {"p25": 0.25, "p50": 0.50, "p75": 0.75, "p95": 0.95}
    return exact_quantiles(table(spark, sf, "orders"), "o_totalprice", cuts, ["o_orderstatus"])


@query
def value_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(histogram(table(spark, sf, "orders"), "o_totalprice"))


@query
def value_histogram_log(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(histogram(table(spark, sf, "orders"), "o_totalprice", bins=20, log=True), 2)


@query
def value_histogram_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(histogram(table(spark, sf, "orders"), "o_totalprice", by=["o_orderstatus"]))


# --- relations and segments ----------------------------------------------------------


@query
def correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(correlation_long(survey_prepared(spark, sf), by=["conjunto"]))


@query
def correlation_square(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(correlation_matrix(survey_prepared(spark, sf)))


@query
def strongest_association(spark: SparkSession, sf: str) -> DataFrame:
    long = correlation_long(survey_prepared(spark, sf), by=["conjunto"])
    return rounded(strongest_correlation(long, by=["conjunto"]))


_PROFILED = {"total": "o_totalprice", "saldo": "c_acctbal"}


@query
def segment_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(segment_profile(customer_orders(spark, sf), columns=_PROFILED, exact=True))


@query
def segment_compositions(spark: SparkSession, sf: str) -> DataFrame:
    return segment_composition(
        customer_orders(spark, sf), ["c_mktsegment", "o_orderpriority", "o_orderstatus"]
    )


@query
def largest_segment(spark: SparkSession, sf: str) -> DataFrame:
    counts = customer_orders(spark, sf).groupBy("cluster").agg(F.count("*").alias("n"))
    return top_group(counts, "cluster", "n")


@query
def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *names)
    return rounded(scaled_columns(rows, names))


@query
def silhouette_sweep(spark: SparkSession, sf: str) -> DataFrame:
    with kept(survey_prepared(spark, sf).select(*LABOUR_SURVEY.numeric)) as (rows,):
        features, _ = prepare_kmeans_features(rows)
        return kmeans_sweep(features)[0]


@query
def kmeans_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profile of the segments of the best k of the sweep."""
    columns = [*LABOUR_SURVEY.numeric, LABOUR_SURVEY.target]
    with kept(survey_prepared(spark, sf).select(*columns)) as (rows,):
        features, _ = prepare_kmeans_features(rows)
        scores, models = kmeans_sweep(features)
        return settle(segment_profile(models[best_k(scores)].transform(features)))


# --- samples and splits ------------------------------------------------------------


@query
def split_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey")
    train, validation = hash_split(orders, ["o_orderkey"])
    return harmonised_union(
        [
            train.withColumn("parte", F.lit("train")),
            validation.withColumn("parte", F.lit("validation")),
        ]
    )


@query
def sample_by_hash(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf, "orders").withColumn("o_orderdate", day)
    return deterministic_sample(orders, max_rows=500, key_columns=["o_orderkey"])


@query
def sample_at_random(spark: SparkSession, sf: str) -> DataFrame:
    return random_sample(table(spark, sf, "orders"), 500)


# --- model errors --------------------------------------------------------------------


def _parts(rows: DataFrame) -> DataFrame:
    """Dataset of a row: hash split of the earlier years, all later rows as test."""
    part = F.when(F.col("era") == "test", F.lit("test")).when(
        hash_unit(CHARGES.keys) < 0.8, F.lit("train")
    )
    return rows.withColumn("dataset", part.otherwise(F.lit("validation")))


def _models(median: float) -> dict[str, Column]:
    return {
        "Baseline": F.lit(median),
        "Precio": F.col("l_extendedprice"),
        "Descuento": F.expr("l_extendedprice * (1 - l_discount)"),
    }


def _predictions(
    spark: SparkSession,
    sf: str,
    keep: list[str],
    enrich: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    median: float | None = None,
) -> DataFrame:
    """Baseline and two closed-form models scored on validation and test rows.

    ``enrich`` may join columns to the rows before every model scores them; ``median``
    is that of the training rows where it is known already.
    """
    rows = _parts(charges(spark, sf))
    if median is None:
        median = target_median(rows.where("dataset = 'train'"), "charge", exact=True)
    scored = enrich(rows.where("dataset <> 'train'"))
    return stack_predictions(scored, _models(median), ["dataset", *keep, "charge"])


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    long = _predictions(spark, sf, [])
    return regression_metrics(long, "charge", by=["modelo", "dataset"])


@query
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_metrics(spark, sf)).orderBy("modelo", "dataset")


@query
def model_winner(spark: SparkSession, sf: str) -> DataFrame:
    return model_winners(_metrics(spark, sf))


@query
def validation_vs_test(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(dataset_deltas(_metrics(spark, sf), "validation", "test"))


@query
def metrics_are_finite(spark: SparkSession, sf: str) -> DataFrame:
    return metrics_finite(_metrics(spark, sf))


@query
def grouped_errors(spark: SparkSession, sf: str) -> DataFrame:
    long = _predictions(spark, sf, ["l_returnflag"]).where("dataset = 'test'")
    return rounded(grouped_error_metrics(long, "l_returnflag", label_col="charge", by=["modelo"]))


@query
def brand_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors per brand; lines whose part is unknown form the unknown group."""
    known = "CASE WHEN p_size > 10 THEN p_partkey ELSE -p_partkey END AS p_partkey"
    brands = table(spark, sf, "part").selectExpr(known, "p_brand")

    def branded(rows: DataFrame) -> DataFrame:
        return rows.join(brands, F.col("l_partkey") == F.col("p_partkey"), "left")

    long = _predictions(spark, sf, ["p_brand"], branded).where("dataset = 'test'")
    return rounded(grouped_error_metrics(long, "p_brand", label_col="charge", by=["modelo"]))


@query
def worst_segments(spark: SparkSession, sf: str) -> DataFrame:
    long = _predictions(spark, sf, ["l_returnflag"]).where("dataset = 'test'")
    errors = grouped_error_metrics(long, "l_returnflag", label_col="charge", by=["modelo"])
    return rounded(worst_segment(errors, "l_returnflag"))


def _bands(spark: SparkSession, sf: str) -> DataFrame:
    # the cuts of the test rows and the median of the training rows in one selection
    rows = _parts(charges(spark, sf)).where("dataset <> 'validation'").select("dataset", "charge")
    ranks = select_ranks(rows, "charge", BAND_CUTS, ["dataset"]).collect()  # one for each cut
    found = {(r["dataset"], r["probability"]): r["value"] for r in ranks}
    cuts = [found["test", p] for p in BAND_CUTS]
    long = _predictions(spark, sf, [], median=found["train", 0.5]).where("dataset = 'test'")
    return banded_error_metrics(long, cuts, label_col="charge", exact=True)


@query
def band_errors(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_bands(spark, sf))


@query
def top_band_vs_lower(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(top_band_comparison(_bands(spark, sf)))


@query
def residual_points(spark: SparkSession, sf: str) -> DataFrame:
    """One hash sample of orders with the residual of every model."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    points = deterministic_sample(orders, max_rows=1_000, key_columns=["o_orderkey"])
    models = {"Cien mil": F.lit(100000.0), "Mitad": F.expr("o_totalprice / 2")}
    long = stack_predictions(points, models, ["o_orderkey", "o_totalprice"])
    return with_residual(long, "o_totalprice")


# --- fitted models -------------------------------------------------------------------


@query
def ols_slopes(spark: SparkSession, sf: str) -> DataFrame:
    """Slopes and intercept of the charge on price and discount."""
    names = ["l_extendedprice", "l_discount"]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(charges(spark, sf))
    model = LinearRegression(labelCol="charge", solver="normal").fit(vectors)
    rows = [*zip(names, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return rounded(spark.createDataFrame(rows, "termino string, valor double"), 3)


def _train_and_validation(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = _parts(charges(spark, sf))
    return rows.where("dataset = 'train'"), rows.where("dataset = 'validation'")


def _swept(spark: SparkSession, sf: str, configs) -> DataFrame:
    metrics, _ = sweep(*_train_and_validation(spark, sf), configs, CHARGES)
    return metrics


@query
def linear_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _swept(spark, sf, LR_CONFIGS)


@query
def forest_sweep(spark: SparkSession, sf: str) -> DataFrame:
    return _swept(spark, sf, RF_CONFIGS)


@query
def forest_importances(spark: SparkSession, sf: str) -> DataFrame:
    """Importances of the best forest of the sweep."""
    train, validation = _train_and_validation(spark, sf)
    metrics, models = sweep(train, validation, RF_CONFIGS, CHARGES)
    model = models[best_config(metrics, RF_CONFIGS)["modelo"]]
    return feature_importance_table(model.stages[-1], model.transform(train))


@query
def forest_importances_by_column(spark: SparkSession, sf: str) -> DataFrame:
    return importance_by_column(forest_importances(spark, sf))


@query
def holdout_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The best of each sweep refitted on all earlier rows, scored on later ones."""
    rows = charges(spark, sf)
    best = {
        name: best_config(settle(_swept(spark, sf, configs)), configs)
        for name, configs in (("Linear Regression", LR_CONFIGS), ("Random Forest", RF_CONFIGS))
    }
    with kept(rows.where("era = 'train'")) as (train,):
        models = {name: pipeline_for(config, CHARGES).fit(train) for name, config in best.items()}
    long = score_models(rows.where("era = 'test'"), models, ["charge"])
    return regression_metrics(long, "charge", by=["modelo"]).orderBy("RMSE")
