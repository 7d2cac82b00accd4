"""Data quality audits, one aggregate job each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.coerce import is_finite, missing_of, number_of, to_code
from ..functions.derive import years_and_months
from ..presets import LABOUR_SURVEY
from ..spec import Cascade, require_columns
from .relational import percent

FIRST_FAIL = _FIRST_FAIL = "__first_fail"


def missing_summary(
    df: DataFrame,
    columns: Sequence[str] = LABOUR_SURVEY.audited,
    by: Sequence[str] = (),
) -> DataFrame:
    """Missing values per column (null, NaN, blank), most affected first.

    One scan: a flag per column, summed map-side, and only the summed row is
    turned into one row per column. ``by`` keeps a tag such as the dataset.
    """
    names = list(columns)
    if not names:
        raise ValueError("at least one column is needed")
    require_columns(df, [*by, *names], "missing_summary")
    flags = df.select(
        *by, *[missing_of(df, c).cast("int").alias(f"__m{i}") for i, c in enumerate(names)]
    )
    sums = flags.groupBy(*by).agg(
        F.count("*").alias("registros_totales"),
        *[F.sum(f"__m{i}").alias(f"__m{i}") for i in range(len(names))],
    )
    return missing_rows(sums, names, by)


def missing_rows(sums: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Summary rows from ``registros_totales`` and the sums ``__m0``, ``__m1``, ... of each group."""
    rows = [
        F.struct(
            F.lit(name).alias("variable"),
            F.col("registros_totales"),
            F.coalesce(f"__m{i}", F.lit(0)).cast("long").alias("faltantes"),
            percent(F.col(f"__m{i}"), F.col("registros_totales")).alias("porcentaje_faltante"),
        )
        for i, name in enumerate(names)
    ]
    return sums.select(*by, F.inline(F.array(*rows))).orderBy(
        *by, F.desc("faltantes"), F.asc("variable")
    )


def flag_first_failure(
    df: DataFrame, cascade: Cascade, columns: Mapping[str, str] | None = None
) -> DataFrame:
    """Adds the number of the first step a row fails, null for kept rows.

    Inputs are coerced once, in a projection of their own, before the steps. A
    duration that ``df`` does not carry is derived and kept, as in the cascade.
    """
    cascade = cascade.with_columns(columns)
    derived = cascade.duration[0] if cascade.duration else None
    derived_column = cascade.inputs[derived][0] if derived else None
    needed = [c for name, (c, _) in cascade.inputs.items() if name != derived]
    require_columns(df, needed, "apply_filters_with_audit")
    if derived_column and derived_column not in df.columns:
        years, months = (cascade.inputs[n][0] for n in cascade.duration[1:])
        df = df.withColumn(
            derived_column, years_and_months(number_of(df, years), number_of(df, months))
        )

    inputs = {
        name: number_of(df, column) if kind == "numeric" else to_code(F.col(column))
        for name, (column, kind) in cascade.inputs.items()
    }
    # A generator of one row keeps the coerced values apart from the conditions: a
    # plain projection would be merged into them and parse a text once per use.
    row = F.struct(*[c.alias(f"__in_{n}") for n, c in inputs.items()])
    coerced = df.select("*", F.inline(F.array(row)))
    values = {name: F.col(f"__in_{name}") for name in inputs}
    failure: Column | None = None
    for step in cascade.steps:
        fails = ~F.coalesce(step.condition(values), F.lit(False))
        number = F.lit(step.step)
        failure = F.when(fails, number) if failure is None else failure.when(fails, number)
    return coerced.select(*df.columns, failure.alias(_FIRST_FAIL))


def audit_failures(flagged: DataFrame, cascade: Cascade, by: Sequence[str] = ()) -> DataFrame:
    """Audit table from flagged rows: one row per step and group."""
    counts = flagged.groupBy(*by).agg(
        F.count("*").alias("__total"),
        *[
            F.count(F.when(F.col(_FIRST_FAIL) == s.step, F.lit(1))).alias(f"__s{s.step}")
            for s in cascade.steps
        ],
    )
    return audit_rows(counts, cascade, by)


def audit_rows(counts: DataFrame, cascade: Cascade, by: Sequence[str] = ()) -> DataFrame:
    """Audit rows from ``__total`` and the exclusions ``__s1``, ``__s2``, ... of each group."""
    start, zero = F.col("__total"), F.lit(0).cast("long")
    labels = [(0, cascade.start, zero)]
    labels += [(s.step, s.label, F.col(f"__s{s.step}")) for s in cascade.steps]
    rows = []
    for number, label, excluded in labels:
        left = start - excluded
        rows.append(
            F.struct(
                F.lit(number).alias("paso"),
                F.lit(label).alias("descripcion"),
                start.alias("registros_antes"),
                excluded.alias("registros_excluidos"),
                left.alias("registros_despues"),
                percent(excluded, start).alias("porcentaje_excluido"),
            )
        )
        start = left
    return counts.select(*by, F.inline(F.array(*rows))).orderBy(*by, "paso")


def apply_filters_with_audit(
    df: DataFrame,
    columns: Mapping[str, str] | None = None,
    *,
    cascade: Cascade = LABOUR_SURVEY.cascade,
    by: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """``(kept rows, audit)`` of a population filter; both are lazy.

    The audit needs no run per step: a row is excluded by the first step it
    fails, so one grouped count of that step gives every before and after.
    """
    flagged = flag_first_failure(df, cascade, columns)
    kept = flagged.where(F.col(_FIRST_FAIL).isNull()).drop(_FIRST_FAIL)
    return kept, audit_failures(flagged, cascade, by)


filter_with_audit = apply_filters_with_audit


def _row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """128-bit digest of the compared columns: two hashes with different seeds.

    Hashing skips nulls, so each column also contributes whether it is null;
    -0.0 is hashed as 0.0, which it equals.
    """
    parts = []
    for name in columns:
        column = F.col(f"`{name}`")
        if df.schema[name].dataType.typeName() in ("double", "float"):
            column = column + F.lit(0.0)
        parts += [column, column.isNull()]
    return F.struct(
        F.xxhash64(F.lit(0), *parts).alias("a"), F.xxhash64(F.lit(1), *parts).alias("b")
    )


def duplicate_keys(
    df: DataFrame, keys: Sequence[str] = LABOUR_SURVEY.keys, by: Sequence[str] = ()
) -> DataFrame:
    """Repeated keys with row count, distinct versions and type.

    ``exacto`` when all rows of the key agree, else ``conflictivo``; null keys
    are keys like any other. Only the key and a digest of the other columns are
    shuffled, and copies are combined before the shuffle, so one key holding a
    large part of the table is spread over its versions.
    """
    groups = [*by, *[k for k in keys if k not in by]]
    require_columns(df, groups, "duplicate_keys")
    compared = [c for c in df.columns if c not in groups]
    digest = _row_digest(df, compared)
    versions = (
        df.select(*groups, digest.alias("__version"))
        .groupBy(*groups, "__version")
        .agg(F.count("*").alias("__rows"))
    )
    kind = F.when(F.col("versiones_distintas") == 1, F.lit("exacto"))
    return (
        versions.groupBy(*groups)
        .agg(
            F.sum("__rows").alias("n_registros"),
            F.count("*").alias("versiones_distintas"),
        )
        .where(F.col("n_registros") > 1)
        .withColumn("tipo", kind.otherwise(F.lit("conflictivo")))
    )


def duplicate_summary(
    df: DataFrame, keys: Sequence[str] = LABOUR_SURVEY.keys, by: Sequence[str] = ()
) -> DataFrame:
    """Repeated keys and their rows per type; nothing is dropped."""
    return (
        duplicate_keys(df, keys, by)
        .groupBy(*by, "tipo")
        .agg(
            F.count("*").alias("claves_duplicadas"),
            F.sum("n_registros").alias("registros_en_claves_duplicadas"),
        )
        .orderBy(*by, "tipo")
    )


def period_counts(
    df: DataFrame, by: Sequence[str] = (LABOUR_SURVEY.period,), alias: str = "filas_elegibles"
) -> DataFrame:
    """Rows per period, or per any other group."""
    return df.groupBy(*by).agg(F.count("*").alias(alias)).orderBy(*by)


def require_rows(**frames: DataFrame) -> None:
    """Fail when one of the named frames is empty; reads at most one row each."""
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"no rows left in {', '.join(empty)}")


def key_differences(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that do not occur equally often on both sides, with both counts.

    One shuffle of partial counts replaces an anti-join in each direction.
    """
    sides = left.select(*keys, F.lit(1).alias("__l"), F.lit(0).alias("__r")).unionByName(
        right.select(*keys, F.lit(0).alias("__l"), F.lit(1).alias("__r"))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.sum("__l").alias("n_izquierda"), F.sum("__r").alias("n_derecha"))
        .where(F.col("n_izquierda") != F.col("n_derecha"))
    )


def require_same_rows(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> None:
    """Fail when two frames do not hold the same keys equally often."""
    if not key_differences(left, right, keys).isEmpty():
        raise AssertionError("the frames do not hold the same rows")


def metrics_finite(
    metrics: DataFrame, columns: Sequence[str] = ("MAE", "RMSE", "R2")
) -> DataFrame:
    """One row: number of metric rows and whether every cell is finite.

    An empty table fails.
    """
    require_columns(metrics, columns, "metrics_finite")
    good = F.lit(True)
    for name in columns:
        good = good & is_finite(F.col(f"__{name}"))
    numbers = metrics.select(*[number_of(metrics, c).alias(f"__{c}") for c in columns])
    return numbers.agg(
        F.count("*").alias("filas"),
        F.coalesce(F.bool_and(good), F.lit(False)).alias("finitas"),
    )
