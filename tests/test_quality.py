"""Audits against step-by-step brute force, with a hot key."""

import pytest
from pyspark.sql import functions as F

from cohortspark import (
    LABOUR_SURVEY,
    apply_filters_with_audit,
    duplicate_keys,
    duplicate_summary,
    key_differences,
    metrics_finite,
    missing_summary,
    require_rows,
    require_same_rows,
)
from cohortspark.functions.coerce import to_code, to_number

FIELDS = (
    "edad", "ocupado", "categoria_ocupacional", "salario_mensual",
    "antiguedad_anios", "antiguedad_meses", "horas_semanales",
)
GOOD = ("30", "1", "2", "3000", "2", "6", "40")
SCHEMA = ", ".join(f"{f} string" for f in FIELDS)


def changed(**values):
    return tuple(values.get(f, g) for f, g in zip(FIELDS, GOOD))


CASES = [
    (None, GOOD),
    (1, changed(edad=None)),
    (1, changed(edad="inf")),
    (2, changed(edad="14.9")),
    (3, changed(ocupado="2")),
    (None, changed(ocupado="1.0")),
    (4, changed(categoria_ocupacional="DESCONOCIDO")),
    (5, changed(salario_mensual="abc")),
    (6, changed(salario_mensual="inf")),
    (6, changed(salario_mensual="nan")),
    (6, changed(salario_mensual="0")),
    (6, changed(salario_mensual="-1")),
    (7, changed(antiguedad_anios="nan")),
    (8, changed(antiguedad_meses="11.5")),
    (8, changed(antiguedad_meses="12")),
    (8, changed(antiguedad_meses="-1")),
    (9, changed(antiguedad_anios="-5")),
    (10, changed(antiguedad_anios="30", edad="25")),
    (11, changed(horas_semanales="0")),
    (12, changed(horas_semanales="168.5")),
    (None, changed(horas_semanales="168")),
]


def test_cascade(spark):
    df = spark.createDataFrame([row for _, row in CASES], SCHEMA)
    kept, audit = apply_filters_with_audit(df)
    rows = audit.collect()
    excluded = {r["paso"]: r["registros_excluidos"] for r in rows}
    for step in range(1, 13):
        assert excluded[step] == sum(s == step for s, _ in CASES), step
    assert kept.count() == sum(s is None for s, _ in CASES) == rows[-1]["registros_despues"]
    assert rows[0]["descripcion"] == "Registros originales" and len(rows) == 13
    assert kept.columns == [*FIELDS, "antiguedad"]


def test_cascade_equals_one_filter_per_step(spark):
    df = spark.createDataFrame([row for _, row in CASES] * 3, SCHEMA)
    _, audit = apply_filters_with_audit(df)
    df = df.withColumn("antiguedad", to_number(F.col("antiguedad_anios")) + to_number(F.col("antiguedad_meses")) / 12)
    values = {
        n: to_number(F.col(c)) if kind == "numeric" else to_code(F.col(c))
        for n, (c, kind) in LABOUR_SURVEY.cascade.inputs.items()
    }
    before = df.count()
    for row, step in zip(audit.collect()[1:], LABOUR_SURVEY.cascade.steps):
        df = df.where(step.condition(values))
        after = df.count()
        assert tuple(row)[2:5] == (before, before - after, after)
        assert row["porcentaje_excluido"] == (100.0 * (before - after) / before if before else None)
        before = after


def test_empty_audit(spark):
    _, audit = apply_filters_with_audit(spark.createDataFrame([], SCHEMA))
    assert [r["porcentaje_excluido"] for r in audit.collect()] == [None] * 13


def test_audit_uses_one_scan(spark):
    df = spark.createDataFrame([GOOD] * 4, SCHEMA).withColumn("d", F.lit("a")).repartition(2)
    _, audit = apply_filters_with_audit(df, by=["d"])
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_renamed_columns(spark):
    names = {f: f"x_{f}" for f in FIELDS}
    df = spark.createDataFrame([GOOD], SCHEMA).withColumnsRenamed(names)
    kept, _ = apply_filters_with_audit(df, names)
    assert kept.count() == 1
    with pytest.raises(ValueError, match="missing columns edad"):
        apply_filters_with_audit(df)


def test_missing(spark):
    rows = [("a", None, 1.0), ("a", " ", float("nan")), ("a", "NaN", None), ("b", "0", 2.0)]
    df = spark.createDataFrame(rows, "d string, s string, x double")
    got = [tuple(r) for r in missing_summary(df, ["s", "x"], by=["d"]).collect()]
    assert got == [
        ("a", "s", 3, 3, 100.0), ("a", "x", 3, 2, 200.0 / 3), ("b", "s", 1, 0, 0.0), ("b", "x", 1, 0, 0.0)
    ]
    empty = missing_summary(df.where("false"), ["s"]).first()
    assert tuple(empty) == ("s", 0, 0, None)
    with pytest.raises(ValueError):
        missing_summary(df, [])


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_duplicates(spark, partitions):
    rows = [
        (1, "a", 1.0), (1, "a", 1.0),
        (2, "a", None), (2, "a", 2.0),
        (3, "a", 1.0),
        (None, "b", 1.0), (None, "b", 1.0),
        (4, None, 0.0), (4, None, -0.0),
        (5, "x", None), (5, None, 1.0),
    ]
    hot = [(9, "h", float(i % 2)) for i in range(200)]  # most rows share one key
    df = spark.createDataFrame(rows + hot, "k int, s string, x double").repartition(partitions)
    got = {r["k"]: (r["n_registros"], r["versiones_distintas"], r["tipo"]) for r in duplicate_keys(df, ["k"]).collect()}
    assert got == {
        1: (2, 1, "exacto"), 2: (2, 2, "conflictivo"), None: (2, 1, "exacto"),
        4: (2, 1, "exacto"), 5: (2, 2, "conflictivo"), 9: (200, 2, "conflictivo"),
    }
    assert [tuple(r) for r in duplicate_summary(df, ["k"]).collect()] == [
        ("conflictivo", 3, 204), ("exacto", 3, 6)
    ]
    assert duplicate_summary(df.where("k = 3"), ["k"]).count() == 0


def test_row_sets(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    got = {r["k"]: (r["n_izquierda"], r["n_derecha"]) for r in key_differences(a, b, ["k"]).collect()}
    assert got == {1: (2, 1), 3: (0, 1)}
    require_same_rows(a, a, ["k"])
    with pytest.raises(AssertionError):
        require_same_rows(a, b, ["k"])
    with pytest.raises(ValueError, match="empty_one"):
        require_rows(full=a, empty_one=a.where("k > 5"))


def test_finite_metrics(spark):
    schema = "MAE string, RMSE string, R2 double"
    good = [("1", "2.5", -0.1)]
    assert tuple(metrics_finite(spark.createDataFrame(good, schema)).first()) == (1, True)
    for bad in (("x", "1", 1.0), ("1", "inf", 1.0), ("1", "1", None), ("1", "1", float("nan"))):
        assert not metrics_finite(spark.createDataFrame([*good, bad], schema)).first()["finitas"]
    assert tuple(metrics_finite(spark.createDataFrame([], schema)).first()) == (0, False)
