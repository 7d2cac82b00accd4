"""Segments, fitted models, errors and the laws between result tables."""

import math
import random

from dataclasses import replace

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from cohortspark import (
    LABOUR_SURVEY,
    banded_error_metrics,
    best_by,
    best_config,
    best_k,
    dataset_deltas,
    evaluate_regression,
    feature_importance_table,
    grouped_error_metrics,
    importance_by_column,
    kmeans_sweep,
    load_model,
    model_pipeline,
    model_winners,
    prepare_kmeans_features,
    quantile_cuts,
    regression_metrics,
    save_model,
    scaled_columns,
    score_models,
    segment_composition,
    segment_profile,
    stack_predictions,
    strongest_correlation,
    sweep,
    target_median,
    top_band_comparison,
    with_baseline,
    with_residual,
    worst_segment,
)
from cohortspark.operators.predict import LR_CONFIGS


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        group = i % 2
        age = rng.gauss(25 if group else 55, 3)
        tenure = rng.gauss(2 if group else 20, 1)
        hours = rng.uniform(20, 60)
        education, domain = str(i % 4), str(i % 3 + 1)
        pay = 50 * age + 400 * int(education) + rng.gauss(0, 50)
        rows.append((str(i), age, tenure, hours, education, str(i % 4 + 1), domain, pay))
    schema = (
        "NUM_HOGAR string, edad double, antiguedad double, horas_semanales double, nivel_educativo string, "
        "categoria_ocupacional string, dominio string, salario_mensual double"
    )
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def test_segments(people):
    features, fitted = prepare_kmeans_features(people)
    assert fitted.stages[0].getInputCols() == list(LABOUR_SURVEY.numeric)
    scores, models = kmeans_sweep(features)
    table = {r["k"]: r["silhouette"] for r in scores.collect()}
    assert list(table) == [2, 3, 4, 5] and best_k(scores) == max(table, key=table.get)
    assert table[2] > 0.3
    segmented = models[2].transform(features)
    profile = segment_profile(segmented).collect()
    total = sum(r["n"] for r in profile)
    overall = people.agg(F.avg("edad")).first()[0]
    assert sum(r["n"] * r["edad_media"] for r in profile) / total == pytest.approx(overall)
    assert sum(r["porcentaje"] for r in profile) == pytest.approx(100)
    exact = segment_profile(segmented, exact=True).collect()
    assert [r["salario_mediana"] for r in exact] == [r["salario_mediana"] for r in profile]
    parts = segment_composition(segmented, ["dominio", "nivel_educativo"]).collect()
    for r in parts:
        assert r["porcentaje_cluster"] == 100.0 * r["n"] / r["n_cluster"]
    assert sum(r["n"] for r in parts if r["variable"] == "dominio") == total


def test_cluster_inputs_are_guarded(spark, people):
    with pytest.raises(ValueError):
        prepare_kmeans_features(people, replace(LABOUR_SURVEY, numeric=("edad", "salario_mensual")))
    few, _ = prepare_kmeans_features(people.limit(4))
    with pytest.raises(ValueError, match="at least 6"):
        kmeans_sweep(few)
    z = scaled_columns(people.select("edad"), ["edad"]).agg(F.avg("edad_z"), F.stddev("edad_z")).first()
    assert z[0] == pytest.approx(0, abs=1e-9) and z[1] == pytest.approx(1)


def test_sweep_importances_and_model_files(spark, people, tmp_path):
    train, validation = people.where("NUM_HOGAR % 5 <> 0"), people.where("NUM_HOGAR % 5 = 0")
    metrics, models = sweep(train, validation, LR_CONFIGS)
    rows = metrics.collect()
    assert [r["RMSE"] for r in rows] == sorted(r["RMSE"] for r in rows) and rows[0]["R2"] > 0.9
    assert metrics.columns == ["modelo", "regParam", "elasticNetParam", "MAE", "RMSE", "R2"]
    assert best_config(metrics, LR_CONFIGS)["modelo"] == rows[0]["modelo"]
    for r in rows:
        alone = evaluate_regression(models[r["modelo"]].transform(validation))
        assert alone["RMSE"] == pytest.approx(r["RMSE"])

    forest = model_pipeline("forest", {"numTrees": 5, "maxDepth": 4}).fit(train)
    table = feature_importance_table(forest.stages[-1], forest.transform(train))
    values = table.collect()
    assert sum(r["importancia"] for r in values) == pytest.approx(1)
    assert len(values) == 3 + 5 + 5 + 4  # every variable has one slot for unknown labels
    assert {r["feature"] for r in values} >= {"edad", "dominio__ohe_1", "dominio__ohe___unknown"}
    rolled = {r["columna"]: r["importancia"] for r in importance_by_column(table).collect()}
    assert set(rolled) == set(LABOUR_SURVEY.numeric + LABOUR_SURVEY.categorical)

    save_model(forest, str(tmp_path / "m"))
    save_model(forest, str(tmp_path / "m"))
    both = {"a": forest, "b": load_model(str(tmp_path / "m"))}
    long = score_models(validation, both, ["NUM_HOGAR", "salario_mensual"])
    wide = long.groupBy("NUM_HOGAR").pivot("modelo", ["a", "b"]).agg(F.first("prediction"))
    assert wide.where("a <> b").count() == 0 and wide.count() == validation.count()

    unseen = validation.withColumn("dominio", F.lit(None).cast("string"))
    assert forest.transform(unseen).count() == validation.count()


def test_target_is_no_predictor():
    with pytest.raises(ValueError):
        model_pipeline("linear", {}, replace(LABOUR_SURVEY, numeric=("salario_mensual",)))


@pytest.fixture(scope="module")
def long(people):
    models = {"low": F.lit(2000.0), "age": F.col("edad") * 60}
    keep = ["nivel_educativo", "salario_mensual"]
    return stack_predictions(people, models, keep).cache()


def test_metrics_equal_the_evaluator(long):
    rows = {r["modelo"]: r for r in regression_metrics(long, by=["modelo"]).collect()}
    for model, row in rows.items():
        for name in ("mae", "rmse", "r2"):
            evaluator = RegressionEvaluator(labelCol="salario_mensual", metricName=name)
            wanted = evaluator.evaluate(long.where(F.col("modelo") == model))
            assert row[name.upper()] == pytest.approx(wanted)
    constant = long.withColumn("salario_mensual", F.lit(5.0))
    assert regression_metrics(constant).first()["R2"] is None


def test_error_tables_agree(long):
    overall = {r["modelo"]: r for r in regression_metrics(long, by=["modelo"]).collect()}
    cuts = quantile_cuts(long, "salario_mensual", exact=True)
    bands = banded_error_metrics(long, cuts)
    groups = grouped_error_metrics(long, "nivel_educativo", by=["modelo"])
    for model, whole in overall.items():
        b = bands.where(F.col("modelo") == model).collect()
        g = groups.where(F.col("modelo") == model).collect()
        for table in (b, g):
            n = sum(r["n"] for r in table)
            assert sum(r["n"] * r["MAE"] for r in table) / n == pytest.approx(whole["MAE"])
        assert math.sqrt(sum(r["n"] * r["RMSE"] ** 2 for r in b) / 600) == pytest.approx(whole["RMSE"])
        for r in b:
            assert r["error_medio"] == pytest.approx(r["salario_medio"] - r["prediccion_media"])
        assert [r["banda_salario"] for r in b] == ["p0-p25", "p25-p50", "p50-p75", "p75-p95", "p95+"]
        worst = worst_segment(groups, "nivel_educativo").where(F.col("modelo") == model).first()
        assert worst["MAE"] == max(r["MAE"] for r in g)
    exact = banded_error_metrics(long, cuts, exact=True).collect()
    assert [r["n"] for r in exact] == [r["n"] for r in bands.collect()]


def test_groups_keep_null_and_blank(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0), (" ", 1.0, 1.0), ("a ", 3.0, 1.0)], "g string, y double, prediction double")
    got = grouped_error_metrics(df, "g", label_col="y").collect()
    assert [tuple(r) for r in got] == [("", 1, 0.0, 0.0), ("DESCONOCIDO", 1, 1.0, -1.0), ("a", 1, 2.0, 2.0)]
    ready = with_residual(df, "y").withColumn("residuo", F.lit(9.0))
    assert grouped_error_metrics(ready, "g", label_col="y").first()["MAE"] == 9.0


def test_baseline(people):
    for exact in (False, True):
        median = target_median(people, exact=exact)
        assert with_baseline(people, median).select("prediction").distinct().collect() == [(median,)]


# Published metrics, to replay the tables derived from them.
PUBLISHED = [
    ("Baseline", "validation", 1690.0977314061454, 2996.4816885972446, -0.023993569195895237),
    ("Baseline", "test", 1718.6783074370192, 2923.0828473640513, -0.03892430782659284),
    ("Linear Regression", "validation", 1245.3199722152729, 2294.2842894257733, 0.3996998726540013),
    ("Linear Regression", "test", 1240.7105465716627, 2163.751702974567, 0.4307323509027091),
    ("Random Forest", "validation", 1134.7010471015064, 2176.6190420735734, 0.45969520520643015),
    ("Random Forest", "test", 1130.406866321447, 2016.764215242486, 0.5054480573601431),
]
BANDS = [
    ("Random Forest", "p0-p25", 4032, 908.9708365856455, -835.3792589265112),
    ("Random Forest", "p25-p50", 2715, 688.4525382194391, -201.8510660117502),
    ("Random Forest", "p50-p75", 3188, 704.8954659018252, -29.54185391117911),
    ("Random Forest", "p75-p95", 2680, 1394.172020013216, 775.1251283813745),
    ("Random Forest", "p95+", 643, 5395.377014588168, 5186.301802413602),
]


def test_published_tables(spark):
    metrics = spark.createDataFrame(PUBLISHED, "modelo string, dataset string, MAE double, RMSE double, R2 double")
    deltas = {r["modelo"]: r for r in dataset_deltas(metrics, "validation", "test").collect()}
    assert deltas["Baseline"]["delta_RMSE"] == pytest.approx(-73.39884123319325)
    assert deltas["Random Forest"]["delta_R2"] == pytest.approx(0.04575285215371294)
    assert {r["direccion"] for r in deltas.values()} == {"disminuyó"}
    assert {r["mejor_RMSE"] for r in model_winners(metrics).collect()} == {"Random Forest"}
    assert best_by(metrics, "RMSE", by=["dataset"]).count() == 2

    bands = spark.createDataFrame(BANDS, "modelo string, banda_salario string, n long, MAE double, error_medio double")
    top = top_band_comparison(bands).first()
    assert top["n_p95_mas"] == 643 and top["direccion_error_p95_mas"] == "subestimación"
    assert top["MAE_promedio_bandas_inferiores"] == pytest.approx(924.1227151800315)
    assert top["delta_MAE_p95_mas_menos_inferiores"] == pytest.approx(4471.254299408137)

    scores = spark.createDataFrame([(2, 0.5545), (3, 0.4129), (4, 0.4799), (5, 0.4838)], "k int, silhouette double")
    assert best_k(scores) == 2
    tied = spark.createDataFrame([(3, 0.5), (2, 0.5)], "k int, silhouette double")
    assert best_k(tied) == 2
    r = spark.createDataFrame(
        [("salario_mensual", "edad", 0.1472), ("salario_mensual", "antiguedad", 0.1796), ("salario_mensual", "salario_mensual", 1.0)],
        "variable_x string, variable_y string, r double",
    )
    assert strongest_correlation(r).first()["variable"] == "antiguedad"
