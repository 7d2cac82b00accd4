"""Mergeable states, silhouettes from moments, error cubes and samples of files."""

import math
import random

import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cohortspark import evaluate_regression, grouped_error_metrics
from cohortspark.operators.evaluate import cube_laws, error_cube
from cohortspark.operators.sample import random_rows_of_files
from cohortspark.operators.segment import silhouettes
from cohortspark.operators.sketches import described_states, merge_states, rank_check, rank_error, value_states


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(4)
    rows = [(f"p{i % 5}", float(i) if i % 3 else 1e6 + rng.gauss(0, 1), str(i % 7)) for i in range(4000)]
    rows += [("p0", math.nan, "x"), ("p1", math.inf, None), ("p9", None, None), ("p8", 7.0, "1")]
    return spark.createDataFrame(rows, "p string, x double, y string").repartition(6)


def table(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_merged_states_describe_all_rows(values):
    states = value_states(values, ["x", "y"], ["p"])
    assert {r["p"] for r in states.collect()} == {"p0", "p1", "p2", "p3", "p4", "p8"}
    whole = table(described_states(merge_states(states)), "variable")
    once = table(described_states(value_states(values, ["x", "y"], []), []), "variable")
    finite = values.where("x < double('Infinity')").agg(F.count("x"), F.avg("x"), F.stddev_samp("x")).first()
    got = whole[("x",)]
    assert (got["n"], got["media"], got["stddev"]) == (finite[0], pytest.approx(finite[1]), pytest.approx(finite[2], rel=1e-9))
    for name in ("n", "media", "stddev", "min", "max"):
        assert whole[("y",)][name] == pytest.approx(once[("y",)][name])
    one = table(described_states(states, ["p"]), "p", "variable")[("p8", "x")]
    assert (one["n"], one["stddev"], one["mediana"], one["p95"]) == (1, None, 7.0, 7.0)


def test_ranks_are_within_the_error_and_the_check_notices_others(values):
    states = value_states(values, ["x"], ["p"])
    answers = described_states(merge_states(states))
    good = rank_check(values, answers, ["x"], [], rank_error())
    assert [r["dentro"] for r in good.collect()] == [True] * 4 and good.first()["n"] == 4001
    moved = answers.withColumn("p25", F.col("p25") + 2000)
    assert [r["corte"] for r in rank_check(values, moved, ["x"], [], rank_error()).where("NOT dentro").collect()] == ["p25"]


def test_states_of_nothing(spark):
    empty = spark.createDataFrame([], "p string, x double")
    assert described_states(merge_states(value_states(empty, ["x"], ["p"]), ["p"]), ["p"]).collect() == []


def test_silhouettes_are_those_of_the_evaluator(spark):
    rng = random.Random(1)
    rows = [(Vectors.dense([rng.gauss(4 * (i % 3), 1), rng.gauss(0, 1), rng.gauss(i % 2, 0.3)]),) for i in range(300)]
    rows += [(Vectors.dense([50.0, 50.0, 50.0]),)] + [(Vectors.dense([0.0, 0.0, 0.0]),)] * 4
    df = spark.createDataFrame(rows, ["features"]).repartition(3).cache()
    models = {k: KMeans(k=k, seed=2, predictionCol="cluster").fit(df) for k in (2, 3, 4, 7)}
    evaluator = ClusteringEvaluator(predictionCol="cluster")
    got = table(silhouettes(df, models), "k")
    for k, model in models.items():
        assert got[(k,)]["silhouette"] == pytest.approx(evaluator.evaluate(model.transform(df)), abs=1e-9)
        assert (got[(k,)]["n"], got[(k,)]["segmentos"]) == (305, k)
    df.unpersist()


def test_error_cube(spark):
    rng = random.Random(8)
    rows = [(m, rng.choice(["a", "b", None, " a "]), i % 4, 10.0 * i, 10.0 * i + rng.gauss(0, 3)) for i in range(200) for m in ("A", "B")]
    long = spark.createDataFrame(rows, "modelo string, g string, h int, y double, prediction double")
    cube = error_cube(long, {"g": "g", "mitad": F.when(F.col("h") < 2, "baja").otherwise("alta")}, label_col="y")
    got = table(cube, "modelo", "dimension", "grupo")
    assert len(got) == 2 * (1 + 3 + 2)
    for model in "AB":
        one = evaluate_regression(long.where(F.col("modelo") == model), "y")
        assert got[(model, None, None)]["MAE"] == pytest.approx(one["MAE"]) and got[(model, None, None)]["RMSE"] == pytest.approx(one["RMSE"])
    for r in grouped_error_metrics(long, "g", label_col="y", by=["modelo"]).collect():
        cell = got[(r["modelo"], "g", r["g"])]
        assert (cell["n"], cell["MAE"], cell["error_medio"]) == (r["n"], pytest.approx(r["MAE"]), pytest.approx(r["error_medio"]))
    assert [(r["n"], r["cumple"]) for r in cube_laws(cube).collect()] == [(200, True)] * 4
    broken = cube.withColumn("MAE", F.when(F.col("grupo") == "baja", F.col("MAE") + 1).otherwise(F.col("MAE")))
    assert {(r["dimension"], r["cumple"]) for r in cube_laws(broken).collect()} == {("g", True), ("mitad", False)}


def test_rows_of_files_are_drawn_alike(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") % 10).alias("v"))
    rows.coalesce(1).sortWithinPartitions("v").write.parquet(str(tmp_path / "t"))
    drawn = []
    for size in ("128MB", "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        drawn.append(sorted(r["v"] for r in random_rows_of_files(spark.read.parquet(str(tmp_path / "t")), 200).collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert drawn[0] == drawn[1] and len(drawn[0]) == 200 and len(set(drawn[0])) == 10
    assert random_rows_of_files(spark.read.parquet(str(tmp_path / "t")), 5000).count() == 3000
    with pytest.raises(ValueError, match="positive"):
        random_rows_of_files(rows, 0)
