"""Forests grown from cells are the forests of MLlib's own regressor."""

import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import functions as F

from cohortspark import model_pipeline
from cohortspark.operators import forest
from cohortspark.operators.forest import CellForestRegressor

SETTINGS = {"labelCol": "pay", "maxBins": 16, "maxMemoryInMB": 64, "cacheNodeIds": True, "seed": 42}


def nodes(model):
    """(path, feature and cut, prediction, impurity, gain, rows) of the nodes of all trees."""
    out = []

    def walk(node, path):
        inner = node.subtreeDepth() > 0
        split = None
        if inner:
            split = node.split()
            kind = split.getClass().getSimpleName()
            split = (split.featureIndex(), split.threshold() if kind == "ContinuousSplit" else sorted(split.leftCategories()))
        out.append((path, split, node.prediction(), node.impurity(), node.gain() if inner else 0.0, node.impurityStats().rawCount()))
        if inner:
            walk(node.leftChild(), path + "l")
            walk(node.rightChild(), path + "r")

    for number, tree in enumerate(model._java_obj.trees()):
        walk(tree.rootNode(), f"{number} ")
    return out


def assert_same(rows, **settings):
    mine, theirs = (kind(**{**SETTINGS, **settings}).fit(rows) for kind in (CellForestRegressor, RandomForestRegressor))
    a, b = nodes(mine), nodes(theirs)
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert [x[5] for x in a] == [x[5] for x in b]
    for i in (2, 3, 4):
        assert [x[i] for x in a] == pytest.approx([x[i] for x in b], rel=1e-6, abs=1e-4, nan_ok=True)
    assert mine.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    return mine, theirs


@pytest.fixture(scope="module")
def features(spark):
    rng = random.Random(5)
    rows = []  # whole numbers have exact sums, so that equal gains are equal here and there
    for i in range(12_000):  # more than the rows from which thresholds are taken
        age, hours, place = rng.gauss(40, 12), float(rng.randrange(0, 60)), rng.choice(["n", "s", "e", None])
        rows.append((age, hours, place, float(round(50 * age + 9 * hours * (place == "s") + rng.gauss(0, 90)))))
    rows = spark.createDataFrame(rows, "age double, hours double, place string, pay double").repartition(3)
    stages = [
        StringIndexer(inputCol="place", outputCol="at", handleInvalid="keep"),
        OneHotEncoder(inputCol="at", outputCol="slots", handleInvalid="keep"),
        VectorAssembler(inputCols=["age", "hours", "slots", "at"], outputCol="features"),
    ]
    rows = rows.cache()
    return Pipeline(stages=stages).fit(rows).transform(rows).select("pay", "features").cache()


def test_the_trees_are_those_of_mllib(features, tmp_path):
    mine, theirs = assert_same(features, numTrees=40, maxDepth=6)
    assert isinstance(mine, RandomForestRegressionModel) and mine.getMaxDepth() == theirs.getMaxDepth() == 6
    scored = mine.transform(features).select(F.sum("prediction")).first()[0]
    assert scored == pytest.approx(theirs.transform(features).select(F.sum("prediction")).first()[0])
    mine.write().save(str(tmp_path / "m"))
    assert nodes(RandomForestRegressionModel.load(str(tmp_path / "m"))) == nodes(mine)


def test_small_tables_and_groups_of_nodes_change_nothing(features, monkeypatch):
    monkeypatch.setattr(forest, "_CHUNK_BYTES", 8 * 3 * 500)
    monkeypatch.setattr(forest, "_TABLE_BYTES", 24 * 3 * 50)
    assert_same(features, numTrees=3, maxDepth=4, minInstancesPerNode=400, minInfoGain=5.0)
    monkeypatch.setattr(forest, "_BLOCK", 7)
    assert_same(features.limit(900).coalesce(1), numTrees=1, maxDepth=3, maxBins=300)


def test_cells_are_as_many_as_bins_not_rows(features):
    few = features.where("features is not null").unionAll(features).coalesce(1)
    model = CellForestRegressor(**SETTINGS, numTrees=2, maxDepth=2)
    rows = forest._points(few, "pay", "features")
    plan = forest._Plan(model, few, rows)
    cells = forest._cells(plan, rows).collect()
    assert sum(len(r["cells"]) for r in cells) // plan.count <= 17 * 17 * 4
    assert model.fit(few).trees[0]._java_obj.rootNode().impurityStats().count() > 20_000


def test_odd_tables(spark):
    def table(rows):
        return spark.createDataFrame([(float(y), Vectors.dense(x)) for y, x in rows], ["pay", "features"]).coalesce(1)

    assert_same(table([(5.0, [1.0, 0.0])] * 40), numTrees=4, maxDepth=3)  # nothing to split by
    assert_same(table([(i % 2, [float(i % 3), float(-i)]) for i in range(50)]), numTrees=6, maxDepth=5)
    with pytest.raises(ValueError, match="rows"):
        CellForestRegressor(**SETTINGS).fit(table([(1.0, [1.0])]).where("pay > 2"))
    bad = table([(1.0, [1.0]), (2.0, [2.0])]).withColumn("pay", F.when(F.col("pay") > 1, F.col("pay")))
    with pytest.raises(Exception, match="Labels MUST NOT be Null"):
        CellForestRegressor(**SETTINGS).fit(bad)
    weighted = table([(float(i), [float(i)]) for i in range(20)]).withColumn("w", F.lit(2.0))
    assert_same(weighted, numTrees=3, weightCol="w")


def test_forests_of_the_library_are_grown_from_cells():
    assert isinstance(model_pipeline("forest").getStages()[-1], CellForestRegressor)
