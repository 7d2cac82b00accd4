"""Quantiles, statistics, distributions, histograms and samples."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark import (
    categorical_distribution,
    correlation_long,
    correlation_matrix,
    descriptive_statistics,
    deterministic_sample,
    distributions,
    exact_quantiles,
    hash_split,
    histogram,
    leading_category,
    median_by_group,
    quantile_cuts,
    random_sample,
    select_ranks,
    strongest_correlation,
    top_group,
)

PROBABILITIES = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]


def disc(values, p):
    ordered = sorted(values)
    n = len(ordered)
    return ordered[max(n - math.floor(n - p * n), 1) - 1]


def hostile(seed=1):
    """Values over all magnitudes; one group and one value hold much of the rows."""
    rng = random.Random(seed)
    rows = [("hot", 7.25)] * 700
    rows += [("hot", 1e6 + i * 1e-9) for i in range(300)]
    rows += [(rng.choice(["a", None]), rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300)) for _ in range(900)]
    rows += [("z", v) for v in (0.0, -0.0, 5e-324, -5e-324, 2.2e-308, 1.7976931348623157e308, -1.7976931348623157e308)]
    rows += [("p", s * 2.0**e * f) for s in (1, -1) for e in (-1030, -3, 0, 5, 1000) for f in (1, 1 - 2**-53, 1 + 2**-52)]
    rows += [("n", None), ("a", None)]
    return rows


def check(got, rows):
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    found = {(r["g"], r["probability"]): (r["n"], r["value"]) for r in got}
    assert len(found) == len(groups) * len(PROBABILITIES)
    for g, values in groups.items():
        for p in PROBABILITIES:
            assert found[g, p] == (len(values), disc(values, p)), (g, p)


def test_exact_selection(spark):
    rows = hostile()
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    check(select_ranks(df, "v", PROBABILITIES, ["g"]).collect(), rows)


def test_exact_without_groups(spark):
    values = [v for _, v in hostile(2) if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, "v", {"m": 0.5, "p95": 0.95}).first()
    assert tuple(got) == (len(values), disc(values, 0.5), disc(values, 0.95))
    assert quantile_cuts(df, "v", [0.25], exact=True) == [disc(values, 0.25)]
    assert tuple(exact_quantiles(df.where("false"), "v", {"m": 0.5}).first()) == (0, None)


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("partitions", [1, 4])
def test_descriptive(spark, exact, partitions):
    values = [float(i) for i in range(1, 101)]
    rows = [(str(v), v * 2) for v in values] + [("nan", None), ("x", float("inf")), ("inf", float("nan"))]
    df = spark.createDataFrame(rows, "b string, a double").repartition(partitions)
    got = descriptive_statistics(df, ["b", "a"], exact=exact).collect()
    assert [r["variable"] for r in got] == ["b", "a"]
    first = got[0].asDict()
    assert first["n"] == 100 and first["mediana"] == 50.0 and first["p95"] == 95.0
    assert first["media"] == pytest.approx(50.5) and first["stddev"] == pytest.approx(np.std(values, ddof=1))
    assert (got[1]["min"], got[1]["max"]) == (2.0, 200.0)
    with pytest.raises(ValueError):
        descriptive_statistics(df, ["b"], accuracy=0)


def test_sketch_stays_within_its_error(spark):
    df = spark.range(200_000).select(((F.col("id") * 7919) % 200_000).cast("double").alias("v"))
    got = descriptive_statistics(df, ["v"], accuracy=1_000).first()
    for name, p in (("p25", 0.25), ("mediana", 0.5), ("p75", 0.75), ("p95", 0.95)):
        assert abs(got[name] / 200_000 - p) <= 2 / 1_000


def test_medians(spark):
    rows = [("a", "1"), ("a", "3"), ("a", "2"), ("b", "nan"), (None, "5")]
    df = spark.createDataFrame(rows, "g string, v string")
    for exact in (False, True):
        got = median_by_group(df, "g", "v", exact=exact)
        assert got.columns == ["g", "n", "mediana_v"]
        assert {r["g"]: tuple(r)[1:] for r in got.collect()} == {"a": (3, 2.0), None: (1, 5.0)}
    best = top_group(got, "g", "mediana_v").first()
    assert best["g"] is None and best["mediana_v"] == 5.0


def test_distributions(spark):
    rows = [("x", "1")] * 3 + [("y", "1")] * 3 + [(None, "2")] * 2
    df = spark.createDataFrame(rows, "a string, b string")
    long = distributions(df, ["a", "b"])
    got = [tuple(r) for r in long.collect()]
    assert got == [
        ("a", "x", 3, 37.5), ("a", "y", 3, 37.5), ("a", None, 2, 25.0), ("b", "1", 6, 75.0), ("b", "2", 2, 25.0)
    ]
    assert [tuple(r)[1] for r in leading_category(long).collect()] == ["x", "1"]
    assert [tuple(r) for r in categorical_distribution(df, "b").collect()] == [("1", 6, 75.0), ("2", 2, 25.0)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_histogram(spark, partitions):
    rng = random.Random(3)
    values = [rng.lognormvariate(8, 1) for _ in range(500)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double").repartition(partitions)
    counts, edges = np.histogram(values, bins=45)
    for got in (histogram(df, "v").collect(), histogram(df, "v", by=["g"]).collect()):
        assert [r["n"] for r in got] == counts.tolist()
        assert [r["desde"] for r in got] == pytest.approx(edges[:-1].tolist())
    logs, _ = np.histogram(np.log(values), bins=10)
    assert [r["n"] for r in histogram(df, "v", bins=10, log=True).collect()] == logs.tolist()
    same = spark.createDataFrame([(5.0,)] * 3, "v double")
    assert [r["n"] for r in histogram(same, "v", bins=5).collect()] == [0, 0, 3, 0, 0]


def test_correlations(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=300)
    data = np.column_stack([x, 2 * x + rng.normal(size=300), rng.normal(size=300)])
    df = spark.createDataFrame(data.tolist(), "a double, b double, c double")
    wanted = np.corrcoef(data.T)
    square = correlation_matrix(df, ["a", "b", "c"]).toPandas()
    assert square[["a", "b", "c"]].to_numpy() == pytest.approx(wanted)
    long = correlation_long(df, ["a", "b", "c"])
    got = {(r[0], r[1]): r[2] for r in long.collect()}
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            assert got[p, q] == pytest.approx(wanted[i, j])
    assert strongest_correlation(long, "a").first()["variable"] == "b"


def hashed(df, n):
    return [r["k"] for r in deterministic_sample(df, max_rows=n, key_columns=["k"]).collect()]


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(3_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    digest = F.sha2(F.concat_ws("¦", F.lit("42"), F.coalesce(F.col("k").cast("string"), F.lit("<NULO>"))), 256)
    wanted = [r["k"] for r in df.orderBy(digest).limit(40).collect()]
    for partitions in (1, 4, 7):
        assert hashed(df.repartition(partitions), 40) == wanted
    assert len(hashed(df, 5_000)) == 3_000
    hot = df.limit(10).withColumn("k", F.lit(1)).unionByName(df)
    assert len(hashed(hot, 25)) == 25
    shuffled = spark.range(0, 20_000, 1, 8).groupBy("id").count().drop("count")  # coalesced
    for seed in range(20):
        drawn = [r["id"] for r in random_sample(shuffled, 300, seed).collect()]
        assert len(drawn) == 300 == len(set(drawn))
    drawn = random_sample(df, 17, seed=3).collect()
    assert len(drawn) == 17 == len(set(drawn)) and drawn == random_sample(df, 17, seed=3).collect()


def test_hash_split(spark):
    df = spark.range(5_000).withColumnRenamed("id", "k")
    parts = [sorted(r[0] for r in p.collect()) for p in hash_split(df, ["k"])]
    again = [sorted(r[0] for r in p.collect()) for p in hash_split(df.repartition(5), ["k"])]
    assert parts == again and sorted(parts[0] + parts[1]) == list(range(5_000))
    assert 0.77 < len(parts[0]) / 5_000 < 0.83
