"""Duplicate keys against earlier periods."""

import re

import pytest

from cohortspark.operators.key_index import KeyIndex

SCHEMA = "a string, b int, periodo_archivo string, x double, y string"


def make(spark, tmp_path, name, **options):
    return KeyIndex(spark, name, str(tmp_path / name), keys=("a", "b"), compared=("x", "y"), buckets=7, **options)


def test_new_rows_against_earlier_ones(spark, tmp_path):
    index = make(spark, tmp_path, "claves_uno")
    first = [("k", 1, "2025T1", 1.0, "u"), ("k", 1, "2025T1", 1.0, "u"), ("k", 2, "2025T1", 1.0, None), (None, 3, "2025T1", 0.0, "u")]
    index.add(spark.createDataFrame(first, SCHEMA))
    index.add(spark.createDataFrame([("k", 2, "2025T2", 1.0, None), ("z", 9, "2025T2", 1.0, "u")], SCHEMA))
    new = [("k", 1, "2025T3", 1.0, "v"), ("k", 2, "2025T3", 1.0, None), (None, 3, "2025T3", -0.0, "u"), ("new", 1, "2025T3", 1.0, "u")]
    found = index.duplicates(spark.createDataFrame(new, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=str) == [
        ("k", "1", 1, 2, "2025T1", "conflictivo"), ("k", "2", 1, 2, "2025T1", "exacto"), (None, "3", 1, 1, "2025T1", "exacto")
    ]
    with pytest.raises(ValueError, match="already in the index: 2025T2"):
        index.add(spark.createDataFrame([("q", 1, "2025T2", 1.0, "u")], SCHEMA))
    assert index.duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_the_index_is_not_shuffled(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("CAST(id AS STRING) AS a", "CAST(id % 5 AS INT) AS b", "'2025T1' AS periodo_archivo", "1.0D AS x", "'u' AS y")
    index = make(spark, tmp_path, "claves_dos")
    index.add(rows)
    again = make(spark, tmp_path, "claves_dos")  # opened once more, as in a later session
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = again.duplicates(rows.selectExpr("a", "b", "'2025T2' AS periodo_archivo", "x", "y"))
        assert found.count() == 20_000
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    side = plan[: plan.index("== Initial Plan ==")] if "== Initial Plan ==" in plan else plan
    scan = next(i for i, line in enumerate(side.splitlines()) if "claves_dos" in line)
    above = side.splitlines()[:scan]
    depth = lambda line: len(re.match(r"[\s:|+\-*]*", line)[0])
    path, level = [], depth(side.splitlines()[scan])
    for line in reversed(above):
        if depth(line) < level:
            path.append(line)
            level = depth(line)
    join = next(i for i, line in enumerate(path) if "Join" in line)
    assert not any("Exchange" in line for line in path[:join]), side


def test_names_are_checked(spark, tmp_path):
    with pytest.raises(ValueError, match="not a table name"):
        make(spark, tmp_path, "x; y")
