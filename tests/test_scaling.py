"""Work that must not grow faster than its input."""

import datetime
import time

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from cohortspark import fold
from cohortspark.operators.predict import KINDS
from cohortspark.plans import loading
from cohortspark.session import compilable
from cohortspark.sources.layouts import first_lines


def _seconds(spark, char: str) -> float:
    texts = spark.range(200).select(F.repeat(F.lit(char), 10_000).alias("x"))
    started = time.monotonic()
    texts.agg(F.sum(F.length(fold(F.col("x"))))).collect()
    return time.monotonic() - started


def test_characters_without_a_longer_form_are_not_looked_up(spark):
    _seconds(spark, "a")  # compiles
    assert _seconds(spark, "ß") < 5 * _seconds(spark, "a") + 2


def test_longer_forms_stand_where_their_characters_were(spark):
    text = "a½b\U0001f100c각\U0001134bﬁß\U0001134b d"
    folded = spark.createDataFrame([(text,), ("",), (None,)], "x string").select(fold(F.col("x"))).collect()
    longer = "\U00011347\U0001133e"
    assert folded[0][0] == f"A1⁄2B0.C각{longer}FISS{longer} D"
    assert [r[0] for r in folded[1:]] == ["", None]


def test_later_lines_do_not_slow_the_first_down(spark, tmp_path):
    long, short, empty = (tmp_path / f"Personas 2025T{i}.csv" for i in (1, 2, 3))
    long.write_text("a,b\n" + "1,2\n" * 600_000)
    short.write_text("\nc")
    empty.write_text("")
    started = time.monotonic()
    lines = first_lines(spark, [str(long), str(short), str(empty)])
    assert time.monotonic() - started < 8
    assert {k.rsplit("/", 1)[1].replace("%20", " "): v for k, v in lines.items()} == {long.name: "a,b", short.name: ""}


def test_wide_plans_are_split_in_any_session(spark, tmp_path):
    session, name = spark.newSession(), "spark.sql.codegen.hugeMethodLimit"
    session.conf.unset(name)
    spark.range(1).write.parquet(str(tmp_path / "t.parquet"))
    loading.table(session, str(tmp_path), "t")
    assert session.conf.get(name) == "8000"
    session.conf.set(name, "7000")
    assert compilable(session).conf.get(name) == "7000"


def test_lines_of_a_period_are_not_gathered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loading, "work_folder", lambda _: str(tmp_path / "work"))
    day = datetime.datetime(1996, 2, 3)
    rows = [(i, 1, 1, i % 7 + 1, 5.0, 10.0, 0.1, 0.0, "A", "F", day) for i in range(70)]
    schema = """l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,
        l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"""
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = loading.extract_bad_rows(spark, str(tmp_path)).collect()
    fields = len(loading.PERSON_TEXT)
    assert {(r["fila"], r["celdas"], r["n"]) for r in found} == {("buena", fields, 50), ("apartada", fields + 1, 10), ("apartada", 9, 10)}
    assert len(list((tmp_path / "work").glob("raw/*/part-*"))) > 1


def test_cached_node_ids_give_the_same_forest(spark):
    kind, fixed = KINDS["forest"]
    assert kind is RandomForestRegressor and fixed["cacheNodeIds"]
    rows = spark.range(500).selectExpr("id % 17 * 1.0 AS a", "id % 5 * 1.0 AS b", "id % 17 * (id % 5) * 1.0 AS y")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows).repartition(2).cache()
    texts = [
        kind(**{**fixed, "cacheNodeIds": cached, "labelCol": "y", "numTrees": 5, "maxDepth": 5}).fit(rows).toDebugString.split("\n", 1)[1]
        for cached in (True, False)
    ]
    assert texts[0] == texts[1]
