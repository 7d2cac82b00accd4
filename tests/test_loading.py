"""Extracts as folders, layouts that differ, quoted cells, and text of other scripts."""

import pytest
from pyspark.sql import functions as F

from cohortspark import LABOUR_SURVEY, fold
from cohortspark.functions.staging import stage
from cohortspark.operators import relational
from cohortspark.sources.extracts import (
    find_person_files,
    ignored_extracts,
    load_extracts,
    manifest,
    require_complete,
)
from cohortspark.spec import DatasetSpec, FieldSpec

SPEC = DatasetSpec(
    fields=(FieldSpec("A", "a"), FieldSpec("B", "b")),
    keys=("a",),
    target="b",
    numeric=(),
    categorical=(),
    audited=(),
    naming=LABOUR_SURVEY.naming,
)
NAME = "Personas-ENEIC-I-2025.csv"


def folder(path, **parts):
    where = path / NAME
    where.mkdir()
    for name, text in parts.items():
        (where / f"{name}.csv").write_bytes(text.encode())
    return str(where)


def rows(table):
    return sorted((r["a"], r["b"]) for r in table.collect())


def test_parts_of_one_layout(spark, tmp_path):
    path = folder(tmp_path, p0="A,B\n1,2\n", p1="A,B\n3,4\n")
    assert rows(load_extracts(spark, [path], spec=SPEC)) == [("1", "2"), ("3", "4")]


def test_parts_of_other_layouts_are_refused(spark, tmp_path):
    path = folder(tmp_path, p0="A,B\n1,2\n", p1="B,A\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_extracts(spark, [path], spec=SPEC).collect()


def test_quoted_cells_and_line_breaks(spark, tmp_path):
    path = folder(tmp_path, p0='A,"B"\n"he said ""hi"", ok",x\n')
    assert rows(load_extracts(spark, [path], spec=SPEC)) == [('he said "hi", ok', "x")]
    (tmp_path / "more").mkdir()
    path = folder(tmp_path / "more", p0='A,B\n"two\nlines",y\n')
    assert rows(load_extracts(spark, [path], spec=SPEC, multi_line=True)) == [("two\nlines", "y")]


def test_rows_of_wrong_width_are_refused(spark, tmp_path):
    path = folder(tmp_path, p0="A,B\n1,2,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_extracts(spark, [path], spec=SPEC).collect()


def test_folders_are_extracts_and_ignored_names_are_listed(spark, tmp_path):
    folder(tmp_path, p0="A,B\n", p1="A,B\n", _SUCCESS="")
    (tmp_path / "Personas-ENEIC-nuevo-corte.csv").write_text("A,B\n")
    found = find_person_files(spark, str(tmp_path))
    assert [(r["archivo"], r["status"]) for r in found.collect()] == [
        (NAME, "ok"),
        ("Personas-ENEIC-nuevo-corte.csv", "no_year"),
    ]
    assert [r["archivo"] for r in ignored_extracts(found).collect()] == ["Personas-ENEIC-nuevo-corte.csv"]
    periods = spark.createDataFrame([(f"{y}T{q}",) for y in range(2000, 2025) for q in (1, 2, 3, 4)] + [("2025T1",)], "periodo string")
    with pytest.raises(FileNotFoundError, match="100 periods from 2000T1 to 2024T4"):
        require_complete(manifest(periods, found))
    require_complete(manifest(periods.where("periodo = '2025T1'"), found))


def test_several_files_of_a_period_are_seen_behind_many_absent_ones(spark):
    table = spark.range(60).select(
        F.format_string("%04dT1", F.col("id") + 1950).alias("periodo"),
        F.when(F.col("id") == 59, 2).otherwise(0).alias("n_archivos"),
    )
    with pytest.raises(ValueError, match="more than one extract for 2009T1"):
        require_complete(table)


def test_spaces_and_letters_of_other_scripts(spark):
    df = spark.createDataFrame([("  7 　",), ("\x1c ",)], "x string")
    assert [r["x"] for r in stage(df).collect()] == ["7", None]
    names = spark.createDataFrame([("ﬁn",), ("\U0001d40f",), ("Ⅷ é ß",), ("plain",)], "x string")
    folded = [r[0] for r in names.select(fold(F.col("x"))).collect()]
    assert folded[:2] == ["FIN", "P"] and folded[2].startswith("VIII E") and folded[3] == "PLAIN"


def test_shares_of_everything_need_no_driver(spark):
    counts = spark.range(6).groupBy((F.col("id") % 3).alias("k")).agg(F.count("*").alias("n"))
    shares = relational.with_share(counts, [], "p", total="t").collect()
    assert {(r["t"], round(r["p"], 6)) for r in shares} == {(6, 33.333333)}
    assert LABOUR_SURVEY.keys
