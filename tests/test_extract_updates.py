"""Many extracts in one scan, rows of other widths, incremental loads and single periods."""

import os

import pytest
from pyspark.sql import functions as F

from cohortspark import LABOUR_SURVEY, header_audit, load_extracts
from cohortspark.sources.extracts import header_rows, scan_extracts
from cohortspark.sources.incremental import read_manifest, update_table
from cohortspark.sources.layouts import csv_names, find_layouts, first_lines
from cohortspark.sources.sinks import write_periods, write_prepared
from test_sources import SOURCES, person, write_extract

EXTRA = [f"X{i}" for i in range(9)]


def wide(path, rows, columns=(*SOURCES, *EXTRA)):
    write_extract(path, rows, list(columns))
    return str(path)


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def test_layouts_share_scans(spark, tmp_path):
    paths = [wide(tmp_path / f"Personas 20{y}T{q}.csv", [person(q)] * q) for y in (24, 25) for q in (1, 2, 3, 4)]
    paths.append(wide(tmp_path / "Personas 2026T1.csv", [person(9)], ["Z", *SOURCES[::-1]]))
    loaded = scan_extracts(spark, paths, required=SOURCES)
    assert sorted(len(layout.parts) for layout in loaded.layouts) == [1, 8] and scans(loaded.table) == 2
    counts = {r[0]: r[1] for r in loaded.table.groupBy("periodo_archivo").count().collect()}
    assert counts == {f"20{y}T{q}": q for y in (24, 25) for q in (1, 2, 3, 4)} | {"2026T1": 1}
    one = loaded.table.where("periodo_archivo = '2026T1'").first()
    assert one["archivo_origen"] == "Personas 2026T1.csv" and one["NUM_HOGAR"] == "9" and one["anio_archivo"] == 2026
    audit = header_audit(header_rows(spark, loaded), SOURCES).collect()
    assert {r["columnas_originales"] for r in audit} == {23, 15} and {r["columnas_faltantes"] for r in audit} == {"ninguna"}
    assert loaded.bad_rows.collect() == []


@pytest.mark.parametrize("bad", ["1,2,3", ",".join("1" * 9), ",".join("1" * 40)])
def test_rows_of_other_widths(spark, tmp_path, bad):
    path = wide(tmp_path / "Personas 2025T1.csv", [person(1), person(2)])
    with open(path, "a", encoding="utf-8") as out:
        out.write(bad + "\n")
    for action in (lambda df: df.count(), lambda df: df.select("periodo_archivo").collect(), lambda df: df.select("edad").collect()):
        with pytest.raises(Exception, match="(?i)malformed"):
            action(load_extracts(spark, [path], selected=["P02A03"]))
    loaded = scan_extracts(spark, [path])
    assert loaded.table.count() == 2 and loaded.table.select("edad").collect() == [(30.0,)] * 2
    (row,) = loaded.bad_rows.collect()
    assert (row["registro"], row["periodo_archivo"], row["archivo_origen"]) == (bad, "2025T1", "Personas 2025T1.csv")
    assert loaded.bad_rows.count() == 1


def test_part_headers_are_compared_before_any_row_is_read(spark, tmp_path):
    folder = tmp_path / "Personas 2025T1.csv"
    wide(folder / "a.csv", [person(1)])
    wide(folder / "b.csv", [person(2)], [*EXTRA, *SOURCES])
    with pytest.raises(ValueError, match="b.csv: its header"):
        load_extracts(spark, [str(folder)], selected=["P02A03"])


def test_headers_need_one_job_and_few_rows(spark, tmp_path):
    paths = []
    for i in range(12):
        path = tmp_path / f"{i}.csv"
        path.write_text(f"a{i},\"b, {i}\"\n" + "x,y\n" * 5000)
        paths.append(str(path))
    tracker, group = spark.sparkContext.statusTracker(), f"headers-{tmp_path}"
    spark.sparkContext.setJobGroup(group, "headers")
    try:
        lines = first_lines(spark, paths)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert sorted(csv_names(v) for v in lines.values()) == sorted([f"a{i}", f"b, {i}"] for i in range(12))
    assert len(tracker.getJobIdsForGroup(group)) <= 1
    assert csv_names('a,"b') is None and csv_names("﻿a;b\r", ";") == ["a", "b"]


def test_empty_and_unnamed_extracts(spark, tmp_path):
    (tmp_path / "Personas 2025T1.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        load_extracts(spark, [str(tmp_path / "Personas 2025T1.csv")])
    only = wide(tmp_path / "Personas 2025T2.csv", [])
    assert load_extracts(spark, [only]).collect() == []
    (tmp_path / "Personas 2025T3.csv").write_text('A,"B\nC"\n1,2\n')
    (layout,) = find_layouts(spark, [str(tmp_path / "Personas 2025T3.csv")], multi_line=True)
    assert layout.header == ("A", "B\nC")


def test_parquet_extracts_with_other_types(spark, tmp_path):
    rows = spark.createDataFrame([person(1)])
    rows.write.parquet(str(tmp_path / "Personas 2025T1.parquet"))
    typed = rows.withColumn("P02A03", F.lit(31.0)).withColumn("NUM_HOGAR", F.lit(7).cast("long"))
    typed.write.parquet(str(tmp_path / "Personas 2025T2.parquet"))
    loaded = scan_extracts(spark, [str(tmp_path / f"Personas 2025T{q}.parquet") for q in (1, 2)])
    got = loaded.table.select("periodo_archivo", "edad", "NUM_HOGAR").collect()
    assert sorted(map(tuple, got)) == [("2025T1", 30.0, "1"), ("2025T2", 31.0, "7")] and len(loaded.layouts) == 2


def states(update):
    return {r["periodo_archivo"]: r["estado"] for r in update.states.collect()}


def test_updates_read_changed_extracts_only(spark, tmp_path):
    raw, table, store = tmp_path / "raw", str(tmp_path / "table"), str(tmp_path / "manifest")
    paths = [wide(raw / f"Personas 2025T{q}.csv", [person(q)] * q) for q in (1, 2, 3)]
    first = update_table(spark, str(raw), table, store)
    assert states(first) == dict.fromkeys(("2025T1", "2025T2", "2025T3"), "nuevo") and first.rows == 6
    again = update_table(spark, str(raw), table, store)
    assert set(states(again).values()) == {"igual"} and again.table is None and again.rows == 0
    # another length, a new extract, one that is gone, and one that is only touched
    wide(raw / "Personas 2025T2.csv", [person(2), person(8), person(9)])
    wide(raw / "Personas 2025T4.csv", [person(4)])
    os.remove(paths[2])
    os.utime(paths[0], (1, 1))
    last = update_table(spark, str(raw), table, store)
    assert states(last) == {"2025T1": "cambiado", "2025T2": "cambiado", "2025T3": "ausente", "2025T4": "nuevo"}
    assert last.loaded == ("2025T1", "2025T2", "2025T4") and last.rows == 5
    counts = {r[0]: r[1] for r in last.table.groupBy("periodo_archivo").count().collect()}
    assert counts == {"2025T1": 1, "2025T2": 3, "2025T3": 3, "2025T4": 1}
    assert read_manifest(spark, store).count() == 3
    wide(raw / "b" / "Personas 2025T4.csv", [person(4)])
    with pytest.raises(ValueError, match="more than one extract for 2025T4"):
        update_table(spark, str(raw), table, store)


def test_a_failed_update_is_done_again(spark, tmp_path):
    raw, table, store = tmp_path / "raw", str(tmp_path / "table"), str(tmp_path / "manifest")
    path = wide(raw / "Personas 2025T1.csv", [person(1)])
    update_table(spark, str(raw), table, store)
    wide(raw / "Personas 2025T1.csv", [person(1), person(2)])
    with open(path, "a", encoding="utf-8") as out:
        out.write("1,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        update_table(spark, str(raw), table, store, keep_bad_rows=False)
    assert spark.read.parquet(table).count() == 1
    done = update_table(spark, str(raw), table, store)
    assert (done.rows, done.bad_rows.count(), states(done)) == (2, 1, {"2025T1": "cambiado"})


def test_single_periods_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("2025T1", 1), ("2025T1", 2), ("2025T2", 3)], "periodo_archivo string, x int")
    assert write_periods(rows, path).rows == 3
    done = write_periods(spark.createDataFrame([("2025T2", 7), ("2025T2", 8)], rows.schema), path)
    assert (done.periods, done.rows) == (("2025T2",), 2)
    assert sorted(map(tuple, done.table.collect())) == [("2025T1", 1), ("2025T1", 2), ("2025T2", 7), ("2025T2", 8)]
    broken = rows.withColumn("x", F.when(F.col("x") == 3, F.raise_error(F.lit("broken")).cast("int")).otherwise(0))
    with pytest.raises(Exception, match="broken"):
        write_periods(broken, path)
    with pytest.raises(Exception, match="no periodo_archivo"):
        write_periods(rows.unionByName(spark.createDataFrame([(None, 1)], rows.schema)), path)
    assert spark.read.parquet(path).count() == 4
    assert write_periods(rows.limit(0), path).rows == 0 and spark.read.parquet(path).count() == 4


def test_the_source_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = spark.range(100).select("id", F.lit("2025T1").alias("periodo_archivo"))
    marked = rows.rdd.map(lambda r: (seen.add(1), tuple(r))[1]).toDF("id long, periodo_archivo string")
    assert write_prepared(marked, str(tmp_path / "a")).count() == 100 and seen.value == 100
    assert write_periods(marked, str(tmp_path / "b")).rows == 100 and seen.value == 200
    assert LABOUR_SURVEY.period == "periodo_archivo"
