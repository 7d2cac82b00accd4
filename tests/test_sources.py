"""File names, extracts, headers and sinks."""

import csv

import pytest
from pyspark.sql import functions as F

from cohortspark import (
    LABOUR_SURVEY,
    RequiredColumnsError,
    check_period,
    detect_period,
    detect_period_from_filename,
    find_person_files,
    fold,
    header_audit,
    load_extracts,
    load_study,
    manifest,
    read_header,
    require_complete,
    sparse_union,
    squeeze,
    table_from_rows,
    write_prepared,
    write_small_table,
)
from cohortspark.sources.extracts import find_dictionaries, list_files

NAMES = {
    "Base-de-datos-Personas-ENEIC-I-2025.xlsx": "2025T1",
    "Base-de-datos-Personas-ENEIC-IV-2025.xlsx": "2025T4",
    "Personas_T1-2026.csv": "2026T1",
    "Personas 2025T3.csv": "2025T3",
    "Personas-Tercer-Trimestre-2025.csv": "2025T3",
    "Personas-2do-trimestre-2025.csv": "2025T2",
    "Personas-Trimestre-1-2025.csv": "2025T1",
    "Personas-I-2025.csv": "2025T1",
    "Personas-ENEIC-2025.csv": "no_quarter",
    "Personas-ENEIC-I.csv": "no_year",
    "Personas-ENEIC-I-2025-2026.csv": "ambiguous_year",
    "Personas-ENEIC-I-2025-T2.csv": "ambiguous_quarter",
}


def test_periods(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "path string").repartition(2)
    period = detect_period(F.col("path"), LABOUR_SURVEY.naming)
    for row in df.select("path", period.alias("p")).collect():
        p = row["p"]
        found = p["periodo_archivo"] if p["status"] == "ok" else p["status"]
        assert found == NAMES[row["path"]], row["path"]
    assert detect_period_from_filename(spark, "Personas 2025T3.csv")["trimestre_calendario"] == 3
    with pytest.raises(ValueError):
        detect_period_from_filename(spark, "Personas.csv")


def test_period_metadata(spark):
    cases = [
        ("Personas 2025T3.csv", None, None, None, "ok"),
        ("Personas 2025T3.csv", "2025T3", "2025", "3", "ok"),
        ("Personas 2025T3.csv", "2025T2", None, None, "contradicts_name"),
        ("Personas.csv", "2025T3", "2025", None, "undetermined"),
        ("Personas.csv", " 2025 T3 ", "2025", "3", "ok"),
        ("Personas.csv", "2025-3", "2025", "3", "bad_format"),
        ("Personas.csv", "2025T3", "x", "3", "not_integer"),
        ("Personas.csv", "2025T3", "2025", "2", "inconsistent"),
    ]
    df = spark.createDataFrame(cases, "path string, p string, y string, q string, wanted string")
    detected = detect_period(F.col("path"), LABOUR_SURVEY.naming)
    status = check_period(F.col("p"), F.col("y"), F.col("q"), detected)
    for row in df.repartition(2).select("*", status.alias("got")).collect():
        assert row["got"] == row["wanted"], row


def test_folding(spark):
    df = spark.createDataFrame([("  Año \t de  Ñandú ﬀ",)], "x string").repartition(2)
    row = df.select(fold(F.col("x")), squeeze(F.col("x"))).first()
    assert row[0].startswith("  ANO \t DE  NANDU")
    assert row[1] == "Año de Ñandú ﬀ"


SOURCES = list(LABOUR_SURVEY.source_columns)


def person(n, **changes):
    row = dict(zip(SOURCES, ["3000", "30", "2", "6", "40", "4", "2.0", "1", "1", str(n), "1", "1.5", "2025", "1"]))
    return row | changes


def write_extract(path, rows, columns=None):
    columns = columns or SOURCES
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as out:
        writer = csv.DictWriter(out, columns, extrasaction="ignore", restval="")
        writer.writeheader()
        writer.writerows(rows)


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    for quarter, roman in enumerate(("I", "II", "III", "IV"), 1):
        columns = SOURCES if quarter < 4 else ["EXTRA", *SOURCES[::-1]]
        rows = [person(i, P05D01=str(1000 * quarter + i)) for i in range(quarter)]
        write_extract(root / f"Base-Personas-ENEIC-{roman}-2025.csv", rows, columns)
    write_extract(root / "Base-Personas-ENEIC-I-2026.csv", [person(9)])
    for other in ("Hogares/Personas-I-2025", "Diccionario-Personas-I-2025", "Boleta-Personas-I-2025"):
        write_extract(root / f"{other}.csv", [person(1)])
    return root


def test_discovery_and_manifest(spark, raw):
    found = find_person_files(spark, [str(raw), str(raw / "missing")])
    rows = found.collect()
    assert [r["periodo_archivo"] for r in rows] == ["2025T1", "2025T2", "2025T3", "2025T4", "2026T1"]
    assert find_dictionaries(list_files(spark, str(raw))).count() == 1
    assert "length" in found.columns and rows[0]["length"] > 0
    plan = list_files(spark, str(raw))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    expected = spark.createDataFrame([("2025T1",), ("2027T1",)], "periodo string")
    table = manifest(expected, found)
    assert [r["n_archivos"] for r in table.collect()] == [1, 0]
    with pytest.raises(FileNotFoundError, match="2027T1"):
        require_complete(table)
    twice = manifest(expected.limit(1), found.unionByName(found))
    with pytest.raises(ValueError, match="more than one"):
        require_complete(twice)


def test_load_study(spark, raw):
    df = load_study(spark, str(raw))
    counts = {r["periodo_archivo"]: r["count"] for r in df.groupBy("periodo_archivo").count().collect()}
    assert counts == {"2025T1": 1, "2025T2": 2, "2025T3": 3, "2025T4": 4, "2026T1": 1}
    last = df.where("periodo_archivo = '2025T4' and NUM_HOGAR = '3'").first()
    assert last["salario_mensual"] == 4003.0 and last["antiguedad"] == 2.5
    assert last["categoria_ocupacional"] == "2" and last["trimestre_calendario"] == 4
    assert last["archivo_origen"] == "Base-Personas-ENEIC-IV-2025.csv"
    assert df.columns == [
        *[f.name for f in LABOUR_SURVEY.fields], "antiguedad", "archivo_origen",
        "periodo_archivo", "anio_archivo", "trimestre_calendario",
    ]
    assert dict(df.dtypes)["anio_archivo"] == "int"


def test_load_errors_and_options(spark, tmp_path):
    path = tmp_path / "Personas 2025T1.csv"
    write_extract(path, [person(1)], SOURCES[:-2])
    with pytest.raises(RequiredColumnsError, match="ANIO"):
        load_extracts(spark, [str(path)])
    some = load_extracts(spark, [str(path)], selected=["P05D01", "ANIO"], required=["P05D01"])
    assert some.columns[:2] == ["salario_mensual", "ANIO"] and some.first()["ANIO"] is None
    with pytest.raises(ValueError, match="not selected"):
        load_extracts(spark, [str(path)], selected=["P05D01"], required=["P02A03"])
    with pytest.raises(ValueError, match="mapped"):
        LABOUR_SURVEY.resolve({"P05D01": "a", "P02A03": "a"})
    unnamed = tmp_path / "Personas.csv"
    write_extract(unnamed, [person(1)])
    with pytest.raises(ValueError, match="no_year"):
        load_extracts(spark, [str(unnamed)])
    given = {"periodo_archivo": "2024T2", "anio_archivo": 2024, "trimestre_calendario": 2}
    assert load_extracts(spark, [str(unnamed)], metadata=given).first()["periodo_archivo"] == "2024T2"
    double = tmp_path / "Personas 2025T2.csv"
    double.write_text("a b,a  b\n1,2\n")
    with pytest.raises(ValueError, match="repeated"):
        read_header(spark, str(double))


def test_folder_and_parquet_extracts(spark, tmp_path):
    folder = tmp_path / "Personas 2025T1"
    for part in range(3):
        write_extract(folder / f"part-{part}.csv", [person(part)])
    write_extract(tmp_path / "Personas 2025T2" / "part-0.csv", [person(7)])
    paths = [str(folder), str(tmp_path / "Personas 2025T2")]
    df = load_extracts(spark, paths)
    assert df.groupBy("periodo_archivo").count().orderBy("periodo_archivo").collect() == [
        ("2025T1", 3), ("2025T2", 1)
    ]
    typed = str(tmp_path / "Personas 2025T3.parquet")
    names = {f.name: f.source for f in LABOUR_SURVEY.fields}
    df.select(*[F.col(n).alias(s) for n, s in names.items()]).write.parquet(typed)
    again = load_extracts(spark, [typed])
    assert again.count() == 4 and again.first()["salario_mensual"] == 3000.0


def test_header_audit(spark):
    rows = [("p", "a", " X "), ("p", "a", "Y"), ("p", "a", "Y  "), ("p", "b", "X")]
    got = header_audit(spark.createDataFrame(rows, "periodo string, archivo string, columna string"), ["X", "Z"])
    assert [tuple(r) for r in got.collect()] == [
        ("p", "a", 3, "Z", "Y"), ("p", "b", 1, "Z", "ninguna")
    ]


def test_sinks(spark, tmp_path):
    df = table_from_rows(spark, [("2025T1", 1.0, "é"), ("2025T2", None, "a,b")], "periodo_archivo string, x double, s string")
    back = write_prepared(df, str(tmp_path / "t"))
    assert back.schema == df.schema or back.columns == df.columns
    assert sorted(back.collect()) == sorted(df.collect())
    pruned = back.where("periodo_archivo = '2025T1'")
    assert "PartitionFilters: [isnotnull(periodo_archivo" in pruned._jdf.queryExecution().toString()
    with pytest.raises(AssertionError):
        write_prepared(df, str(tmp_path / "u"), expected_rows=5)
    target = write_small_table(df.orderBy("periodo_archivo"), tmp_path / "out" / "t.csv")
    raw = target.read_bytes()
    assert raw.startswith(b"\xef\xbb\xbf") and b'"a,b"' in raw
    with pytest.raises(ValueError):
        write_small_table(df, tmp_path / "v.csv", max_rows=1)


def test_sparse_union(spark):
    a = spark.createDataFrame([(1, "x")], "n int, a string")
    b = spark.createDataFrame([(2, "y")], "n int, b string")
    assert sparse_union([a, b]).orderBy("n").collect() == [(1, "x", None), (2, None, "y")]
