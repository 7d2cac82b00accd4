"""Registered queries over real extracts, and their SQL.

Line items are written as extracts by quarter below the shared folder and loaded again.
"""

from __future__ import annotations

import csv
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import is_finite
from ..operators.key_index import KeyIndex
from ..operators.quality import apply_filters_with_audit, period_counts
from ..operators.relational import settle
from ..presets import LABOUR_SURVEY
from ..sources.extracts import find_person_files, header_audit, header_rows, scan_extracts
from ..sources.incremental import update_table
from ..sources.sinks import bounded, table_from_rows, write_periods, write_small_table
from .oracles import _KEPT, _PERSON, _filter_audit, _missing_typed, _sql, _standard_columns
from .study import HOLDOUT, TRAINING, load_and_audit
from .views import FILE_TEXT, PERIOD_TEXT, PERSON_TEXT, QUARTER, YEAR, spark_sql, survey_prepared, survey_raw, table, work_folder

Query = Callable[[SparkSession, str], DataFrame]

_FIELDS = list(PERSON_TEXT)
#: Columns of the files that nobody selects.
_EXTRA = {"L_EXTRA_1": "CAST(l_discount AS {S})", "L_EXTRA_2": "CAST(l_tax AS {S})"}
#: Parquet extracts have typed columns.
_TYPED = {"NUM_HOGAR": "long", "NUM_PERSONA": "int", "FACTOR": "double", "ANIO": "short"}
#: A folder for each value, whose name is the extract's.
_FOLDER = "extracto"
_CHANGED, _FIRST_YEARS, _REPLACED = "2021T2", 2024, "2022T3"
_LAST = "2026T4"
PERIODS = tuple(f"{y}T{q}" for y in range(2020, 2027) for q in (1, 2, 3, 4))


def _people(lines: DataFrame, suffix: str) -> DataFrame:
    texts = {**PERSON_TEXT, **_EXTRA}
    name = F.regexp_replace(spark_sql(FILE_TEXT), r"\.csv$", suffix)
    return lines.select(*[spark_sql(t).alias(n) for n, t in texts.items()], name.alias(_FOLDER), F.expr(QUARTER).alias("__q"))


def _write(people: DataFrame, root: str, mode: str = "append") -> str:
    """Odd and even quarters get their columns in different order."""
    kind = "parquet" if people.where(F.col(_FOLDER).endswith(".parquet")).limit(1).count() else "csv"
    for order, half in ((1, [*_FIELDS, *_EXTRA]), (0, [*_EXTRA, *_FIELDS[::-1]])):
        cells = [F.col(c).cast(_TYPED[c]).alias(c) if kind == "parquet" and c in _TYPED else c for c in half]
        writer = people.where(F.col("__q") % 2 == order).select(*cells, _FOLDER).write.mode(mode).partitionBy(_FOLDER)
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.option("partitionOverwriteMode", "dynamic").options(**(options if kind == "csv" else {})).format(kind).save(root)
    return root


def _extracts(spark: SparkSession, sf: str, suffix: str) -> str:
    return _write(_people(table(spark, sf, "lineitem"), suffix), f"{work_folder(spark)}/raw")


def _paths(spark: SparkSession, root: str) -> list[str]:
    return [r["path"] for r in find_person_files(spark, root).select("path").collect()]  # one for each period


def _finite(rows: DataFrame) -> DataFrame:
    return rows.select(
        *[
            F.when(is_finite(F.col(f.name)), F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in rows.schema.fields
        ]
    )


def load_csv_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """28 folders of CSV parts in two layouts, found, checked and loaded in two scans."""
    root = _extracts(spark, sf, ".csv")
    return _finite(scan_extracts(spark, _paths(spark, root), required=LABOUR_SURVEY.source_columns).table)


def load_parquet_extracts(spark: SparkSession, sf: str) -> DataFrame:
    """The same from typed Parquet extracts."""
    root = _extracts(spark, sf, ".parquet")
    return _finite(scan_extracts(spark, _paths(spark, root), required=LABOUR_SURVEY.source_columns).table)


def extract_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Header audit of the files themselves."""
    loaded = scan_extracts(spark, _paths(spark, _extracts(spark, sf, ".csv")))
    return header_audit(header_rows(spark, loaded), [*LABOUR_SURVEY.source_columns, "P99"])


def extract_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Good and bad rows of extracts in which some lines are too short or too long."""
    people = _people(table(spark, sf, "lineitem"), ".csv").na.fill("")
    cells = F.concat_ws(",", *_FIELDS)
    line = F.when(F.col("NUM_PERSONA") == "5", F.concat(cells, F.lit(",1"))).when(
        F.col("NUM_PERSONA") == "6", F.substring_index(cells, ",", 9)
    )
    # Lines of any width are one column, whose name is the header of every part that a task writes.
    lines = people.select(F.coalesce(line, cells).alias(",".join(_FIELDS)), _FOLDER)
    root = f"{work_folder(spark)}/raw"
    whole = {"sep": "\x01", "quote": "\0", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.write.partitionBy(_FOLDER).csv(root, header=True, **whole)
    loaded = scan_extracts(spark, _paths(spark, root))
    good = loaded.table.select("periodo_archivo", F.lit("buena").alias("fila"), F.lit(len(_FIELDS)).alias("celdas"))
    written = F.size(F.split("registro", ","))
    bad = loaded.bad_rows.select("periodo_archivo", F.lit("apartada").alias("fila"), written.alias("celdas"))
    return good.unionByName(bad).groupBy("periodo_archivo", "fila", "celdas").agg(F.count("*").alias("n"))


def extract_updates(spark: SparkSession, sf: str) -> DataFrame:
    """What an update finds after new extracts came and one was written again."""
    work, lines = work_folder(spark), table(spark, sf, "lineitem")
    old = F.expr(YEAR) < _FIRST_YEARS
    root = _write(_people(lines.where(old), ".csv"), f"{work}/raw")
    update_table(spark, root, f"{work}/table", f"{work}/manifest")
    _write(_people(lines.where(~old), ".csv"), root)
    again = lines.where(spark_sql(PERIOD_TEXT) == _CHANGED).where("l_linenumber <= 2")
    _write(_people(again, ".csv"), root, "overwrite")
    done = update_table(spark, root, f"{work}/table", f"{work}/manifest")
    read = F.col("periodo_archivo").isin(*done.loaded)
    states = done.states.select("periodo_archivo", "archivo", "estado", read.alias("leido"))
    return states.join(period_counts(done.table, alias="filas"), "periodo_archivo")


def replaced_period(spark: SparkSession, sf: str) -> DataFrame:
    """One period of a table by period replaced, all others as they were."""
    path = f"{work_folder(spark)}/periods"
    prepared = survey_prepared(spark, sf)
    write_periods(prepared, path)
    some = prepared.where(F.col("periodo_archivo") == _REPLACED).where("edad < 40")
    done = write_periods(some.withColumn("salario_mensual", F.lit(1.0)), path)
    sums = done.table.groupBy("periodo_archivo").agg(
        F.count("*").alias("n"), F.round(F.sum("salario_mensual"), 2).alias("salarios")
    )
    return sums.withColumn("escrito", F.col("periodo_archivo").isin(*done.periods))


def study_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The quality tables of the whole study, from one pass over CSV extracts."""
    root = _extracts(spark, sf, ".csv")
    _, tables = load_and_audit(spark, root, work_folder(spark), PERIODS)
    long = [
        tables[name].select(
            F.lit(name).alias("tabla"), F.col(group).alias("grupo"), F.col(item).cast("string").alias("elemento"),
            *[F.col(c).alias(f"n{i}") for i, c in enumerate(counts)],
            *[F.lit(None).cast("long").alias(f"n{i}") for i in range(len(counts), 3)],
        )
        for name, (group, item, counts) in _TABLES.items()
    ]
    stacked = long[0]
    for rows in long[1:]:
        stacked = stacked.unionByName(rows)
    return settle(stacked)


#: (group, item, numbers) of each quality table.
_TABLES = {
    "missing_summary": ("conjunto", "variable", ["registros_totales", "faltantes"]),
    "filter_audit": ("conjunto", "paso", ["registros_antes", "registros_excluidos", "registros_despues"]),
    "prepared_counts_by_period": ("periodo_archivo", "periodo_archivo", ["filas_elegibles"]),
    "duplicate_key_audit": ("conjunto", "tipo", ["claves_duplicadas", "registros_en_claves_duplicadas"]),
}


def duplicate_across_periods(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of the last year that earlier years have too, found in a bucketed index."""
    raw = survey_raw(spark, sf)
    name = f"claves_{uuid.uuid4().hex}"
    index = KeyIndex(spark, name, f"{work_folder(spark)}/{name}", compared=_COMPARED, buckets=16)
    index.add(raw.where("conjunto = 'entrenamiento'"))
    return index.duplicates(raw.where("conjunto = 'holdout'"))


def selected_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Four fields under names of the caller's own, from CSV extracts with sixteen."""
    root = _extracts(spark, sf, ".csv")
    wanted = {"P05D01": "pago", "  NUM_HOGAR ": "hogar", "NUM_PERSONA": "persona", "L_EXTRA_1": "descuento"}
    rows = scan_extracts(spark, _paths(spark, root), selected=wanted, required=["P05D01", "L_EXTRA_1"]).table
    return _finite(rows.select("pago", "hogar", "persona", "descuento", "periodo_archivo"))


def renamed_audit(spark: SparkSession, sf: str) -> DataFrame:
    """The population filter over a table whose columns have other names."""
    names = {"edad": "anos", "salario_mensual": "pago", "ocupado": "trabaja"}
    raw = survey_raw(spark, sf).withColumnsRenamed(names)
    return apply_filters_with_audit(raw, names, by=["conjunto"])[1]


def report_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A report file of the counts by period, read again; a larger table is refused."""
    counts = period_counts(survey_prepared(spark, sf))
    with tempfile.TemporaryDirectory() as folder:  # reports are files of the driver
        target = write_small_table(counts, f"{folder}/counts.csv", max_rows=len(PERIODS))
        with open(target, encoding="utf-8-sig", newline="") as report:
            rows = [(r["periodo_archivo"], int(r["filas_elegibles"])) for r in csv.DictReader(report)]
    try:
        bounded(counts, max_rows=len(rows) - 1)
        refused = False
    except ValueError:
        refused = True
    table = table_from_rows(spark, rows, "periodo_archivo string, filas_elegibles long")
    return table.withColumn("mayor_rechazada", F.lit(refused))


_COMPARED = ("edad", "categoria_ocupacional", "dominio")


def loading_queries() -> dict[str, Query]:
    found = (
        load_csv_extracts, load_parquet_extracts, extract_headers, extract_bad_rows, extract_updates, replaced_period, study_quality,
        duplicate_across_periods, selected_columns, renamed_audit, report_round_trip,
    )
    return {f.__name__: f for f in found}


def _loaded(suffix: str) -> str:
    columns = _standard_columns().replace('"conjunto"', "").rstrip(", ")
    name = f"'{_FOLDER}=' || replace(archivo_origen, '.csv', '{suffix}') AS archivo_origen"
    return f"WITH {_PERSON} SELECT {columns.replace(chr(34) + 'archivo_origen' + chr(34), name)} FROM survey"


def _study_quality() -> str:
    tag = f"CASE WHEN periodo_archivo = '{_LAST}' THEN '{HOLDOUT}' ELSE '{TRAINING}' END"
    person = _PERSON.replace("SELECT *, antiguedad_anios", f"SELECT * REPLACE ({tag} AS conjunto), antiguedad_anios")
    parts = {
        "missing_summary": _missing_typed(),
        "filter_audit": _filter_audit(),
        "prepared_counts_by_period": f"WITH {_KEPT} SELECT periodo_archivo, count(*) AS filas_elegibles FROM kept GROUP BY 1",
        "duplicate_key_audit": f"""WITH {_PERSON}, d AS (SELECT conjunto, periodo_archivo, "NUM_HOGAR",
              "NUM_PERSONA", count(*) AS n, count(DISTINCT to_json(survey)) AS v
              FROM survey GROUP BY ALL HAVING count(*) > 1)
            SELECT conjunto, CASE WHEN v = 1 THEN 'exacto' ELSE 'conflictivo' END AS tipo,
              count(*) AS claves_duplicadas, CAST(sum(n) AS BIGINT) AS registros_en_claves_duplicadas
            FROM d GROUP BY ALL""",
    }
    tables = []
    for name, (group, item, counts) in _TABLES.items():
        numbers = [f"{c} AS n{i}" for i, c in enumerate(counts)]
        numbers += [f"NULL::BIGINT AS n{i}" for i in range(len(counts), 3)]
        sql = parts[name].replace(_PERSON, person)
        tables.append(
            f"SELECT '{name}' AS tabla, {group} AS grupo, CAST({item} AS VARCHAR) AS elemento, {', '.join(numbers)} FROM ({sql})"
        )
    return " UNION ALL ".join(tables)


def loading_oracles() -> dict[str, str]:
    period, quarter = _sql(PERIOD_TEXT), f"{QUARTER} % 2"
    file = f"'{_FOLDER}=' || {_sql(FILE_TEXT)}"
    return {
        "load_csv_extracts": _loaded(".csv"),
        "load_parquet_extracts": _loaded(".parquet"),
        "extract_headers": f"""SELECT DISTINCT {period} AS periodo, {file} AS archivo,
            CAST({len(_FIELDS) + len(_EXTRA)} AS BIGINT) AS columnas_originales, 'P99' AS columnas_faltantes,
            'ninguna' AS columnas_repetidas FROM lineitem WHERE {quarter} >= 0""",
        "extract_bad_rows": f"""SELECT {period} AS periodo_archivo,
            CASE WHEN l_linenumber IN (5, 6) THEN 'apartada' ELSE 'buena' END AS fila,
            CASE l_linenumber WHEN 5 THEN {len(_FIELDS) + 1} WHEN 6 THEN 9 ELSE {len(_FIELDS)} END AS celdas,
            count(*) AS n FROM lineitem GROUP BY ALL""",
        "extract_updates": f"""WITH f AS (SELECT {period} AS p, {YEAR} AS y, {file} AS a, l_linenumber FROM lineitem)
            SELECT p AS periodo_archivo, a AS archivo,
              CASE WHEN p = '{_CHANGED}' THEN 'cambiado' WHEN y < {_FIRST_YEARS} THEN 'igual' ELSE 'nuevo' END AS estado,
              p = '{_CHANGED}' OR y >= {_FIRST_YEARS} AS leido,
              count(*) FILTER (WHERE p <> '{_CHANGED}' OR l_linenumber <= 2) AS filas
            FROM f GROUP BY p, a, y""",
        "replaced_period": f"""WITH {_KEPT}, k AS (SELECT periodo_archivo AS p, edad,
              CASE WHEN periodo_archivo = '{_REPLACED}' THEN 1.0 ELSE salario_mensual END AS s FROM kept)
            SELECT p AS periodo_archivo, count(*) AS n, round(sum(s), 2) AS salarios, p = '{_REPLACED}' AS escrito
            FROM k WHERE p <> '{_REPLACED}' OR edad < 40 GROUP BY p""",
        "study_quality": _study_quality(),
        "selected_columns": f"""WITH {_PERSON}, l AS (SELECT *, row_number() OVER () AS r FROM survey),
            d AS (SELECT CAST(l_discount AS VARCHAR) AS descuento, row_number() OVER () AS r FROM lineitem)
            SELECT CASE WHEN isfinite(salario_mensual) THEN salario_mensual END AS pago, "NUM_HOGAR" AS hogar,
              "NUM_PERSONA" AS persona, descuento, periodo_archivo FROM l JOIN d USING (r)""",
        "renamed_audit": _filter_audit(),
        "report_round_trip": f"""WITH {_KEPT} SELECT periodo_archivo, count(*) AS filas_elegibles,
            true AS mayor_rechazada FROM kept GROUP BY periodo_archivo""",
        "duplicate_across_periods": f"""WITH {_PERSON}, v AS (SELECT *, CAST(row(edad, categoria_ocupacional, dominio) AS VARCHAR) AS x FROM survey),
            k AS (SELECT "NUM_HOGAR", "NUM_PERSONA", count(*) FILTER (conjunto = 'holdout') AS n_nuevos,
              count(*) FILTER (conjunto <> 'holdout') AS n_anteriores,
              min(periodo_archivo) FILTER (conjunto <> 'holdout') AS primer_periodo,
              CASE WHEN count(DISTINCT x) = 1 THEN 'exacto' ELSE 'conflictivo' END AS tipo FROM v GROUP BY 1, 2)
            SELECT * FROM k WHERE n_nuevos > 0 AND n_anteriores > 0""",
    }
