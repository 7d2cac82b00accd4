"""Loading what is new: a manifest of the extracts loaded before, kept next to the table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.relational import settle
from ..presets import LABOUR_SURVEY
from ..spec import DatasetSpec
from .extracts import find_person_files, scan_extracts
from .sinks import write_periods

NEW, CHANGED, SAME, GONE = "nuevo", "cambiado", "igual", "ausente"

_STORED = "path string, archivo string, periodo_archivo string, length long, partes long, modificado timestamp, huella long"
_VERSIONS = f"{_STORED}, version int"
_NAMES = [c.split()[0] for c in _STORED.split(", ")]


def _versions(spark: SparkSession, store: str) -> DataFrame:
    """All versions of a manifest; its folder is made where there is none yet."""
    spark.createDataFrame([], _VERSIONS).write.mode("append").partitionBy("version").parquet(store)
    return spark.read.schema(_VERSIONS).parquet(store)


def read_manifest(spark: SparkSession, store: str) -> DataFrame:
    """The extracts of the last version of a manifest; none when there is no manifest."""
    versions = _versions(spark, store)
    last = versions.agg(F.max("version")).first()[0]  # from the folders' names
    return versions.where(F.col("version") == F.lit(last)).select(*_NAMES)


def write_manifest(extracts: DataFrame, store: str) -> int:
    """Adds a version of the manifest, one file; returns its number.

    Earlier versions stay, so a version that was not finished does no harm.
    """
    last = _versions(extracts.sparkSession, store).agg(F.max("version")).first()[0] or 0
    one = extracts.select(*_NAMES).coalesce(1).withColumn("version", F.lit(last + 1))
    one.write.mode("append").partitionBy("version").parquet(store)
    return last + 1


def compare_extracts(found: DataFrame, before: DataFrame) -> DataFrame:
    """(path, archivo, periodo_archivo, estado): extracts found now against those before.

    An extract is unchanged when none of its parts has another name, length or time.
    """
    old = before.select(F.col("path").alias("__path"), F.col("archivo").alias("__archivo"),
                        F.col("periodo_archivo").alias("__periodo"), F.col("huella").alias("__huella"),
                        F.col("length").alias("__length"), F.col("partes").alias("__partes"))
    both = found.join(old, F.col("path") == F.col("__path"), "full")
    same = (F.col("huella") == F.col("__huella")) & (F.col("length") == F.col("__length")) & (F.col("partes") == F.col("__partes"))
    state = (
        F.when(F.col("path").isNull(), F.lit(GONE))
        .when(F.col("__path").isNull(), F.lit(NEW))
        .otherwise(F.when(same, F.lit(SAME)).otherwise(F.lit(CHANGED)))
    )
    return both.select(
        F.coalesce("path", "__path").alias("path"),
        F.coalesce("archivo", "__archivo").alias("archivo"),
        F.coalesce("periodo_archivo", "__periodo").alias("periodo_archivo"),
        state.alias("estado"),
    )


@dataclass(frozen=True)
class Update:
    """What an update found and did."""

    states: DataFrame
    table: DataFrame | None
    bad_rows: DataFrame | None
    loaded: tuple[str, ...]
    rows: int


def update_table(
    spark: SparkSession, roots: str | Sequence[str], table: str, store: str, spec: DatasetSpec = LABOUR_SURVEY, **options
) -> Update:
    """Loads the periods whose extract is new or changed into a table by period.

    Only their files are read. Extracts that are gone are reported and their periods stay
    in the table; two extracts of one period are an error. The manifest gets its next
    version when the rows are in the table: an update that fails is done again by the
    next one, which replaces the same periods.
    """
    found = find_person_files(spark, roots, naming=spec.naming)
    found = settle(found.where("status = 'ok'").select(*_NAMES))
    twice = found.groupBy("periodo_archivo").count().where("count > 1").select("periodo_archivo").limit(20).collect()
    if twice:
        raise ValueError(f"more than one extract for {', '.join(sorted(r[0] for r in twice))}")
    states = settle(compare_extracts(found, read_manifest(spark, store)))
    wanted = states.where(F.col("estado").isin(NEW, CHANGED)).select("path").collect()  # one for each extract
    if not wanted:
        if not states.where(F.col("estado") == GONE).isEmpty():
            write_manifest(found, store)
        return Update(states, None, None, (), 0)
    loaded = scan_extracts(spark, [r["path"] for r in wanted], spec=spec, required=spec.source_columns, **options)
    written = write_periods(loaded.table, table, spec.period)
    write_manifest(found, store)
    return Update(states, written.table, loaded.bad_rows, written.periods, written.rows)
