"""Parquet, report table and model sinks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Fixed value: largest table that may be written as a single report file.
MAX_ROWS = 10_000


def write_prepared(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("periodo_archivo",),
    expected_rows: int | None = None,
    rebalance: bool = False,
) -> DataFrame:
    """Overwrite a Parquet table, check its row count and return it.

    The rows are counted by the job that writes them, and the written table from its file
    footers; ``expected_rows`` is what an audit counted before. Reading the result back
    cuts the lineage of everything before it. ``rebalance`` gathers the rows of a period
    into files of a sensible size, for input that is not ordered by period; adaptive
    execution splits a period that is too large.
    """
    rows_out = df.hint("rebalance", *partition_by) if rebalance else df
    seen = Observation()
    counted = rows_out.observe(seen, F.count("*").alias("rows"))
    counted.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    # Period texts stay texts: the schema is given, not inferred from folders.
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    rows = seen.get["rows"] if expected_rows is None else expected_rows
    if written.count() != rows:
        raise AssertionError(f"{path} does not hold the {rows} rows written to it")
    return written.select(*df.columns)


@dataclass(frozen=True)
class PeriodsWritten:
    """A table by period, and what the last write put into it."""

    table: DataFrame
    periods: tuple[str, ...]
    rows: int


def write_periods(df: DataFrame, path: str, period: str = "periodo_archivo", rebalance: bool = False) -> PeriodsWritten:
    """Replaces the periods that ``df`` has in a Parquet table; all others stay.

    Files of a period are exchanged when all tasks have ended, so that a job that fails
    leaves the table as it was. The writing job counts its rows and lists its periods
    while the rows pass by, in the stage that writes them: the source is read once, and
    a task that is repeated counts once. The counts have to be those of the footers of
    the new files. Rows without a period are refused before anything is exchanged.
    """
    named = F.coalesce(F.col(period), F.raise_error(F.lit(f"a row has no {period}")).cast("string"))
    rows = df.withColumn(period, named)
    rows = rows.hint("rebalance", period) if rebalance else rows
    seen = Observation()
    counted = rows.observe(seen, F.count("*").alias("rows"), F.collect_set(period).alias("periods"))
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(period).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
    n, periods = seen.get["rows"], tuple(sorted(seen.get["periods"]))  # one name for each folder
    if table.where(F.col(period).isin(*periods)).count() != n:
        raise AssertionError(f"{path} does not hold the {n} rows written to it")
    return PeriodsWritten(table, periods, n)


def bounded(df: DataFrame, max_rows: int = MAX_ROWS):
    """Small result as a pandas table; a larger one is an error, never cut."""
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    table = df.limit(max_rows + 1).toPandas()
    if len(table) > max_rows:
        raise ValueError(f"the table has more than {max_rows} rows")
    return table


def write_small_table(df: DataFrame, destination: str | Path, *, max_rows: int = MAX_ROWS) -> Path:
    """One CSV report file (header, UTF-8 with BOM) of a bounded table."""
    table = bounded(df, max_rows)
    target = Path(destination)
    target.parent.mkdir(parents=True, exist_ok=True)
    table.to_csv(target, index=False, encoding="utf-8-sig")
    return target


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite a fitted pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def table_from_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small result table with an explicit schema and column order."""
    return spark.createDataFrame(list(rows), schema)
