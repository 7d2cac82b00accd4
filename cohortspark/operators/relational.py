"""Small relational building blocks used by several operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which null keys match, keeping one copy of the keys.

    No strategy is forced; adaptive execution picks it from measured sizes and
    splits skewed partitions.
    """
    renamed = {k: f"__right_{k}" for k in keys}
    other = right.select(
        *[F.col(c).alias(renamed.get(c, c)) for c in right.columns]
    )
    condition = None
    for key, twin in renamed.items():
        test = F.col(key).eqNullSafe(F.col(twin))
        condition = test if condition is None else condition & test
    joined = left.join(other, condition, how)
    return joined if how == "left_semi" else joined.drop(*renamed.values())


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only a local session may lack one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="cohortspark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Evaluate a derived table once: written to the shared folder and read again.

    Later plans start from the files, whose size the planner knows, and so do stages
    that are repeated after an executor was lost. The rows have no order.
    """
    path = f"{shared_folder(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Input of costly work, in as many partitions as ``cohortspark.inputPartitions``.

    Without that setting the input stays as its files split it, which suits large
    tables; the setting is for inputs of a few unsplittable files.
    """
    wanted = df.sparkSession.conf.get("cohortspark.inputPartitions", None)
    return df.repartition(int(wanted)) if wanted else df


@contextmanager
def kept(*frames: DataFrame):
    """Frames that ML iterates over, held in memory or on disk, then released."""
    held = [spread(df).persist(StorageLevel.MEMORY_AND_DISK) for df in frames]
    try:
        yield held
    finally:
        for df in held:
            df.unpersist()


def with_share(
    counts: DataFrame, within: Sequence[str], alias: str, total: str | None = None, n: str = "n"
) -> DataFrame:
    """Adds the percentage of ``n`` within groups of already counted rows.

    The totals come from a second aggregate joined back, not from a window, so a group
    with very many categories never lands in a single task. Both read one exchange.
    """
    name = total or "__total"
    if within:
        totals = counts.groupBy(*within).agg(F.sum(n).alias(name))
        joined = null_safe_join(counts, totals, within)
    else:
        joined = counts.withColumn(name, counts.agg(F.sum(n).cast("long")).scalar())
    shared = joined.withColumn(alias, percent(F.col(n), F.col(name)))
    return shared if total else shared.drop(name)


def long_form(
    df: DataFrame, values: dict[str, Column], keep: Sequence[str], variable: str, value: str
) -> DataFrame:
    """One row per (input row, named value), built inside a single scan."""
    items = [
        F.struct(F.lit(name).alias(variable), column.alias(value))
        for name, column in values.items()
    ]
    return df.select(*keep, F.inline(F.array(*items)))


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole, null for an empty whole."""
    return F.when(whole > 0, F.lit(100.0) * part / whole)
