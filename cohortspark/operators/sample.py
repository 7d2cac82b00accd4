"""Hash splits and bounded samples that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..presets import LABOUR_SURVEY
from ..spec import require_columns
from .segment import SEED

#: Fixed value: size of the published samples.
SAMPLE_ROWS = 5_000
_GROUPS = 256  # of tasks, in the first step of a sample


def _identity(keys: Sequence[str], seed: int) -> Column:
    # Separator and null marker of the hashed identity.
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("<NULO>")) for k in keys]
    return F.sha2(F.concat_ws("¦", F.lit(str(seed)), *parts), 256)


def hash_unit(keys: Sequence[str], seed: int = SEED) -> Column:
    """Uniform number in [0, 1) that depends on the keys and the seed only."""
    head = F.conv(F.substring(_identity(keys, seed), 1, 8), 16, 10).cast("long")
    return head / F.lit(float(1 << 32))


def hash_split(
    df: DataFrame,
    keys: Sequence[str] = LABOUR_SURVEY.keys,
    fraction: float = 0.8,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """``(train, validation)``: rows of one key always stay together.

    Unlike a seeded random split the result is the same for any partitioning and
    after lost executors.
    """
    require_columns(df, keys, "hash_split")
    unit = hash_unit(keys, seed)
    return df.where(unit < fraction), df.where(unit >= fraction)


def _first_by(df: DataFrame, order: Sequence[Column], max_rows: int) -> DataFrame:
    """First rows in a total order, in one scan and always by two levels.

    Each task passes on its first rows only, these are cut down in groups of tasks,
    and what the groups leave meets in the final step.
    """
    group = Window.partitionBy("__group").orderBy(*order)
    return (
        df.withColumn("__group", F.spark_partition_id() % _GROUPS)
        .withColumn("__place", F.row_number().over(group))
        .where(F.col("__place") <= max_rows)
        .drop("__group", "__place")
        .orderBy(*order)
        .limit(max_rows)
    )


def deterministic_sample(
    df: DataFrame,
    *,
    max_rows: int = SAMPLE_ROWS,
    seed: int = SEED,
    key_columns: Sequence[str] = LABOUR_SURVEY.keys,
) -> DataFrame:
    """The ``max_rows`` rows with the smallest hash of seed and keys."""
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    require_columns(df, key_columns, "deterministic_sample")
    hashed = df.withColumn("__digest", _identity(key_columns, seed))
    order = [F.col("__digest"), *[F.col(k).cast("string") for k in key_columns]]
    return _first_by(hashed, order, max_rows).drop("__digest")


def random_sample(df: DataFrame, max_rows: int, seed: int = SEED) -> DataFrame:
    """Seeded random rows, for exploration; depends on the partitioning.

    The numbers are drawn once, in the job that returns the rows.
    """
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    drawn = df.withColumn("__u", F.rand(seed))
    return _first_by(drawn, [F.col("__u")], max_rows).drop("__u")


def random_rows_of_files(reader: DataFrame, max_rows: int, seed: int = SEED) -> DataFrame:
    """Random rows of a table of Parquet files, the same for any partitioning.

    The number of a row comes from the seed, the name of its file and its place in it, so
    that rows need no key and repeated rows are drawn one by one. ``reader`` has to be the
    files' own scan.
    """
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    place = reader.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    drawn = place.withColumn("__u", _identity(["__file", "__row"], seed))
    return _first_by(drawn, [F.col("__u"), F.col("__file"), F.col("__row")], max_rows).drop("__u", "__file", "__row")
