"""What the operators of this subpackage share: written tables, indexes, components."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortspark import session

#: A word: a run of anything but ASCII white space.
WORD = "[^\\x20\\x09-\\x0D]+"
#: After so many written tables the driver collects its garbage.
_TABLES = 4
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which all executors share.

    Only a local session, whose driver is its one executor, may do without it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nobody else writes to it."""
    return f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """The rows as a Parquet table in the shared folder: later stages start from there,
    also after executors are lost, and every reader sees the same rows.

    With `drop_shuffles` the shuffle files of the job go when it ends, as nothing reads
    them after the table is there; `df` itself should not be run again.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, str(drop_shuffles or before == "true").lower())
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    context = spark.sparkContext
    context._cohortspark_tables = getattr(context, "_cohortspark_tables", 0) + 1
    if context._cohortspark_tables % _TABLES == 0:
        free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Gives this package to the executors' Python workers, once for each session.

    Batches of texts for Python are made smaller, unless the session has chosen their
    size: several copies of a batch exist at a time in each worker.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, "1000")
    session.ship(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files and broadcasts of plans that nobody holds any more,
    which it does when the driver happens to collect its garbage. The driver's heap shrinks
    to what is in use; left alone, loops of small jobs let it grow to its limit."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Column names for own use that do not clash with those of the frame."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words, found as the places where a word starts."""
    plain = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.when(F.trim(plain) == "", 0).otherwise(
        F.size(F.split(F.trim(plain), " +"))
    ).cast("long")


def gapless(df: DataFrame, order: list[Column], index: str) -> DataFrame:
    """Numbers the rows from 0 in the given order, without one task seeing them all.

    The sorted rows are written once; the first number of each range comes from the
    ranges' counts, of which there are as many as partitions.
    """
    part, pos, first = free_name(df, "part", "pos", "first")
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumns(
        {
            part: F.spark_partition_id(),
            pos: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    placed = written(placed, "sorted")
    counts = placed.groupBy(part).agg(F.count("*").alias(first))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(part, F.coalesce(F.sum(first).over(before), F.lit(0)).alias(first))
    return (
        placed.join(counts, part)
        .withColumn(index, F.col(first) + F.col(pos))
        .drop(part, pos, first)
    )


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex that has an edge in (a, b) of longs.

    Each round lets every vertex point to its smallest neighbour, follows the pointers
    to their ends, and contracts the edges to those ends. At least half of the vertices
    go in each round. The component is its smallest vertex. All steps are joins and
    minima with a combine before the shuffle, so a vertex with very many edges is no
    group of one task. Self edges and repeated edges do no harm; no edges, no rows.
    """
    spark = edges.sparkSession
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(edges.distinct(), "edges")
    found: DataFrame | None = None
    while not edges.isEmpty():
        ends = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tree = ends.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("low"))
        tree = _followed(written(tree.select("vertex", F.least("vertex", "low").alias("root")), "tree"))
        a = tree.select(F.col("vertex").alias("a"), F.col("root").alias("ra"))
        b = tree.select(F.col("vertex").alias("b"), F.col("root").alias("rb"))
        edges = edges.join(a, "a").join(b, "b").where("ra <> rb")
        edges = edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        edges = written(edges.distinct(), "edges")
        if found is None:
            found = tree
        else:
            step = tree.select(F.col("vertex").alias("root"), F.col("root").alias("next"))
            found = found.join(step, "root", "left")
            found = written(
                found.select("vertex", F.coalesce("next", "root").alias("root")), "found"
            )
    if found is None:
        return spark.createDataFrame([], "vertex long, component long")
    return found.withColumnRenamed("root", "component")


def _followed(tree: DataFrame) -> DataFrame:
    """Pointers to the ends of their chains, by doubling."""
    while True:
        up = tree.select(F.col("vertex").alias("root"), F.col("root").alias("next"))
        longer = written(
            tree.join(up, "root").select("vertex", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")),
            "pointers",
        )
        moved = longer.where("moved").isEmpty()
        tree = longer.select("vertex", "root")
        if moved:
            return tree


def labelled(rows: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """Adds `component_id`: of the key's component, or the key itself without one."""
    return rows.join(
        groups.select(F.col("vertex").alias(key), F.col("component")), key, "left"
    ).withColumn("component_id", F.coalesce("component", key)).drop("component")


#: Bits of the filter in `thinned`: 512 bitmaps of 4096 bytes, 2 MB, whatever the data.
_FILTER_BITS, _BITMAP = 1 << 24, 1 << 15


def thinned(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in the one column of `wanted`, and some others.

    A bitmap of fixed size over hashes of the wanted keys is broadcast, so that a join
    that follows need not shuffle the rest. With more wanted keys than bits all rows
    pass; results do not depend on it.
    """

    def spot(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(_FILTER_BITS))

    name = wanted.columns[0]
    bits = wanted.select(spot(F.col(name)).alias("spot"))
    bits = bits.groupBy(F.expr(f"spot div {_BITMAP}").alias("_bitmap"))
    bits = written(bits.agg(F.bitmap_construct_agg(F.col("spot") % _BITMAP).alias("_bits")), "bits")
    at = spot(F.col(key)) % _BITMAP
    byte = F.conv(F.hex(F.substring("_bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(bits), F.floor(spot(F.col(key)) / _BITMAP) == F.col("_bitmap"))
    is_set = F.shiftrightunsigned(byte, 0).bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0
    return found.where(is_set).select(*rows.columns)
