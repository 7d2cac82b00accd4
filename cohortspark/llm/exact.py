"""Exact duplicates of whole texts by an extendible-hash index on shared files.

`build_index` gives every distinct text an entry. Copies are combined where they are
read and compared byte by byte when they meet. The entries go to buckets of a directory
over the leading hash bits: the directory doubles until no bucket holds more than
`capacity` entries, and only overfull buckets split. Texts of the same hash are chained
within their bucket. The index is written in ranges of buckets to the shared folder.

Cases: very long texts are hashed and compared whole, byte by byte; a null text counts as empty, and empty texts are equal; of equal texts the
largest id stays, a null id only if there is no other; rows that repeat both id and
text are one document (`probe` marks all of them as kept, `keep_one` returns one); an
empty table gives an empty result; other columns are carried along, and those with
names of this module's results are replaced in `probe`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import free_name, text_of, written

#: Deepest directory: 2^24 slots. A bucket that is still overfull has longer chains.
DEEPEST = 24


def _hash(text: Column) -> Column:
    return F.xxhash64(text)


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _slot(h: Column, depth: int) -> Column:
    return F.shiftrightunsigned(h, 64 - depth)


def directory(entries: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for each slot in use, and the global depth."""
    leaves = entries.groupBy(_slot(F.col("h"), DEEPEST).alias("leaf")).agg(F.count("*").alias("n"))
    leaves = written(leaves, "leaves")
    total = leaves.agg(F.sum("n")).first()[0] or 0
    depth = min(DEEPEST, max(1, int(math.log2(max(1, total / capacity)))))
    buckets, rest = None, leaves
    while True:
        prefix = F.shiftrightunsigned("leaf", DEEPEST - depth)
        sums = rest.groupBy(prefix.alias("prefix")).agg(F.sum("n").alias("n"))
        fits = F.col("n") <= (capacity if depth < DEEPEST else F.lit(2**62))
        level = written(sums.select("prefix", F.lit(depth).alias("depth"), fits.alias("fits")), "level")
        full = level.where("fits").drop("fits")
        buckets = full if buckets is None else buckets.unionByName(full)
        over = level.where("not fits")
        if over.isEmpty():
            break
        rest = rest.join(over.select(F.col("prefix").alias("_p")), prefix == F.col("_p"), "leftsemi")
        depth += 1
    low = F.shiftleft("prefix", 0)
    slots = buckets.select(
        F.explode(
            F.expr(
                f"sequence(prefix * shiftleft(1L, {depth} - depth),"
                f" (prefix + 1) * shiftleft(1L, {depth} - depth) - 1)"
            )
        ).alias("slot"),
        (low * F.expr(f"shiftleft(1L, {DEEPEST} - depth)")).alias("bucket"),
        "depth",
    )
    return written(slots, "directory"), depth


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096
) -> tuple[DataFrame, DataFrame, int]:
    """The index files, the directory and its depth.

    Index rows: bucket, h, chain (place in the chain of a hash), sha (digest), n_chars,
    group_size, keep_id.
    """
    text = text_of(text_col)
    copies = docs.select(_hash(text).alias("h"), text.alias("t"), F.col(id_col).alias("id"))
    entries = copies.groupBy("h", "t").agg(F.count("*").alias("group_size"), F.max("id").alias("keep_id"))
    entries = written(
        entries.select("h", _digest(F.col("t")).alias("sha"), F.length("t").alias("n_chars"), "group_size", "keep_id"),
        "entries",
    )
    slots, depth = directory(entries, capacity)
    chained = (
        entries.withColumn("slot", _slot(F.col("h"), depth))
        .join(slots.drop("depth"), "slot")
        .withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "h").orderBy("sha")))
    )
    index = chained.select("bucket", "h", "chain", "sha", "n_chars", "group_size", "keep_id")
    index = index.repartitionByRange("bucket", "h").sortWithinPartitions("bucket", "h", "chain")
    return written(index, "index"), slots, depth


def _found(docs: DataFrame, h: str, sha: str, built: tuple[DataFrame, DataFrame, int]) -> DataFrame:
    """Rows with `_keep` and `_size` of their text, by directory, bucket and chain."""
    index, slots, depth = built
    entry = index.select(
        F.col("bucket").alias("_bucket"), F.col("h").alias("_h"), F.col("sha").alias("_sha"),
        F.col("keep_id").alias("_keep"), F.col("group_size").alias("_size"),
    )
    slot = slots.select(F.col("slot").alias("_slot"), F.col("bucket").alias("_own"))
    return (
        docs.join(slot, _slot(F.col(h), depth) == F.col("_slot"))
        .join(entry, (F.col("_own") == F.col("_bucket")) & (F.col(h) == F.col("_h")) & (F.col(sha) == F.col("_sha")))
        .drop("_slot", "_own", "_bucket", "_h", "_sha")
    )


def probe(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096
) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256."""
    built = build_index(docs, id_col, text_col, capacity)
    text = text_of(text_col)
    keys = docs.select(F.col(id_col).alias("_id"), _hash(text).alias("_key"), _digest(text).alias("_digest"))
    return _found(keys, "_key", "_digest", built).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096
) -> DataFrame:
    """The rows that stay, one for each distinct text, with their own columns."""
    built = build_index(docs, id_col, text_col, capacity)
    h, sha = free_name(docs, "_key", "_digest")
    text = text_of(text_col)
    keyed = docs.withColumns({h: _hash(text), sha: _digest(text)})
    kept = _found(keyed, h, sha, built).where(F.col(id_col).eqNullSafe(F.col("_keep")))
    return kept.dropDuplicates([h, sha]).select(*docs.columns)
