"""A corpus from raw documents: filtered, deduplicated, mixed and encoded.

Each stage takes (spark, docs, sf_dir) and returns a frame; it is written as Parquet and
read again as the next stage's docs. All stages but the last return the columns of docs.

Cases: null and empty texts go through every stage like other texts (the exact stage
keeps one of them); ids identify rows: rows that repeat an id stay or go together, and
are taken equally often by the mixture; empty tables stay empty; further columns are
carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import exact, mixture, ngram_join, pieces, quality
from cohortspark.llm.common import free_name, text_of, word_count, written
from cohortspark.llm.queries import PIECES, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the row with the largest id."""
    return exact.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies keeps the document with the smallest id."""
    groups = ngram_join.jaccard_components(docs)
    gone = groups.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "leftanti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that sources have weights 3, 1, 2 in turn and
    together 150% of the words."""
    copies, key = free_name(docs, "copies", "key")
    sized = written(docs.select("doc_id", "source", word_count(text_of()).alias("size")), "sized")
    mixed = mixture.mix_by_weights(sized, "doc_id", (3, 1, 2), 1.5, 2.0)
    times = mixed.groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    rows = docs.join(times, docs["doc_id"].eqNullSafe(F.col(key)))
    repeated = rows.withColumn(copies, F.explode(F.array_repeat(F.lit(1), F.col(copies))))
    return repeated.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of the pieces, and their number."""
    codec = pieces.Codec(spark, PIECES)
    coded = docs.withColumn("token_ids", codec.encode(F.col("text")))
    return coded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("source mixture", mix_sources),
    ("piece encoding", encode),
]

#: SQL cannot express the classifier, the rounding of the mixture, or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
