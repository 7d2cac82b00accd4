"""Importance resampling of documents towards the word n-grams of target texts.

A table of 256 bytes lower-cases A-Z and blanks every byte that separates words; letters,
digits and all bytes of other scripts stay, so that UTF-8 needs no decoding. bytes.split
yields the words. The crc32 of a run of words seeds that of the run with one word more:
crc32(b" " + word, crc32(run)) is the checksum of the joined words. Checksums modulo the
number of buckets are counted: Counters in the tasks, of one entry for each bucket at
most, then sums of the tasks' counts. A bucket's gain compares target and source, a
document's weight is the sum of its features' gains, and a keyed Gumbel number added to it
turns the highest scores into a sample without replacement.

The gains are a list of one number for each bucket, which is all that tasks are given.
Texts are read in slices, so that a long text needs little more than itself. Ranks come
from sorted ranges and their counts; only ids and scores are shuffled.

Cases: null and empty texts, and texts without words, have no features and weight 0, and
are never drawn unless `min_words` is 0; a null id is hashed as the empty text and comes
last among equal scores; rows that repeat an id share its Gumbel number, and rows alike in
id and score get their ranks in any order; empty tables give an empty result, an empty
target compares with no features at all; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import gapless, ship, written

BUCKETS = 10_000
WIDEST = 3
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
#: Lower-cases A-Z; what separates words becomes a blank.
TABLE = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_SLICE = 1 << 18


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words in lists, of a slice of the text each."""
    low = 0
    while low < len(text):
        part = text[low : low + _SLICE].translate(TABLE)
        high = low + len(part)
        if high < len(text):
            # a word cut by the slice's end belongs to the next slice, or is read to its end
            cut = part.rfind(b" ") + 1
            if cut:
                part, high = part[:cut], low + cut
            else:
                while high < len(text) and not part.endswith(b" "):
                    more = text[high : high + _SLICE].translate(TABLE)
                    stop = more.find(b" ") + 1 or len(more)
                    part, high = part + more[:stop], high + stop
        low = high
        found = part.split()
        if found:
            yield found


def checksums(text: bytes, widest: int = WIDEST) -> Iterator[tuple[int, list[int]]]:
    """(number of words, checksums of all their runs), slice by slice.

    A slice has the runs that end in it; the checksums of the runs that end with the last
    word are kept for the next slice.
    """
    open_: list[int] = []  # of the runs of 1, 2, ... words that end with the last word
    for words in words_of(text):
        out = runs = list(map(crc32, words))
        kept = [runs[-1]]
        joined = [b" " + w for w in words]
        for width in range(2, widest + 1):
            before = ([open_[width - 2]] if len(open_) > width - 2 else []) + runs[:-1]
            # shorter runs than words: those that would start before the text are missing
            runs = list(map(crc32, joined[len(joined) - len(before) :], before))
            if not runs:
                break
            out = out + runs
            kept.append(runs[-1])
        open_ = kept
        yield len(words), out


def _texts(batch: pa.RecordBatch, at: int) -> list[bytes | None]:
    return batch.column(at).cast(pa.large_binary()).to_pylist()


def feature_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for batch in batches:
            for text in _texts(batch, 0):
                for _, found in checksums(text or b""):
                    counts.update((np.array(found, dtype=np.uint32) % buckets).tolist())
        columns = [pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "n"])

    ship(texts.sparkSession)
    partial = texts.select(F.col(text_col).cast("string")).mapInArrow(counted, "bucket int, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The gain of every bucket, from (bucket, n) of the source and of the target."""
    sides = source.select("bucket", "n", F.lit(0).alias("of_target")).unionByName(
        target.select("bucket", "n", F.lit(1).alias("of_target"))
    )
    counts = {(row["of_target"], row["bucket"]): row["n"] for row in sides.collect()}  # two for each bucket
    s, t = ([counts.get((side, b), 0) for b in range(buckets)] for side in (0, 1))
    s_all, t_all = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(1000 * math.log((b + 1.0) * s_all / ((a + 1.0) * t_all))) for a, b in zip(s, t, strict=True)]


def gumbel(doc_id: int | None, seed: int) -> int:
    """Thousandths of a standard Gumbel number that id and seed choose."""
    name = f"{seed}:{'' if doc_id is None else doc_id}".encode()
    h = int(hashlib.sha256(name).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(
    docs: DataFrame, gain: list[int], id_col: str = "doc_id", text_col: str = "text", seed: int = 42
) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every document."""
    table = np.array(gain, dtype=np.int64)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch, 1), strict=True):
                n_words = n_features = weight = 0
                for n, found in checksums(text or b""):
                    n_words += n
                    n_features += len(found)
                    weight += int(table[np.array(found, dtype=np.uint32) % len(table)].sum())
                out.append((n_words, n_features, weight, weight + gumbel(doc_id, seed)))
            numbers = zip(*out, strict=True) if out else [[]] * 4
            columns = [batch.column(0), *(pa.array(list(c), pa.int64()) for c in numbers)]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_features", "weight", "score"])

    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(scored, f"`{id_col}` long, n_words long, n_features long, weight long, score long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 5,
    min_words: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    seed: int = 42,
) -> DataFrame:
    """Every document with `rank`: 1 for the first drawn, null where not drawn.

    `percent` of the documents with at least `min_words` words are drawn.
    """
    gain = gains(feature_counts(docs, text_col, buckets), feature_counts(target, text_col, buckets), buckets)
    rows = written(weighed(docs, gain, id_col, text_col, seed), "weighed")
    able = rows.where(F.col("n_words") >= min_words)
    drawn = percent * able.count() // 100
    placed = gapless(able, [F.desc("score"), F.col(id_col).asc_nulls_last()], "rank")
    ranked = placed.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    rest = rows.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(id_col, "n_features", "weight", "score", "rank")
