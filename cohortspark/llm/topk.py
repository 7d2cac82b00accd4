"""Exact search for the vectors with the largest integer inner products.

Components become floor(256 * x). A vector is cut into 1, 4 and 16 segments; each has a
mean and a deviation. For two vectors the squared distance is at least the sum over
segments of length * ((mean - mean')^2 + (deviation - deviation')^2), and with both norms
known a lower bound of the distance is an upper bound of the inner product, which is

    sum of length * (mean * mean' + deviation * deviation').

Queries and candidates are dealt into blocks of bounded size, and every pair of blocks is
a group of its own, so that a task holds two blocks whatever the table's size. In a group
the bounds are taken coarse to fine, each for what the one before left, against the score
that the query has for certain at its rank k; exact products are computed for survivors.
Of every group each query keeps its k best, and the best of these are the result. The work
and the copies of blocks grow with queries times candidates, as the search asks for; each
block of up to 65,536 vectors is copied once for each block of the other side.

Cases: vectors that are null or empty or hold null or non-finite components (also after
the multiplication), and rows without an id, take no part; vectors of other length than
the query's are no candidates; a row that repeats a query's id is a row of its own and so
its candidate, and each repeated query row has a result of its own; equal scores go to the
smaller id; scores beyond the range of a long are cut to its ends and then equal; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import ship, written

SCALE = 256
SEGMENTS = (1, 4, 16)
BLOCK = 1 << 16
#: Vectors in one step of a group, on either side.
_QUERIES, _CANDIDATES = 256, 4096
_EXACT = float(1 << 53)
_LONG = np.iinfo(np.int64)


def scaled_integers(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column) -> DataFrame:
    """(row, vec_id, is_query, dim, v): usable vectors, v being their integers as doubles.

    Integers within two bytes take two bytes each, all others eight.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            sizes = np.diff(np.asarray(column.offsets))
            values = np.asarray(column.flatten().fill_null(float("nan")), dtype=np.float64)
            with np.errstate(over="ignore"):
                values = np.floor(SCALE * values)
            out, keep, at = [], [], 0
            for i, size in enumerate(sizes):
                v = values[at : at + size]
                at += size
                if size and np.isfinite(v).all():
                    narrow = np.abs(v).max() < 1 << 15
                    out.append(v.astype("<i2" if narrow else "<f8").tobytes())
                    keep.append(i)
            kept = batch.select(["row", "vec_id", "is_query"]).take(pa.array(keep, pa.int64()))
            dim = pa.array(sizes[keep] if keep else [], pa.int32())
            yield pa.RecordBatch.from_arrays([*kept.columns, dim, pa.array(out, pa.binary())], [*kept.schema.names, "dim", "v"])

    ship(vectors.sparkSession)
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("vec_id"),
        is_query.alias("is_query"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    return rows.mapInArrow(packed, "row long, vec_id long, is_query boolean, dim int, v binary")


def unpacked(vectors: pd.Series, dim: int) -> np.ndarray:
    """The packed vectors as rows of doubles."""
    out = np.empty((len(vectors), dim))
    wide = np.array([len(v) != 2 * dim for v in vectors], dtype=bool)
    for code, rows in (("<i2", ~wide), ("<f8", wide)):
        if rows.any():
            out[rows] = np.frombuffer(b"".join(vectors[rows]), dtype=code).reshape(-1, dim)
    return out


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, times the root of its length: the inner
    product of two such rows is the bound of the vectors' inner product."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    length = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / length
    rest = x - np.repeat(mean, length, axis=1)
    deviation = np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1))
    return np.hstack([mean * np.sqrt(length), deviation])


def _products(q: np.ndarray, v: np.ndarray, limit: float) -> np.ndarray:
    """Exact inner products: as doubles while all sums are below 2^53, else as ints."""
    if limit < _EXACT:
        return q @ v.T
    whole = [[int(c) for c in row] for row in v]
    return np.array([[sum(map(int.__mul__, map(int, a), b)) for b in whole] for a in q], dtype=object)


class _Best:
    """The k best (score, id, row) of one query, and the score that rank k has for certain."""

    def __init__(self, k: int):
        self.k, self.found, self.floor = k, [], -np.inf

    def add(self, scores, ids, rows) -> None:
        cut = (max(_LONG.min, min(_LONG.max, int(s))) for s in scores)
        merged = self.found + [(-s, int(i), int(r)) for s, i, r in zip(cut, ids, rows, strict=True)]
        self.found = sorted(merged)[: self.k]
        if len(self.found) == self.k:
            self.floor = np.nextafter(float(-self.found[-1][0]), -np.inf)


def search_block(queries: pd.DataFrame, candidates: pd.DataFrame, dim: int, k: int) -> Iterator[tuple]:
    """(query row, query id, vec_id, row, score) of the k best of each query in a pair of blocks."""
    with np.errstate(over="ignore", invalid="ignore"):
        yield from _search_block(queries, candidates, dim, k)


def _search_block(queries: pd.DataFrame, candidates: pd.DataFrame, dim: int, k: int) -> Iterator[tuple]:
    q, v = unpacked(queries["v"], dim), unpacked(candidates["v"], dim)
    levels = [(segment_statistics(q, s), segment_statistics(v, s)) for s in SEGMENTS]
    size_q, size_v = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
    (q_row, q_id), (v_row, v_id) = ((x["row"].to_numpy(), x["vec_id"].to_numpy()) for x in (queries, candidates))
    best = [_Best(k) for _ in range(len(q))]
    # long candidates first: what they score lets the bounds drop most of the others
    order = np.argsort(-size_v, kind="stable")
    for low in range(0, len(order), _CANDIDATES):
        step = order[low : low + _CANDIDATES]
        for first in range(0, len(q), _QUERIES):
            a, b = np.arange(first, min(first + _QUERIES, len(q))), step
            for of_q, of_v in levels:
                floor = np.array([best[i].floor for i in a])[:, None]
                slack = 1e-9 * size_q[a][:, None] * size_v[b] + 0.5
                open_ = ~(of_q[a] @ of_v[b].T + slack < floor)  # also where a bound is no number
                a, b = a[open_.any(axis=1)], b[open_.any(axis=0)]
            if not len(a) or not len(b):
                continue
            limit = float(size_q[a].max() * size_v[b].max())
            scores = _products(q[a], v[b], limit)
            floor = [best[i].floor for i in a]
            for i, found, least in zip(a, scores, floor, strict=True):
                hits = np.flatnonzero((found >= least) & (v_row[b] != q_row[i]))
                if len(hits) > k and limit < _EXACT:  # the k best and their ties
                    edge = np.sort(found[hits])[-k]
                    hits = hits[found[hits] >= edge]
                if len(hits):
                    best[i].add(found[hits], v_id[b[hits]], v_row[b[hits]])
    for i, one in enumerate(best):
        for negative, vec_id, row in one.found:
            yield q_row[i], q_id[i], vec_id, row, -negative


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of every query row."""
    spark = vectors.sparkSession
    usable = written(scaled_integers(vectors, id_col, vector_col, is_query), "integers")
    total, asked = usable.agg(F.count("*"), F.count_if("is_query")).first()
    blocks = max(-(-total // block), spark.sparkContext.defaultParallelism)
    query_blocks = max(-(-asked // block), 1)

    def dealt(salt: int, n: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "row"), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    names = ["row", "vec_id", "dim", "v"]
    asks = usable.where("is_query").select(*names, dealt(1, query_blocks).alias("a")).select(*names, "a", all_of(blocks).alias("b"))
    offers = usable.select(*names, dealt(2, blocks).alias("b")).select(*names, "b", all_of(query_blocks).alias("a"))

    def searched(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [] if left.empty or right.empty else search_block(left, right, int(left["dim"].iloc[0]), k)
        return pd.DataFrame(found, columns=["query_row", "query_id", "vec_id", "row", "score"])

    keys = ["dim", "a", "b"]
    best = (
        asks.groupBy(*keys)
        .cogroup(offers.groupBy(*keys))
        .applyInPandas(searched, "query_row long, query_id long, vec_id long, row long, score long")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
