"""Quality scores of documents: random Fourier features, ridge regression, isotonic fit.

Statistics of a text (lengths, character classes, repetition) are standardised and
mapped to random cosines, whose products approximate a Gaussian kernel. The normal
equations of a ridge regression are summed within partitions, then in a tree. Two
halves of the labelled rows score each other; from these scores, counted in fixed bins,
a monotone fit gives the probability that a raw score stands for. Ids, languages,
sources and labels are no inputs of a score.

Cases: statistics are those of whole texts, however long; null and empty texts have statistics of zeros and get a score like others; rows
with a null label or without a document do not train; repeated labels count as often as
they occur; with labels of one value only or none, every score is the share of label 1
(0.5 without labels); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from cohortspark.llm.common import ship, text_of, written

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))
_MARKS = b"#$%&*+/<=>@\\^_`{|}~"
_PAUSES = b".,;:!?'\"()-"
N_STATISTICS = 19
_BINS, _LOW, _HIGH = 2048, -0.5, 1.5


def statistics_of(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * N_STATISTICS
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = [size - len(raw.translate(None, kind)) for kind in (_UPPER, _LOWER, _DIGITS, _MARKS, _PAUSES)]
    upper, lower, digits, marks, pauses = letters
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    wide = size - upper - lower - digits - marks - pauses - raw.count(b" ") - raw.count(b"\n")
    packed = len(zlib.compress(raw, 1)) / size
    return [
        float(np.log1p(n)),
        float(np.log1p(size)),
        (size - n) / n,
        upper / size,
        upper / (upper + lower + 1),
        digits / size,
        marks / size,
        pauses / size,
        wide / size,
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        raw.count(b".") / n,
        len(counts) / n,
        len(counts) / n**0.75,
        max(counts.values()) / n,
        repeats / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        min(packed, 2.0),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics_of(t) for t in texts])


def statistics(text: Column) -> Column:
    """Array of the text's statistics."""
    return _statistics(text)


@dataclass(frozen=True)
class Model:
    """Scaling, cosines, ridge weights and the knots of the monotone fit."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip(self.raw(x), _LOW, _HIGH)
        level = np.interp(raw, self.knots, self.values)
        # within a level, the ridge score still orders the texts
        return np.clip(0.998 * level + 0.002 * (raw - _LOW) / (_HIGH - _LOW), 0, 1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype="f8").reshape(-1, N_STATISTICS)


def _sums(model: Model):
    """Normal equations of each half of a partition's rows."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = len(model.phases) + 1
        total = np.zeros((2, size, size + 1))
        for frame in frames:
            for low in range(0, len(frame), 4096):
                part = frame.iloc[low : low + 4096]
                z, y = model.features(_matrix(part["stats"])), part["y"].to_numpy(dtype="f8")
                for half in (0, 1):
                    own = part["half"].to_numpy() == half
                    total[half, :, :size] += z[own].T @ z[own]
                    total[half, :, size] += z[own].T @ y[own]
        yield pd.DataFrame({"total": [total.tobytes()]})

    return rows


def _added(a: bytes, b: bytes) -> bytes:
    return (np.frombuffer(a) + np.frombuffer(b)).tobytes()


def monotone(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the nearest non-decreasing sequence by weighted squares."""
    level: list[list[float]] = []
    for v, w in zip(values, weights, strict=True):
        level.append([v, w, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v2, w2, n2 = level.pop()
            v1, w1, n1 = level.pop()
            level.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, n1 + n2])
    return np.concatenate([np.full(n, v) for v, _, n in level]) if level else np.empty(0)


def fit(labelled: DataFrame, n_features: int = 512, width: float = 4.0, ridge: float = 1e-3, seed: int = 7) -> Model:
    """The model of (stats, y, half): y is 0 or 1, half (0 or 1) splits the rows."""
    spark = labelled.sparkSession
    ship(spark)
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((N_STATISTICS, n_features)) / width
    phases = rng.uniform(0, 2 * np.pi, n_features)
    facts = labelled.agg(
        F.count("*"), F.sum("y"),
        *[f(F.col("stats")[i]) for i in range(N_STATISTICS) for f in (F.avg, F.stddev_pop)],
    ).first()
    n, positive = facts[0], facts[1] or 0
    if positive in (0, n):
        share = positive / n if n else 0.5
        flat = np.array([share, share])
        none = np.zeros(N_STATISTICS)
        return Model(none, none + 1, directions, phases, np.zeros(n_features + 1), np.array([_LOW, _HIGH]), flat)
    mean, scale = np.array(facts[2::2]), np.array(facts[3::2])
    scale = np.where(scale > 1e-12, scale, 1.0)
    empty = np.zeros(n_features + 1)
    base = Model(mean, scale, directions, phases, empty, empty, empty)
    partial = labelled.select("stats", "y", "half").mapInPandas(_sums(base), "total binary")
    packed = partial.rdd.map(lambda row: bytes(row[0])).treeReduce(_added, depth=3)
    size = n_features + 1
    halves = np.frombuffer(packed).reshape(2, size, size + 1)

    def solved(equations: np.ndarray) -> np.ndarray:
        gram = equations[:, :size]
        rows = gram[-1, -1]
        return np.linalg.solve(gram + ridge * max(rows, 1.0) / n_features * np.eye(size), equations[:, size])

    crossed = [Model(mean, scale, directions, phases, solved(halves[1 - h]), empty, empty) for h in (0, 1)]

    @F.pandas_udf("int")
    def bin_of(stats: pd.Series, half: pd.Series) -> pd.Series:
        x = _matrix(stats)
        raw = np.where(half.to_numpy() == 0, crossed[0].raw(x), crossed[1].raw(x))
        place = (np.clip(raw, _LOW, _HIGH) - _LOW) / (_HIGH - _LOW) * _BINS
        return pd.Series(np.minimum(place.astype("i4"), _BINS - 1))

    counts = labelled.groupBy(bin_of("stats", "half").alias("bin")).agg(F.count("*").alias("n"), F.avg("y").alias("y"))
    rows = sorted(tuple(r) for r in counts.collect())  # one row for each bin
    bins, weights, means = (np.array(c, dtype="f8") for c in zip(*rows, strict=True))
    knots = (bins + 0.5) / _BINS * (_HIGH - _LOW) + _LOW
    return Model(mean, scale, directions, phases, solved(halves.sum(axis=0)), knots, monotone(means, weights))


def scores(model: Model, stats: Column) -> Column:
    """The model's score (0 to 1) of an array of statistics."""

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(column)))

    return score(stats)


def third(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3; null ids give 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3, F.lit(0))


def training_rows(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> DataFrame:
    """(stats, y, half) of the labelled rows whose `third` is not 1, written."""
    marks = labels.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    rows = stats.where(third(id_col) != 1).join(marks, F.col(id_col) == F.col("_id"))
    half = (F.pmod(F.xxhash64(F.lit("half"), F.col(id_col)), F.lit(2))).cast("int")
    return written(rows.select("stats", "y", half.alias("half")), "training")


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row of docs."""
    ship(docs.sparkSession)
    stats = written(docs.select(F.col(id_col), statistics(text_of(text_col)).alias("stats")), "statistics")
    model = fit(training_rows(stats, labels, id_col))
    out = stats.select(F.col(id_col), (third(id_col) == 1).alias("held_out"), scores(model, F.col("stats")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that are not rejected, with their own columns."""
    ship(docs.sparkSession)
    wanted = docs.join(labels.select(F.col(id_col).alias("_id")).distinct(), F.col(id_col) == F.col("_id"), "leftsemi")
    known = wanted.select(F.col(id_col), statistics(text_of(text_col)).alias("stats"))
    model = fit(training_rows(known, labels, id_col))
    return docs.where(scores(model, statistics(text_of(text_col))) >= 0.5)
