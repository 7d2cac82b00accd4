"""Random forests for many rows: the trees of MLlib's own regressor, grown from sums.

A forest only sees the bins of a row's features, so rows with the same bins are one cell to
it: their draws, and sums of the target by draw, are added up for every tree in one pass over
the rows, and the levels of the trees are grown from the cells. How many cells there are
is bounded by the bins (16 for a number), and never more than rows.

Splits, draws of rows and features of a node are those that MLlib finds and draws for the
same partitions and seed, nodes are taken in its order and ties are decided as it does; sums
are added in another order, so that numbers agree to rounding; a node of few rows and one value
may be taken for a leaf by one and be looked at by the other. Cells are kept in bounded
tables of a task, blocks of them are cached, and only the best splits reach the driver.
"""

from __future__ import annotations

import json
import math
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .relational import shared_folder

_CHUNK_BYTES = 1 << 26  # of draws that are added to a task's cells at a time
_TABLE_BYTES = 1 << 28  # of sums of a task's cells, which are passed on beyond it
_BLOCK = 4096  # cells
_MASK = (1 << 64) - 1
_SAMPLE = 10_000  # rows for the thresholds, at least
#: Features looked at in a node, of so many.
_SUBSETS = {
    "all": lambda n: n,
    "sqrt": lambda n: math.ceil(math.sqrt(n)),
    "log2": lambda n: max(1, math.ceil(math.log(n) / math.log(2))),
    "onethird": lambda n: math.ceil(n / 3.0),
}
_KNOWN = ("auto", *_SUBSETS)
#: Sums of a cell or a bin: of the draws, of the target and of its square.
_SUMS = 3


class CellForestRegressor(RandomForestRegressor):
    """MLlib's regressor, fitted from cells. Weighted rows, samples without replacement,
    other rates than 1 and numbers of features are left to MLlib."""

    def _fit_java(self, dataset: DataFrame):
        usual = self.getBootstrap() and self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() in _KNOWN
        if not usual or self.isDefined("weightCol"):
            return super()._fit_java(dataset)
        self._transfer_params_to_java()
        ship(dataset.sparkSession)
        rows = _points(dataset, self.getLabelCol(), self.getFeaturesCol())
        plan = _Plan(self, dataset, rows)
        blocks = _cells(plan, rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            trees = _grown(plan, blocks)
        finally:
            blocks.unpersist()
        return _model(self, plan, trees)


def _points(dataset: DataFrame, label: str, features: str) -> DataFrame:
    return dataset.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))


class _Plan:
    """What MLlib derives from the parameters and the rows before it grows trees."""

    def __init__(self, estimator: RandomForestRegressor, dataset: DataFrame, rows: DataFrame):
        jvm = dataset.sparkSession._jvm
        field = dataset._jdf.schema().apply(estimator.getFeaturesCol())
        arity = jvm.org.apache.spark.ml.util.MetadataUtils.getCategoricalFeatures(field)
        arity = dict(jvm.scala.jdk.javaapi.CollectionConverters.asJava(arity))
        self.trees, self.seed = estimator.getNumTrees(), estimator.getSeed()
        self.depth, self.memory = estimator.getMaxDepth(), estimator.getMaxMemoryInMB() << 20
        self.fewest, self.least_gain = estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
        n, first = rows.count(), rows.select(F.size("x")).first()
        if not n:
            raise ValueError("a forest needs rows to learn from")
        self.count = first[0]
        self.least_weight = estimator.getMinWeightFractionPerNode() * n
        most = min(estimator.getMaxBins(), n)
        if arity and max(arity.values()) > most:
            raise ValueError(f"a category of {max(arity.values())} values needs as many bins, not {most}")
        self.bins = np.array([arity[f] if arity.get(f, 0) > 1 else most for f in range(self.count)])
        self.thresholds: list = [None] * self.count
        numbers = [f for f in range(self.count) if f not in arity]
        if numbers:
            share = min(1.0, max(int(self.bins.max()) ** 2, _SAMPLE) / n)
            values = _sampled(rows.select("x"), share, self.seed)
            for f in numbers:
                self.thresholds[f] = _thresholds(values[:, f], share * n, most - 1)
                self.bins[f] = len(self.thresholds[f]) + 1
        self.splits = self.bins - 1
        self.picked = _SUBSETS["all" if self.trees == 1 else "onethird"](self.count)
        if estimator.getFeatureSubsetStrategy() != "auto":
            self.picked = _SUBSETS[estimator.getFeatureSubsetStrategy()](self.count)


def _refuse(x: pa.Array, y: pa.Array) -> None:
    """Fails where MLlib refuses to learn from a row."""
    if y.null_count or np.isnan(y.to_numpy(zero_copy_only=False)).any():
        raise ValueError("Labels MUST NOT be Null or NaN")
    if x.null_count:
        raise ValueError("Vectors MUST NOT be Null")
    if not np.isfinite(x.flatten().to_numpy(zero_copy_only=False)).all():
        raise ValueError("Vector values MUST NOT be NaN or Infinity")


def _sampled(x: DataFrame, share: float, seed: int) -> np.ndarray:
    """Features of the rows from which MLlib takes thresholds: 10,000, or the square of the bins."""
    if share < 1.0:
        java = x.sparkSession._jsparkSession
        number = _Shifts(seed).bits(32)
        some = x._jdf.rdd().sample(False, share, number - (1 << 32) if number >> 31 else number)
        x = DataFrame(java.createDataFrame(some.toJavaRDD(), x._jdf.schema()), x.sparkSession)
    return np.array([r["x"] for r in x.collect()], dtype=np.float64)


def _thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """Middles between neighbouring values, where the rows up to there are nearest to even
    parts. Zeros are what is left of the expected rows, also where those are fewer."""
    values, counts = np.unique(values[values != 0.0], return_counts=True)
    if not len(values):
        return np.empty(0)
    counts, zeros = counts.astype(np.float64), expected - counts.sum()
    if zeros > 2.0**-52 * counts.sum() * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= most:
        return middles
    stride, out = expected / (most + 1), []
    target, before = stride, np.cumsum(counts)
    for i, middle in enumerate(middles):
        if abs(before[i] - target) < abs(before[i + 1] - target):
            out.append(middle)
            target += stride
    return np.array(out)


# --- cells -----------------------------------------------------------------------------


def _draws(spark: SparkSession, trees: int, seed: int) -> Column:
    """How often each tree draws the row: MLlib's stream of Poisson numbers of a partition."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    expressions, types = jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.types
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    name = "org.apache.spark.sql.catalyst.expressions.UnsafeArrayData"

    def of_class(java_name: str):
        return jvm.java.lang.Class.forName(java_name)

    def seq(*items):
        array = jvm.java.util.ArrayList()
        for item in items:
            array.add(item)
        return jvm.org.apache.spark.api.python.PythonUtils.toSeq(array)

    poisson = jvm.org.apache.commons.math3.distribution.PoissonDistribution(1.0)
    source = expressions.Literal.fromObject(poisson, types.ObjectType(poisson.getClass()))
    start = (F.spark_partition_id().cast("long") + F.lit(seed + 1)).cast("long")
    setter = gateway.jvm.java.util.HashMap()
    setter["reseedRandomGenerator"] = utils.expression(start._jc)
    setter = jvm.org.apache.spark.api.python.PythonUtils.toScalaMap(setter)
    seeded = expressions.objects.InitializeJavaBean(source, setter)
    number = utils.expression(F.lit(trees)._jc)
    ints = types.ObjectType(of_class("[I"))

    def sample(target):
        drawn = expressions.objects.Invoke(target, "sample", ints, seq(number), seq(), True, False, False)
        integers = types.ArrayType(types.DataTypes.IntegerType, False)
        whole = expressions.objects.StaticInvoke(
            of_class(name), integers, "fromPrimitiveArray", seq(drawn), seq(), True, False, False, jvm.scala.Option.empty()
        )
        return Column(utils.column(whole))

    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return F.when(first, sample(seeded)).otherwise(sample(source))


class _Table:
    """Sums of the cells of a task, of at most `size`."""

    def __init__(self, trees: int, features: int, kind: str, size: int):
        self.keys = np.empty(0, dtype=f"S{features * np.dtype(kind).itemsize}")
        self.slots = np.empty(0, dtype=np.int64)  # of the sorted keys
        self.sums = np.zeros((trees, _SUMS, size))  # untouched pages take no memory

    def add(self, keys: np.ndarray, first: np.ndarray, place: np.ndarray, y: np.ndarray, drawn: np.ndarray) -> None:
        """`keys` are sorted, with their first rows, `place` is where those of the rows are;
        drawn is (tree, row). Cells keep the order of their first rows: sums of few rows are
        then rounded as MLlib's are, which tests them for being of one value."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), dtype=bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        slots = np.empty(len(keys), dtype=np.int64)
        slots[known] = self.slots[at[known]]
        size = len(self.keys)
        slots[~known] = size + np.argsort(np.argsort(first[~known]))
        self.keys = np.insert(self.keys, at[~known], keys[~known])
        self.slots = np.insert(self.slots, at[~known], slots[~known])
        for tree, weight in enumerate(drawn):
            for i in range(_SUMS):
                weight = weight * y if i else weight
                self.sums[tree, i, slots] += np.bincount(place, weight, len(keys))

    def blocks(self) -> Iterator[tuple[bytes, bytes]]:
        order = np.argsort(self.slots)
        keys = self.keys[order]
        for low in range(0, len(keys), _BLOCK):
            part = keys[low : low + _BLOCK]
            yield part.tobytes(), np.ascontiguousarray(self.sums[:, :, low : low + len(part)]).tobytes()


def _bins_of(x: np.ndarray, thresholds: list, kind: str) -> np.ndarray:
    out = np.empty(x.shape, dtype=kind)
    for f, cuts in enumerate(thresholds):
        out[:, f] = x[:, f].astype(np.int64) if cuts is None else np.searchsorted(cuts, x[:, f])
    return out


def _kind(bins: np.ndarray) -> str:
    return "u1" if bins.max(initial=1) < 255 else "u4"


def _cells(plan: _Plan, rows: DataFrame) -> DataFrame:
    """Blocks (cells, sums) of the rows' bins, for all trees, in one pass."""
    trees, features, thresholds, kind = plan.trees, plan.count, plan.thresholds, _kind(plan.bins)
    chunk = max(1, _CHUNK_BYTES // (8 * trees))  # rows
    most = max(1, _TABLE_BYTES // (8 * _SUMS * trees))  # cells, before a last chunk is added

    def new_table() -> _Table:
        return _Table(trees, features, kind, most + chunk)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = new_table()

        def flat(column, dtype, width):
            return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)

        def passed(some: _Table) -> Iterator[pa.RecordBatch]:
            for cells, sums in some.blocks():
                yield pa.RecordBatch.from_arrays([pa.array([cells], pa.binary()), pa.array([sums], pa.binary())], ["cells", "sums"])

        def add(x: np.ndarray, y: np.ndarray, drawn: np.ndarray) -> None:
            keys = np.ascontiguousarray(x).view(table.keys.dtype).ravel()
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            new = np.ones(len(keys), dtype=bool)
            new[1:] = ordered[1:] != ordered[:-1]
            place = np.empty(len(keys), dtype=np.int64)
            place[order] = np.cumsum(new) - 1
            table.add(ordered[new], order[new], place, y, np.ascontiguousarray(drawn.T, dtype=np.float64))

        def chunks() -> Iterator[list[np.ndarray]]:
            held, waiting = [], 0
            for batch in batches:
                _refuse(batch.column("x"), batch.column("y"))
                x = _bins_of(flat(batch.column("x"), np.float64, features), thresholds, kind)
                held.append((x, batch.column("y").to_numpy(zero_copy_only=False), flat(batch.column("drawn"), np.int32, trees)))
                waiting += len(x)
                if waiting >= chunk:
                    yield [np.concatenate(parts) for parts in zip(*held)]
                    held, waiting = [], 0
            if held:
                yield [np.concatenate(parts) for parts in zip(*held)]

        for whole in chunks():
            for low in range(0, len(whole[1]), chunk):
                add(*(part[low : low + chunk] for part in whole))
                if len(table.keys) >= most:
                    yield from passed(table)
                    table = new_table()
        yield from passed(table)

    drawn = rows.select("x", "y", _draws(rows.sparkSession, trees, plan.seed).alias("drawn"))
    return drawn.mapInArrow(summed, "cells binary, sums binary")


# --- levels ----------------------------------------------------------------------------


class _Random:
    """java.util.Random, of which MLlib takes the seeds of the nodes' features."""

    def __init__(self, seed: int):
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        value = self.state >> 16
        return value - (1 << 32) if value >> 31 else value

    def long(self) -> int:
        return ((self._next() << 32) + self._next()) & _MASK


def _murmur(data: bytes, seed: int) -> int:
    h, m = seed, 0xFFFFFFFF
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & m
        k = (k << 15 | k >> 17) & m
        h ^= k * 0x1B873593 & m
        h = (h << 13 | h >> 19) & m
        h = (h * 5 + 0xE6546B64) & m
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    return h ^ h >> 16


class _Shifts:
    """Spark's own generator, XORShiftRandom."""

    def __init__(self, seed: int):
        data = struct.pack(">Q", seed & _MASK)
        low = _murmur(data, 0x3C074A61)
        self.state = _murmur(data, low) << 32 | low

    def bits(self, n: int) -> int:
        self.state ^= self.state << 21 & _MASK
        self.state ^= self.state >> 35
        self.state ^= self.state << 4 & _MASK
        return self.state & ((1 << n) - 1)

    def unit(self) -> float:
        return ((self.bits(26) << 27) + self.bits(27)) * 2.0**-53


def _some_features(count: int, picked: int, seed: int) -> list[int]:
    """Spark's reservoir sample of the features."""
    random, out = _Shifts(seed), list(range(picked))
    for item in range(picked, count):
        at = int(random.unit() * (item + 1))
        if at < picked:
            out[at] = item
    return out


def _map_order(keys: list[int]) -> list[int]:
    """Order in which Scala's immutable map gives these numbers."""
    if len(keys) <= 4:
        return sorted(keys, key=lambda k: ((k ^ k >> 16) & 15, k))

    def spread(k: int) -> int:
        k = (k + ~(k << 9)) & 0xFFFFFFFF
        k ^= k >> 14
        k = (k + (k << 4)) & 0xFFFFFFFF
        return k ^ k >> 10

    def order(some: list[int], shift: int) -> list[int]:
        groups: dict[int, list[int]] = {}
        for k in some:
            groups.setdefault(spread(k) >> shift & 31, []).append(k)
        alone = [groups[g][0] for g in sorted(groups) if len(groups[g]) == 1]
        return alone + [k for g in sorted(groups) if len(groups[g]) > 1 for k in order(groups[g], shift + 5)]

    return order(keys, 0)


class _Tree:
    """Nodes in the order they were made; the right child follows the left one."""

    def __init__(self):
        self.feature, self.left, self.child, self.level = [-1], [None], [-1], [0]
        self.sums: list[tuple | None] = [None]
        self.impurity, self.gain, self.cut = [None], [-1.0], [None]

    def children(self, node: int, sums) -> int:
        self.child[node] = first = len(self.feature)
        for side in sums:
            for column, value in (
                (self.feature, -1), (self.left, None), (self.child, -1), (self.level, self.level[node] + 1),
                (self.sums, tuple(side)), (self.impurity, _impurity(*side)), (self.gain, -1.0), (self.cut, None),
            ):
                column.append(value)
        return first

    def walk(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        left = np.zeros((len(self.left), most), dtype=bool)
        for node, bins in enumerate(self.left):
            if bins is not None:
                left[node] = bins
        return np.array(self.feature, dtype=np.int32), left, np.array(self.child, dtype=np.int64)


def _impurity(count: float, total: float, squares: float) -> float:
    return (squares - total * total / count) / count if count else 0.0


def _impurities(sums: np.ndarray) -> np.ndarray:
    count, total, squares = sums[..., 0], sums[..., 1], sums[..., 2]
    some = np.where(count > 0, count, 1.0)
    return np.where(count > 0, (squares - total * total / some) / some, 0.0)


def _grown(plan: _Plan, blocks: DataFrame) -> list[_Tree]:
    """The trees, group of nodes by group of nodes as MLlib takes them."""
    random, most = _Random(plan.seed), int(plan.bins.max())
    trees = [_Tree() for _ in range(plan.trees)]
    stack = [(t, 0) for t in range(plan.trees)]  # its end is taken first
    while stack:
        group: dict[int, list[tuple[int, list[int]]]] = {}
        memory = 0
        while stack:
            tree, node = stack[-1]
            if plan.picked < plan.count:
                features = _some_features(plan.count, plan.picked, random.long())
            else:
                features = list(range(plan.count))
            needed = _SUMS * 8 * int(plan.bins[features].sum())
            if memory and memory + needed > plan.memory:
                break
            stack.pop()
            group.setdefault(tree, []).append((node, features))
            memory += needed
        best = _best_splits(plan, blocks, trees, group, most)
        for tree in _map_order(list(group)):
            for node, _ in group[tree]:
                _split(plan, trees[tree], node, best[tree, node], most)
                level, first = trees[tree].level[node], trees[tree].child[node]
                if first >= 0 and level + 1 < plan.depth:
                    stack += [(tree, side) for side in (first, first + 1) if abs(trees[tree].impurity[side]) >= 2.0**-52]
    return trees


def _split(plan: _Plan, tree: _Tree, node: int, best: dict, most: int) -> None:
    if tree.level[node] == 0:
        tree.sums[node], tree.impurity[node] = tuple(best["own"]), _impurity(*best["own"])
    if not best["valid"]:
        tree.impurity[node] = -1.0
        return
    if best["gain"] <= 0 or tree.level[node] == plan.depth:
        return
    feature, bins = best["feature"], best["bins"]
    left = np.zeros(most, dtype=bool)
    left[bins] = True
    cuts = plan.thresholds[feature]
    tree.cut[node] = (sorted(map(float, bins)), int(plan.bins[feature])) if cuts is None else ([float(cuts[len(bins) - 1])], -1)
    tree.feature[node], tree.left[node], tree.gain[node] = feature, left, best["gain"]
    tree.children(node, (best["left_sums"], best["right_sums"]))


def _best_splits(plan: _Plan, blocks: DataFrame, trees: list[_Tree], group: dict, most: int) -> dict:
    """The best split of every node of a group: one pass over the cells."""
    features, picked, kind, count = plan.count, plan.picked, _kind(plan.bins), plan.trees
    walks = {t: trees[t].walk(most) for t in group}
    nodes = {t: (np.array([n for n, _ in some]), np.array([f for _, f in some])) for t, some in group.items()}
    impurity = {t: np.array([trees[t].impurity[n] if trees[t].level[n] else np.nan for n, _ in some]) for t, some in group.items()}

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {t: np.zeros((_SUMS, own.size * most)) for t, (_, own) in nodes.items()}
        slots = {}
        for t, (some, _) in nodes.items():
            slots[t] = np.full(len(walks[t][0]), -1)
            slots[t][some] = np.arange(len(some))
        for batch in batches:
            for cells, stored in zip(batch.column("cells"), batch.column("sums")):
                x = np.frombuffer(cells.as_buffer(), dtype=kind).reshape(-1, features)
                stats = np.frombuffer(stored.as_buffer(), dtype=np.float64).reshape(count, _SUMS, -1)
                for t, (_, own) in nodes.items():
                    at = slots[t][_walked(x, *walks[t])]
                    rows = np.flatnonzero((at >= 0) & (stats[t, 0] > 0))
                    at = at[rows]
                    bins = x[rows[:, None], own[at]].astype(np.int64)
                    spots = ((at * picked)[:, None] + np.arange(picked)) * most + bins
                    for i in range(_SUMS):
                        weights = np.repeat(stats[t, i, rows], picked)
                        sums[t][i] += np.bincount(spots.ravel(), weights, sums[t].shape[1])
        if nodes:
            tables = [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(tables, ["tree", "sums"])

    def decided(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole: dict[int, np.ndarray] = {}
        for frame in frames:
            for t, stored in zip(frame["tree"], frame["sums"]):
                part = np.frombuffer(stored, dtype=np.float64)
                whole[t] = whole[t] + part if t in whole else part
        for t, sums in whole.items():
            some, own = nodes[t]
            table = np.moveaxis(sums.reshape(_SUMS, len(some), picked, most), 0, -1)
            yield pd.DataFrame(_decisions(plan, t, some, own, table, impurity[t]))

    schema = (
        "tree int, node int, valid boolean, gain double, feature int, bins array<int>, "
        "own array<double>, left_sums array<double>, right_sums array<double>"
    )
    found = blocks.mapInArrow(binned, "tree int, sums binary").repartition("tree").mapInPandas(decided, schema)
    return {(r["tree"], r["node"]): r.asDict() for r in found.collect()}


def _walked(x: np.ndarray, feature: np.ndarray, left: np.ndarray, child: np.ndarray) -> np.ndarray:
    """The node of each cell, from the root."""
    node = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x)) if feature[0] >= 0 else np.empty(0, dtype=np.int64)
    while len(rows):
        at = node[rows]
        at = child[at] + ~left[at, x[rows, feature[at]]]
        node[rows] = at
        rows = rows[feature[at] >= 0]
    return node


def _decisions(plan: _Plan, tree: int, some: np.ndarray, own: np.ndarray, table: np.ndarray, impurity: np.ndarray) -> dict:
    """Best splits of the nodes of a tree; table is (node, feature, bin, sum)."""
    n, picked, most, _ = table.shape
    bins, number = plan.bins[own], np.arange(most)
    categorical = np.array([c is None for c in plan.thresholds])[own][..., None]
    # categories in the order of their means, empty ones at the end
    means = np.where(table[..., 0] > 0, table[..., 1] / np.where(table[..., 0] > 0, table[..., 0], 1.0), np.finfo(float).max)
    rank = np.where(categorical, means, number.astype(float))
    rank = np.where(number < bins[..., None], rank, np.inf)
    order = np.argsort(rank, axis=-1, kind="stable")
    left = np.cumsum(np.take_along_axis(table, order[..., None], axis=2), axis=2)
    right = left[:, :, -1:, :] - left
    first = np.argmax(np.array(plan.splits)[own] > 0, axis=1)
    whole = (left + right)[np.arange(n), first, 0]
    impurity = np.where(np.isnan(impurity), _impurities(whole), impurity)[:, None, None]
    counts = left[..., 0] + right[..., 0]
    counts = np.where(counts > 0, counts, 1.0)
    gain = impurity - left[..., 0] / counts * _impurities(left) - right[..., 0] / counts * _impurities(right)
    fewest = np.minimum(left[..., 0], right[..., 0])
    bad = (fewest < plan.fewest) | (fewest < plan.least_weight) | (gain < plan.least_gain)
    gain = np.where(bad, -np.finfo(float).max, gain)
    gain = np.where(number < np.array(plan.splits)[own][..., None], gain, -np.inf)
    cut = np.argmax(gain, axis=2)
    gain = np.take_along_axis(gain, cut[..., None], axis=2)[..., 0]
    pick = np.argmax(gain, axis=1)
    rows = np.arange(n)
    cut, gain = cut[rows, pick], gain[rows, pick]
    return {
        "tree": np.full(n, tree, dtype=np.int32), "node": some.astype(np.int32), "valid": gain > -np.finfo(float).max, "gain": gain,
        "feature": own[rows, pick].astype(np.int32),
        "bins": [order[i, pick[i], : cut[i] + 1].astype(np.int32) for i in range(n)],
        "own": list(whole), "left_sums": list(left[rows, pick, cut]), "right_sums": list(right[rows, pick, cut]),
    }


# --- the model -------------------------------------------------------------------------

_NODE = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
#: Parameters of a single tree.
_OF_TREES = (
    "cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "maxBins", "maxDepth", "maxMemoryInMB",
    "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed",
)


def _described(tree: _Tree) -> list[tuple]:
    """Nodes in MLlib's order: a node, its left side, its right side. Leaves that are
    siblings and predict the same are one leaf."""
    means = [s[1] / s[0] if s[0] else float("nan") for s in tree.sums]
    leaf = [c < 0 for c in tree.child]
    for node in reversed(range(len(leaf))):
        first = tree.child[node]
        if first >= 0 and leaf[first] and leaf[first + 1] and means[first] == means[first + 1]:
            leaf[node] = True
    out: list = []
    stack = [(0, -1)]  # with the place of the parent whose right side it is
    while stack:
        node, parent = stack.pop()
        place = len(out)
        if parent >= 0:
            out[parent][7] = place
        sums = [float(v) for v in tree.sums[node]]
        row = [place, means[node], float(tree.impurity[node]), sums, int(sums[0]), -1.0, -1, -1, (-1, [], -1)]
        if not leaf[node]:
            values, categories = tree.cut[node]
            row[5], row[6], row[8] = float(tree.gain[node]), place + 1, (int(tree.feature[node]), values, categories)
            stack += [(tree.child[node] + 1, place), (tree.child[node], -1)]
        out.append(row)
    return [tuple(row) for row in out]


def _model(estimator: RandomForestRegressor, plan: _Plan, trees: list[_Tree]):
    """The model in MLlib's own form: written as it writes models, and loaded."""
    spark = SparkSession.active()
    jvm, java = spark._jvm, estimator._java_obj
    path = f"{shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    values = {p.name: v for p, v in estimator.extractParamMap().items() if p.name in _OF_TREES}

    def described(name: str, uid: str, params: dict, **more) -> str:
        kind = f"org.apache.spark.ml.regression.{name}"
        return json.dumps({"class": kind, "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": params, "defaultParamMap": {}, **more})

    whole = described("RandomForestRegressionModel", estimator.uid, {"impurity": values["impurity"]}, numFeatures=plan.count, numTrees=plan.trees)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    each = [(t, described("DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", values), 1.0) for t in range(plan.trees)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(t, row) for t, tree in enumerate(trees) for row in _described(tree)]
    spark.createDataFrame(nodes, _NODE).coalesce(1).write.parquet(f"{path}/data")
    model = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel.load(path)
    return java.copyValues(model.setParent(java), jvm.org.apache.spark.ml.param.ParamMap.empty())
