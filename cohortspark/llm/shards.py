"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

How many rows each partition sends to each shard is drawn first, so that the matrix has
the law that a uniform permutation of all rows gives it. Each partition then permutes
its rows and deals them out by its row of the matrix; after the exchange each shard is
permuted again. No task sees a whole shard, and the driver only sees counts of blocks of
1024 partitions.

Cases: nulls, empty and very long texts and repeated rows are rows like any other; an empty table
gives an empty result; fewer rows than shards leave shards empty; columns of the result
that the input has already are replaced. Rows keep all their columns.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import free_name, gapless, ship, written

_BLOCK = 1024


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """Good ones among `drawn` of good + bad, for populations of any size.

    The distribution is summed outwards from its mode over 14 standard deviations, by
    the ratios of neighbouring terms; what lies beyond is below double precision.
    """
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (total + 2)))
    share = good / total
    spread = drawn * share * (1 - share) * (total - drawn) / max(1, total - 1)
    reach = int(14 * spread**0.5) + 30
    up = np.arange(mode, min(high, mode + reach), dtype="f8")
    down = np.arange(mode, max(low, mode - reach), -1, dtype="f8")
    rise = np.cumsum(np.log((good - up) * (drawn - up)) - np.log((up + 1) * (bad - drawn + up + 1)))
    fall = np.cumsum(np.log(down * (bad - drawn + down)) - np.log((good - down + 1) * (drawn - down + 1)))
    weight = np.exp(np.concatenate([fall[::-1], [0.0], rise]))
    cumulative = np.cumsum(weight)
    at = int(np.searchsorted(cumulative, rng.random() * cumulative[-1], side="right"))
    return int(mode - len(fall) + min(at, len(weight) - 1))


def deal(rng: np.random.Generator, capacity: list[int], drawn: int) -> list[int]:
    """How `drawn` rows fall on shards with the given free places."""
    left, out = sum(capacity), []
    for places in capacity:
        left -= places
        n = hypergeometric(rng, places, left, drawn)
        out.append(n)
        drawn -= n
    return out


def shard_sizes(rows: int, n_shards: int) -> list[int]:
    return [rows // n_shards + (s < rows % n_shards) for s in range(n_shards)]


def communication_matrix(parts: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(part, ends): ends[s] is the number of rows the part sends to shards 0 to s.

    `parts` has (part, n). Blocks of parts are drawn on the driver, the parts of each
    block in a task of their own.
    """
    spark = parts.sparkSession
    ship(spark)
    blocks = parts.groupBy(F.expr(f"cast(floor(part / {_BLOCK}) as long)").alias("block")).agg(F.sum("n").alias("n"))
    counts = blocks.orderBy("block").collect()  # one row for 1024 partitions
    free = shard_sizes(sum(r["n"] for r in counts), n_shards)
    rng, rows = np.random.default_rng(seed), []
    for r in counts:
        own = deal(rng, free, r["n"])
        free = [a - b for a, b in zip(free, own, strict=True)]
        rows.append((r["block"], own))
    table = spark.createDataFrame(rows, "block long, own array<long>")

    def draw(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        left = [int(x) for x in group["own"].iloc[0]]
        rng = np.random.default_rng([seed, int(group["block"].iloc[0]) + 1])
        ends = []
        for n in group["n"]:
            sent = deal(rng, left, int(n))
            left = [a - b for a, b in zip(left, sent, strict=True)]
            ends.append(np.cumsum(sent).tolist())
        return pd.DataFrame({"part": group["part"].to_numpy(), "ends": ends})

    blocked = parts.withColumn("block", F.expr(f"cast(floor(part / {_BLOCK}) as long)")).join(table, "block")
    return written(blocked.groupBy("block").applyInPandas(draw, "part int, ends array<long>"), "matrix")


def shuffle_to_shards(df: DataFrame, n_shards: int, seed: int = 42) -> DataFrame:
    """The rows with `shard` (0 to n_shards - 1) and `slot` (from 0 within the shard).

    Every assignment with these shard sizes and every order within shards is equally
    likely. Shard sizes differ by one at most, the first shards being the larger ones.
    """
    df = df.drop("shard", "slot")
    part, pos, key, ends, second, index = free_name(df, "part", "pos", "key", "ends", "second", "index")
    names = df.columns
    mixed = df.withColumn(key, F.xxhash64(F.lit(seed), F.struct(*names)))
    mixed = mixed.sortWithinPartitions(key).withColumns(
        {
            part: F.spark_partition_id(),
            pos: F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        }
    )
    placed = written(mixed.drop(key), "permuted")
    counts = written(placed.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n")), "counts")
    matrix = communication_matrix(counts, n_shards, seed)
    matrix = matrix.select(F.col("part").alias(part), F.col("ends").alias(ends))
    sent = placed.join(matrix, part).withColumn(
        "shard", F.size(F.filter(ends, lambda e: e <= F.col(pos))).cast("int")
    )
    sent = sent.withColumn(second, F.xxhash64(F.lit(seed + 1), part, pos)).drop(ends)
    order = [F.col("shard"), F.col(second), F.col(part), F.col(pos)]
    numbered = gapless(sent, order, index)
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    large, more = divmod(rows, n_shards)
    start = F.col("shard") * large + F.least(F.col("shard"), F.lit(more))
    return numbered.withColumn("slot", F.col(index) - start).select(*names, "shard", "slot")
