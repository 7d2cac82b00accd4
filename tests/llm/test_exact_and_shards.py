import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import exact, shards

DOCS = [
    (1, "a b", "x"), (2, "a b", "y"), (3, None, "x"), (4, "", None), (5, "A b", "z"),
    (6, "a b ", "z"), (7, "é" * 5000, "z"), (8, "é" * 5000, "z"), (9, "a b", "y"), (9, "a b", "y"),
]
SCHEMA = "doc_id long, text string, h string"


@pytest.mark.parametrize("capacity", [1, 3, 4096])
def test_probe_agrees_with_plain_grouping(spark, capacity):
    rows = exact.probe(spark.createDataFrame(DOCS, SCHEMA), capacity=capacity).collect()
    texts = [t or "" for _, t, _ in DOCS]
    want = Counter()
    for i, text, _ in DOCS:
        same = [j for j, t, _ in DOCS if (t or "") == (text or "")]
        digest = hashlib.sha256((text or "").encode()).hexdigest()
        want[(i, max(same), texts.count(text or ""), i == max(same), digest)] += 1
    assert Counter(tuple(r) for r in rows) == want


def test_keep_one_keeps_a_row_of_each_text_and_all_columns(spark):
    kept = exact.keep_one(spark.createDataFrame(DOCS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "h"]
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 8, 9]


def test_null_ids_and_empty_tables(spark):
    rows = exact.probe(spark.createDataFrame([(None, "x"), (None, "x"), (1, "y")], "doc_id long, text string"))
    assert sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in rows.collect()) == [
        (0, None, 2, True), (0, None, 2, True), (1, 1, 1, True),
    ]
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.probe(empty).count() == 0 and exact.keep_one(empty).count() == 0


def test_directory_splits_only_overfull_buckets(spark):
    entries = spark.range(2000).select(F.xxhash64("id").alias("h"))
    slots, depth = exact.directory(entries, 100)
    held = entries.withColumn("slot", exact._slot(F.col("h"), depth)).join(slots, "slot")
    counts = {r.bucket: (r.n, r.depth) for r in held.groupBy("bucket").agg(F.count("*").alias("n"), F.first("depth").alias("depth")).collect()}
    assert sum(n for n, _ in counts.values()) == 2000
    assert max(n for n, _ in counts.values()) <= 100
    assert slots.count() == 2**depth and max(d for _, d in counts.values()) == depth


def test_shards_are_exact_and_slots_gapless(spark):
    df = spark.range(1000).withColumn("shard", F.lit("clash")).repartition(7)
    rows = shards.shuffle_to_shards(df, 24).collect()
    assert sorted(r.id for r in rows) == list(range(1000))
    sizes = Counter(r.shard for r in rows)
    assert [sizes[s] for s in range(24)] == shards.shard_sizes(1000, 24)
    for s in range(24):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))


def test_repeated_rows_null_rows_few_rows_and_none(spark):
    same = spark.createDataFrame([(None, None)] * 50 + [(1, "")], "doc_id long, text string")
    rows = shards.shuffle_to_shards(same, 4).collect()
    assert sorted(Counter(r.shard for r in rows).values()) == [12, 13, 13, 13]
    assert shards.shuffle_to_shards(same.limit(2), 8).count() == 2
    assert shards.shuffle_to_shards(same.limit(0), 8).count() == 0


def test_hypergeometric_law():
    rng = np.random.default_rng(1)
    draws = [shards.hypergeometric(rng, 30, 70, 20) for _ in range(20000)]
    reference = np.random.default_rng(2).hypergeometric(30, 70, 20, 20000)
    assert abs(np.mean(draws) - 6) < 0.05 and abs(np.std(draws) - np.std(reference)) < 0.05
    assert shards.hypergeometric(rng, 0, 5, 3) == 0 and shards.hypergeometric(rng, 5, 0, 3) == 3
    large = shards.hypergeometric(rng, 10**12, 3 * 10**12, 10**9)
    assert abs(large - 2.5e8) < 1e6


def test_partitions_send_by_the_law(spark):
    df = spark.range(0, 4000, 1, 4)  # a thousand rows of each thousand
    rows = shards.shuffle_to_shards(df, 5, 3).collect()
    sent = Counter((r.id // 1000, r.shard) for r in rows)
    assert all(140 < sent[p, s] < 260 for p in range(4) for s in range(5))  # 200, deviation 11
    first = [r.id for r in rows if r.shard == 0 and r.slot < 100]
    assert 1500 < np.mean(first) < 2500
