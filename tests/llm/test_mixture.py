import math
import random

import pytest

from cohortspark.llm import mixture
from cohortspark.llm.common import text_of, word_count, written


def waterfill(sizes, weights, share, cap):
    total, full = share * sum(sizes), set()
    while True:
        free = [i for i in range(len(sizes)) if i not in full]
        level = (total - sum(cap * sizes[i] for i in full)) / sum(weights[i] for i in free)
        more = {i for i in free if weights[i] * level > cap * sizes[i]}
        if not more:
            return [cap * s if i in full else weights[i] * level for i, s in enumerate(sizes)]
        full |= more


def test_targets_are_reached(spark):
    rows = [(i, f"s{i % 5}", 20 + (i * 37) % 400) for i in range(3000)]
    sized = written(spark.createDataFrame(rows, "doc_id long, source string, size long"), "sized")
    out = mixture.mix_by_weights(sized, "doc_id", (3, 1, 2), 1.5).collect()
    sizes = [sum(z for _, s, z in rows if s == f"s{k}") for k in range(5)]
    want = waterfill(sizes, [3, 1, 2, 3, 1], 1.5, 2.0)
    for k in range(5):
        own = [r for r in out if r.source == f"s{k}"]
        assert own[0].target == pytest.approx(want[k]) and own[0].source_size == sizes[k]
        assert abs(sum(r.taken for r in own) - want[k]) <= 210
        assert all(r.copies in (0, 1, 2) and r.taken == r.copies * r.size for r in own)
    again = mixture.mix_by_weights(sized, "doc_id", (3, 1, 2), 1.5).collect()
    assert sorted((r.doc_id, r.copies) for r in out) == sorted((r.doc_id, r.copies) for r in again)


def test_rates_are_the_entropy_solution(spark):
    rows = [(i, "a", 10 * (i % 7 + 1)) for i in range(70)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    targets = spark.createDataFrame([("a", 1500.0)], "source string, target double")
    out = mixture.mix(sized, targets, "doc_id").collect()
    assert sum(r.rate * r.size for r in out) == pytest.approx(1500)
    slopes = {round(math.log(r.rate) / r.size, 7) for r in out}  # one tilt for all sizes
    assert len(slopes) == 1


def test_null_sources_empty_texts_repeated_ids_and_clashes(spark):
    docs = spark.createDataFrame(
        [(1, None, "a b"), (2, None, None), (3, "x", ""), (4, "x", "c d \x0b e"), (4, "x", "f"), (5, "y", ""), (None, "x", "g h")],
        "doc_id long, source string, text string",
    )
    sized = docs.selectExpr("doc_id", "source", "1 AS target", "text").withColumn("size", word_count(text_of())).drop("text")
    out = mixture.mix_by_weights(written(sized, "sized"), "doc_id", (3, 1, 2), 1.5).collect()
    assert len(out) == 7 and {r.doc_id: r.size for r in out if r.doc_id != 4} == {1: 2, 2: 0, 3: 0, 5: 0, None: 2}
    assert sorted(r.size for r in out if r.doc_id == 4) == [1, 2]
    assert {r.source: r.source_size for r in out} == {None: 2, "x": 5, "y": 0}
    assert all(r.taken <= 2 * r.size for r in out)
    assert [r.copies for r in out if r.source == "y"] == [1]
    empty = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixture.mix_by_weights(empty, "doc_id", (3, 1, 2), 1.5).count() == 0


def test_rates_solve_the_dual(spark):
    """The rates of each source add up to its target, from starts at either end of the bracket."""
    rng = random.Random(9)
    rows = [(i, f"s{i % 6}", rng.randrange(1, 3000)) for i in range(300)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long")
    totals = {s: sum(n for _, t, n in rows if t == s) for s in {r[1] for r in rows}}
    shares = {"s0": 0.2, "s1": 0.999, "s2": 1.001, "s3": 1.5, "s4": 1.97, "s5": 2.0}
    targets = spark.createDataFrame([(s, totals[s] * x) for s, x in shares.items()], "source string, target double")
    mixed = mixture.mix(sized, targets, "doc_id").collect()
    for source, share in shares.items():
        own = [r for r in mixed if r["source"] == source]
        assert sum(r["rate"] * r["size"] for r in own) == pytest.approx(share * totals[source], rel=1e-6)
        assert all(0 <= r["rate"] <= 2 and r["copies"] <= 2 for r in own)
