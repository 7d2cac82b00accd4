"""Bounds of the n-gram join: they may let pairs through, and never drop one that counts."""

import random

import numpy as np
from pyspark.sql import functions as F

from brute import groups, jaccard_links
from cohortspark.llm import ngram_join
from cohortspark.llm.shingles import shingle_sets


def test_parities_differ_in_no_more_bits_than_the_sets():
    rng = np.random.default_rng(2)
    for n, m, common in ((3, 5, 2), (700, 900, 600), (5000, 4100, 4000), (40_000, 31_000, 30_000)):
        pool = rng.integers(0, 1 << 63, size=n + m - common, dtype=np.uint64)
        a, b = pool[:n], pool[n - common :]
        bits = ngram_join.differing_bits(ngram_join.wide_parity(a).tobytes(), ngram_join.wide_parity(b).tobytes())
        assert bits <= n + m - 2 * common
        far = ngram_join.differing_bits(ngram_join.wide_parity(a).tobytes(), ngram_join.wide_parity(pool[common - n :]).tobytes())
        assert far >= 0
    unlike = [ngram_join.wide_parity(rng.integers(0, 1 << 63, size=3000, dtype=np.uint64)).tobytes() for _ in range(2)]
    assert ngram_join.differing_bits(*unlike) * 7 > 6000  # such a pair is dropped


def test_merged_columns_keep_rows_and_weights(spark):
    rows = [(g, r, 20, g) for r in (1, 2, 3) for g in (0, 1, 2)] + [(7, 1, 20, 4), (7, 2, 20, 3), (8, 1, 20, 5), (8, 3, 20, 3)]
    merged = ngram_join.merged_columns(spark.createDataFrame(rows, "g long, row long, n long, pos int"))
    found = sorted((r["row"], r["pos"], r["last"], r["w"]) for r in merged.collect())
    assert found == [(1, 0, 2, 3), (1, 4, 4, 1), (1, 5, 5, 1), (2, 0, 2, 3), (2, 3, 3, 1), (3, 0, 2, 3), (3, 3, 3, 1)]


def test_shared_passages_of_long_texts(spark):
    """Texts of all degrees of likeness around the threshold, with passages in common."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(50, 400))] for _ in range(6)]
    texts = {}
    for i in range(90):
        own = [rng.choice(words) for _ in range(rng.randrange(5, 200))]
        picked = rng.sample(passages, rng.randrange(1, 4))
        texts[i] = " ".join([w for p in picked for w in p] + own)
    base = [rng.choice(words) for _ in range(1500)]
    for i in range(90, 120):
        copy = list(base)
        for at in rng.sample(range(len(copy)), (i - 90) * 4):
            copy[at] = rng.choice(words)
        texts[i] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(docs).collect()}
    assert got == groups(texts, jaccard_links(texts))
    sizes = {r["doc_id"]: r["n_shingles"] for r in ngram_join.jaccard_components(docs.where(F.col("doc_id") < 3)).collect()}
    assert sizes == {i: len(shingle_sets([texts[i]])[0]) for i in range(3)}


def test_contractions_leave_few_meetings_of_near_copies(spark, monkeypatch):
    rng = random.Random(9)
    texts = {}
    for i in range(60):  # the first one is far from most, all are near those of two changes
        words = [f"w{j}" for j in range(300)]
        for place in rng.sample(range(300), 5 if i == 0 else rng.randint(2, 5)):
            words[place] = f"x{i}-{place}"
        texts[i] = " ".join(words)
    seen, product = [], ngram_join.product_pairs

    def counted(rows):
        left = rows.select("g", "comp").alias("l").join(rows.select("g", "comp").alias("r"), "g").where("l.comp < r.comp")
        seen.append(left.count())
        return product(rows)

    monkeypatch.setattr(ngram_join, "product_pairs", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = groups(texts, jaccard_links(texts))
    for turns in (1, ngram_join._TURNS):
        monkeypatch.setattr(ngram_join, "_TURNS", turns)
        rows = ngram_join.jaccard_components(docs).collect()
        assert {r.doc_id: r.component_id for r in rows} == want
    assert seen[1] * 3 < seen[0]


def test_contractions_go_on_when_the_first_leaves_most_meetings(spark, monkeypatch):
    rng = random.Random(4)
    texts = {}
    for i in range(120):  # the first row, which stood for its columns, is near to few others
        words = [f"w{j}" for j in range(150)]
        for place in rng.sample(range(150), 4 if i < 20 else rng.choice((1, 2, 2, 3))):
            words[place] = f"x{i}-{place}"
        texts[i] = " ".join(words)
    met, product = [], ngram_join.product_pairs

    def counted(rows):
        found = product(rows)
        met.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "product_pairs", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    links = jaccard_links(texts)
    rows = ngram_join.jaccard_components(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == groups(texts, links)
    assert met[0] * 10 < len(links)
