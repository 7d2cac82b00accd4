"""The resampling, alignment and search operators against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from cohortspark.llm import alignment, resample, topk

# --- resampling ------------------------------------------------------------------

TEXT = "doc_id long, text string, row string, bucket int"


def features(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [crc32(r.encode()) % 10000 for r in runs]


def plain_resample(rows, target, percent, min_words):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    out = []
    for doc_id, text in rows:
        n, found = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in found)
        name = "42:" + ("" if doc_id is None else str(doc_id))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = {r[0]: i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((r[0], *r[2:], ranks.get(r[0])) for r in out), key=str)


def some_texts():
    rng = random.Random(3)
    words = ["Alpha", "beta", "ÉtÉ", "語", "x9", "the", "of"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " ..!\n"), (None, "alone " * 30), (64, "copy of it " * 9), (65, "copy of it " * 9)]
    return rows + [(66, "long-text, " * 60_000 + "ende")]


@pytest.mark.parametrize("size", [1, 3, 1 << 18])
def test_slices_give_the_same_checksums(monkeypatch, size):
    monkeypatch.setattr(resample, "_SLICE", size)
    for text in ("", "a", "aB cé 語 d", "...a..b", "abcdef  ghi.j k l m", "é" * 9 + " " + "x" * 7):
        n, found = 0, []
        for words, sums in resample.checksums(text.encode()):
            n, found = n + words, found + [c % 10000 for c in sums]
        assert (n, sorted(found)) == (features(text)[0], sorted(features(text)[1]))


def test_resample(spark):
    rows = some_texts()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], TEXT).repartition(5)
    target = ["the beta of X9 été", None, "語 of the beta"]
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(docs, aims, percent=20)
    assert sorted(map(tuple, got.collect()), key=str) == plain_resample(rows, target, 20, 20)
    again = resample.resample(docs.repartition(2), aims, percent=20)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, got.collect()), key=str)


def test_resample_of_nothing(spark):
    empty = spark.createDataFrame([], TEXT)
    one = spark.createDataFrame([(1, "a b", "", 0), (1, "a b", "", 0)], TEXT)
    assert resample.resample(empty, one).collect() == []
    rows = resample.resample(one, empty, percent=100, min_words=2).collect()
    assert sorted(r["rank"] for r in rows) == [1, 2] and len({r["score"] for r in rows}) == 1


# --- alignment -------------------------------------------------------------------

BYTES, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.byte_level(BYTES), alignment.piece_model(PIECES)


def plain_alignment(rows, a, b):
    counts, per = Counter(), []
    for doc_id, text in rows:
        whole, ids, ends = f" {text}".encode(), [], []
        for side in (a, b):
            ids.append(side.encode([text])[0] if text else [])
            tokens = [side.table[i] for i in ids[-1]]
            ends.append([sum(map(len, tokens[: k + 1])) for k in range(len(tokens))])
            if b"".join(tokens) != whole:
                ids, ends = [[], []], [[], []]
                break
        spans = [list(zip([0, *e][:-1], e)) for e in ends]
        links = [
            (ids[0][i], ids[1][j])
            for i, (s, e) in enumerate(spans[0])
            for j, (u, v) in enumerate(spans[1])
            if max(s, u) < min(e, v)
        ]
        counts.update(links)
        groups, begin = [], 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            sides = [",".join(str(i) for i, e in zip(x, y) if begin < e <= end) for x, y in zip(ids, ends)]
            groups.append("|".join(sides))
            begin = end
        per.append((doc_id, len(ids[0]), len(ids[1]), len(groups), links, ";".join(groups)))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        (d, n_a, n_b, n, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), text)
        for d, n_a, n_b, n, links, text in per
    )


def aligned_texts():
    odd = ["", None, "a", " leading", "two  blanks\n\n", "no▁mark", "ﬁ ligature", "<|endoftext|> and </s> <0x41>", "日本語のテキスト", "é café 🎉🎉", "\x00\t\x7f"]
    same = ["the same words again"] * 3
    long = ["All work and no play makes Jack a dull boy. Ünïcödé! " * 12]
    return list(enumerate(odd + same + long))


@pytest.mark.parametrize("options", [{}, {"work": 16}, {"work": 3, "hot_pairs": 20}, {"work": 1, "hot_pairs": 0}])
def test_alignment(spark, tokenizers, options):
    rows = aligned_texts()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, row string, piece int")
    want = plain_alignment(rows, *tokenizers)
    got = alignment.align(docs.repartition(3), *tokenizers, **options)
    assert sorted(map(tuple, got.collect())) == want
    hashed = alignment.align(docs, *tokenizers, digest=True, **options)
    digests = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    assert sorted(map(tuple, hashed.collect())) == digests


def test_links_are_those_of_the_pair_counts(spark, tokenizers):
    docs = spark.createDataFrame(aligned_texts(), "doc_id long, text string")
    aligner = alignment.Aligner(*tokenizers, work=10)
    pieces = aligner.pieces(docs)
    links = aligner.links(pieces).groupBy((F.shiftleft(F.col("b_id").cast("long"), 32) + F.col("a_id")).alias("pair")).count()
    assert sorted(map(tuple, links.collect())) == sorted((r["pair"], r["n"]) for r in aligner.pair_counts(pieces).collect())


def test_chunks_do_not_change_ids(tokenizers):
    texts = [t for _, t in aligned_texts() if t]
    texts += ["Some words 4 you, and  more\nwords é a b ! c 日本 x y 's ´ z ", "don't do 't 're a  b \t c\n d ½ e ß , f"] * 3
    texts += ["".join(random.Random(i).choices("ab1 ,'é日\n\u0301\u00a0-", k=80)) for i in range(200)]
    encode = alignment.Encoder(tokenizers, chunks=50)
    assert all(t.splits for t in tokenizers)
    for some in (texts[i : i + 7] for _ in range(2) for i in range(0, len(texts), 7)):
        for text, ids in zip(some, encode(some), strict=True):
            whole = [t.encode([text])[0] for t in tokenizers]
            same = all(b"".join(map(t.table.__getitem__, w)) == f" {text}".encode() for t, w in zip(tokenizers, whole))
            assert (ids is not None) == same
            assert not same or [i.tolist() for i in ids] == whole, text


def test_pieces_have_equal_work():
    import numpy as np

    a, b = np.cumsum([3, 1, 4, 1, 5, 9, 2, 6]), np.cumsum([4, 4, 8, 5, 10])
    i, j = alignment.diagonal_splits(a, b, 4)
    assert (i + j).tolist() == [0, 4, 8, 12, 13]
    merged = sorted([(e, 0) for e in a.tolist()] + [(e, 1) for e in b.tolist()])
    assert i.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in (0, 4, 8, 12, 13)]


def test_alignment_of_no_rows(spark, tokenizers):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), *tokenizers).collect() == []


# --- search ----------------------------------------------------------------------


def plain_search(rows, k):
    usable = [(i, r, [math.floor(256 * x) for x in v]) for i, (r, v) in enumerate(rows) if v and None not in v and r is not None and all(map(math.isfinite, v))]
    out = []
    for i, q, x in usable:
        if q % 3 == 0:
            scores = [(sum(map(int.__mul__, x, y)), r, j) for j, r, y in usable if j != i and len(y) == len(x)]
            scores = sorted((-max(-(2**63), min(2**63 - 1, s)), r, j) for s, r, j in scores)
            out += [(q, rank, r, -score) for rank, (score, r, _) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 1 << 16])
def test_search(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "_CANDIDATES", 16)
    monkeypatch.setattr(topk, "_QUERIES", 8)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) for _ in range(20)]) for i in range(60)]
    rows += [(60 + i, rows[3][1]) for i in range(9)] + [(3, rows[3][1])]  # ties, a repeated id
    rows += [(80, None), (81, []), (82, [1.0, None]), (84, [math.nan]), (87, [math.inf]), (None, [1.0] * 20)]
    rows += [(90, [1.0]), (91, [2.0]), (92, [-3.0]), (93, [0.0])]  # other lengths
    rows += [(96, [1e14, 1.0, 3.0]), (97, [1e14, 1.0, 2.0]), (98, [1e14, 2.0, 3.0]), (99, [5e13, 1.0, -1.0]), (100, [1e300, 1.0, 1.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, row int, v string")
    found = topk.top_k(table.repartition(4), F.col("vec_id") % 3 == 0, 5, block=block)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == plain_search(rows, 5)


def test_bounds_hold():
    import numpy as np

    x = np.floor(256 * np.random.default_rng(1).normal(size=(50, 37)))
    exact = x @ x.T
    bounds = [topk.segment_statistics(x, s) for s in topk.SEGMENTS]
    for coarse, fine in zip(bounds, bounds[1:]):
        assert (coarse @ coarse.T >= fine @ fine.T - 1e-6).all()
    assert (bounds[-1] @ bounds[-1].T >= exact - 1e-6).all()


def test_search_of_no_rows(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
