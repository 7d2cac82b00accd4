import random
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import alignment, pieces, token_files
from cohortspark.llm.queries import PIECES

sentencepiece = pytest.importorskip("sentencepiece")
needs_model = pytest.mark.skipif(not Path(PIECES).exists(), reason="no model file")

ODD = [
    "", " ", "   ", "a", "  two  spaces ", "tab\tand\nlines\r\n", "日本語𝒳😀", "x▁y", "\x00\x01", "naïve café ß",
    "for (int i = 0; i < 10; i++) {\n    x_1 += `a`;\n}\n", "aaaaaaaaaaaaaaaaaaaa", "12345 3.14", "привет мир", "ab" * 3000,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz .,_éßñ0123ABC'-\n日дд▁😀"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(1500)]


@needs_model
def test_encoding_equals_the_library(texts):
    own = pieces.Transducer(pieces.read_model(PIECES))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for t in texts:
        ids = np.frombuffer(own.encoded(t), dtype="<i4").tolist()
        assert ids == library.encode(t), t
        assert own.decoded(ids) == t.replace("▁", " ")


@needs_model
def test_merges_and_paths_agree(texts):
    own = pieces.Transducer(pieces.read_model(PIECES))
    for t in texts[:300]:
        text = own.normalised(t)
        if len(text) < 200:
            assert [x for part in own.part.findall(text) for x in own.finite(part)] == own.merged(text)


def unigram():
    names = ["<unk>", "<0x00>", "▁", "a", "b", "ab", "▁ab", "abab"]
    names += [f"<0x{b:02X}>" for b in range(1, 256)]
    kinds = [2, 6, 1, 1, 1, 1, 1, 1] + [6] * 255
    scores = [0.0, 0.0, -2.0, -3.0, -3.0, -4.0, -4.5, -9.5] + [0.0] * 255
    return pieces.Model(tuple(names), tuple(scores), tuple(kinds), False, {}, True, False)


def test_unigram_shortest_path():
    model = unigram()
    own = pieces.Transducer(model)

    def best(text):
        if not text:
            return 0.0, []
        found = []
        for end in range(1, len(text) + 1):
            piece = text[:end]
            if piece in own.arcs or end == 1:
                cost = -model.scores[own.arcs[piece]] if piece in own.arcs else -own.worst
                rest, tail = best(text[end:])
                found.append((cost + rest, [piece, *tail]))
        return min(found, key=lambda x: x[0])

    for t in ("abab", "ab ab", "ba", "abc", "aab", "é b"):
        text = own.normalised(t)
        ids = np.frombuffer(own.encoded(t), dtype="<i4").tolist()
        cost = sum(-model.scores[i] if model.kinds[i] == 1 else 0 for i in ids)
        unknown = sum(c not in own.arcs for c in text)
        assert cost - unknown * own.worst == pytest.approx(best(text)[0])
        assert own.decoded(ids) == t


def test_rewriting_rules_of_a_compiled_map():
    from sentencepiece import sentencepiece_model_pb2 as proto

    norm = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    model = proto.ModelProto()
    model.ParseFromString(norm.serialized_model_proto())
    rules = pieces.rewriting_rules(model.normalizer_spec.precompiled_charsmap)
    assert rules["ﬁ"] == "fi" and rules["Ⅷ"] == "VIII"
    own = pieces.Transducer(pieces.Model(**{**unigram().__dict__, "rules": rules}))
    for t in ("ﬁn Ⅷ", "ＡＢ", "é", "ｶﾞ"):
        assert own.normalised(t) == norm.normalize(t)


@needs_model
def test_columns_and_nulls(spark, texts):
    codec = pieces.Codec(spark, PIECES)
    data = [(i, t, "x") for i, t in enumerate([*texts[:200], None])]
    df = spark.createDataFrame(data, "doc_id long, text string, token_ids string")
    out = df.withColumn("token_ids", codec.encode(F.col("text"))).withColumn("back", codec.decode(F.col("token_ids")))
    for r in out.collect():
        assert r.back == (r.text or "").replace("▁", " ")
    assert df.limit(0).withColumn("ids", codec.encode(F.col("text"))).count() == 0


def test_permutation_is_a_bijection_that_the_key_chooses():
    for n in (1, 2, 3, 5, 17, 1000, 4097):
        assert sorted(token_files.Permutation(n, 3)(np.arange(n)).tolist()) == list(range(n))
    a, b = (token_files.Permutation(1000, k)(np.arange(1000)) for k in (1, 2))
    assert (a != b).mean() > 0.9


@pytest.mark.parametrize("ids", ["bytes", "pieces"])
def test_shards_hold_every_text_in_permuted_order(spark, tmp_path, ids):
    if ids == "pieces" and not Path(PIECES).exists():
        pytest.skip("no model file")
    ids = token_files.ByteIds() if ids == "bytes" else token_files.PieceIds(alignment.piece_model(PIECES))
    rng = random.Random(6)
    data = [(i, "é word " * rng.randint(0, 40), 1) for i in range(120)] + [(500, None, 1), (501, "", 1), (0, "same", 1), (0, "same", 1)]
    df = spark.createDataFrame(data, "doc_id long, text string, slot int").repartition(3)
    folder = f"file://{tmp_path}/out"
    rows = sorted(token_files.materialise(df, folder, ids, length=32, shard_rows=10).collect())
    found = list(token_files.read_sequences(folder))
    assert [r.slot for r in rows] == list(range(len(found)))
    assert [r["crc32"] for r in rows] == [zlib.crc32(s.tobytes()) for s in found]
    assert all(r.shard == r.slot // 10 and r.byte_offset == r.slot % 10 * 32 * found[0].itemsize for r in rows)
    assert [s.tolist() for s in token_files.read_sequences(folder, 23)] == [s.tolist() for s in found[23:]]
    order = token_files.Permutation(len(found), 42)(np.arange(len(found)))
    stream, got, one = np.concatenate([found[i] for i in order]), [], []
    for x in stream[stream != ids.pad].tolist():
        if x == ids.end:
            got.append(one)
            one = []
        else:
            one.append(x)
    want = [np.frombuffer(own, dtype=ids.dtype).tolist() for own in ids.encoded([t for _, t, _ in data if t])]
    assert sorted(got) == sorted(want) and not one
    assert token_files.materialise(df.limit(0), f"file://{tmp_path}/none", ids).count() == 0


@needs_model
def test_pipeline_stages_on_a_small_corpus(spark, tmp_path):
    import brute
    import corpus_pipeline as pipeline

    rng = random.Random(2)
    rows = []
    for i in range(300):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(60)]
        text = " ".join(w.upper() + "!!" for w in words) if i % 5 == 0 else " ".join(words)
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    clean = [r for r in rows if r[0] % 5]
    rows += [(1000 + k, r[1], "en", "s0", r[4]) for k, r in enumerate(clean[:20])]
    rows += [(2000 + k, r[1] + " end", "en", "s1", r[4]) for k, r in enumerate(clean[20:40])]
    rows += [(3000, None, None, None, None), (3001, "", "en", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, int(i % 5 > 0)) for i in range(300)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    names = [n for n, _ in pipeline.STAGES]
    assert len(names) == 5
    stages = dict(pipeline.STAGES)
    good = stages[names[0]](spark, docs, str(tmp_path))
    assert good.columns == docs.columns
    ids = {r.doc_id for r in good.collect()}
    assert not {i for i in ids if i < 1000 and i % 5 == 0} and len([i for i in ids if i < 3000]) == 280
    once = stages[names[1]](spark, good, str(tmp_path))
    kept = {r.doc_id: r.text for r in once.collect()}
    assert {i for i in kept if 1000 <= i < 2000} == set(range(1000, 1020)) and len([i for i in kept if i < 3000]) == 260
    near = stages[names[2]](spark, once, str(tmp_path))
    groups = brute.groups(kept, brute.jaccard_links(kept))
    assert {r.doc_id for r in near.collect()} == {i for i in kept if groups[i] == i}
    out = pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= {i for i in kept if groups[i] == i}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for r in out:
        assert r.token_ids == library.encode(r.text or "") and r.n_tokens == len(r.token_ids)
    words = sum(len((r.text or "").split()) for r in out)
    source = sum(len((kept[i] or "").split()) for i in kept if groups[i] == i)
    assert abs(words - 1.5 * source) <= 3 * 65
