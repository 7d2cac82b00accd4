from pathlib import Path

import numpy as np
import pytest

from cohortspark.llm import queries, token_files

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.mark.skipif(not Path(queries.PIECES).exists(), reason="no model file")
def test_the_query_writes_ids_of_the_model(spark, tmp_path, monkeypatch):
    texts = ["two words", "naïve café ß 日本", "", None, " x ", "x▁y  z", "a" * 70_000 + " b", "for (i = 0; i < 10; i++) {\n}\n" * 400]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    folder = f"file://{tmp_path}/out"
    monkeypatch.setattr(queries, "new_folder", lambda *_: folder)
    rows = queries.op8_token_files(spark, str(tmp_path)).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    want = [[*library.encode(t), library.eos_id()] for t in texts if t]
    found = list(token_files.read_sequences(folder))
    assert sum(r.n_tokens for r in rows) == sum(map(len, want))
    order = token_files.Permutation(len(found), 42)(np.arange(len(found)))
    stream = np.concatenate([found[i] for i in order]).tolist()
    got, one = [], []
    for x in stream:
        one.append(x)
        if x == library.eos_id():
            got.append([i for i in one if i])  # without the padding before it
            one = []
    assert sorted(got) == sorted(want)
