"""SQL of the registered queries against the queries, on rows that are hard for either."""

import duckdb
import pytest

from cohortspark.llm import queries


def agree(spark, folder, name, tables):
    con = duckdb.connect()
    for table, df in tables.items():
        df.write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    want = con.execute(queries.llm_oracles()[name])
    columns = sorted(c[0] for c in want.description)
    places = [[c[0] for c in want.description].index(c) for c in columns]
    found = queries.llm_queries()[name](spark, str(folder))
    assert sorted(found.columns) == columns
    rows = sorted(map(tuple, found.select(*columns).collect()), key=repr)
    assert rows == sorted((tuple(r[i] for i in places) for r in want.fetchall()), key=repr)
    return [dict(zip(columns, r, strict=True)) for r in rows]


def test_secrets(spark, tmp_path):
    key, digest = "AKIA" + "Z9" * 10, "0123456789abcdef" * 2
    texts = [
        None, "", "no finding", f"password = '{digest}' {key}", f"日本 é😀 API_KEY:abcdef apikey=short {digest}",
        f"{key}{digest}\n{key} Secret:\"x\" token=\"abc.def-ghi\"" * 50, "paſſword=abcdefgh toKen=abcdefgh", "x " * 400_000 + f"passwd={key}",
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, texts[3], "s"), (None, texts[4], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = agree(spark, tmp_path, "op7_secret_scan", {"documents": docs})
    assert all(sum(r[n] for r in found) for n in ("n_assign", "n_access", "n_hex"))


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, shard string")


HARD = [
    (0, None, "a", 1, "x"), (1, "", "a", 1, "x"), (2, "one two", "a", 1, "x"), (2, "one two", "a", 1, "x"),
    (3, "日本語 é😀", None, 1, "x"), (4, "w " * 300_000, "b", 1, "x"), (5, "tab\tand\nline \x0b end", "Z", 1, None),
]


def test_laws_of_shards(spark, tmp_path):
    rows = HARD + [(i, f"text {i % 7}", "s", 1, "x") for i in range(10, 200)]
    agree(spark, tmp_path, "laws_of_shards", {"documents": documents(spark, rows)})


@pytest.mark.parametrize("hard", [HARD, []])
def test_laws_of_mixture(spark, tmp_path, hard):
    rows = hard + [(i, "w " * (i % 40), f"s{i % 5 if i % 3 else 1}", 1, "x") for i in range(10, 900)]
    agree(spark, tmp_path, "laws_of_mixture", {"documents": documents(spark, rows)})
