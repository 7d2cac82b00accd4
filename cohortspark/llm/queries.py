"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm import (
    alignment, exact, lines, mixture, ngram_join, pieces, quality, resample, secret_scan, shards, token_files, topk, vectors,
)
from cohortspark.llm.common import new_folder, text_of, word_count, written


#: A SentencePiece model; its place is a parameter of the queries that use it.
PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: A byte-level BPE as a tokenizers file.
BYTE_BPE = os.environ.get("BYTE_BPE", "/opt/tokenizers/byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = written(docs.select("doc_id", "source", word_count(text_of()).alias("size")), "sized")
    mixed = mixture.mix_by_weights(sized, "doc_id", (3, 1, 2), 1.5, 2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked_vectors(table(spark, sf_dir, "embeddings"))


def op3_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(text_of()).alias("text_crc32"),
    )
    out = shards.shuffle_to_shards(rows, 24)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_pieces(spark: SparkSession, sf_dir: str, model: str = PIECES) -> DataFrame:
    codec = pieces.Codec(spark, model)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.withColumn("token_ids", codec.encode(F.col("text")))
    back = codec.decode(F.col("token_ids"))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        "token_ids",
        (back == F.translate(text_of(), pieces.MARK, " ")).alias("round_trip"),
    )


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), keys="grams")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [
        F.expr(f"cast(size(filter(secrets, s -> s.rule = '{rule.name}')) as long)").alias(f"n_{rule.name}")
        for rule in secret_scan.RULES
    ]
    listed = F.array_join(
        F.transform("secrets", lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    rows = found.select("doc_id", *counts, listed.alias("spans"))
    return rows.withColumn("base_sha256", F.sha2("spans", 256))


def op8_token_files(spark: SparkSession, sf_dir: str, model: str = PIECES) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ids = token_files.PieceIds(alignment.piece_model(model))
    return token_files.materialise(docs, new_folder(spark, "shards"), ids)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.probe(table(spark, sf_dir, "documents"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return resample.resample(docs, target, percent=5, min_words=20)


def op12_align_tokens(spark: SparkSession, sf_dir: str, byte_bpe: str = BYTE_BPE, model: str = PIECES) -> DataFrame:
    a, b = alignment.byte_level(byte_bpe), alignment.piece_model(model)
    aligned = alignment.align(table(spark, sf_dir, "documents"), a, b, digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op13_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def laws_of_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of `op3_shuffle_shards` without what is random, and what holds for all:
    shards within one row of each other, and slots from 0 without gaps."""
    rows = written(op3_shuffle_shards(spark, sf_dir), "dealt")
    by_shard = rows.groupBy("shard").agg(
        F.count("*").alias("n"), F.min("slot").alias("low"), F.max("slot").alias("high"), F.countDistinct("slot").alias("slots")
    )
    gapless = (F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("slots") == F.col("n"))
    least = F.when(F.count("*") == 24, F.min("n")).otherwise(0)  # a shard without rows is not there
    laws = by_shard.agg(
        (F.max("n") - least <= 1).alias("even"),
        (F.every(gapless) & (F.min("shard") >= 0) & (F.max("shard") < 24)).alias("gapless"),
    )
    return rows.select("doc_id", "size", "text_crc32", "law").join(F.broadcast(laws.withColumn("law", F.lit("rows"))), "law")  # one row


def laws_of_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and targets of `op1_mix_sources`, whether a document stays within its bound, and
    whether its source ends within one document of its target."""
    rows = written(op1_mix_sources(spark, sf_dir), "mixed")
    source = table(spark, sf_dir, "documents").select("doc_id", "source").distinct()
    sums = rows.join(source, "doc_id").groupBy("source")
    sums = sums.agg(F.sum("taken").alias("all_taken"), F.max("size").alias("most"), F.first("target").alias("goal"))
    near = sums.select("source", (F.abs(F.col("all_taken") - F.col("goal")) <= F.col("most")).alias("near"))
    near = source.join(near, source["source"].eqNullSafe(near["source"])).select("doc_id", "near")
    return rows.join(near, "doc_id").select(
        "doc_id", "size", "source_size", F.round("target").cast("long").alias("target"),
        (F.col("taken") <= 2 * F.col("size")).alias("bounded"), "near",
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_mix_sources, op2_near_vectors, op3_shuffle_shards, op4_pieces, op5_fuzzy_lines, op6_quality, op7_secret_scan, op8_token_files, op9_ngram_join, op10_exact_dedup, op11_resample, op12_align_tokens, op13_exact_topk, laws_of_shards, laws_of_mixture)
    }


#: crc32 in SQL: the shifted remainders of the 256 bytes, and a fold over a text's bytes.
_CRC = """
    remainders AS (
        SELECT list(c ORDER BY b) AS t
        FROM (
            SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
                       lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
            FROM (SELECT unnest(range(256)) AS b)
        )
    ),
    checksums AS (
        SELECT f, xor(4294967295, list_reduce(
                   list_prepend(4294967295, list_transform(
                       regexp_extract_all(hex(encode(f)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS crc
        FROM (SELECT DISTINCT f FROM features), remainders
    )
"""

_COMPONENTS = """
    reach(a, b) AS (
        SELECT a, b FROM linked
        UNION
        SELECT r.a, l.b FROM reach r JOIN linked l ON r.b = l.a
    ),
    lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
"""


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.islower() else c for c in words)


#: Kind, expression, its group with the value, and the least characters of that.
_SECRETS = (
    ("assign", f"({_either_case('password|passwd|secret|token|api_?key')})[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)


def _secrets_sql() -> str:
    """Matches and what stands between them alternate, so their lengths give the places."""
    kinds = " UNION ALL ".join(
        f"""
            SELECT id, {k} AS k, '{name}' AS kind, unnest(string_split_regex(text, '{regex}')) AS gap,
                   unnest(regexp_extract_all(text, '{regex}')) AS whole,
                   unnest(regexp_extract_all(text, '{regex}', {group})) AS value,
                   unnest(range(len(regexp_extract_all(text, '{regex}')))) AS i, {least} AS least
            FROM texts"""
        for k, (name, regex, group, least) in enumerate(_SECRETS)
    )
    counts = ", ".join(f"count(*) FILTER (kind = '{name}') AS n_{name}" for name, *_ in _SECRETS)
    return f"""
            WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
            matches AS ({kinds}),
            placed AS (
                SELECT *, CAST(sum(length(gap) + length(whole)) OVER (PARTITION BY id, k ORDER BY i) AS BIGINT) AS upto
                FROM matches WHERE i IS NOT NULL
            ),
            found AS (
                SELECT id, {counts},
                       string_agg(kind || ':' || (upto - length(whole)) || ':' || upto, ',' ORDER BY upto - length(whole), k) AS spans
                FROM placed WHERE length(value) >= least GROUP BY id
            )
            SELECT doc_id, {", ".join(f"coalesce(n_{name}, 0) AS n_{name}" for name, *_ in _SECRETS)},
                   sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
            FROM texts LEFT JOIN found USING (id)
        """


def llm_oracles() -> dict[str, str]:
    return {
        "op7_secret_scan": _secrets_sql(),
        "laws_of_shards": f"""
            WITH features AS (SELECT coalesce(text, '') AS f FROM documents),
            {_CRC}
            SELECT doc_id, CAST(strlen(coalesce(text, '')) + 8 AS BIGINT) AS size, crc AS text_crc32,
                   'rows' AS law, true AS even, true AS gapless
            FROM documents JOIN checksums ON f = coalesce(text, '')
        """,
        # sources in the order in which a rising level reaches their bounds
        "laws_of_mixture": """
            WITH sized AS (
                SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents
            ),
            sources AS (
                SELECT source, CAST(sum(size) AS BIGINT) AS own,
                       [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
                FROM sized GROUP BY source
            ),
            levels AS (
                SELECT *, 2 * own / weight AS bound,
                       (1.5::DOUBLE * sum(own) OVER () - coalesce(sum(2 * own) OVER below, 0))
                           / sum(weight) OVER (ORDER BY 2 * own / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
                FROM sources
                WINDOW below AS (ORDER BY 2 * own / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            ),
            goals AS (
                SELECT source, own, least(2 * own, weight * (SELECT max(level) FROM levels WHERE level <= bound)) AS target FROM levels
            )
            SELECT doc_id, size, own AS source_size, CAST(round(target) AS BIGINT) AS target, true AS bounded, true AS near
            FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
        """,
        "op2_near_vectors": f"""
            WITH RECURSIVE usable AS (
                SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x
                FROM embeddings
                WHERE label IS NOT NULL
                  AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
                  AND len(list_filter(embedding, lambda c: c <> 0)) > 0
            ),
            linked AS (
                SELECT p.vec_id AS a, q.vec_id AS b
                FROM usable p JOIN usable q ON p.label = q.label AND p.vec_id <> q.vec_id AND len(p.x) = len(q.x)
                WHERE list_cosine_similarity(p.x, q.x) >= 0.93
            ),
            {_COMPONENTS},
            counted AS (SELECT a, count(*) AS n FROM linked GROUP BY a)
            SELECT vec_id,
                   coalesce(n, 0) AS n_links,
                   least(vec_id, coalesce(low, vec_id)) AS component_id,
                   vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
            FROM embeddings LEFT JOIN counted c ON c.a = vec_id LEFT JOIN lowest l ON l.a = vec_id
        """,
        "op9_ngram_join": f"""
            WITH RECURSIVE worded AS (
                SELECT doc_id,
                       regexp_extract_all(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x20\\x09-\\x0D]+'
                       ) AS w
                FROM documents
            ),
            sets AS (
                SELECT doc_id,
                       CASE WHEN len(w) = 0 THEN []
                            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                            ELSE list_distinct([array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)])
                       END AS s
                FROM worded
            ),
            incidence AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
            linked AS (
                SELECT p.doc_id AS a, q.doc_id AS b
                FROM incidence p JOIN incidence q ON p.g = q.g AND p.doc_id <> q.doc_id
                GROUP BY ALL
                HAVING 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))
            ),
            {_COMPONENTS}
            SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
            FROM sets LEFT JOIN lowest ON a = doc_id
        """,
        "op11_resample": f"""
            WITH texts AS (
                SELECT 0 AS side, row_number() OVER () AS id, doc_id, text FROM documents
                UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
            ),
            worded AS (
                SELECT side, id, doc_id, regexp_extract_all(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
                FROM texts
            ),
            features AS (
                SELECT side, id, unnest(w) AS f FROM worded
                UNION ALL
                SELECT side, id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM worded
                UNION ALL
                SELECT side, id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM worded
            ),
            {_CRC},
            bucketed AS (
                SELECT side, id, crc % 10000 AS bucket, count(*) AS n
                FROM features JOIN checksums USING (f) GROUP BY ALL
            ),
            totals AS (
                SELECT CAST(coalesce(sum(n) FILTER (side = 0), 0) AS DOUBLE) + 10000 AS s_all,
                       CAST(coalesce(sum(n) FILTER (side = 1), 0) AS DOUBLE) + 10000 AS t_all
                FROM bucketed
            ),
            gains AS (
                SELECT bucket, CAST(floor(1000 * ln(
                           (t + 1) * any_value(s_all) / ((s + 1) * any_value(t_all)))) AS BIGINT) AS gain
                FROM (
                    SELECT bucket, CAST(coalesce(sum(n) FILTER (side = 0), 0) AS DOUBLE) AS s,
                           CAST(coalesce(sum(n) FILTER (side = 1), 0) AS DOUBLE) AS t
                    FROM bucketed GROUP BY bucket
                ), totals
                GROUP BY bucket, s, t
            ),
            weights AS (
                SELECT id, CAST(sum(n * gain) AS BIGINT) AS weight, CAST(sum(n) AS BIGINT) AS n_features
                FROM bucketed JOIN gains USING (bucket) WHERE side = 0 GROUP BY id
            ),
            scored AS (
                SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
                       coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                           (CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296
                       ))) AS BIGINT) AS score
                FROM worded LEFT JOIN weights USING (id) WHERE side = 0
            ),
            ranked AS (
                SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place,
                       5 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS drawn
                FROM scored
            )
            SELECT doc_id, n_features, weight, score,
                   CASE WHEN n_words >= 20 AND place <= drawn THEN place END AS rank
            FROM ranked
        """,
        "op13_exact_topk": """
            WITH usable AS (
                SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
                FROM embeddings
                WHERE vec_id IS NOT NULL AND len(embedding) > 0
                  AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
            ),
            scored AS (
                SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                       CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
                FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
                WHERE q.vec_id % 50 = 0
            )
            SELECT query_id,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
            QUALIFY rank <= 5
        """,
        "op10_exact_dedup": """
            SELECT doc_id,
                   max(doc_id) OVER same AS keep_id,
                   count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents
            WINDOW same AS (PARTITION BY coalesce(text, ''))
        """,
    }
