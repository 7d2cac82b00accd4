"""Alignment of the tokens that two tokenizers make of the same text.

Both lists of tokens end at byte offsets in ascending order. Merging the two lists of ends
walks through the text, and every step is the overlap of one token of A with one of B;
where both end, a group ends. The merge is cut into pieces of equal work by its diagonals:
diagonal d holds all ways to take d ends, i of A and d - i of B, and a binary search finds
the one that a merge (A first on ties) passes. Pieces are rows of a table, each with the
ids of its tokens, the token of either side that is still open at its end, and the offsets
at which it begins; they are merged independently of each other, so that a very long text
is many rows of bounded size. Each piece emits its overlaps and whole groups; what is open
at its sides is stitched together in the order of the pieces.

Overlaps are counted for each pair of ids: sorted runs of bounded size in the tasks, then
sums. The most frequent pairs, at most 2^20 of them, are given to all tasks; the overlaps of all other pairs are joined with the counts.

Cases: texts that are null or empty, and texts that one of the tokenizers does not
reproduce, have no tokens: numbers are 0 and the groups empty; rows that repeat an id or a
text are texts of their own; very long texts are encoded in chunks (but for models with
pieces across words); an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import ship, text_of, written
from cohortspark.llm.shingles import batches as text_batches

MARK = "▁"
WORK = 1 << 15
HOT_PAIRS = 1 << 20
_LINKS = 1 << 18
_RUN = 1 << 21
_EDGE = "[!-~\u00c0-\u024f]"
_CUT = re.compile(f"(?<={_EDGE}) (?={_EDGE})")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes
    stand for themselves, the others for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


@dataclass(frozen=True)
class _File:
    """A tokenizer is sent to the tasks as its file; each worker loads it once."""

    content: str | bytes = field(repr=False)

    def __reduce__(self):
        return type(self), (self.content,)


class ByteLevel(_File):
    """A byte-level BPE as a tokenizers file; special tokens in texts are plain text."""

    @cached_property
    def _model(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(self.content)
        model.encode_special_tokens = True
        return model

    @cached_property
    def table(self) -> list[bytes]:
        letters = _byte_letters()
        ids = self._model.get_vocab(with_added_tokens=True)
        out = [b""] * (max(ids.values()) + 1)
        for token, i in ids.items():
            out[i] = bytes(letters[c] for c in token)
        return out

    #: Words are cut before a single space, so no token goes across it.
    splits = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text."""
        made = self._model.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return [m.ids for m in made]


class Pieces(_File):
    """A SentencePiece model, which puts a space before the text itself."""

    @cached_property
    def _model(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.content)

    @cached_property
    def table(self) -> list[bytes]:
        m = self._model
        names = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        return [
            bytes([int(n[3:5], 16)]) if m.is_byte(i) else n.replace(MARK, " ").encode("utf-8", "surrogatepass")
            for i, n in enumerate(names)
        ]

    @cached_property
    def splits(self) -> bool:
        """Whether no piece goes across a space, so that merges do not either."""
        return not any(b" " in t.lstrip(b" ") for t in self.table)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def byte_level(path: str) -> ByteLevel:
    return ByteLevel(Path(path).read_text(encoding="utf-8"))


def piece_model(path: str) -> Pieces:
    return Pieces(Path(path).read_bytes())


class Encoder:
    """Encodes texts as chunks, and remembers the ids of chunks that it met lately.

    A text is cut at single spaces between two letters, digits or signs of Latin scripts.
    Neither tokenizer joins what is on both sides of one, so that the chunks' ids, each
    with its space before it, are the text's ids. Most chunks are words, and repeat; new
    ones are encoded as one text.
    """

    def __init__(self, tokenizers: tuple, chunks: int = 1 << 18, longest: int = 48):
        self.tokenizers, self.chunks, self.longest = tokenizers, chunks, longest
        self.lengths = [np.array([len(t) for t in v.table]) for v in tokenizers]
        self.split = _CUT.split if all(v.splits for v in tokenizers) else lambda text: [text]
        # of each tokenizer; all know the same chunks
        self.known: list[dict[str, bytes | None]] = [{} for _ in tokenizers]
        self.older = self.known

    def __call__(self, texts: list[str]) -> Iterator[list[np.ndarray] | None]:
        """The ids that each tokenizer gives a space and a text, or none for a text of
        which one of them does not give the bytes."""
        parts = list(map(self.split, texts))
        known, older = self.known, self.older
        wanted = set(chain.from_iterable(parts)).difference(known[0])
        again = {c for c in wanted if c in older[0]}
        new = wanted.difference(again)
        ends = {c for chunks in parts for c in (chunks[0], chunks[-1])} & new
        singles, inner = list(ends), list(new - ends)
        for side, ids in enumerate(known):
            ids.update((c, older[side][c]) for c in again)
            ids.update(self._singly(side, singles))
            ids.update(self._together(side, inner))
        lost = {c for ids in known for c in new if ids[c] is None}
        out = [
            [np.frombuffer(b"".join(map(ids.__getitem__, chunks)), dtype="<u4") for ids in known]
            if not lost or lost.isdisjoint(chunks)
            else None
            for chunks in parts
        ]
        for chunk in [c for c in new if len(c) > self.longest or c in lost]:
            for ids in known:
                del ids[chunk]
        if len(known[0]) > self.chunks:
            self.known, self.older = [{} for _ in known], known
        return iter(out)

    def _checked(self, side: int, chunk: str, ids: list[int]) -> bytes | None:
        same = b"".join(map(self.tokenizers[side].table.__getitem__, ids)) == f" {chunk}".encode()
        return np.array(ids, dtype="<u4").tobytes() if same else None

    def _singly(self, side: int, chunks: list[str]) -> dict[str, bytes | None]:
        made = self.tokenizers[side].encode(chunks)
        return {c: self._checked(side, c, ids) for c, ids in zip(chunks, made, strict=True)}

    def _together(self, side: int, chunks: list[str]) -> dict[str, bytes | None]:
        """The ids of chunks that stood between two others, encoded as one text."""
        if not chunks:
            return {}
        text = " ".join(chunks)
        ids = self._checked(side, text, self.tokenizers[side].encode([text])[0])
        if ids is None:
            return self._singly(side, chunks)
        begins = np.cumsum([len(c.encode()) + 1 for c in chunks])
        ends = np.cumsum(self.lengths[side][np.frombuffer(ids, dtype="<u4")])
        upto = [0, *(4 * (np.searchsorted(ends, begins) + 1)).tolist()]
        return {c: ids[low:high] for c, low, high in zip(chunks, upto, upto[1:])}


def id_code(tokenizer) -> str:
    return "<u2" if len(tokenizer.table) <= 1 << 16 else "<u4"


# --- the merge -----------------------------------------------------------------


def diagonal_splits(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) where a merge of the ends is cut into pieces of `work` ends each."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (searching := np.flatnonzero(low < high)).size:
        middle = (low[searching] + high[searching]) // 2
        before = a[middle] <= b[d[searching] - middle - 1]
        low[searching] = np.where(before, middle + 1, low[searching])
        high[searching] = np.where(before, high[searching], middle)
    return low, d - low


@dataclass(frozen=True)
class Merged:
    """What one piece emits; tokens are counted within the piece."""

    link_a: np.ndarray
    link_b: np.ndarray
    cut_a: np.ndarray  # tokens of A before the end of each group that ends here
    cut_b: np.ndarray


def merged(a_end: np.ndarray, b_end: np.ndarray, n_a: int, n_b: int, begin: int) -> Merged:
    """Overlaps and ends of groups of a piece.

    The ends may have one more than the n_a and n_b ends of the piece: of the token that
    is still open. `begin` is the last end of A before the piece.
    """
    own_a, own_b = a_end[:n_a], b_end[:n_b]
    upto = np.searchsorted(own_a, own_b, "right")
    last = np.where(upto > 0, own_a[upto - 1], begin) if n_a else np.full(n_b, begin)
    both = last == own_b
    alone = np.flatnonzero(~both)
    return Merged(
        np.concatenate([np.arange(n_a), upto[alone]]),
        np.concatenate([np.searchsorted(b_end, own_a), alone]),
        upto[both],
        np.flatnonzero(both) + 1,
    )


def groups_text(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, sizes: tuple[int, int]) -> bytes:
    """`a1,a2|b1;a3|b2,b3` of whole groups, whose tokens end at the cuts."""
    if not len(cut_a):
        return b""
    groups = np.arange(len(cut_a))
    of_a = np.repeat(groups, np.diff(cut_a, prepend=0))
    of_b = np.repeat(groups, np.diff(cut_b, prepend=0))
    place_a = np.arange(len(a)) + np.append(0, cut_b[:-1])[of_a]
    place_b = np.arange(len(b)) + cut_a[of_b]
    code_a, code_b = 2 * a, 2 * b + 2 * sizes[0]
    code_a[cut_a - 1] += 1
    code_b[cut_b - 1] += 1
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    codes[place_a], codes[place_b] = code_a, code_b
    names = _names(*sizes)
    return b"".join(map(names.__getitem__, codes.tolist()))[:-1]


@lru_cache(maxsize=2)
def _names(size_a: int, size_b: int) -> list[bytes]:
    """Every id of A, then of B, within a group and as its last."""
    sides = ((size_a, "|"), (size_b, ";"))
    return [f"{i}{mark}".encode() for size, last in sides for i in range(size) for mark in (",", last)]


def _listed(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


# --- pieces of all texts ---------------------------------------------------------

_PIECE = "row long, doc_id long, piece int, pieces int, begin_a long, begin_b long, n_a int, n_b int, a binary, b binary"


class Aligner:
    """Two tokenizers, and the tables of an alignment of texts."""

    def __init__(self, a, b, work: int = WORK, hot_pairs: int = HOT_PAIRS):
        self.a, self.b, self.work, self.hot_pairs = a, b, work, hot_pairs

    def pieces(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row for each piece of each text; a text without tokens has one of no tokens."""
        spark = docs.sparkSession
        ship(spark)
        shared, work = spark.sparkContext.broadcast((self.a, self.b)), self.work

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a, b = shared.value
            lengths = [np.array([len(t) for t in v.table]) for v in (a, b)]
            codes = [id_code(v) for v in (a, b)]
            encode = Encoder((a, b))

            def of(text: str, ids: list[np.ndarray] | None) -> Iterator[tuple]:
                if not text or ids is None:
                    yield 0, 1, 0, 0, 0, 0, b"", b""
                    return
                ends = [np.cumsum(n[i]) for n, i in zip(lengths, ids, strict=True)]
                cuts = diagonal_splits(*ends, work)
                for p in range(len(cuts[0]) - 1):
                    sides = []
                    for side in (0, 1):
                        low, high = cuts[side][p : p + 2]
                        begin = int(ends[side][low - 1]) if low else 0
                        sides.append((begin, int(high - low), ids[side][low : high + 1].astype(codes[side]).tobytes()))
                    yield (p, len(cuts[0]) - 1, *(x for pair in zip(*sides, strict=True) for x in pair))

            for batch in batches:
                row, doc_id, texts = (batch.column(i).to_pylist() for i in range(3))
                for low, high in text_batches(texts, 1 << 19):
                    some = [t or "" for t in texts[low:high]]
                    out = [
                        (row[low + i], doc_id[low + i], *piece)
                        for i, (text, ids) in enumerate(zip(some, encode(some), strict=True))
                        for piece in of(text, ids)
                    ]
                    yield _batch(out, _PIECE)

        rows = docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).cast("long").alias("doc_id"),
            text_of(F.col(text_col).cast("string")).alias("text"),
        )
        return written(rows.mapInArrow(cut, _PIECE), "pieces")

    def _merges(self) -> Callable[[dict], tuple[np.ndarray, np.ndarray, Merged]]:
        """A function from rows of pieces to (ids of A, ids of B, what the piece emits)."""
        lengths = [np.array([len(t) for t in v.table]) for v in (self.a, self.b)]
        codes = [id_code(v) for v in (self.a, self.b)]

        def merge(piece: dict) -> tuple[np.ndarray, np.ndarray, Merged]:
            a, b = (np.frombuffer(piece[s], dtype=c).astype(np.int64) for s, c in zip("ab", codes, strict=True))
            a_end, b_end = piece["begin_a"] + np.cumsum(lengths[0][a]), piece["begin_b"] + np.cumsum(lengths[1][b])
            return a, b, merged(a_end, b_end, piece["n_a"], piece["n_b"], piece["begin_a"])

        return merge

    def links(self, pieces: DataFrame) -> DataFrame:
        """(row, doc_id, piece, a_id, b_id) of every overlap."""
        merge, schema = self._merges(), "row long, doc_id long, piece int, a_id int, b_id int"

        def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in batch.to_pylist():
                    a, b, found = merge(piece)
                    n = len(found.link_a)
                    same = [pa.array(np.full(n, piece[c]), t) if piece[c] is not None else pa.nulls(n, t)
                            for c, t in (("row", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()))]
                    ids = [pa.array(x, pa.int32()) for x in (a[found.link_a], b[found.link_b])]
                    yield pa.RecordBatch.from_arrays([*same, *ids], ["row", "doc_id", "piece", "a_id", "b_id"])

        return pieces.mapInArrow(emitted, schema)

    def pair_counts(self, pieces: DataFrame) -> DataFrame:
        """(pair, n, best): how often ids overlap, and whether no other id of A overlaps
        more often with the id of B. The pair is the id of B in the high half of a long."""
        merge = self._merges()

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            total = np.empty(0, np.int64), np.empty(0, np.int64)

            def added():
                keys, n = np.unique(np.concatenate(held), return_counts=True)
                keys, at = np.unique(np.concatenate([total[0], keys]), return_inverse=True)
                return keys, np.bincount(at, np.concatenate([total[1], n])).astype(np.int64)

            for batch in batches:
                for piece in batch.to_pylist():
                    a, b, found = merge(piece)
                    held.append(b[found.link_b] << 32 | a[found.link_a])
                    size += len(found.link_a)
                    if size >= _RUN:
                        total, held, size = added(), [], 0
                        if len(total[0]) >= _RUN:
                            yield _columns(("pair", "n"), total)
                            total = np.empty(0, np.int64), np.empty(0, np.int64)
            if held:
                total = added()
            yield _columns(("pair", "n"), total)

        counts = pieces.select("begin_a", "begin_b", "n_a", "n_b", "a", "b").mapInArrow(counted, "pair long, n long")
        counts = written(counts.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
        of_b = F.shiftright("pair", 32)
        most = counts.groupBy(of_b.alias("b_id")).agg(F.max("n").alias("most"))
        known = counts.withColumn("b_id", of_b).join(most, "b_id")
        return written(known.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")

    def _hot(self, pairs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The most frequent pairs, their counts and whether they are the best."""
        level = F.floor(F.log2("n") * 8).cast("int")
        sizes = pairs.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()  # 504 at most
        least, taken = None, 0
        for row in sorted(sizes, key=lambda r: -r["level"]):
            taken += row["n"]
            if taken > self.hot_pairs:
                break
            least = row["level"]
        hot = pairs.where(level >= least) if least is not None else pairs.limit(0)
        found = hot.toPandas()  # at most `hot_pairs` rows
        return found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool)

    def documents(self, pieces: DataFrame, pairs: DataFrame, digest: bool = False) -> DataFrame:
        """One row for each text: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum
        and groups (their text, or with `digest` its SHA-256, which needs less room)."""
        spark = pieces.sparkSession
        shared = spark.sparkContext.broadcast(self._hot(pairs))
        merge, sizes = self._merges(), (len(self.a.table), len(self.b.table))
        parts = written(pieces.mapInArrow(_described(merge, sizes, shared, digest), _PART), "parts")
        numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        names = ["row", "doc_id", *numbers, "groups"]
        whole = parts.where("pieces = 1").select(*names)
        many = parts.where("pieces > 1").drop("rare").repartition("row").sortWithinPartitions("row", "piece")
        schema = "row long, doc_id long, " + ", ".join(f"{n} long" for n in numbers) + ", groups string"
        rows = whole.unionByName(many.mapInArrow(_stitched(digest), schema))
        rare = parts.select("row", F.explode("rare").alias("pair")).groupBy("row", "pair").agg(F.count("*").alias("times"))
        rare = rare.join(pairs, "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more_sum"),
        )
        full = rows.join(rare, "row", "left")
        return full.select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links",
            (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
            "groups",
        )


_PART = (
    "row long, doc_id long, piece int, pieces int, n_a long, n_b long, n_groups long, n_links long, n_best long, "
    "count_sum long, groups string, head_a string, head_b string, tail_a string, tail_b string, rare array<long>"
)


def _schema(ddl: str) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, types[t]) for n, t in (c.split() for c in ddl.split(", "))])


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = _schema(ddl)
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _columns(names: tuple[str, ...], arrays: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], list(names))


def _described(merge, sizes, shared, digest):
    """Pieces to parts: numbers, whole groups, what is open at the sides, rare pairs."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, times, best = shared.value
        places = pd.Index(pair)

        def counted(held: list[tuple]) -> Iterator[tuple]:
            """Looks the pairs of some pieces up, all at once."""
            keys = np.concatenate([keys for _, keys, _ in held])
            at = places.get_indexer(keys)
            hot = at >= 0
            n, top = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
            n[hot], top[hot] = times[at[hot]], best[at[hot]]
            low = 0
            for head, own, tail in held:
                part = slice(low, low + len(own))
                low += len(own)
                yield (*head, len(own), int(top[part].sum()), int(n[part].sum()), *tail, own[~hot[part]].tolist())

        held, size = [], 0
        for batch in batches:
            for piece in batch.to_pylist():
                a, b, found = merge(piece)
                n_a, n_b, p, n = piece["n_a"], piece["n_b"], piece["piece"], piece["pieces"]
                cut_a, cut_b = found.cut_a, found.cut_b
                sides = [None] * 4
                if n == 1:
                    text = groups_text(a[:n_a], b[:n_b], cut_a, cut_b, sizes)
                    if digest and text:
                        text = hashlib.sha256(text).hexdigest()
                elif len(cut_a):
                    begin, end = (cut_a[0], cut_b[0]), (cut_a[-1], cut_b[-1])
                    text = groups_text(a[begin[0] : end[0]], b[begin[1] : end[1]], cut_a[1:] - begin[0], cut_b[1:] - begin[1], sizes)
                    sides = [_listed(x) for x in (a[: begin[0]], b[: begin[1]], a[end[0] : n_a], b[end[1] : n_b])]
                else:
                    text, sides[:2] = b"", [_listed(a[:n_a]), _listed(b[:n_b])]
                head = (piece["row"], piece["doc_id"], p, n, n_a, n_b, len(cut_a))
                held.append((head, b[found.link_b] << 32 | a[found.link_a], (text, *sides)))
                size += len(found.link_a)
                if size >= _LINKS:
                    yield _batch(list(counted(held)), _PART)
                    held, size = [], 0
        if held:
            yield _batch(list(counted(held)), _PART)

    return described


def _stitched(digest):
    """Parts of the same text, one after the other, to the text's row."""

    def stitched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        for batch in batches:
            out = []
            for part in batch.to_pylist():
                if part["piece"] == 0:
                    sums, open_, some, sink = [0] * 6, ([], []), False, hashlib.sha256() if digest else []
                put = sink.update if digest else sink.append
                sums = [s + part[n] for s, n in zip(sums, names, strict=True)]
                for side, key in zip(open_, ("head_a", "head_b"), strict=True):
                    if part[key]:
                        side.append(part[key])
                if part["n_groups"]:
                    closed = ("|".join(",".join(side) for side in open_), part["groups"])
                    for text in filter(None, closed):
                        put((";" * some + text).encode())
                        some = True
                    open_ = tuple([part[key]] if part[key] else [] for key in ("tail_a", "tail_b"))
                if part["piece"] == part["pieces"] - 1:
                    text = sink.hexdigest() if digest else b"".join(sink).decode()
                    out.append((part["row"], part["doc_id"], *sums, text))
            yield _batch(out, "row long, doc_id long, " + ", ".join(f"{n} long" for n in names) + ", groups string")

    return stitched


def align(docs: DataFrame, a, b, id_col: str = "doc_id", text_col: str = "text", digest: bool = False, **options) -> DataFrame:
    """The alignment of every text of a table; see `Aligner.documents`."""
    aligner = Aligner(a, b, **options)
    pieces = aligner.pieces(docs, id_col, text_col)
    return aligner.documents(pieces, aligner.pair_counts(pieces), digest)
