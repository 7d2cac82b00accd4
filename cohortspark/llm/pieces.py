"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The model is compiled to three transducers: the normaliser (its rewriting rules, the
leading space and the escape of spaces), the acceptor of pieces, and the fallback from
characters without a piece to bytes. Composed with a text they give a lattice whose arcs
are pieces; its shortest path in the tropical semiring is the encoding.

- A unigram model weighs an arc with the negated score of its piece.
- A BPE model has no such weights: what it does depends on the order of merges. Here the
  states remember the last piece, and an arc weighs 0 if merging the two pieces' text
  gives these two pieces again, else infinity. The path of finite weight is unique and is
  the result of the merges, so that one state for each position is enough.

If no piece has a space inside, a text falls apart where a space follows something else;
such parts are composed once and kept in a table of bounded size.

Cases: very long texts are encoded whole, part by part; null and empty texts give no ids and decode to an empty text; a space mark in the
text is a space (as in the model's own library); other characters always survive, as
bytes if need be; ids out of range or of control pieces decode to nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cohortspark.llm.common import ship

MARK = "▁"
_LARGEST_MODEL = 64 << 20
_KEPT = 200_000
_NORMAL, _UNKNOWN, _BYTE = 1, 2, 6
_UNIGRAM, _BPE = 1, 2
_FAR = float("inf")


@dataclass(frozen=True)
class Model:
    """What the transducers are compiled from."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    bpe: bool
    rules: dict[str, str]
    leading: bool
    squeeze: bool


def read_model(path: str) -> Model:
    """Parses a model file on the driver; it must be below a fixed size."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as file:
        raw = file.read(_LARGEST_MODEL + 1)
    if len(raw) > _LARGEST_MODEL:
        raise ValueError("the model is larger than 64 MB")
    model = proto.ModelProto()
    model.ParseFromString(raw)
    kinds = tuple(p.type for p in model.pieces)
    if model.trainer_spec.model_type not in (_UNIGRAM, _BPE) or 4 in kinds:
        raise ValueError("only unigram and BPE models without user-defined pieces")
    if not model.trainer_spec.byte_fallback:
        raise ValueError("only models with byte fallback")
    if model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with spaces as prefixes")
    norm = model.normalizer_spec
    return Model(
        tuple(p.piece for p in model.pieces),
        tuple(p.score for p in model.pieces),
        kinds,
        model.trainer_spec.model_type == _BPE,
        rewriting_rules(norm.precompiled_charsmap),
        norm.add_dummy_prefix,
        norm.remove_extra_whitespaces,
    )


def rewriting_rules(charsmap: bytes) -> dict[str, str]:
    """The rules of a compiled character map: a double-array trie, then the results."""
    if not charsmap:
        return {}
    size = int.from_bytes(charsmap[:4], "little")
    units = np.frombuffer(charsmap[4 : 4 + size], dtype="<u4").tolist()
    results = charsmap[4 + size :]
    rules: dict[str, str] = {}

    def offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    stack = [(0 ^ offset(units[0]), b"")]
    while stack:
        node, key = stack.pop()
        for byte in range(256):
            at = node ^ byte
            if at >= len(units) or units[at] & 0x800000FF != byte or not byte:
                continue
            child = at ^ offset(units[at])
            name = key + bytes([byte])
            if units[at] & 0x100:
                begin = units[child] & 0x7FFFFFFF
                rules[name.decode()] = results[begin : results.index(b"\0", begin)].decode()
            stack.append((child, name))
    return rules


class _Table(dict):
    """Ids (as bytes) of parts of texts. When it is full, the parts that were not used
    since it was last full are forgotten."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= _KEPT:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(part)
        if ids is None:
            ids = np.array(self.encode(part), dtype="<i4").tobytes()
        self[part] = ids
        return ids


class Transducer:
    """The compiled model."""

    def __init__(self, model: Model):
        self.model = model
        self.arcs = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == _NORMAL}
        # every beginning of a piece, and whether it is a piece itself
        self.begins = {p[:n]: p[:n] in self.arcs for p in self.arcs for n in range(1, len(p) + 1)}
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == _BYTE}
        self.worst = min(model.scores[i] for i in self.arcs.values()) - 10
        self.known: dict[str, dict[str, bool]] = {}
        self.part = re.compile(self.parts())
        self.table = _Table(self.shortest)
        longest = max(map(len, model.rules), default=0)
        self.rule_lengths = range(longest, 0, -1)
        self.text_of = [
            bytes([int(p[3:5], 16)]) if k == _BYTE else p.replace(MARK, " ").encode() if k == _NORMAL else b""
            for p, k in zip(model.pieces, model.kinds, strict=True)
        ]
        # the same one after the other, with nothing for an unknown id
        self.flat = np.frombuffer(b"".join(self.text_of), dtype=np.uint8)
        self.flat_size = np.array([*map(len, self.text_of), 0])
        self.flat_begin = np.cumsum(self.flat_size) - self.flat_size

    def parts(self) -> str:
        """A regex for the parts that no piece crosses the borders of.

        Pieces have no mark inside, and apart from leading marks they consist of letters
        and digits or have none; where that does not hold, the text is one part.
        """
        bodies = [p.lstrip(MARK) for p in self.arcs]
        if any(MARK in p for p in bodies):
            return r"[\s\S]+"
        mixed = {"_"}
        word = re.compile(r"\w")
        while True:
            own = {p: [c not in mixed and bool(word.match(c)) for c in p] for p in bodies}
            more = {c for p, w in own.items() if any(w) and not all(w) for c, x in zip(p, w, strict=True) if x}
            if not more:
                break
            mixed |= more
        no_word = "".join(map(re.escape, sorted(mixed)))
        used = {c for p in bodies for c in p}
        lone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in used)
        words = f"{MARK}*[^\\W{no_word}{lone}]+"
        others = f"{MARK}*(?:[^\\w{MARK}{lone}]|[{no_word}])+"
        return f"{words}|{others}|{MARK}+" + (f"|[{lone}]+" if lone else "")

    # --- normaliser

    def normalised(self, text: str) -> str:
        """The text as the piece acceptor reads it."""
        model = self.model
        if model.rules:
            out, at = [], 0
            while at < len(text):
                for n in self.rule_lengths:
                    if (found := model.rules.get(text[at : at + n])) is not None:
                        out.append(found)
                        at += min(n, len(text) - at)
                        break
                else:
                    out.append(text[at])
                    at += 1
            text = "".join(out)
        text = text.replace(MARK, " ") if not model.squeeze else text
        if model.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if model.leading else "") + text).replace(" ", MARK)

    # --- pieces and byte fallback

    def merged(self, text: str) -> list[str]:
        """Merges neighbours, the best piece first, the leftmost of equals."""
        parts, scores = list(text), self.model.scores
        while True:
            best, at = -_FAR, -1
            for i in range(len(parts) - 1):
                piece = self.arcs.get(parts[i] + parts[i + 1])
                if piece is not None and scores[piece] > best:
                    best, at = scores[piece], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def joins(self, last: str, piece: str) -> bool:
        """Whether merging the text of two pieces gives these pieces again: the weight
        of a BPE arc is 0 then, else infinity."""
        return self.merged(last + piece) == ([last, piece] if last else [piece])

    def arcs_of(self, before: str) -> dict[str, bool]:
        """What is known of the arcs of the state that remembers `before`."""
        if len(self.known) >= _KEPT:
            self.known.clear()
        return self.known.setdefault(before, {})

    def finite(self, part: str) -> list[str]:
        """The path of finite weight for BPE, searched depth first, longest piece first.

        Every beginning of the part has one such path, so that a position from which the
        end was not reached need not be tried again.
        """
        n, begins, known = len(part), self.begins, self.known
        path: list[str] = []
        ends: list[list[int]] = []  # for each piece of the path, where it could end too
        at, before, dead = 0, "", set()
        todo: list[int] | None = None
        while at < n:
            if todo is None:
                todo = [at + 1]
                for end in range(at + 1, n + 1):
                    arc = begins.get(part[at:end])
                    if arc is None:
                        break
                    if arc and end > at + 1:
                        todo.append(end)
            arcs = known.get(before)
            if arcs is None:
                arcs = self.arcs_of(before)
            while todo:
                end = todo.pop()
                if end in dead:
                    continue
                piece = part[at:end]
                joins = arcs.get(piece)
                if joins is None:
                    joins = arcs[piece] = self.joins(before, piece)
                if joins:
                    path.append(piece)
                    ends.append(todo)
                    at, before, todo = end, piece, None
                    break
            else:
                dead.add(at)
                at -= len(path.pop())
                todo, before = ends.pop(), path[-1] if path else ""
        return path

    def cheapest(self, part: str) -> list[str]:
        """The shortest path for a unigram model."""
        n, scores = len(part), self.model.scores
        cost, last = [_FAR] * (n + 1), [""] * (n + 1)
        cost[0] = 0.0
        for at in range(n):
            for end in range(at + 1, n + 1):
                piece = part[at:end]
                arc = self.begins.get(piece)
                if arc or end == at + 1:
                    total = cost[at] - (scores[self.arcs[piece]] if arc else self.worst)
                    if total < cost[end]:
                        cost[end], last[end] = total, piece
                if arc is None:
                    break
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def shortest(self, part: str) -> list[int]:
        """Ids on the shortest path through the lattice of one part of a text."""
        out: list[int] = []
        for piece in self.finite(part) if self.model.bpe else self.cheapest(part):
            if piece in self.arcs:
                out.append(self.arcs[piece])
            else:
                out.extend(self.bytes[b] for b in piece.encode("utf-8", "surrogatepass"))
        return out

    # --- whole texts

    def encoded(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        return b"".join(map(self.table.__getitem__, self.part.findall(self.normalised(text))))

    def decoded(self, ids) -> str:
        size, texts = len(self.text_of), self.text_of
        raw = b"".join([texts[i] for i in ids if 0 <= i < size])
        if self.model.leading and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


    def decoded_batch(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """The texts of rows with so many of the ids each."""
        ids = np.where((ids >= 0) & (ids < len(self.text_of)), ids, len(self.text_of)).astype("i8")
        sizes = self.flat_size[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(int(ends[-1]), dtype=np.uint8)
        for low in range(0, len(ids), 1 << 20):  # the temporary arrays stay small
            high = min(len(ids), low + (1 << 20))
            own = sizes[low:high]
            shift = self.flat_begin[ids[low:high]] - (ends[low:high] - ends[low])
            out[ends[low] : ends[high]] = self.flat[np.repeat(shift, own) + np.arange(int(own.sum()))]
        bound = ends[np.concatenate([[0], np.cumsum(lengths)])]
        begin, end = bound[:-1].copy(), bound[1:]
        if self.model.leading and len(out):
            begin += (begin < end) & (out[np.minimum(begin, len(out) - 1)] == 32)
        raw = out.tobytes()
        return pa.array([raw[a:b].decode("utf-8", "replace") for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.string())


class Codec:
    """Encoding and decoding as column functions; the model travels as a broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        ship(spark)
        self.path = path
        self.model = spark.sparkContext.broadcast(read_model(path))

    def transducer(self) -> Transducer:
        return compiled(self.path, self.model)

    def encode(self, text: Column) -> Column:
        """Array of ids."""
        path, model = self.path, self.model

        @F.arrow_udf("array<int>")
        def ids(texts: pa.Array) -> pa.Array:
            codec = compiled(path, model)
            parts = [codec.encoded(t) for t in texts.to_pylist()]
            ends = np.cumsum([0] + [len(p) // 4 for p in parts]).astype("i4")
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
            return pa.ListArray.from_arrays(pa.array(ends), flat)

        return ids(text)

    def decode(self, ids: Column) -> Column:
        """The text of an array of ids."""
        path, model = self.path, self.model

        @F.arrow_udf("string")
        def text(rows: pa.Array) -> pa.Array:
            codec = compiled(path, model)
            lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            return codec.decoded_batch(rows.flatten().to_numpy(zero_copy_only=False), lengths)

        return text(ids)


_HELD: dict[str, Transducer] = {}


def compiled(path: str, model) -> Transducer:
    """The transducer of a broadcast model, compiled once in each Python worker."""
    if path not in _HELD:
        _HELD.clear()
        _HELD[path] = Transducer(model.value)
    return _HELD[path]
