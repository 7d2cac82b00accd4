"""Token ids as binary shards in training order.

The texts of each input partition become one stream of ids with an end id after every
text, cut into sequences of fixed length; only a partition's last sequence is padded.
Sequences are numbered by partition. A keyed Feistel permutation of the next power of
four, walked along its cycles until it is back below the number of sequences, gives each
its global slot. Slots are dealt out in ranges; each range is one file whose sequence k
starts at byte k * stride, so that reading can start, and start again, at any slot.

Cases: null and empty texts give no ids; very long texts are encoded in one piece and fill
as many sequences as they need; a table without texts gives no shards; repeated
rows are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.alignment import Pieces, id_code
from cohortspark.llm.common import ship, written
from cohortspark.llm.shingles import mix

_ROUNDS = 6
_BATCH = 1 << 23  # characters that are encoded at once
_WORDS = 2000  # distinct words that are
_BLOCK = 128  # sequences in a row of the table of ids
_RUN = pa.schema({"part": pa.int32(), "first": pa.int64(), "n": pa.int32(), "tokens": pa.int64(), "body": pa.binary()})
_LATIN = "!-~\u00c0-\u024f"
#: A text whose words are not to be encoded on their own.
_ODD = f" ([^{_LATIN}]|\\z)|[^{_LATIN}] |\\A[^{_LATIN}]|[^{_LATIN}]\\z|\u2581"


class ByteIds:
    """UTF-8 bytes as ids 0 to 247; 255 and 254, which UTF-8 never has, end and pad."""

    dtype, end, pad = "u1", 255, 254

    def encoded(self, texts: list[str]) -> Iterator[bytes]:
        return (t.encode("utf-8", "surrogatepass") for t in texts)


class PieceIds:
    """Ids of a SentencePiece model, of two bytes each, or of four if it has more than
    65,536 pieces.

    The distinct words of a batch of texts are encoded as one text, and the ids of the texts
    put together from theirs. This holds for texts whose spaces are single ones between signs
    of Latin scripts (no piece has a space inside, so none goes across); others are encoded
    one by one.
    """

    def __init__(self, model: Pieces, end: int = 2, pad: int = 0):
        self.model, self.end, self.pad, self.dtype = model, end, pad, id_code(model)

    def encoded(self, texts: list[str]) -> Iterator[bytes]:
        rows = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(rows, _ODD).to_pylist() if self.model.splits else [True] * len(texts)
        together = self._together(rows.filter(pa.array([not o for o in odd])))
        for text, o in zip(texts, odd, strict=True):
            yield self._single(text) if o else next(together)

    def _single(self, text: str) -> bytes:
        return np.array(self.model.encode([text])[0]).astype(self.dtype).tobytes()

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of words one after the other, and how many each has; nothing if the
        model does not give back their bytes."""
        table = self.model.table
        lengths, all_ids, counts = np.array([len(t) for t in table]), [], []
        for low in range(0, len(words), _WORDS):
            some = words.slice(low, _WORDS)
            text = " ".join(some.to_pylist())
            ids = self.model.encode([text])[0]
            if b"".join(map(table.__getitem__, ids)) != f" {text}".encode():
                return None
            all_ids.append(np.array(ids))
            ends = np.cumsum(lengths[all_ids[-1]])
            last = np.cumsum(pc.binary_length(some).to_numpy(zero_copy_only=False) + 1)
            counts.append(np.diff(np.searchsorted(ends, last) + 1, prepend=0))
        return np.concatenate(all_ids).astype(self.dtype), np.concatenate(counts)

    def _together(self, texts: pa.Array) -> Iterator[bytes]:
        if not len(texts):
            return
        words = pc.split_pattern(texts, " ")
        coded = words.flatten().dictionary_encode()
        if (found := self._distinct(coded.dictionary)) is None:
            yield from map(self._single, texts.to_pylist())
            return
        ids, count = found
        first, code = np.cumsum(count) - count, coded.indices.to_numpy(zero_copy_only=False)
        # of each text: where its words' ids are, one word after the other
        bounds = words.offsets.to_numpy()
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = code[low:high]
            n = count[own]
            after = np.cumsum(n)
            yield ids[np.repeat(first[own] - after + n, n) + np.arange(after[-1])].tobytes()


@dataclass(frozen=True)
class Permutation:
    """A bijection of 0 to size - 1 that the key chooses."""

    size: int
    key: int

    def __call__(self, index: np.ndarray) -> np.ndarray:
        half = max(1, (max(1, self.size - 1).bit_length() + 1) // 2)
        mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
        keys = mix(np.arange(1, _ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ mix(np.full(_ROUNDS, self.key, dtype=np.uint64)))
        out = np.asarray(index, dtype=np.uint64).copy()
        walking = np.arange(len(out))
        while len(walking):
            left, right = out[walking] >> shift, out[walking] & mask
            for k in keys:
                left, right = right, left ^ (mix(right + k) & mask)
            moved = left << shift | right
            out[walking] = moved
            walking = walking[moved >= self.size]
        return out.astype(np.int64)


def _encoded(texts: Iterable[str | None], ids) -> Iterator[bytes]:
    """The ids of every text that has characters, with the end id."""
    end = np.array([ids.end], dtype=ids.dtype).tobytes()
    held, size = [], 0
    for text in texts:
        if text:
            held.append(text)
            size += len(text)
            if size >= _BATCH:
                yield from (own + end for own in ids.encoded(held))
                held, size = [], 0
    if held:
        yield from (own + end for own in ids.encoded(held))


def _blocks(texts: Iterable[str | None], ids, length: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(number of the first sequence, sequences, ids that are no padding, bytes) of runs of
    the sequences of a stream."""
    width = np.dtype(ids.dtype).itemsize
    stride, held, first = length * width, bytearray(), 0
    pad = np.array([ids.pad], dtype=ids.dtype).tobytes()
    for own in _encoded(texts, ids):
        held += own
        whole = len(held) // (stride * _BLOCK) * stride * _BLOCK
        for at in range(0, whole, stride * _BLOCK):
            yield first, _BLOCK, _BLOCK * length, bytes(held[at : at + stride * _BLOCK])
            first += _BLOCK
        del held[:whole]
    if held:
        tokens = len(held) // width
        n = -(-tokens // length)
        yield first, n, tokens, bytes(held) + pad * (n * length - tokens)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def materialise(
    docs: DataFrame, folder: str, ids, length: int = 2048, shard_rows: int = 16384, key: int = 42, text_col: str = "text"
) -> DataFrame:
    """Writes the shards to `folder`, which all executors see; returns one row for each
    sequence: slot, shard, byte_offset, n_tokens, crc32 (of the sequence's bytes).

    Texts are encoded once, into a table of runs of sequences in the shared folder; they are
    counted and dealt out from there. A shard is written under a name of its own and then
    renamed, so that a repeated task leaves one whole file.
    """
    spark = docs.sparkSession
    ship(spark)
    stride = length * np.dtype(ids.dtype).itemsize

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        texts = (text for batch in batches for text in batch.column(0).to_pylist())
        for first, n, tokens, body in _blocks(texts, ids, length):
            row = {"part": part, "first": first, "n": n, "tokens": tokens, "body": zlib.compress(body, 1)}
            yield pa.RecordBatch.from_pylist([row], _RUN)

    runs = docs.select(text_col).mapInArrow(encoded, "part int, first long, n int, tokens long, body binary")
    runs = written(runs, "runs")
    begins, total = {}, 0
    for part, n in sorted(runs.groupBy("part").agg(F.sum("n")).collect()):  # a row for each input partition
        begins[part] = total
        total += n
    slots = Permutation(total, key)
    shards = -(-total // shard_rows)

    def dealt(rows) -> Iterator[tuple[int, tuple[bytes, bytes, bytes]]]:
        """Of each run, the sequences that go to the same shard."""
        for part, first, n, tokens, body in rows:
            sequences = np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(n, stride)
            real = np.clip(tokens - length * np.arange(n), 0, length)
            at = slots(begins[part] + first + np.arange(n))
            order = np.argsort(at)
            for own in np.split(order, np.flatnonzero(np.diff(at[order] // shard_rows)) + 1):
                yield int(at[own[0]]) // shard_rows, (at[own].tobytes(), real[own].tobytes(), zlib.compress(sequences[own].tobytes(), 1))

    def stored(shard: int, rows) -> Iterator[tuple[int, int, int, int, int]]:
        begin = shard * shard_rows
        size = min(shard_rows, total - begin)
        if size <= 0:
            return
        body, index = bytearray(size * stride), []
        for _, (at, real, packed) in rows:
            sequences = zlib.decompress(packed)
            for i, (slot, n) in enumerate(zip(np.frombuffer(at, "i8").tolist(), np.frombuffer(real, "i8").tolist(), strict=True)):
                offset, own = (slot - begin) * stride, sequences[i * stride : (i + 1) * stride]
                body[offset : offset + stride] = own
                index.append((slot, shard, offset, n, zlib.crc32(own)))
        if len(index) != size:
            raise ValueError("a shard has not got all its sequences")
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path)
        own = f"{path}/.{shard_name(shard)}-{uuid.uuid4().hex}"
        with system.open_output_stream(own) as out:
            out.write(body)
        system.move(own, f"{path}/{shard_name(shard)}")
        yield from index

    schema = "slot long, shard long, byte_offset long, n_tokens long, crc32 long"
    if not total:
        return spark.createDataFrame([], schema)
    # ranges of slots, without a sample of the keys
    ranges = runs.select("part", "first", "n", "tokens", "body").rdd.mapPartitions(dealt).partitionBy(shards, lambda shard: shard)
    table = written(spark.createDataFrame(ranges.mapPartitionsWithIndex(stored), schema, verifySchema=False), "index")
    facts = {"sequences": total, "length": length, "dtype": ids.dtype, "shard_rows": shard_rows, "key": key}
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(facts).encode())
    return table


def read_sequences(folder: str, first: int = 0) -> Iterator[np.ndarray]:
    """The sequences from slot `first` on, in training order."""
    system, path = fs.FileSystem.from_uri(folder)
    with system.open_input_stream(f"{path}/manifest.json") as file:
        facts = json.loads(file.read())
    dtype, rows = np.dtype(facts["dtype"]), facts["shard_rows"]
    stride = facts["length"] * dtype.itemsize
    for shard in range(first // rows, -(-facts["sequences"] // rows)):
        with system.open_input_file(f"{path}/{shard_name(shard)}") as file:
            file.seek(max(0, first - shard * rows) * stride)
            while piece := file.read(stride):
                yield np.frombuffer(piece, dtype=dtype)
