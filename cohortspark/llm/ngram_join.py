"""Jaccard join of documents by a blocked sparse product with their n-gram incidence.

Rows of the incidence are distinct shingle sets (documents of equal sets are one row),
columns are shingles. Sizes bound what has to be multiplied: two sets of Jaccard
similarity t share a shingle among their first n - ceil(t n) + 1 ones in any order common
to all sets, so only these prefixes go into the product. The order is rare first, by a
frequency table of fixed size over all documents. Column blocks find the shingles that
several rows share; overlaps are accumulated over the shared columns, and pairs whose
sizes and positions bound their overlap below the threshold are discarded before texts
are compared.

Dense groups are contracted first: rows are compared with a few rows of the columns they
share, and linked rows become one component, again and again while that leaves the product
less to do. The product then only takes pairs of different components, so that a
large group of near copies costs as many comparisons as it has rows, and yet no link
between components is lost.

Shingles and sets are compared by 64-bit and 128-bit hashes.

Cases: very long texts are hashed a slice at a time, and their sets are whole; null and empty texts have an empty set and link with nothing, and neither do rows
whose id is null; rows of equal sets are one component, repeated rows included; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm import common
from cohortspark.llm.common import components, ship, thinned
from cohortspark.llm.shingles import batches, shingle_sets, signature

#: Written tables whose shuffles are not read again.
written = partial(common.written, drop_shuffles=True)

_TABLE_BITS, _CHUNK = 20, 4096
_MARKS = tuple(f"m{i}" for i in range(8))
_MARKED = 1000  # larger sets fill 512 bits, so that these bound nothing
_BLOCK_ENTRIES = 200_000
_FLUSH = 300_000
_LEAST, _TURNS = 2, 6  # contractions of a dense product: at least, and at most
_DRAWN = 4  # rows that stand for a column in them, besides the most central one
_MEETINGS = 2  # a product with fewer meetings for each entry needs no contraction
_GROUP = 1000  # comparisons with one row that a task takes at once


# --- facts of every document and the frequency table --------------------------------


def parity(hashes: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the number of hashes that fall on it. Two sets differ
    in at least as many shingles as their parities do in bits."""
    bits = np.bincount((hashes & np.uint64(511)).astype(np.int64), minlength=512).astype(np.uint8) & 1
    return np.packbits(bits).view(np.int64)


def _facts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size and signature of every set; at the end the partition's frequencies."""
    counts = np.zeros(1 << _TABLE_BITS, dtype=np.int64)
    seen = False
    for frame in frames:
        texts = frame["text"].tolist()
        sizes, first, second, marks = [], [], [], []
        for low, high in batches(texts):
            sets = shingle_sets(texts[low:high])
            for s in sets:
                a, b = signature(s)
                sizes.append(len(s))
                first.append(a)
                second.append(b)
                marks.append(parity(s))
            whole = np.concatenate(sets)
            counts += np.bincount((whole >> np.uint64(64 - _TABLE_BITS)).astype(np.int64), minlength=len(counts))
            seen = True
        out = pd.DataFrame({"id": frame["id"], "n": sizes, "c1": first, "c2": second, "chunk": -1, "counts": None})
        table = np.array(marks, dtype=np.int64).reshape(-1, len(_MARKS))
        yield out.assign(**{m: table[:, i] for i, m in enumerate(_MARKS)})
    if seen:
        parts = counts.reshape(-1, _CHUNK)
        packed = [zlib.compress(p.astype(np.int64).tobytes(), 1) for p in parts]
        none = pd.array([None] * len(parts), dtype="Int64")
        zeros = dict.fromkeys(["n", "c1", "c2", *_MARKS], 0)
        yield pd.DataFrame({"id": none, **zeros, "chunk": np.arange(len(parts)), "counts": packed})


def _added(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums of the frequency chunks that come by; a task holds few chunks."""
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for chunk, packed in zip(frame["chunk"], frame["counts"], strict=True):
            own = np.frombuffer(zlib.decompress(packed), dtype=np.int64)
            sums[chunk] = sums[chunk] + own if chunk in sums else own
    yield pd.DataFrame({"chunk": list(sums), "counts": [zlib.compress(v.tobytes(), 1) for v in sums.values()]})


def document_facts(docs: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """(id, n, c1, c2, marks) of every row of (id, text), the frequency classes, and the total."""
    marks = "".join(f"{m} long, " for m in _MARKS)
    schema = f"id long, n long, c1 long, c2 long, {marks}chunk int, counts binary"
    table = written(docs.select("id", "text").mapInPandas(_facts, schema), "facts")
    summed = table.where("chunk >= 0").select("chunk", "counts").repartition("chunk")
    rows = summed.mapInPandas(_added, "chunk int, counts binary").collect()  # 2^20 numbers
    counts = np.zeros((1 << _TABLE_BITS) // _CHUNK * _CHUNK, dtype=np.int64).reshape(-1, _CHUNK)
    for row in rows:
        counts[row["chunk"]] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.int64)
    classes = np.ceil(2 * np.log2(counts.ravel() + 1)).astype(np.uint8)
    return table.where("chunk < 0").select("id", "n", "c1", "c2", *_MARKS), classes, int(counts.sum())


# --- the shared part of the prefixes ------------------------------------------------


def packed(g, c1, c2, n, pos, blocks: int, number: int) -> pd.DataFrame:
    """Entries (column g; row c1, c2 of size n; position) by column block.

    A column that several entries share is known to be shared: all its entries skip the
    blocks (negative block numbers), and one of them stands for them there. So a block
    gets each column at most once from each call, however frequent it is.
    """
    order = np.argsort(g, kind="stable")
    g, c1, c2, n, pos = (x[order] for x in (g, c1, c2, n, pos))
    new = np.concatenate([[True], g[1:] != g[:-1]])
    last = np.concatenate([new[1:], [True]])
    out = []

    def add(block: int, pick: np.ndarray) -> None:
        out.append((block, *(x[pick].tobytes() for x in (g, c1, c2, n, pos))))

    known = np.flatnonzero(~(new & last))
    for low in range(0, len(known), 20_000):
        add(-1 - (number + low) % 4093, known[low : low + 20_000])
    firsts = np.flatnonzero(new)
    block = (g[firsts] >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    for low, high in zip(cut, [*cut[1:], len(firsts)], strict=True):
        add(int(block[low]), firsts[low:high])
    return pd.DataFrame(out, columns=["block", "g", "c1", "c2", "n", "pos"])


PACKED = "block long, g binary, c1 binary, c2 binary, n binary, pos binary"
ENTRY = "g long, c1 long, c2 long, n int, pos int"


def _prefix_rows(classes, blocks: int) -> Callable:
    """Prefix entries of each partition by column block."""

    def flush(g, row, pos, keys, number):
        r = np.concatenate(row)
        c1, c2, n = (np.array(k, dtype=np.int64) for k in zip(*keys, strict=True))
        return packed(np.concatenate(g), c1[r], c2[r], n[r].astype("i4"), np.concatenate(pos), blocks, number)

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rank = classes.value
        g, row, pos, keys, seen, held = [], [], [], [], set(), 0
        number = 0
        for frame in frames:
            texts = frame["text"].tolist()
            for low, high in batches(texts):
                for s in shingle_sets(texts[low:high]):
                    if not len(s):
                        continue
                    key = (*signature(s), len(s))
                    if key in seen:
                        continue
                    seen.add(key)
                    size = len(s) - (3 * len(s) + 3) // 4 + 1
                    own = rank[(s >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]
                    g.append(s[np.argsort(own, kind="stable")[:size]])
                    row.append(np.full(size, len(keys), dtype="i4"))
                    pos.append(np.arange(size, dtype="i4"))
                    keys.append(key)
                    held += size
                if held >= _FLUSH:
                    yield flush(g, row, pos, keys, number)
                    number += 7919
                    g, row, pos, keys, seen, held = [], [], [], [], set(), 0
        if held:
            yield flush(g, row, pos, keys, number)

    return rows


def shared_entries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of columns that several rows have, out of the whole column blocks of a task."""
    parts: list[tuple] = []

    def unpacked(f):
        types = {"g": np.uint64, "c1": np.int64, "c2": np.int64, "n": "i4", "pos": "i4"}
        return [np.frombuffer(b"".join(f[c]), dtype=t) for c, t in types.items()]

    def table(g, c1, c2, n, pos):
        return pd.DataFrame({"g": g.view(np.int64), "c1": c1, "c2": c2, "n": n, "pos": pos})

    for frame in frames:
        known = frame[frame["block"] < 0]
        if len(known):
            yield table(*unpacked(known))
        rest = frame[frame["block"] >= 0]
        if len(rest):
            parts.append(unpacked(rest))
    if parts:
        g, c1, c2, n, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.argsort(g, kind="stable")
        run = np.concatenate([[True], g[order][1:] != g[order][:-1]])
        several = ~(run & np.concatenate([run[1:], [True]]))
        order = order[several]  # mostly few: now by row too, without repeats
        order = order[np.lexsort((c2[order], c1[order], g[order]))]
        same = (g[order][1:] == g[order][:-1]) & (c1[order][1:] == c1[order][:-1]) & (c2[order][1:] == c2[order][:-1])
        order = order[np.concatenate([[True], ~same])] if len(order) else order
        if len(order):
            run = np.concatenate([[True], g[order][1:] != g[order][:-1]])
            order = order[~(run & np.concatenate([run[1:], [True]]))]
            yield table(*(x[order] for x in (g, c1, c2, n, pos)))


def shared_prefixes(docs: DataFrame, classes: np.ndarray, total: int) -> DataFrame:
    """(g, c1, c2, n, pos): prefix entries of all columns that several rows share."""
    spark = docs.sparkSession
    blocks = max(64, total // 4 // _BLOCK_ENTRIES)
    held = spark.sparkContext.broadcast(classes)  # 2^20 bytes
    rows = docs.select("text").mapInPandas(_prefix_rows(held, blocks), PACKED)
    shared = rows.repartition("block").mapInPandas(shared_entries, ENTRY)
    return written(shared, "shared")


def merged_columns(entries: DataFrame) -> DataFrame:
    """(g, row, n, pos, last, w): columns that the same rows have become one of weight w.

    Passages that documents share are runs of such columns, so that a pair meets once for
    a passage and not once for each of its shingles. `pos` and `last` are the first and the
    last place of the merged columns in the row's prefix; as all rows have one order, these
    are the same two columns in every row.
    """
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "row")).alias(f"s{seed}") for seed in (1, 2)]
    alike = entries.groupBy("g").agg(F.count("*").alias("k"), *marks)
    same = entries.join(alike, "g").groupBy(F.xxhash64("k", "s1", "s2").alias("g"), "row")
    merged = same.agg(
        F.first("n").alias("n"), F.min("pos").alias("pos"), F.max("pos").alias("last"), F.count("*").cast("int").alias("w")
    )
    return written(merged, "columns")


# --- candidates ---------------------------------------------------------------------


def _sizes_fit(a: str, b: str) -> Column:
    return F.least(a, b) * 4 >= F.greatest(a, b) * 3


def _current(entries: DataFrame, found: DataFrame | None) -> DataFrame:
    """Entries with their component, of the columns that several components share."""
    if found is None:
        return entries.withColumn("comp", F.col("row"))  # several rows, several components
    of = found.select(F.col("vertex").alias("row"), F.col("component"))
    rows = entries.join(of, "row", "left").withColumn("comp", F.coalesce("component", "row")).drop("component")
    ends = rows.groupBy("g").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    return written(rows.join(ends.where("low < high").select("g"), "g"), "current")


def meetings(rows: DataFrame) -> tuple[int, int]:
    """Entries, and pairs of entries of one column and different components."""
    sizes = rows.groupBy("g", "comp").agg(F.count("*").alias("k"))
    columns = sizes.groupBy("g").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("own"))
    # as doubles: a column of many rows has more pairs than a long holds of all columns
    pairs = F.sum((F.col("k").cast("double") * F.col("k") - F.col("own")) / 2)
    entries, met = columns.agg(F.sum("k"), pairs).first()
    return entries or 0, int(met or 0)


def _differing(a: Callable, b: Callable) -> Column:
    """In how many bits the parities of two sets differ; a and b give their columns."""
    return sum((F.bit_count(a(m).bitwiseXOR(b(m))) for m in _MARKS), F.lit(0))


def _close(differ: Column, na: Column, nb: Column) -> Column:
    """Sets that reach the threshold differ in (na + nb) / 7 shingles at most."""
    return F.when(F.greatest(na, nb) <= _MARKED, differ * 7 <= na + nb).otherwise(True)


def _central(rows: DataFrame) -> DataFrame:
    """The rows with `hub`, larger where many rows share a row's columns. Of a group of
    near copies these are the rows with few changes of their own, near to most others."""
    sizes = rows.groupBy("g").agg(F.count("*").alias("k"))
    sums = rows.join(sizes, "g").groupBy("row").agg((F.sum(F.col("k") * F.col("w")) / F.first("n")).alias("hub"))
    return written(rows.join(sums, "row"), "central")


def star_pairs(rows: DataFrame, turn: int) -> DataFrame:
    """(a, b): for each component one pair of a row b of it with a row a of another one.

    A few rows stand for each column: its most central one, and some drawn by hash. Of the
    pairs they make, a component takes the one whose parities differ least, and of large
    sets the one that shares most columns, if those are a third of a prefix. Only a head
    start: what it leaves out, the product finds.
    """
    rows = _central(rows)
    whole = F.struct("row", "n", "comp", *_MARKS)
    drawn = [F.min_by(whole, F.struct(F.xxhash64(F.lit(turn), F.lit(k), "row"), "row")) for k in range(_DRAWN)]
    stars = F.array_distinct(F.array(F.max_by(whole, F.struct("hub", "row")), *drawn))
    first = rows.groupBy("g").agg(stars.alias("z")).select("g", F.explode("z").alias("z"))
    near = rows.join(first, "g").where(F.col("comp") != F.col("z.comp"))
    near = near.withColumns({"a": F.col("z.row"), "na": F.col("z.n")}).where(_sizes_fit("n", "na"))
    near = near.withColumn("differ", _differing(F.col, lambda m: F.col("z")[m]))
    near = near.where(_close(F.col("differ"), F.col("n"), F.col("na")))
    met = near.groupBy("row", "n", "comp", "a", "na", "differ").agg(F.sum("w").alias("met"))
    marked = F.greatest("n", "na") <= _MARKED
    met = met.where(marked | (F.col("met") * 12 >= F.col("n")))
    apart = F.when(marked, F.col("differ") / (F.col("n") + F.col("na"))).otherwise(1.0)
    best = met.groupBy("comp").agg(F.min(F.struct(apart, -F.col("met"), "a", "row")).alias("best"))
    return written(best.select(F.col("best.a").alias("a"), F.col("best.row").alias("b")), "stars")


def product_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): all pairs of rows in different components that may reach the threshold.

    The common columns of a pair's prefixes are counted; what follows a common column is
    bounded by what is left of either set. 7 * overlap >= 3 * (sizes) is Jaccard 3/4.
    """
    def side(x: str) -> DataFrame:
        named = {"row": x, "n": f"n{x}", "pos": f"p{x}", "last": f"l{x}", "comp": f"c{x}"}
        marks = [F.when(F.col("n") <= _MARKED, F.col(m)).otherwise(0).alias(f"{m}{x}") for m in _MARKS]
        weight = [F.col("w")] if x == "a" else []
        return rows.select("g", *[F.col(old).alias(new) for old, new in named.items()], *weight, *marks)

    left, right = side("a"), side("b")
    need = (F.col("na") + F.col("nb")) * 3

    def rest(at: str) -> Column:
        return F.least(F.col("na") - F.col(f"{at}a"), F.col("nb") - F.col(f"{at}b"))

    fits = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _sizes_fit("na", "nb")
    # the overlap is not larger than what is left at the first common column; this drops
    # later columns only, which are part of what is left at those that stay
    tight = rest("p") * 7 >= need
    differ = _differing(lambda m: F.col(f"{m}a"), lambda m: F.col(f"{m}b"))
    close = _close(differ, F.col("na"), F.col("nb"))
    met = left.join(right, "g").where(fits & tight & close)
    # all common columns up to this place are counted: merged ones to their last, if no
    # column between their first and their last is dropped
    whole = rest("l") * 7 >= need
    for x in ("a", "b"):
        met = met.withColumn(f"u{x}", F.when(whole, F.col(f"l{x}")).otherwise(F.col(f"p{x}")))
    sums = met.groupBy("a", "b", "na", "nb").agg(F.sum("w").alias("met"), F.max("ua").alias("ua"), F.max("ub").alias("ub"))
    return written(sums.where((F.col("met") + rest("u") - 1) * 7 >= need).select("a", "b"), "pairs")


# --- a second bound for large sets ----------------------------------------------------


def wide_parity(hashes: np.ndarray) -> np.ndarray:
    """As `parity`, with two bits or more for each hash, so that large sets do not fill it."""
    width = 1 << max(9, int(2 * len(hashes) - 1).bit_length())
    bits = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width).astype(np.uint8) & 1
    return np.packbits(bits)


def differing_bits(a: bytes, b: bytes) -> int:
    """In how many bits two parities differ, the wider one folded to the other's width."""
    x, y = sorted((np.frombuffer(v, dtype=np.uint8) for v in (a, b)), key=len)
    folded = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(folded ^ x).sum())


def _parities(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        texts, sizes, bits = frame["text"].tolist(), [], []
        for low, high in batches(texts):
            for s in shingle_sets(texts[low:high]):
                sizes.append(len(s))
                bits.append(wide_parity(s).tobytes())
        yield pd.DataFrame({"row": frame["row"], "n": sizes, "bits": bits})


def _near(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        differ = np.array([differing_bits(x, y) for x, y in zip(frame["x"], frame["y"], strict=True)], dtype=np.int64)
        fits = differ * 7 <= (frame["na"] + frame["nb"]).to_numpy()
        yield frame.loc[fits, ["a", "b"]]


def bounded_pairs(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose sets may be near enough by their wide parities; docs has (row, text).

    Parities are a small part of the texts' size, so that fewer texts are shuffled.
    """
    wanted = written(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(), "ends")
    known = thinned(docs, "row", wanted).mapInPandas(_parities, "row long, n long, bits binary")
    known = written(known, "parities")

    def side(x: str, bits: str) -> DataFrame:
        return known.select(F.col("row").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(bits))

    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return written(both.mapInPandas(_near, "a long, b long").distinct(), "near")


# --- comparison ---------------------------------------------------------------------


def _agreeing(prepare: Callable, agree: Callable) -> Callable:
    """Links among rows sorted by (a, part, b), where a null b brings a's own text."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_key, own = None, None
        for frame in frames:
            texts = frame["text"].tolist()
            a_of, part = frame["a"].tolist(), frame["part"].tolist()
            head, b_of = frame["b"].isna().tolist(), frame["b"].fillna(0).astype("int64").tolist()
            out: list[tuple[int, int]] = []
            for low, high in batches(texts):
                for i, s in enumerate(prepare(texts[low:high]), low):
                    if head[i]:
                        own_key, own = (a_of[i], part[i]), s
                    elif (a_of[i], part[i]) != own_key:
                        raise ValueError("a text to compare with is missing")
                    elif agree(own, s):
                        out.append((a_of[i], b_of[i]))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows


def _jaccard(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 7 * both >= 3 * (len(a) + len(b))


def compared(pairs: DataFrame, texts: DataFrame, prepare: Callable = shingle_sets, agree: Callable = _jaccard) -> DataFrame:
    """The pairs (a, b) whose texts agree; texts has (row, text), written.

    Rows with many partners are dealt out in groups of partners, each with its own copy
    of the row's text; tasks read the groups one after the other.
    """
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    many = many.select("a", F.ceil(F.col("n") / _GROUP).cast("int").alias("parts"))
    members = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    members = members.join(texts.withColumnRenamed("row", "b"), "b").select("a", "part", "b", "text")
    heads = many.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    heads = heads.join(texts.withColumnRenamed("row", "a"), "a")
    heads = heads.select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    dealt = members.unionByName(heads).repartition("a", "part")
    dealt = dealt.sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return written(dealt.mapInPandas(_agreeing(prepare, agree), "a long, b long"), "links")


# --- the operator -------------------------------------------------------------------


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id (see above)."""
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    facts, classes, total = document_facts(plain)
    some = [F.first(m).alias(m) for m in _MARKS]
    sets = facts.where("n > 0 and id is not null").groupBy("c1", "c2").agg(F.min("id").alias("row"), *some)
    sets = written(sets, "sets")
    shared = shared_prefixes(plain, classes, total)
    names = sets.select("c1", "c2", "row")
    entries = shared.join(names, ["c1", "c2"]).groupBy("g", "row")
    entries = written(entries.agg(F.first("n").cast("long").alias("n"), F.first("pos").alias("pos")), "entries")
    entries = merged_columns(entries)

    links, found, before = None, None, 0
    for turn in range(_TURNS + 1):
        rows = _current(entries, found)
        held, met = meetings(rows)
        # a contraction that left nearly all meetings is the last one, but the rows of one
        # turn may be unlucky
        contract = turn < _TURNS and met > _MEETINGS * held and (turn < _LEAST or met * 20 <= before * 19)
        before = met
        rows = rows.join(sets.select("row", *_MARKS), "row")
        pairs = star_pairs(rows, turn) if contract else product_pairs(rows)
        named = plain.withColumnRenamed("id", "row")
        pairs = bounded_pairs(pairs, named)
        wanted = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
        wanted = written(wanted, "wanted")
        texts = thinned(named, "row", wanted)
        texts = texts.join(wanted, "row").dropDuplicates(["row"])
        texts = written(texts.select("row", "text"), "texts")
        new = compared(pairs, texts)
        links = new if links is None else links.unionByName(new)
        found = components(links)
        if not contract:
            break
    out = facts.select("id", "n", "c1", "c2").join(names, ["c1", "c2"], "left")
    out = out.join(found.withColumnRenamed("vertex", "row"), "row", "left")
    grouped = F.coalesce("component", "row")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("id").isNotNull(), grouped).otherwise(F.col("id")).alias("component_id"),
    )
