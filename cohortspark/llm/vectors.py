"""Near duplicates among embeddings by an exact metric range join.

Vectors of one label and length, scaled to unit length, lie at a distance of at most
r = sqrt(2 - 2 * cosine) if and only if their cosine reaches the threshold. Pivots drawn
from each label divide its vectors into cells by the nearest pivot. A vector also visits
every other cell whose members can be within r: by the triangle inequality those with
d(x, p) - r no more than the cell's radius, and with d(x, p) - d(x, own pivot) <= 2 r; in
Euclidean space also those whose border plane is within r. Cells are then joined each for
itself, in blocks of bounded size, so that each home vector meets all its partners in its
own cell.

Equal vectors are combined before the join. A block returns for each home vector the
number of its partners and, as links, a spanning tree of what it found, not all pairs.

Cases: a vector links with nothing if it or its label is null, or if it is empty, zero or
has components that are null or not finite; vectors of different lengths do not link;
repeated rows are vectors of their own; an empty table gives an empty result; other
columns are ignored. Rows with a null id have no component and are nobody's partner.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import components, labelled, ship, written

_CELL = 4096  # vectors for each pivot, and of one side of a block
_SLACK = 1e-6  # distances are compared with this much to spare, cosines with none


def _units(frame: pd.DataFrame) -> np.ndarray:
    x = np.array(frame["vector"].tolist(), dtype="f8")
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(label, size, vector, v, copies): usable vectors once each, v their smallest id."""
    vector = F.col(vector_col).cast("array<double>")
    usable = (
        F.col(id_col).isNotNull()
        & F.col(label_col).isNotNull()
        & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
        & F.exists(vector, lambda c: c != 0)
    )
    rows = df.where(F.coalesce(usable, F.lit(False)))
    # 0 and -0 are one key to Spark, and equal vectors have equal cosines
    return rows.groupBy(F.col(label_col).alias("label"), vector.alias("vector")).agg(
        F.min(id_col).alias("v"), F.count("*").alias("copies")
    ).withColumn("size", F.size("vector"))


def pivots(vectors: DataFrame) -> DataFrame:
    """(label, size, pivot, centre): one pivot for so many vectors of a label."""
    counts = vectors.groupBy("label", "size").agg(F.count("*").alias("n"))
    wanted = counts.select("label", "size", F.ceil(F.col("n") / _CELL).alias("wanted"), "n")
    # a hash below wanted / n of its range takes about as many, and the smallest hash one
    share = (F.shiftrightunsigned(F.xxhash64(F.lit("pivot"), "v"), 11) / float(1 << 53)).alias("share")
    least = vectors.groupBy("label", "size").agg(F.min(F.struct(share, "v")).alias("least"))
    rows = vectors.join(wanted, ["label", "size"]).join(least, ["label", "size"])
    chosen = rows.where((share < (F.col("wanted") - 1) / F.col("n")) | (F.col("v") == F.col("least.v")))
    return written(chosen.select("label", "size", F.col("v").alias("pivot"), F.col("vector").alias("centre")), "pivots")


def _visits(r: float):
    """Home and guest visits of each vector: cell, whether home, distance to the pivot."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (label, size), part in frame.groupby(["label", "size"], sort=False):
                x = _units(part)
                ids = part["cells"].iloc[0]
                centres = np.array([c["centre"] for c in ids], dtype="f8").reshape(len(ids), size)
                names = np.array([c["pivot"] for c in ids], dtype="i8")
                centres = _units(pd.DataFrame({"vector": list(centres)}))
                d = np.sqrt(np.maximum(0, 2 - 2 * (x @ centres.T)))
                between = np.sqrt(np.maximum(1e-12, 2 - 2 * (centres @ centres.T)))
                home = d.argmin(axis=1)
                own = d[np.arange(len(x)), home]
                near = (d - own[:, None]) <= 2 * r + _SLACK
                near &= (d**2 - own[:, None] ** 2) <= (2 * r + _SLACK) * between[home] + _SLACK
                near[np.arange(len(x)), home] = True
                at, cell = np.nonzero(near)
                yield pd.DataFrame(
                    {
                        "label": label, "size": size, "cell": names[cell], "home": cell == home[at],
                        "far": d[at, cell], "v": part["v"].to_numpy()[at], "copies": part["copies"].to_numpy()[at],
                        "vector": part["vector"].to_numpy()[at],
                    }
                )

    return rows


def _spanning(links: np.ndarray, n: int) -> np.ndarray:
    """For each of n vertices the first vertex of its component; links is symmetric."""
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        front = np.array([start])
        root[start] = start
        while len(front):
            reached = links[front].any(axis=0) & (root < 0)
            front = np.flatnonzero(reached)
            root[front] = start
    return root


def _joined(threshold: float):
    def block(frame: pd.DataFrame) -> pd.DataFrame:
        """Partners of the home vectors of one block (a, b): side a against side b."""
        homes, others = frame[frame["side"] == 0], frame[frame["side"] == 1]
        out = {"v": homes["v"].to_numpy(), "n": np.zeros(len(homes), dtype="i8"), "root": homes["v"].to_numpy()}
        if len(homes) and len(others):
            x, y = _units(homes), _units(others)
            linked = (x @ y.T) >= threshold
            own = homes["v"].to_numpy()[:, None] == others["v"].to_numpy()[None, :]
            linked &= ~own
            out["n"] = linked @ others["copies"].to_numpy()
            # vertices: both sides by id, the same vector on both sides being one
            names, place = np.unique(np.concatenate([homes["v"], others["v"]]), return_inverse=True)
            graph = np.zeros((len(names), len(names)), dtype=bool)
            a, b = np.nonzero(linked)
            a, b = place[a], place[len(homes) + b]
            graph[a, b] = graph[b, a] = True
            root = names[_spanning(graph, len(names))]
            mine = place[: len(homes)]
            extra = np.setdiff1d(np.arange(len(names)), mine)
            extra = extra[root[extra] != names[extra]]
            out = {
                "v": np.concatenate([out["v"], names[extra]]),
                "n": np.concatenate([out["n"], np.zeros(len(extra), dtype="i8")]),
                "root": np.concatenate([root[mine], root[extra]]),
            }
        return pd.DataFrame(out)

    return block


def linked_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of df."""
    ship(df.sparkSession)
    r = float(np.sqrt(2 - 2 * threshold))
    label = F.col(label_col).cast("string")
    base = df.select(F.col(id_col), F.col(vector_col), label.alias(label_col))
    vectors = written(distinct_vectors(base, id_col, vector_col, label_col), "vectors")
    cells = pivots(vectors).groupBy("label", "size").agg(
        F.sort_array(F.collect_list(F.struct("pivot", "centre"))).alias("cells")
    )
    visits = vectors.join(cells, ["label", "size"]).mapInPandas(
        _visits(r), "label string, size int, cell long, home boolean, far double, v long, copies long, vector array<double>"
    )
    visits = written(visits, "visits")
    facts = visits.groupBy("label", "size", "cell").agg(
        F.max(F.when(F.col("home"), F.col("far"))).alias("radius"),
        F.count(F.when(F.col("home"), 1)).alias("homes"),
        F.count("*").alias("all"),
    )
    # no member of the cell is nearer to a guest than its distance less the radius
    rows = visits.join(facts, ["label", "size", "cell"]).where(F.col("home") | (F.col("far") - r - _SLACK <= F.col("radius")))
    parts_a, parts_b = F.ceil(F.col("homes") / _CELL), F.ceil(F.col("all") / _CELL)
    spot = F.xxhash64("v")
    rows = rows.withColumns({"pa": parts_a.cast("int"), "pb": parts_b.cast("int")})
    key = ["label", "size", "cell", "a", "b"]
    side_a = rows.where("home").withColumns(
        {"side": F.lit(0), "a": F.pmod(spot, F.col("pa")).cast("int"), "b": F.explode(F.sequence(F.lit(0), F.col("pb") - 1))}
    )
    side_b = rows.withColumns(
        {"side": F.lit(1), "b": F.pmod(spot, F.col("pb")).cast("int"), "a": F.explode(F.sequence(F.lit(0), F.col("pa") - 1))}
    )
    fields = [*key, "side", "v", "copies", "vector"]
    blocks = side_a.select(*fields).unionByName(side_b.select(*fields))
    found = written(blocks.groupBy(*key).applyInPandas(_joined(threshold), "v long, n long, root long"), "partners")
    groups = components(found.where("v <> root").select(F.col("v").alias("a"), F.col("root").alias("b")))
    partners = found.groupBy("v").agg(F.sum("n").alias("others"))
    known = labelled(vectors, "v", groups).join(partners, "v", "left")
    known = known.select(
        F.col("label").alias("_label"), F.col("vector").alias("_vector"), "component_id",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    rows = base.select(F.col(id_col), label.alias("_own"), F.col(vector_col).cast("array<double>").alias("_double"))
    out = rows.join(known, (F.col("_own") == F.col("_label")) & (F.col("_double") == F.col("_vector")) & F.col(id_col).isNotNull(), "left")
    out = out.select(
        F.col(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col(id_col)).alias("component_id"),
    )
    return out.withColumn("kept", F.col(id_col) == F.col("component_id"))
