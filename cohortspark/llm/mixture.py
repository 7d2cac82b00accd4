"""Mixing sources to target sizes by entropy balancing.

Of all document rates from 0 to `cap` whose sizes add up to the targets, the balanced
ones have the least relative entropy to taking every document once. They are
exponentially tilted, rate = min(cap, exp(lambda * size / scale)), with one lambda for
each source: the solution of a convex dual. Newton steps, kept within a bracket, solve
the duals of all sources together; one pass is one aggregate over the counts of
documents by source and size, which determine the sums, at the iterates and at points
around them, so that a pass narrows the bracket as many single steps would. The rates are rounded to whole
copies: the integer part, and one more copy for the documents of a source whose hash
falls furthest below their fraction, until the target is met.

Cases: very long texts are their number of words, as all others; a null source is a source of its own, last in order; null and empty texts have
size 0 and are taken once unless their source's target is its cap (`cap` copies) or 0;
a source without words has target 0 and its documents are taken once; rows with the same id are rounded alike; an empty
table gives an empty result; columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortspark.llm.common import free_name, gapless, written

_PASSES, _POINTS, _CLOSER = 40, 7, 4.0
_BITS, _DIGIT = 36, 18
_FILLINGS = 3


def _match(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on `source`, null being a value."""
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, left["source"].eqNullSafe(other["_source"]), how).drop("_source")


def source_totals(sized: DataFrame) -> DataFrame:
    """(source, source_size), written."""
    return written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Adds `weight`: the weights in turn, by source in code point order, null last."""
    numbered = gapless(sources, [F.col("source").asc_nulls_last()], "place")
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    return numbered.withColumn("weight", pick).drop("place")


def capped_targets(sources: DataFrame, share: float, cap: float) -> DataFrame:
    """Adds `target`: `share` of all sizes by weight, none above cap * source_size.

    What a capped source leaves is shared again by the weights of the others. The level
    (size for one unit of weight) only rises, and a job sees all sources at once.
    """
    limit, level = F.col("source_size") * cap, 0.0
    whole = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total = share * (whole[0] or 0)
    level, previous = total / (whole[1] or 1), -1.0
    while level != previous:
        full = F.col("weight") * level > limit
        fixed, free = sources.agg(
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)),
        ).first()
        previous, level = level, (max(total - fixed, 0.0) / free if free else level)
    return sources.withColumn("target", F.least(F.col("weight") * level, limit).cast("double"))


def tilts(sized: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """(source, target, scale, tilt): tilt is null where all rates are the cap or 0."""
    cells = written(
        sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "cells"
    )
    facts = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).cast("double").alias("mass"),
        (F.sum(F.col("n") * F.col("size") * F.col("size")) / F.sum(F.col("n") * F.col("size"))).alias("scale"),
        F.min("size").alias("least"),
    )
    state = _match(targets.select("source", "target"), facts)
    inner = (F.col("target") > 0) & (F.col("target") < cap * F.col("mass"))
    near = F.col("least") / F.col("scale")  # the smallest x: it gives the widest bracket
    below = F.col("target") < F.col("mass")
    state = state.select(
        "source", "target", "scale",
        F.when(below, F.log(F.col("target") / F.col("mass")) / near).otherwise(0.0).alias("low"),
        F.when(below, 0.0).otherwise(F.log(F.lit(cap)) / near).alias("high"),
        F.when(inner, F.lit(0.0)).alias("tilt"),
        inner.alias("open"),
    )
    state = written(state, "tilts")
    for _ in range(_PASSES):
        if state.where("open").isEmpty():
            break
        # the Newton iterate, and points on both sides that come closer and closer to it
        steps = [F.lit(_CLOSER**-i) for i in range(1, _POINTS + 1)]
        below = [F.col("tilt") - (F.col("tilt") - F.col("low")) * s for s in steps]
        above = [F.col("tilt") + (F.col("high") - F.col("tilt")) * s for s in steps]
        points = F.array_distinct(F.array(F.col("tilt"), *below, *above))
        tried = state.where("open").select("source", "target", "scale", F.explode(points).alias("at"))
        x = F.col("size") / F.col("scale")
        free = F.col("at") * x < F.log(F.lit(cap))
        rate = F.when(free, F.exp(F.col("at") * x)).otherwise(cap)
        weight = F.col("n") * F.col("size")
        sums = (
            _match(cells, tried)
            .groupBy("source", "at")
            .agg(
                (F.sum(weight * rate) - F.first("target")).alias("gap"),
                F.coalesce(F.sum(F.when(free, weight * x * rate)), F.lit(0.0)).alias("slope"),
            )
        )
        found = sums.groupBy("source").agg(
            F.max(F.when(F.col("gap") < 0, F.col("at"))).alias("under"),
            F.min(F.when(F.col("gap") >= 0, F.col("at"))).alias("over"),
            F.min_by(F.struct("at", "gap", "slope"), F.abs("gap")).alias("best"),
        )
        joined = _match(state, found, "left")
        low, high = F.coalesce("under", "low"), F.coalesce("over", "high")
        newton = F.col("best.at") - F.col("best.gap") / F.nullif(F.col("best.slope"), F.lit(0.0))
        inside = (newton > low) & (newton < high)
        done = (F.abs("best.gap") <= 1e-10 * F.col("target")) | (high - low <= 1e-12 * (1 + F.abs("best.at")))
        moved = F.when(done, F.col("best.at")).when(inside, newton).otherwise((low + high) / 2)
        was = F.col("open")
        state = written(
            joined.select(
                "source", "target", "scale",
                F.when(was, low).otherwise(F.col("low")).alias("low"),
                F.when(was, high).otherwise(F.col("high")).alias("high"),
                F.when(was, moved).otherwise(F.col("tilt")).alias("tilt"),
                (was & ~done).alias("open"),
            ),
            "tilts",
        )
    # sums of doubles differ in their last bits from run to run; the copies should not
    return state.select("source", "target", "scale", F.round("tilt", 9).alias("tilt"))


def _thresholds(rated: DataFrame, seeds: DataFrame) -> DataFrame:
    """(source, edge, need, mass): keys below the edge fit, `need` is then left and the
    documents at the edge have `mass`.

    A radix search over the keys: two histograms of 262,144 digits for each source.
    """
    state = seeds.select("source", "need", F.lit(0).cast("long").alias("edge"))
    for step in range(_BITS // _DIGIT):
        shift = _BITS - _DIGIT * (step + 1)
        within = F.shiftrightunsigned("key", shift + _DIGIT) == F.shiftrightunsigned("edge", shift + _DIGIT)
        digits = (
            _match(rated, state)
            .where(within)
            .groupBy("source", F.shiftrightunsigned("key", shift).bitwiseAND(F.lit((1 << _DIGIT) - 1)).alias("digit"))
            .agg(F.sum("size").alias("mass"))
        )
        run = Window.partitionBy("source").orderBy("digit")  # 262,144 rows of a source at most
        back = Window.partitionBy("source").orderBy(F.col("digit").desc())
        sums = _match(digits, state.select("source", "need")).withColumn("upto", F.sum("mass").over(run))
        hit = (
            sums.withColumn("last", F.row_number().over(back) == 1)
            .where((F.col("upto") > F.col("need")) | F.col("last"))
            .groupBy("source")
            .agg(F.min(F.struct("digit", "mass", "upto")).alias("hit"))
        )
        joined = _match(state, hit, "left")
        state = written(
            joined.select(
                "source",
                (F.col("need") - F.coalesce(F.col("hit.upto") - F.col("hit.mass"), F.lit(0))).alias("need"),
                (F.col("edge") + F.coalesce(F.shiftleft("hit.digit", shift), F.lit(0))).alias("edge"),
                F.coalesce("hit.mass", F.lit(0)).alias("mass"),
            ),
            "edges",
        )
    return state


def mix(sized: DataFrame, targets: DataFrame, id_col: str, cap: float = 2.0, seed: int = 42) -> DataFrame:
    """Adds `target`, `rate`, `copies` and `taken` (copies * size) to every row.

    `sized` has the id, `source` and `size` (a long); `targets` has (source, target) for
    every source. Sizes and sources are best written beforehand, as they are read often.
    """
    sized = sized.drop("target", "rate", "copies", "taken")
    names = sized.columns
    extra, key, scale, tilt, need = free_name(sized, "extra", "key", "scale", "tilt", "need")
    facts = tilts(sized, targets, cap)
    facts = _match(targets.select("source", "target"), facts.drop("target"), "left")
    facts = facts.withColumnsRenamed({"scale": scale, "tilt": tilt})
    rows = _match(sized, facts)
    rate = (
        F.when(F.col(scale).isNull(), 1.0)  # a source without words
        .when(F.col(tilt).isNotNull(), F.least(F.lit(cap), F.exp(F.col(tilt) * F.col("size") / F.col(scale))))
        .otherwise(F.when(F.col("target") > 0, F.lit(cap)).otherwise(0.0))
    )
    half = 1 << (_BITS - 1)
    rows = rows.withColumn("rate", rate)
    fraction = F.col("rate") - F.floor("rate")
    uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col)), 64 - _BITS + 1)
    rows = rows.withColumn(key, F.when(fraction > 0, uniform - F.floor(fraction * half) + half))
    rows = rows.drop(scale, tilt).withColumn(extra, F.lit(0))
    rated = written(rows, "rated")
    own = rated.groupBy("source").agg(
        (F.first("target") - F.sum(F.floor("rate") * F.col("size"))).alias("need")
    )
    own = written(own, "needs")
    for filling in range(_FILLINGS):
        # what the document at the edge would exceed, smaller documents fill
        last = filling == _FILLINGS - 1
        left = own.withColumnRenamed("need", need)
        fits = F.col(key).isNotNull() & (F.col("size") > 0) & (F.col(extra) == 0)
        if filling:
            fits = fits & (F.col("size") <= F.col(need) * (2 if last else 1))
        candidates = _match(rated, left).where(fits)
        edges = _thresholds(candidates.select("source", "size", F.col(key).alias("key")), own)
        at_edge = F.col("mass") <= F.col("left") * (2 if last else 1)
        edges = edges.withColumnRenamed("need", "left")
        more = fits & ((F.col(key) < F.col("edge")) | ((F.col(key) == F.col("edge")) & at_edge))
        taken = _match(_match(rated, left), edges).withColumn(extra, F.when(more, 1).otherwise(F.col(extra)))
        rated = written(taken.select(rated.columns), "rated")
        own = edges.select(
            "source",
            (F.col("left") - F.when(at_edge, F.col("mass")).otherwise(0)).alias("need"),
        )
    copies = (F.floor("rate") + F.col(extra)).cast("int")
    return rated.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size")).select(
        *names, "target", "rate", "copies", "taken"
    )


def mix_by_weights(
    sized: DataFrame, id_col: str, weights: tuple[int, ...], share: float, cap: float = 2.0, seed: int = 42
) -> DataFrame:
    """`mix` with targets from weights that sources take in turn; adds `source_size` too."""
    sources = cyclic_weights(source_totals(sized), weights)
    targets = written(capped_targets(sources, share, cap), "targets")
    mixed = mix(sized.drop("source_size"), targets, id_col, cap, seed)
    return _match(mixed, targets.select("source", "source_size"))
