"""Secret scans by a trigram inverted index, in DataFrame functions only.

Each rule's regex is turned into a Boolean query over trigrams: clauses of which one
must have all its trigrams in the (lower-cased) text. The index holds one posting for
each trigram of the rules and each distinct text hash; copies of a text are combined
before the shuffle. A clause's postings are intersected by counting them, and only texts
in the result are matched against the regex. Rules without mandatory trigrams are
matched against every text.

A text whose hash is another candidate's is matched in vain, so hashes cost nothing but
time. Matches of a rule are leftmost and do not overlap; a match whose checked group is
shorter than the rule's least length is dropped after that.

Cases: very long texts are searched whole; null and empty texts have no matches; rows of equal text each get their matches;
an empty table gives an empty result; columns named like the results are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import free_name, text_of, written

try:  # the parser behind re, under its name in Python 3.11 and later
    from re import _constants as sre
    from re import _parser as parser
except ImportError:
    import sre_constants as sre
    import sre_parse as parser

#: Most strings that a part of a regex is spelled out into; beyond it the part is any.
_MOST = 32


@dataclass(frozen=True)
class Rule:
    """A regex understood alike by Java and Python; `group` must have `least` characters."""

    name: str
    regex: str
    least: int
    group: int = 0


#: Fixed values.
RULES = (
    Rule(
        "assign",
        "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        6,
        2,
    ),
    # runs are as long as they can be, so that the least length may stand in the regex
    Rule("access", "AKIA[A-Z0-9]{16,}", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)


# --- regex to trigram query ---------------------------------------------------------


def _spelled(tokens) -> list[list[str] | None]:
    """The regex as a row of parts: the strings a part can be, or None for anything."""
    parts: list[list[str] | None] = []
    for op, value in tokens:
        if op is sre.LITERAL:
            parts.append([chr(value).lower()])
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in value) and len(value) <= _MOST:
            parts.append(sorted({chr(v).lower() for _, v in value}))
        elif op is sre.SUBPATTERN:
            parts.extend(_spelled(value[-1]))
        elif op is sre.BRANCH:
            parts.append(_whole([_spelled(branch) for branch in value[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = value
            once = _whole([_spelled(body)])
            if once is not None and high <= 2:
                parts.append(sorted({"".join(p) for n in range(low, high + 1) for p in product(once, repeat=n)}))
            else:
                parts.extend(_spelled(body) * min(low, 3))
                parts.append(None)
        elif op is sre.AT:
            continue
        else:
            parts.append(None)
    return parts


def _whole(branches: list[list[list[str] | None]]) -> list[str] | None:
    """All strings of the branches, or None if there are too many."""
    out: set[str] = set()
    for parts in branches:
        if any(p is None for p in parts):
            return None
        strings = [""]
        for p in parts:
            strings = [a + b for a in strings for b in p]
            if len(strings) > _MOST:
                return None
        out.update(strings)
    return sorted(out) if len(out) <= _MOST else None


def trigram_query(regex: str) -> list[frozenset[str]]:
    """Clauses of mandatory trigrams: a match has all trigrams of some clause.

    Of the stretches of the regex that can be spelled out, the one whose clauses are
    the most selective (most trigrams in the smallest) is taken; without one the list is empty.
    """
    stretches, strings = [], [""]
    for part in [*_spelled(parser.parse(regex)), None]:
        longer = None if part is None else [a + b for a in strings for b in part]
        if longer is not None and len(longer) <= _MOST:
            strings = longer
            continue
        stretches.append(strings)
        strings = part or [""]
    if strings != [""]:
        stretches.append(strings)
    best: list[frozenset[str]] = []
    for strings in stretches:
        clauses = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() in clauses:  # a string too short to have a trigram
            continue
        minimal = [c for c in clauses if not any(o < c for o in clauses)]
        if not best or (min(map(len, minimal)), -len(minimal)) > (min(map(len, best)), -len(best)):
            best = sorted(minimal, key=sorted)
    return best


# --- index and candidates -----------------------------------------------------------


def postings(docs: DataFrame, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """(trigram, text_key): the inverted index over the given trigrams, written."""
    low = F.lower(text_of(text_col))
    present = F.filter(
        F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]),
        lambda t: t.isNotNull(),
    )
    keyed = docs.select(F.xxhash64(text_of(text_col)).alias("text_key"), low.alias("low"))
    rows = keyed.select("text_key", F.explode(present).alias("trigram"))
    return written(rows.groupBy("trigram", "text_key").agg(F.lit(1).alias("one")).drop("one"), "postings")


def candidates(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text") -> DataFrame | None:
    """(text_key, rules): for each text that may match, the names of the rules."""
    spark = docs.sparkSession
    clauses = [(r.name, i, t) for r in rules for i, c in enumerate(trigram_query(r.regex)) for t in sorted(c)]
    if not clauses:
        return None
    needed = spark.createDataFrame(clauses, "rule string, clause int, trigram string")
    sizes = needed.groupBy("rule", "clause").agg(F.count("*").alias("needed"))
    index = postings(docs, sorted({t for _, _, t in clauses}), text_col)
    met = (
        index.join(needed.join(sizes, ["rule", "clause"]), "trigram")
        .groupBy("text_key", "rule", "clause")
        .agg(F.count("*").alias("met"), F.first("needed").alias("needed"))
        .where("met = needed")
    )
    return met.groupBy("text_key").agg(F.collect_set("rule").alias("rules"))


# --- matching -----------------------------------------------------------------------


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end), in code points, of the rule's matches that are long enough.

    Every match is found together with the gap before it, anchored at the end of the
    last one, so that lengths add up to positions. A plain search comes first, since
    most texts have no match.
    """
    anchored = F.lit(f"\\G([\\s\\S]*?)({rule.regex})")
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, anchored, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, anchored, F.lit(2)).alias("hit"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        checked = F.regexp_extract(pair["hit"], rule.regex, rule.group) if rule.group else pair["hit"]
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(F.length(checked) >= rule.least, F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    walked = F.aggregate(pairs, begin, step, lambda state: state["spans"])
    return F.when(F.regexp_like(text, F.lit(rule.regex)), walked).otherwise(none)


def _named(place: int, rule: Rule):
    def row(span: Column) -> Column:
        return F.struct(
            span["start"].alias("start"), F.lit(place).alias("place"), F.lit(rule.name).alias("rule"), span["end"].alias("end")
        )

    return row


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Adds `secrets`: array of (start, place, rule, end), by start and place of the rule."""
    docs = docs.drop("secrets")
    names = docs.columns
    key, may = free_name(docs, "key", "may")
    found = candidates(docs, rules, text_col)
    text = text_of(text_col)
    rows = docs
    if found is not None:
        found = found.select(F.col("text_key").alias(key), F.col("rules").alias(may))
        rows = docs.withColumn(key, F.xxhash64(text)).join(found, key, "left")
    lists = []
    for place, rule in enumerate(rules):
        spans = _spans(text, rule)
        if trigram_query(rule.regex):
            none = F.array().cast("array<struct<start:int,end:int>>")
            spans = F.when(F.array_contains(F.col(may), rule.name), spans).otherwise(none)
        lists.append(F.transform(spans, _named(place, rule)))
    return rows.withColumn("secrets", F.array_sort(F.concat(*lists))).select(*names, "secrets")
