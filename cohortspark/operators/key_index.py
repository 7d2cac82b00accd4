"""An index of the keys loaded before, bucketed so that it is never shuffled again.

A new period is compared with all earlier ones: its keys are shuffled to the buckets of
the index, whose files are read in place.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..presets import LABOUR_SURVEY
from ..spec import require_columns
from .quality import _row_digest

BUCKETS = 200
_COLUMNS = "clave string, periodo string, n long, version_a long, version_b long"


def _key(keys: Sequence[str]) -> Column:
    """One text for the keys: absent names stand for nulls, so null keys are keys too."""
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]))


@dataclass(frozen=True)
class KeyIndex:
    """A bucketed table of ``(clave, periodo, n, version)`` under a path all executors see.

    ``buckets`` belongs to the files: it must be the same whenever the index is opened.
    """

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...] = tuple(k for k in LABOUR_SURVEY.keys if k != LABOUR_SURVEY.period)
    compared: tuple[str, ...] = LABOUR_SURVEY.profiled + LABOUR_SURVEY.categorical
    period: str = LABOUR_SURVEY.period
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        if not re.fullmatch(r"\w+", self.name):
            raise ValueError(f"not a table name: {self.name!r}")
        place = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_COLUMNS}) USING parquet "
            f"CLUSTERED BY (clave) SORTED BY (clave) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def _versions(self, df: DataFrame) -> DataFrame:
        """Rows by key, period and version; equal rows are counted before the shuffle."""
        require_columns(df, [*self.keys, self.period, *self.compared], "KeyIndex")
        digest = _row_digest(df, self.compared)
        rows = df.select(_key(self.keys).alias("clave"), F.col(self.period).alias("periodo"), digest.alias("d"))
        return rows.groupBy("clave", "periodo", "d").agg(F.count("*").alias("n")).select(
            "clave", "periodo", "n", F.col("d.a").alias("version_a"), F.col("d.b").alias("version_b")
        )

    def add(self, df: DataFrame) -> None:
        """Adds the keys of periods that are not in the index yet."""
        rows = self._versions(df)
        known = self.rows().select("periodo").distinct()
        twice = df.select(F.col(self.period).alias("periodo")).distinct().join(known, "periodo").limit(20).collect()
        if twice:
            raise ValueError(f"already in the index: {', '.join(sorted(r[0] for r in twice))}")
        rows.repartition(self.buckets, "clave").write.insertInto(self.name)

    def duplicates(self, df: DataFrame) -> DataFrame:
        """Keys of the rows that earlier periods have too.

        ``(*keys, n_nuevos, n_anteriores, primer_periodo, tipo)``: ``exacto`` when all rows
        of the key agree in the compared columns, now and before, else ``conflictivo``.
        """
        sides = []
        for kind, rows in (("nuevos", self._versions(df)), ("anteriores", self.rows())):
            version = F.struct("version_a", "version_b")
            found = rows.groupBy("clave").agg(
                F.sum("n").alias(f"n_{kind}"), F.min("periodo").alias(f"p_{kind}"),
                F.min(version).alias(f"low_{kind}"), F.max(version).alias(f"high_{kind}"),
            )
            sides.append(found)
        both = sides[0].join(sides[1], "clave")
        same = (F.col("low_nuevos") == F.col("high_nuevos")) & (F.col("low_anteriores") == F.col("high_anteriores"))
        same = same & (F.col("low_nuevos") == F.col("low_anteriores"))
        names = F.from_json("clave", ", ".join(f"`{k}` string" for k in self.keys))
        return both.select(names.alias("k"), "n_nuevos", "n_anteriores", F.col("p_anteriores").alias("primer_periodo"),
                           F.when(same, F.lit("exacto")).otherwise(F.lit("conflictivo")).alias("tipo")).select(
            *[F.col(f"k.`{k}`").alias(k) for k in self.keys], "n_nuevos", "n_anteriores", "primer_periodo", "tipo"
        )
