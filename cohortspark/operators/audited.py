"""Quality tables that cost no pass of their own: counted while the rows are written."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.coerce import missing_of
from ..presets import LABOUR_SURVEY
from ..spec import DatasetSpec, require_columns
from .quality import FIRST_FAIL, audit_rows, flag_first_failure, missing_rows

ELIGIBLE = "elegible"


@dataclass(frozen=True)
class AuditedRows:
    """Written rows, and what was counted as they were written."""

    #: The rows that pass the population filter.
    prepared: DataFrame
    #: All rows, with whether they pass.
    rows: DataFrame
    missing: DataFrame
    audit: DataFrame
    raw_by_period: DataFrame
    eligible_by_period: DataFrame


def write_audited(
    raw: DataFrame,
    path: str,
    *,
    by: str,
    tags: Sequence[str],
    periods: Sequence[str],
    spec: DatasetSpec = LABOUR_SURVEY,
    audited: Sequence[str] | None = None,
) -> AuditedRows:
    """Writes all rows by eligibility and period, and audits them in the same job.

    ``by`` names the dataset column; ``tags`` and ``periods`` list what occurs in it and in
    the period column, so that every number of the quality tables (missing values, first
    failed steps, rows by period) is one sum over all rows, taken by the tasks that write
    them. The raw rows are evaluated once, and readers of the prepared rows never open the
    files of the others. Rows with another tag or period are an error: they would be
    missing from the tables.
    """
    names = list(spec.audited if audited is None else audited)
    require_columns(raw, [by, spec.period, *names], "write_audited")
    flagged = flag_first_failure(raw, spec.cascade)
    passes, step = F.col(FIRST_FAIL).isNull(), F.col(FIRST_FAIL)
    sums = {"n": F.count("*")}
    for i, tag in enumerate(tags):
        here = F.col(by).eqNullSafe(F.lit(tag))
        sums[f"t{i}"] = F.count_if(here)
        sums |= {f"t{i}m{j}": F.count_if(here & missing_of(raw, c)) for j, c in enumerate(names)}
        sums |= {f"t{i}s{s.step}": F.count_if(here & (step == s.step)) for s in spec.cascade.steps}
    for i, period in enumerate(periods):
        here = F.col(spec.period).eqNullSafe(F.lit(period))
        sums |= {f"p{i}": F.count_if(here), f"e{i}": F.count_if(here & passes)}

    seen = Observation()
    counted = flagged.observe(seen, *[column.alias(name) for name, column in sums.items()])
    out = counted.withColumn(ELIGIBLE, passes).drop(FIRST_FAIL)
    out.write.mode("overwrite").partitionBy(ELIGIBLE, spec.period).parquet(path)
    found = seen.get
    rows = raw.sparkSession.read.schema(out.schema).parquet(path).select(*out.columns)
    for kind, many in (("t", tags), ("p", periods)):
        if sum(found[f"{kind}{i}"] for i in range(len(many))) != found["n"]:
            column = by if kind == "t" else spec.period
            raise ValueError(f"there are rows with another {column} than {', '.join(many)}")
    if rows.count() != found["n"]:
        raise AssertionError(f"{path} does not hold the {found['n']} rows written to it")

    spark = raw.sparkSession
    listed = [i for i in range(len(tags)) if found[f"t{i}"]]
    totals = [(tags[i], found[f"t{i}"], *[found[f"t{i}m{j}"] for j in range(len(names))]) for i in listed]
    kinds = ", ".join(f"__m{j} long" for j in range(len(names)))
    missing = missing_rows(spark.createDataFrame(totals, f"`{by}` string, registros_totales long, {kinds}"), names, [by])
    steps = [s.step for s in spec.cascade.steps]
    fails = [(tags[i], found[f"t{i}"], *[found[f"t{i}s{s}"] for s in steps]) for i in listed]
    kinds = ", ".join(f"__s{s} long" for s in steps)
    audit = audit_rows(spark.createDataFrame(fails, f"`{by}` string, __total long, {kinds}"), spec.cascade, [by])

    def by_period(kind: str, alias: str) -> DataFrame:
        counts = [(p, found[f"{kind}{i}"]) for i, p in enumerate(periods) if found[f"{kind}{i}"]]
        return spark.createDataFrame(counts, f"`{spec.period}` string, {alias} long").orderBy(spec.period)

    return AuditedRows(
        rows.where(ELIGIBLE).drop(ELIGIBLE), rows, missing, audit,
        by_period("p", "filas_originales"), by_period("e", "filas_elegibles"),
    )
