"""The test tables seen as the tables the operators work on.

Column texts use ``{S}`` for the string type, so the very same dirt can be put
into a Spark table and into the SQL that checks it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import apply_filters_with_audit
from ..operators.relational import shared_folder, spread
from ..presets import LABOUR_SURVEY
from ..session import compilable
from ..sources.extracts import standardise
from ..spec import DatasetSpec, FieldSpec

# Survey years are shifted so that they look like the years of the extracts.
YEAR = "(year(l_shipdate) + 25)"
QUARTER = "quarter(l_shipdate)"
ROMAN = "CASE {q} WHEN 1 THEN 'I' WHEN 2 THEN 'II' WHEN 3 THEN 'III' ELSE 'IV' END"

#: Raw text of every survey field, made from a line item.
PERSON_TEXT = {
    "P05D01": """CASE WHEN l_orderkey % 17 = 0 THEN NULL
        WHEN l_orderkey % 19 = 0 THEN '  '
        WHEN l_orderkey % 23 = 0 THEN 'nan'
        WHEN l_orderkey % 29 = 0 THEN 'x7'
        WHEN l_orderkey % 31 = 0 THEN 'Infinity'
        WHEN l_orderkey % 37 = 0 THEN '-5'
        ELSE CAST(l_extendedprice AS {S}) END""",
    "P02A03": """CASE WHEN l_partkey % 41 = 0 THEN 'n/d'
        ELSE CAST(CAST(l_quantity AS INT) + 10 AS {S}) || '.0' END""",
    "P05C07A": """CASE WHEN l_suppkey % 47 = 0 THEN 'inf'
        ELSE CAST(l_suppkey % 40 AS {S}) END""",
    "P05C07B": """CASE WHEN l_partkey % 43 = 0 THEN '11.5'
        WHEN l_partkey % 47 = 0 THEN '12'
        ELSE CAST(l_partkey % 12 AS {S}) || '.0' END""",
    "P05H01A": """CASE WHEN l_partkey % 53 = 0 THEN '0'
        ELSE CAST(CAST(l_quantity AS INT) * 3 + l_linenumber * 6 AS {S}) END""",
    "P03A03A": """CASE WHEN l_orderkey % 53 = 0 THEN NULL
        ELSE CAST(l_partkey % 8 AS {S}) || '.0' END""",
    "P05C16": """CASE WHEN l_linenumber <= 4 THEN CAST(l_linenumber AS {S})
        WHEN l_linenumber = 5 THEN '1.00' WHEN l_linenumber = 6 THEN '9' ELSE '' END""",
    "DOMINIO": """CASE WHEN l_suppkey % 59 = 0 THEN NULL
        ELSE CAST(1 + l_suppkey % 3 AS {S}) END""",
    "OCUPADOS": """CASE WHEN l_suppkey % 61 = 0 THEN NULL
        WHEN l_returnflag = 'A' THEN '1.0' WHEN l_returnflag = 'N' THEN ' 1 ' ELSE '2' END""",
    "NUM_HOGAR": "CAST(l_orderkey AS {S})",
    "NUM_PERSONA": "CAST(l_linenumber AS {S})",
    "FACTOR": "CAST(CAST(l_quantity AS INT) AS {S})",
    "ANIO": f"CAST({YEAR} AS {{S}})",
    "TRIMESTRE": f"CAST({QUARTER} AS {{S}})",
}

PERIOD_TEXT = f"CAST({YEAR} AS {{S}}) || 'T' || CAST({QUARTER} AS {{S}})"
FILE_TEXT = (
    f"'Base-Personas-ENEIC-' || {ROMAN.format(q=QUARTER)} || '-' || CAST({YEAR} AS {{S}}) || '.csv'"
)
DATASET_TEXT = f"CASE WHEN {YEAR} >= 2026 THEN 'holdout' ELSE 'entrenamiento' END"


def spark_sql(text: str):
    return F.expr(text.format(S="STRING"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return compilable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A folder of its own for each run, below the one that all executors share."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


def survey_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged survey texts with provenance, one row per line item."""
    lines = spread(table(spark, sf_dir, "lineitem"))
    return lines.select(
        *[spark_sql(text).alias(name) for name, text in PERSON_TEXT.items()],
        spark_sql(FILE_TEXT).alias("archivo_origen"),
        spark_sql(PERIOD_TEXT).alias("periodo_archivo"),
        F.expr(YEAR).cast("int").alias("anio_archivo"),
        F.expr(QUARTER).cast("int").alias("trimestre_calendario"),
        F.expr(DATASET_TEXT).alias("conjunto"),
    )


def survey_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard typed survey table."""
    tags = ("archivo_origen", "periodo_archivo", "anio_archivo", "trimestre_calendario", "conjunto")
    return standardise(survey_text(spark, sf_dir), {t: F.col(t) for t in tags})


def survey_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the survey table that pass the population filter."""
    return apply_filters_with_audit(survey_raw(spark, sf_dir))[0]


def survey_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_filters_with_audit(survey_raw(spark, sf_dir), by=["conjunto"])[1]


CHARGE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"

#: Line items as a modelling table.
CHARGES = DatasetSpec(
    fields=tuple(
        FieldSpec(c, c) for c in ("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    ),
    keys=("l_orderkey", "l_linenumber"),
    target="charge",
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus"),
    audited=("charge",),
)


def charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their charge, period and dataset."""
    return spread(table(spark, sf_dir, "lineitem")).select(
        *CHARGES.keys,
        "l_partkey",
        *CHARGES.numeric,
        *CHARGES.categorical,
        F.expr(CHARGE).alias("charge"),
        F.expr("CASE WHEN year(l_shipdate) >= 2000 THEN 'test' ELSE 'train' END").alias("era"),
    )


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer and a rule-based customer segment."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    segment = "CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 5000 THEN 1 ELSE 2 END"
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        "o_totalprice",
        "o_orderstatus",
        "o_orderpriority",
        "c_acctbal",
        "c_mktsegment",
        F.expr(segment).alias("cluster"),
    )
