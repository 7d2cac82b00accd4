"""Pearson correlations."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..presets import LABOUR_SURVEY
from ..spec import require_columns
from .profile import finite_of


def correlation_long(
    df: DataFrame, columns: Sequence[str] = LABOUR_SURVEY.profiled, by: Sequence[str] = ()
) -> DataFrame:
    """Rows ``(*by, variable_x, variable_y, r)`` for every ordered pair.

    All pairs come from one aggregate over rows that are finite in every column.
    Suits a handful of columns; see :func:`correlation_matrix` for wide vectors.
    """
    names = list(columns)
    require_columns(df, [*by, *names], "correlation_long")
    values = df.select(
        *by, *[finite_of(df, c).alias(f"__v{i}") for i, c in enumerate(names)]
    )
    # no filter: it would be pushed below the coercion and evaluate it again
    complete = F.lit(True)
    for i in range(len(names)):
        complete = complete & F.col(f"__v{i}").isNotNull()
    pairs = list(combinations(range(len(names)), 2))
    wide = values.groupBy(*by).agg(
        *[F.corr(F.when(complete, F.col(f"__v{i}")), F.when(complete, F.col(f"__v{j}"))).alias(f"__r{i}_{j}") for i, j in pairs],
        F.count_if(complete).alias("__n"),
    )
    wide = wide.where("__n > 0") if by else wide

    def cell(i: int, j: int):
        r = F.lit(1.0) if i == j else F.col(f"__r{min(i, j)}_{max(i, j)}")
        return F.struct(
            F.lit(names[i]).alias("variable_x"), F.lit(names[j]).alias("variable_y"), r.alias("r")
        )

    cells = [cell(i, j) for i in range(len(names)) for j in range(len(names))]
    return wide.select(*by, F.inline(F.array(*cells)))


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = LABOUR_SURVEY.profiled, method: str = "pearson"
) -> DataFrame:
    """Square matrix through MLlib, one row per variable in column order.

    Invalid values are an error. Only the matrix, of a size fixed by the number
    of columns, reaches the driver.
    """
    names = list(columns)
    require_columns(df, names, "correlation_matrix")
    vectors = VectorAssembler(
        inputCols=names, outputCol="correlation_features", handleInvalid="error"
    ).transform(df)
    matrix = Correlation.corr(vectors, "correlation_features", method).head()[0].toArray()
    rows = [(name, *map(float, row)) for name, row in zip(names, matrix)]
    columns_ddl = ", ".join(f"`{n}` double" for n in names)
    return df.sparkSession.createDataFrame(rows, f"variable string, {columns_ddl}")


def strongest_correlation(
    long: DataFrame, target: str = LABOUR_SURVEY.target, by: Sequence[str] = ()
) -> DataFrame:
    """Variable with the largest absolute correlation with the target."""
    others = long.where((F.col("variable_x") == target) & (F.col("variable_y") != target))
    rank = F.struct((-F.abs("r")).alias("a"), F.col("variable_y").alias("variable"), "r")
    return others.where(F.col("r").isNotNull()).groupBy(*by).agg(F.min(rank).alias("__b")).select(
        *by, "__b.variable", "__b.r"
    )
