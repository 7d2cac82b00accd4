"""Times the headline queries, and naive multi-job versions of some of them.

Prints one JSON line. Environment: BENCH_SF_DIR, BENCH_CPUS, and BENCH_NAIVE=0 to
leave the naive versions out.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml.evaluation import RegressionEvaluator  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from cohortspark import LABOUR_SURVEY, is_missing  # noqa: E402
from cohortspark.functions.coerce import number_of, to_code  # noqa: E402
from cohortspark.plans import queries as q  # noqa: E402
from cohortspark.plans.views import customer_orders, survey_raw  # noqa: E402
from cohortspark.session import configure  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "standard_load",
    "filter_audit",
    "missing_typed",
    "missing_staged",
    "duplicate_key_audit",
    "eligible_period_counts",
    "descriptive_stats_sketch",
    "descriptive_stats",
    "median_by_group_sketch",
    "median_by_groups",
    "categorical_distributions",
    "value_histogram",
    "correlations",
    "segment_compositions",
    "split_by_hash",
    "sample_by_hash",
    "model_comparison",
    "grouped_errors",
    "band_errors",
    "ols_slopes",
    "linear_sweep",
    "silhouette_sweep",
)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


# --- the same results with a job per number -------------------------------------


def naive_missing(spark: SparkSession, sf: str) -> None:
    raw = survey_raw(spark, sf)
    for tag in ("entrenamiento", "holdout"):
        part = raw.where(F.col("conjunto") == tag)
        part.count()
        for name in LABOUR_SURVEY.audited:
            part.where(is_missing(F.col(name))).count()


def naive_filter_audit(spark: SparkSession, sf: str) -> None:
    raw = survey_raw(spark, sf)
    inputs = LABOUR_SURVEY.cascade.inputs
    for tag in ("entrenamiento", "holdout"):
        working = raw.where(F.col("conjunto") == tag).cache()
        working.count()
        values = {
            n: number_of(raw, c) if kind == "numeric" else to_code(F.col(c))
            for n, (c, kind) in inputs.items()
        }
        for step in LABOUR_SURVEY.cascade.steps:
            after = working.where(step.condition(values)).cache()
            after.count()
            working.unpersist()
            working = after
        working.unpersist()


def naive_duplicates(spark: SparkSession, sf: str) -> None:
    raw = survey_raw(spark, sf)
    keys = list(LABOUR_SURVEY.keys)
    rest = [c for c in raw.columns if c not in keys]
    for tag in ("entrenamiento", "holdout"):
        part = raw.where(F.col("conjunto") == tag)
        counts = part.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        versions = part.groupBy(*keys).agg(F.countDistinct(F.struct(*rest)).alias("v"))
        joined = counts.join(versions, keys, "left")
        run(joined.groupBy(F.col("v") == 1).agg(F.count("*"), F.sum("n")))


def naive_distributions(spark: SparkSession, sf: str) -> None:
    prepared = q._labelled(spark, sf)
    for tag in ("entrenamiento", "holdout"):
        part = prepared.where(F.col("conjunto") == tag)
        for column in q._DISTRIBUTED:
            total = part.count()
            run(part.groupBy(column).count().withColumn("p", F.col("count") * 100.0 / total))


def naive_compositions(spark: SparkSession, sf: str) -> None:
    rows = customer_orders(spark, sf)
    for column in ("c_mktsegment", "o_orderpriority", "o_orderstatus"):
        counts = rows.groupBy("cluster", column).agg(F.count("*").alias("n"))
        totals = rows.groupBy("cluster").agg(F.count("*").alias("t"))
        run(counts.join(totals, "cluster").withColumn("p", F.col("n") * 100.0 / F.col("t")))


def naive_metrics(spark: SparkSession, sf: str) -> None:
    long = q._predictions(spark, sf, [])
    for model in ("Baseline", "Precio", "Descuento"):
        for dataset in ("validation", "test"):
            part = long.where((F.col("modelo") == model) & (F.col("dataset") == dataset))
            for metric in ("mae", "rmse", "r2"):
                RegressionEvaluator(
                    labelCol="charge", predictionCol="prediction", metricName=metric
                ).evaluate(part)


NAIVE = {
    "missing_typed": naive_missing,
    "filter_audit": naive_filter_audit,
    "duplicate_key_audit": naive_duplicates,
    "categorical_distributions": naive_distributions,
    "segment_compositions": naive_compositions,
    "model_comparison": naive_metrics,
}


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = (
        configure(SparkSession.builder.master(f"local[{CPUS}]"))
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("cohortspark.inputPartitions", CPUS)  # the test tables are single files
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    everything = q.all_queries()
    for name in ("filter_audit", "model_comparison"):  # start the JVM's compilers
        run(everything[name](spark, SF_DIR))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    times = {n: timed(lambda n=n: run(everything[n](spark, SF_DIR))) for n in names}
    naive = {}
    if os.environ.get("BENCH_NAIVE", "1") != "0":
        naive = {n: timed(lambda w=w: w(spark, SF_DIR)) for n, w in NAIVE.items()}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "naive": naive,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
