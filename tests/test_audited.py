"""Quality tables counted by the job that writes the rows."""

import pytest
from pyspark.sql import functions as F

from cohortspark import LABOUR_SURVEY, apply_filters_with_audit, missing_summary, period_counts
from cohortspark.operators.audited import ELIGIBLE, write_audited
from cohortspark.plans.views import survey_raw

FOLDER = "/root/testdata/sf0.001"
TAGS = ("entrenamiento", "holdout", "otro")
PERIODS = tuple(f"{y}T{q}" for y in range(2020, 2028) for q in (1, 2, 3, 4))


@pytest.fixture(scope="module")
def raw(spark):
    return survey_raw(spark, FOLDER)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_tables_are_those_of_separate_passes(spark, raw, tmp_path):
    done = write_audited(raw, str(tmp_path / "t"), by="conjunto", tags=TAGS, periods=PERIODS)
    kept, audit = apply_filters_with_audit(raw, by=["conjunto"])
    assert rows(done.audit) == rows(audit) and done.audit.columns == audit.columns
    assert rows(done.missing) == rows(missing_summary(raw, by=["conjunto"]))
    assert rows(done.eligible_by_period) == rows(period_counts(kept))
    assert rows(done.raw_by_period) == rows(period_counts(raw, alias="filas_originales"))
    keys = [*LABOUR_SURVEY.keys, "salario_mensual"]
    assert sorted(rows(done.prepared.select(*keys))) == sorted(rows(kept.select(*keys)))
    assert done.rows.columns == [*raw.columns, ELIGIBLE] and done.prepared.columns == raw.columns
    scan = done.prepared._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(elegible" in scan


def test_the_raw_rows_are_evaluated_once(spark, raw, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    marked = raw.rdd.map(lambda r: (seen.add(1), tuple(r))[1]).toDF(raw.schema)
    done = write_audited(marked, str(tmp_path / "t"), by="conjunto", tags=TAGS, periods=PERIODS)
    done.audit.collect(), done.missing.collect(), done.prepared.count()
    assert seen.value == raw.count()


def test_rows_that_no_table_would_count_are_refused(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="another conjunto"):
        write_audited(raw, str(tmp_path / "a"), by="conjunto", tags=TAGS[1:], periods=PERIODS)
    with pytest.raises(ValueError, match="another periodo_archivo"):
        write_audited(raw, str(tmp_path / "b"), by="conjunto", tags=TAGS, periods=PERIODS[2:])
    odd = raw.withColumn("conjunto", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="another conjunto"):
        write_audited(odd, str(tmp_path / "c"), by="conjunto", tags=TAGS, periods=PERIODS)


def test_no_rows(spark, raw, tmp_path):
    done = write_audited(raw.limit(0), str(tmp_path / "t"), by="conjunto", tags=TAGS, periods=PERIODS)
    for table in (done.prepared, done.rows, done.missing, done.audit, done.raw_by_period, done.eligible_by_period):
        assert table.collect() == []
