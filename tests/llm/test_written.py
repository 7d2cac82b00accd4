"""Loops of small jobs leave nothing behind on the driver."""

from cohortspark.llm import common


def test_the_driver_collects_its_garbage_while_tables_are_written(spark, monkeypatch):
    freed = []
    monkeypatch.setattr(common, "free_shuffles", freed.append)
    for _ in range(12):
        table = common.written(spark.range(3), "numbers")
    assert len(freed) >= 2
    assert sorted(r["id"] for r in table.collect()) == [0, 1, 2]
