"""Whole writes or nothing, batches once, deletes."""

import os

import pytest
from pyspark.sql import functions as F

from lectern.sources.published import Versions, delete_published, publish, read_published

SCHEMA = "id long, t string"


def rows(spark, path):
    return sorted(tuple(r) for r in read_published(spark, path, SCHEMA).collect())


def test_recreate_append_delete(spark, tmp_path):
    path, make = f"file://{tmp_path}/t", lambda *ids: spark.createDataFrame([(i, f"t{i}") for i in ids], SCHEMA)
    assert rows(spark, path) == []
    publish(make(1, 2, 3).repartition(3), path)
    publish(make(4), path, "append", batch=7)
    publish(make(4), path, "append", batch=7)  # again: nothing is added
    publish(make(5), path, "append", batch=8)
    assert [i for i, _ in rows(spark, path)] == [1, 2, 3, 4, 5]
    delete_published(spark, path, SCHEMA, F.col("id") % 2 == 0)
    publish(make(5), path, "append", batch=8)
    assert [i for i, _ in rows(spark, path)] == [1, 3, 5]
    publish(make(), path)
    assert rows(spark, path) == []
    publish(make(9), path)
    assert rows(spark, path) == [(9, "t9")]
    plan = read_published(spark, path, SCHEMA).filter("id > 5")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in plan


def test_a_failing_task_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    publish(spark.range(10).select("id", F.lit("old").alias("t")), path)
    before = Versions(path).last()

    def fails(batches):
        for pdf in batches:
            if (pdf["id"] == 77).any():
                raise RuntimeError("no")
            yield pdf

    bad = spark.range(100, numPartitions=4).select("id", F.lit("new").alias("t")).mapInPandas(fails, SCHEMA)
    for mode in ("overwrite", "append"):
        with pytest.raises(Exception, match="no"):
            publish(bad, path, mode)
    assert Versions(path).last() == before and {t for _, t in rows(spark, path)} == {"old"}
    assert set(before[1]["files"]) <= set(os.listdir(f"{tmp_path}/t/data"))
