"""What large queries leave on disk while they run."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeloom.plans import flights, medallion, queries
from lakeloom.sources.staging import by_slices, settled, shared_folder, spent, stage

SMALL = "/root/testdata/sf0.001"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test data")


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles()
    return sum(names.apply(n).getName().startswith("shuffle_") for n in range(names.size()))


def settle(spark, count):
    """Files go in a thread of their own."""
    import time

    for _ in range(50):
        if shuffle_files(spark) <= count:
            break
        time.sleep(0.1)
    return shuffle_files(spark)


@needs_data
def test_slices_hold_every_flight_once(spark):
    parts = [rows(flights.flight_raw(spark, SMALL, (nth, 5))) for nth in range(5)]
    assert all(parts)
    assert sorted(r for part in parts for r in part) == sorted(rows(flights.flight_raw(spark, SMALL)))


@needs_data
def test_large_tables_are_written_in_slices(spark, monkeypatch):
    assert flights.slices(spark, SMALL) == [(0, 1)]
    whole = rows(flights.flight_raw(spark, SMALL))
    monkeypatch.setattr(flights, "SLICE_MB", 0.01)
    assert len(flights.slices(spark, SMALL)) == flights.MOST_SLICES
    assert rows(queries.csv_roundtrip(spark, SMALL)) == whole


def test_a_staged_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    stage(spark.range(1000).repartition(7).groupBy("id").count(), "spent")
    assert settle(spark, before) <= before
    assert spark.conf.get(CLEANUP) == "false"
    with pytest.raises(ZeroDivisionError), spent(spark):
        assert spark.conf.get(CLEANUP) == "true"
        1 / 0
    assert spark.conf.get(CLEANUP) == "false"


def test_what_a_settled_table_was_made_of_goes(spark):
    inner = []

    def make():
        inner.append(stage(spark.range(10), "inner"))
        return inner[0].groupBy("id").count()

    found = settled(spark, "outer", make)
    assert found.count() == 10
    paths = [p for p in os.listdir(f"{shared_folder(spark)}/lakeloom") if p.startswith("inner-")]
    assert not paths


@pytest.mark.parametrize("count", [1, 4])
def test_slices_hold_every_key_once(spark, count):
    df = spark.createDataFrame([(None if n % 9 == 0 else n % 9, n) for n in range(90)], "k int, n int")
    make = lambda part: part.groupBy("k").agg(F.sum("n").alias("n"))
    assert rows(by_slices(df, ["k"], count, "sliced", make)) == rows(make(df))


@needs_data
@pytest.mark.parametrize("name", ["lake_aircraft", "lake_passengers", "lake_snapshot_changes", "lake_top_cost"])
def test_a_lake_in_slices_has_the_same_rows(spark, monkeypatch, name):
    whole = rows(queries.QUERIES[name](spark, SMALL))
    counts = []
    monkeypatch.setattr(medallion, "SLICE_MB", 0.05)
    monkeypatch.setattr(medallion, "by_slices", lambda df, keys, count, *rest: counts.append(count) or by_slices(df, keys, count, *rest))
    before = shuffle_files(spark)
    assert rows(queries.QUERIES[name](spark, SMALL)) == whole
    assert counts and min(counts) > 1
    # Spark tracks no shuffle of the few first rows of each task.
    assert name == "lake_top_cost" or settle(spark, before) <= before
