from __future__ import annotations

import os
import pytest
from pyspark.sql import functions as F
from conftest import rows

from lakeloom.schemas import FLIGHT_RAW
from lakeloom.sources import ingest, layout, staging, tables

MB = 1024 * 1024


def test_csv_fills_short_rows_and_drops_extra_fields(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1,2\n3\n4,5,6\n")
    found = ingest.read_raw_csv(spark, str(tmp_path / "in.csv"), "a string, b string")
    assert rows(found) == [("1", "2"), ("3", None), ("4", "5")]


def test_csv_header_is_data_unless_stated(spark, tmp_path):
    (tmp_path / "in.csv").write_text("a,b\n1,2\n")
    path = str(tmp_path / "in.csv")
    assert ingest.read_raw_csv(spark, path, "a string, b string").count() == 2
    assert rows(ingest.read_raw_csv(spark, path, "a string, b string", header=True)) == [("1", "2")]
    assert ingest.read_raw_csv(spark, path).schema == FLIGHT_RAW


def test_json_with_and_without_schema(spark, tmp_path):
    (tmp_path / "in.json").write_text('{"add": {"path": "p", "stats": "{}"}}\n{"other": 1}\n')
    path = str(tmp_path / "in.json")
    assert dict(ingest.read_json(spark, path).dtypes) == {
        "add": "struct<path:string,stats:string>",
        "other": "bigint",
    }
    assert rows(ingest.read_json(spark, path, "other int")) == [(None,), (1,)]


def test_paths_and_names(spark, tmp_path):
    df = spark.range(5)
    path = str(tmp_path / "t")
    tables.write_overwrite(df, path)
    tables.write_overwrite(df, path, partition_by=None)
    assert rows(tables.read(spark, path)) == rows(df)
    assert rows(tables.read_sql(spark, path)) == rows(df)

    tables.write_overwrite(df, "managed")
    tables.write_overwrite(df, "managed")
    assert tables.read(spark, "managed").count() == 5
    tables.write_overwrite(df, "outside", str(tmp_path / "outside"))
    assert tables.read(spark, str(tmp_path / "outside")).count() == 5
    assert tables.as_view(df, "seen").sparkSession.sql("select * from seen").count() == 5


@pytest.mark.parametrize("kind", ["path", "managed", "external"])
def test_append(spark, tmp_path, kind):
    df = spark.range(5)
    path = str(tmp_path / "data") if kind == "external" else None
    table = str(tmp_path / "t") if kind == "path" else f"append_{kind}"
    tables.write_append(df, table, path)
    tables.write_append(df, table, path)
    assert tables.read(spark, table).count() == 10


@pytest.mark.parametrize("kind", ["path", "managed", "external"])
def test_append_of_a_batch_counts_once(spark, tmp_path, kind):
    path = str(tmp_path / "data") if kind == "external" else None
    table = str(tmp_path / "t") if kind == "path" else f"batch_{kind}"
    for batch, df in (("1", spark.range(5)), ("2", spark.range(5, 8)), ("1", spark.range(4))):
        tables.write_append(df, table, path, batch_id=batch)
    assert rows(tables.read(spark, table).select("id")) == [(i,) for i in (0, 1, 2, 3, 5, 6, 7)]


def test_swap_may_read_the_table_it_replaces(spark, tmp_path):
    root = str(tmp_path / "swapped")
    tables.swap(spark.range(5), "swapped", root)
    tables.swap(spark.table("swapped").where("id > 2"), "swapped", root)
    assert rows(spark.table("swapped")) == [(3,), (4,)]


def test_partition_counts():
    # A size just over a multiple of the target takes one more partition, and never a fraction.
    assert layout.partitions_for(0) == 3
    assert layout.partitions_for(601 * MB) == 4
    assert layout.partitions_for(800 * MB) == 4
    assert layout.partitions_for(800 * MB + 1) == 5
    assert layout.partitions_for(100 * 1024 * 1024 * MB) == 524288


def test_layout_of_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 1000, 1, 8).write.parquet(path)
    df = spark.read.parquet(path)
    size = layout.stored_bytes(spark, path)
    assert layout.estimated_bytes(df) == size > 0
    assert layout.estimated_mb(df) == size / MB
    assert layout.sized_repartition(df).rdd.getNumPartitions() == 3
    assert layout.sized_repartition(df, size_bytes=1000 * MB).rdd.getNumPartitions() == 5
    assert layout.sized_repartition(df, shuffle=False).rdd.getNumPartitions() <= 3
    wide = spark.range(0, 1000, 1, 8)
    assert layout.compact(wide, 2).rdd.getNumPartitions() == 2
    assert layout.compact(wide, 2, size_bytes=1200 * MB).rdd.getNumPartitions() == 5
    assert rows(layout.sized_repartition(df)) == rows(df)


def test_sizes_that_cannot_be_told(spark, tmp_path):
    path = str(tmp_path / "sized")
    tables.write_append(spark.range(10), "sized", path, batch_id="1")
    with pytest.raises(ValueError, match="size_bytes"):
        layout.estimated_bytes(spark.table("sized"))
    assert 0 < layout.stored_bytes(spark, path) < MB
    stored = spark.read.parquet(path)
    for unsized in (stored.join(stored, "id"), stored.groupBy("id").count()):
        with pytest.raises(ValueError, match="size_bytes"):
            layout.sized_repartition(unsized)
        assert layout.sized_repartition(unsized, size_bytes=1).rdd.getNumPartitions() == 3


def failing(df):
    """``df`` whose job fails in its last row."""
    last = F.when(F.col("id") == 9, F.raise_error(F.lit("midway")).cast("long")).otherwise(F.col("id"))
    return df.withColumn("id", last)


@pytest.mark.parametrize("kind", ["path", "managed", "external"])
def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_path, kind):
    path = str(tmp_path / "t")
    name, outside = (path, None) if kind == "path" else (f"kept_{kind}", path if kind == "external" else None)
    tables.write_overwrite(spark.range(5), name, outside)
    with pytest.raises(Exception, match="midway"):
        tables.write_overwrite(failing(spark.range(10)), name, outside)
    assert rows(tables.read(spark, name)) == [(n,) for n in range(5)]
    tables.write_overwrite(tables.read(spark, name).where("id > 2"), name, outside)
    assert rows(tables.read(spark, name)) == [(3,), (4,)]
    assert [f.name for f in tmp_path.iterdir()] == ([] if kind == "managed" else ["t"])
    assert [t.name for t in spark.catalog.listTables() if "__" in t.name] == []


@pytest.mark.parametrize("named", [True, False])
def test_a_batch_can_become_empty(spark, tmp_path, named):
    path = str(tmp_path / "it's")
    name = "emptied" if named else path
    tables.write_append(spark.range(5), name, path, batch_id="2020-01-01 00:00:00")
    tables.write_append(spark.range(2), name, path, batch_id="b")
    with pytest.raises(Exception, match="midway"):
        tables.write_append(failing(spark.range(10)), name, path, batch_id="b")
    assert tables.read(spark, name).count() == 7
    tables.write_append(spark.range(0), name, path, batch_id="2020-01-01 00:00:00")
    assert rows(tables.read(spark, name).select("id")) == [(0,), (1,)]


def test_swap_keeps_a_stated_number_of_folders(spark, tmp_path):
    root = str(tmp_path / "it's")
    for n in range(4):
        tables.swap(spark.range(n + 1), "swapped_often", root, keep=1)
    assert spark.table("swapped_often").count() == 4
    assert len([f for f in (tmp_path / "it's").iterdir() if f.name.startswith("v-")]) == 2


def test_a_scope_removes_what_it_staged(spark):
    with staging.scope(spark):
        inside = staging.stage(spark.range(3), "scoped")
        folder = inside.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)


def test_broadcast_only_within_the_limit(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    dim = spark.read.parquet(path)

    def hinted(limit_mb):
        joined = spark.range(10).join(layout.broadcast_within(dim, limit_mb), "id")
        return "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()

    assert hinted(64)
    assert not hinted(0)


def test_keep(spark):
    df = layout.keep(spark.range(3))
    assert df.storageLevel.useMemory and df.storageLevel.useDisk
    df.unpersist()


def test_stage_uses_the_shared_folder(spark):
    staged = staging.stage(spark.range(3), "numbers")
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(folder in f for f in staged.inputFiles())
    assert rows(staged) == [(0,), (1,), (2,)]


CODES = [("007", 1), ("010", 2), ("1e3", 3), (None, 4), ("a/b=c %", 5), ("2020-01-01", 6)]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
@pytest.mark.parametrize("kind", ["managed", "external"])
def test_partitions_keep_their_values_and_types(spark, tmp_path, kind, fmt):
    table = f"codes_{kind}_{fmt}"
    path = str(tmp_path / "codes") if kind == "external" else None
    schema = "code string, amount int, day date, note string"
    first = spark.createDataFrame([(c, n, None, "x") for c, n in CODES], schema).withColumn("day", F.lit("2020-02-03").cast("date"))
    # The second has one value less and another one more.
    second = first.where("code is null or code <> '007'").unionByName(first.where("code = '007'").withColumn("code", F.lit("08")))
    for df in (first, second, second):
        tables.write_overwrite(df, table, path, fmt, partition_by=["code"])
        found = tables.read(spark, table, fmt)
        assert found.columns == ["amount", "day", "note", "code"]
        assert dict(found.dtypes) == dict(df.dtypes)
        assert rows(found.select(*df.columns)) == rows(df)
        assert found.where("code = '1e3'").count() == 1
    spark.catalog.refreshTable(table)
    assert spark.table(table).where("code is null").count() == 1
    # It may change its partitioning, and need not have any.
    tables.write_overwrite(spark.table(table).select(*first.columns), table, path, fmt, partition_by=["amount", "code"])
    assert rows(spark.table(table).select(*first.columns)) == rows(second)
    tables.write_overwrite(first, table, path, fmt)
    assert rows(spark.table(table)) == rows(first)
    spark.sql(f"drop table {table}")
    if path:
        assert os.path.isdir(path)


def test_typed_partitions_and_a_reader_of_the_folder(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.sql("select id, if(id = 3, null, date '2020-01-01' + cast(id % 2 as int)) as day, cast(id % 3 as short) as part from range(9)")
    tables.write_overwrite(df, "days", path, partition_by=["day", "part"])
    assert rows(spark.table("days").select(*df.columns)) == rows(df)
    assert dict(spark.table("days").dtypes) == dict(df.dtypes)
    assert rows(tables.read(spark, path, schema=df.schema).select(*df.columns)) == rows(df)


@pytest.mark.parametrize("kind", ["managed", "external"])
def test_a_failed_overwrite_leaves_the_old_rows(spark, tmp_path, monkeypatch, kind):
    path = str(tmp_path / "kept") if kind == "external" else None
    table = f"kept_{kind}"
    df = spark.createDataFrame(CODES, "code string, amount int")
    tables.write_overwrite(df, table, path, partition_by=["code"])
    failing = df.withColumn("amount", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        tables.write_overwrite(failing, table, path, partition_by=["code"])
    assert rows(spark.table(table).select("code", "amount")) == rows(df)

    # The last step fails: finding the partitions of the table under its final name.
    found = tables._find_partitions

    def breaks(session, name):
        found(session, name)
        if name == table and not broken:
            broken.append(name)
            raise RuntimeError("catalog is gone")

    broken = []
    monkeypatch.setattr(tables, "_find_partitions", breaks)
    with pytest.raises(RuntimeError, match="catalog is gone"):
        tables.write_overwrite(df.where("amount = 1"), table, path, partition_by=["code"])
    assert rows(spark.table(table).select("code", "amount")) == rows(df)
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{table}__")]
    assert left == [] and [f for f in os.listdir(tmp_path) if "__" in f] == []


def test_a_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 8).selectExpr("id", "uuid() as text", "if(id % 10 < 9, 'hot', cast(id % 7 as string)) as part")
    with_sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m"}
    for key, value in with_sizes.items():
        spark.conf.set(key, value)
    try:
        tables.write_overwrite(df, "hot", str(tmp_path / "hot"), partition_by=["part"])
    finally:
        for key in with_sizes:
            spark.conf.unset(key)
    assert len([f for f in os.listdir(tmp_path / "hot" / "part=hot") if f.startswith("part-")]) > 3
    assert spark.table("hot").count() == 400_000
