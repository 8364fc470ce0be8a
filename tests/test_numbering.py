from __future__ import annotations

import pytest
from conftest import plan_of, rows
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from lakeloom.operators import numbering


@pytest.mark.parametrize("count", [0, 1, 5, 3000])
def test_dense_id_equals_a_global_row_number(spark, count):
    df = spark.range(count).select(F.md5(F.col("id").cast("string")).alias("name"))
    numbered = numbering.dense_id(df, "name")
    expected = df.withColumn("id", F.row_number().over(Window.orderBy("name")).cast("bigint"))
    assert rows(numbered) == rows(expected)


def test_dense_id_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("name"))
        numbered = numbering.dense_id(df.repartition(7), "name")
        files = numbered.inputFiles()
        expected = df.withColumn("id", F.row_number().over(Window.orderBy("name")).cast("bigint"))
        assert len(set(files)) > 1
        assert rows(numbered) == rows(expected)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_id_over_two_columns_and_nulls(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("a", 1)], "x string, y int")
    assert rows(numbering.dense_id(df, "x", "y")) == [
        (None, 3, 1),
        ("a", 1, 2),
        ("a", 2, 3),
        ("b", 1, 4),
    ]


def test_nth_row_orders_structs_null_first(spark):
    data = [
        Row(add=Row(a=2, b="x"), v=1),
        Row(add=None, v=2),
        Row(add=Row(a=1, b="z"), v=3),
        Row(add=Row(a=1, b="y"), v=4),
    ]
    df = spark.createDataFrame(data, "add struct<a: int, b: string>, v int")
    found = [numbering.nth_row(df, "add", n).first()["v"] for n in (1, 2, 3, 4)]
    assert found == [2, 4, 3, 1]
    assert numbering.nth_row(df, "add", 5).count() == 0


def test_nth_row_per_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 9), (None, 5), (None, 4)], "g string, v int")
    assert rows(numbering.nth_row(df, "v", 2, ["g"])) == [(None, 5, 2), ("a", 3, 2)]


def test_deep_nth_row_equals_a_window(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"),
        (F.col("id") * 7919 % 9001).alias("v"),
    )
    window = Window.partitionBy("g").orderBy("v")
    expected = df.withColumn("rn", F.row_number().over(window)).where("rn = 1500")
    assert rows(numbering.nth_row(df, "v", 1500, ["g"])) == rows(expected)
    assert numbering.nth_row(df, "v", 5000).first()["v"] == sorted(
        r.v for r in df.collect()
    )[4999]


@pytest.mark.parametrize("n", [999, 1000, 1001])
@pytest.mark.parametrize("threshold", ["1000", "100", "-1"])
@pytest.mark.parametrize("groups", [None, ["g"]])
def test_ties_are_settled_alike_for_any_n(spark, n, threshold, groups):
    rows_ = spark.range(3000).select(F.lit(1).alias("tied"), (5000 - F.col("id")).alias("x"), F.lit(7).alias("g"))
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        for df in (rows_, rows_.repartition(3)):
            found = numbering.nth_row(df, "tied", n, groups)
            plan = plan_of(found)
            assert [r.x for r in found.collect()] == [2000 + n]
            if groups is None:
                assert "Exchange SinglePartition" not in plan or "TakeOrderedAndProject" in plan or n > 1000
    finally:
        spark.conf.set(name, before)


def test_a_column_without_an_order_does_not_matter(spark):
    df = spark.range(2000).select("id", F.parse_json(F.lit("{}")).alias("v"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    for n in (5, 1001):
        assert numbering.nth_row(df, "id", n).first()["id"] == n - 1


KEYS = {
    "struct": "struct(if(id % 11 = 0, null, id % 50) as a, struct(cast(id as string) as b) as c)",
    "timestamp": "timestamp_micros(id * 7919 % 9001 * 1000001)",
    "local": "cast(timestamp_micros(id * 7919 % 9001 * 1000001) as timestamp_ntz)",
    "date": "date '2020-01-01' + cast(id * 7919 % 9001 as int)",
    "decimal": "cast(id * 7919 % 9001 as decimal(20, 3)) / 7",
    "double": "case id % 10 when 0 then null when 1 then double('nan') else cast(id * 7919 % 9001 as double) end",
    "text": "if(id % 5 = 0, null, md5(cast(id as string)))",
    "array": "array(id % 3, id * 7919 % 9001)",
    "equal": "1",
}


@pytest.mark.parametrize("kind", list(KEYS))
def test_a_deep_row_is_found_for_any_kind_of_key(spark, monkeypatch, kind):
    monkeypatch.setattr(numbering, "_TOP_ROWS", 40)
    monkeypatch.setattr(numbering, "_SAMPLED_ROWS", 300)
    df = spark.range(6000).selectExpr("id as own", f"{KEYS[kind]} as k")
    for n in (41, 3000, 5999, 6000, 6001):
        window = Window.orderBy("k", "own")
        expected = df.withColumn("rn", F.row_number().over(window)).where(F.col("rn") == n)
        assert str(rows(numbering.nth_row(df, "k", n))) == str(rows(expected))


def test_a_deep_row_along_a_falling_key(spark):
    df = spark.range(5000).select("id")
    assert numbering.nth_row(df, F.desc("id"), 2001).first()["id"] == 2999


def test_a_deep_row_moves_keys_of_one_range_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 200_000, 1, 4).selectExpr("id * 7919 % 200003 as k", "uuid() as text").write.parquet(path)
    df = spark.read.parquet(path)
    found = numbering.nth_row(df, "k", 100_000)
    plan = plan_of(found)
    # What is left is a filter on the key and a top-n.
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
    assert found.first()["k"] == sorted(i * 7919 % 200003 for i in range(200_000))[99_999]
