"""Lines that do not fit, fields of several types, and key profiles by batches."""

from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeloom.operators import profiles, quality
from lakeloom.sources import ingest, tables

LINES = ["1,a,x", "2,b", "3,c,y,z", '4,"q,r",w', '5,"open,v', "6,,", "x,d,e", ""]


@pytest.fixture
def lines(spark, tmp_path):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n")
    return ingest.read_raw_csv(spark, str(tmp_path / "in.csv"), "k int, s string, c string", line="_line")


def test_good_lines_fit_the_schema(lines):
    good = ingest.good_lines(lines, "_line")
    assert rows(good) == [(1, "a", "x"), (4, "q,r", "w"), (6, None, None)]
    # Asking for one column, or for none, does not change which lines fit.
    assert rows(good.select("k")) == [(1,), (4,), (6,)]
    assert good.count() == 3


def test_bad_lines_are_kept_with_the_reason(lines):
    bad = ingest.bad_lines(lines, "_line")
    assert rows(bad.select("line", "n_fields", "reason")) == [
        ("2,b", 2, "short"), ("3,c,y,z", 4, "long"), ('5,"open,v', 3, "quote"), ("x,d,e", 3, "type"),
    ]
    assert bad.count() == 4 and bad.select("line").count() == 4
    assert all(r.file_path.endswith("in.csv") for r in bad.collect())


def test_without_a_line_column_nothing_changes(spark, tmp_path):
    (tmp_path / "in.csv").write_text("1,2\n3\n4,5,6\n")
    assert rows(ingest.read_raw_csv(spark, str(tmp_path / "in.csv"), "a string, b string")) == [("1", "2"), ("3", None), ("4", "5")]


def test_variants_keep_the_types_of_their_values(spark, tmp_path):
    values = [{"k": 1}, {"k": "two"}, {"k": {"deep": [1, 2.5]}}, {"other": True}, {"k": None}, {"k": 3.5}]
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, values)) + "\n")
    read = ingest.read_variant(spark, str(tmp_path / "in.json"))
    assert read.dtypes == [("value", "variant")]
    fields = {"$.k": "string", "$.k.deep[1]": "double", "$.other": "boolean"}
    found = read.select(ingest.variant_fields("value", fields).alias("f")).select("f.*")
    assert {r.k for r in found.collect()} == {"1", "two", '{"deep":[1,2.5]}', None, "3.5"}
    assert [r.other for r in found.collect() if r.other is not None] == [True]
    numbers = read.select(ingest.variant_fields("value", {"$.k": "int"}).alias("f"))
    assert sorted(r.f.k for r in numbers.collect() if r.f.k is not None) == [1, 3]
    # One scan: the schema is not looked for beforehand.
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_profiles_of_batches_merge(spark, tmp_path):
    path = str(tmp_path / "sketches")
    df = spark.range(60_000).selectExpr("id as own", "id % 5000 as some", "if(id % 3 = 0, null, 'same') as text", "id % 4 as batch")
    for batch in range(4):
        part = df.where(F.col("batch") == batch)
        tables.write_append(profiles.sketch_keys(part, ["own", "some", "text"], str(batch)).drop("batch_id"), path, batch_id=str(batch))
    # A batch that comes again replaces its sketches.
    tables.write_append(profiles.sketch_keys(df.where("batch = 2"), ["own", "some", "text"], "2").drop("batch_id"), path, batch_id="2")
    found = {r.column: r for r in profiles.merged_profile(tables.read(spark, path)).collect()}
    for key in ("own", "some", "text"):
        exact = quality.key_profile(df, key).first()
        assert (found[key].num_records, found[key].cnt) == (60_000, exact["cnt"])
        assert abs(found[key].cnt_dist - exact["cnt_dist"]) <= 4 * profiles.ERROR * exact["cnt_dist"]


def test_the_profile_of_one_batch_reads_that_batch_only(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 2 as day").write.partitionBy("day").parquet(path)
    plan = profiles.sketch_keys(spark.read.parquet(path).where("day = 1"), ["id"], "1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and plan.count("FileScan") == 1


def test_a_batch_without_rows(spark):
    found = profiles.sketch_keys(spark.range(0), ["id"], "none")
    assert [(r.num_records, r.cnt) for r in found.collect()] == [(0, 0)]
    assert profiles.merged_profile(found).first()["cnt_dist"] == 0
