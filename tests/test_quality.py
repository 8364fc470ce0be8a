from __future__ import annotations

import pytest
from conftest import rows

from lakeloom.operators import quality

SCHEMA = "a int, b string, valid_to date"


def test_not_null(spark):
    clean = spark.createDataFrame([(1, "x", None)], SCHEMA)
    assert quality.null_violations(clean).count() == 0
    quality.assert_not_null(clean)
    assert quality.null_violations(clean, exclude=[]).count() == 1

    bad = spark.createDataFrame([(1, "x", None), (2, None, None)], SCHEMA)
    assert rows(quality.null_violations(bad)) == [(2, None, None)]
    with pytest.raises(AssertionError, match="b"):
        quality.assert_not_null(bad)
    assert quality.null_violations(bad.select("valid_to")).count() == 0


def test_key_profile(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(quality.key_profile(df, "k")) == [(3, 2)]


def test_file_stats(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "b"), (None, "a")], "x int, y string").coalesce(1).write.parquet(path)
    spark.createDataFrame([(7, None)], "x int, y string").coalesce(1).write.mode("append").parquet(path)
    stats = quality.file_stats(spark.read.parquet(path), ["x", "y"])
    assert stats.columns[:2] == ["file_path", "num_records"]
    assert rows(stats.drop("file_path")) == [(1, 7, 7, 0, None, None, 1), (2, 1, 1, 1, "a", "b", 0)]


def test_inventory(spark, tmp_path):
    root = tmp_path / "lake"
    for name, size in (("a/x.bin", 3), ("a/y.bin", 4), ("a/b/c/z.bin", 5), ("w.bin", 1), ("n.txt", 9)):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"x" * size)

    def short(df, *cols):
        return sorted(
            (r["directory"].split(str(tmp_path))[1], *[r[c] for c in cols]) for r in df.collect()
        )

    held = quality.file_inventory(spark, str(root), "*.bin")
    assert short(held, "file_count", "total_bytes") == [
        ("/lake", 1, 1),
        ("/lake/a", 2, 7),
        ("/lake/a/b/c", 1, 5),
    ]
    for given in (str(root), f"file:{root}/", f"file://{root}"):
        tree = quality.tree_inventory(spark, given, "*.bin")
        assert short(tree, "dir_count", "file_count", "total_bytes") == [
            ("/lake", 4, 4, 13),
            ("/lake/a", 3, 3, 12),
            ("/lake/a/b", 2, 1, 5),
            ("/lake/a/b/c", 1, 1, 5),
        ]
    everything = quality.files(spark, str(root))
    assert everything.count() == 5
    assert "content" not in everything._jdf.queryExecution().executedPlan().toString()
