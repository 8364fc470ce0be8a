from __future__ import annotations

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators import incremental

SCHEMA = "k string, v int"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_insert_new(spark):
    target = frame(spark, [("a", 1), ("a", 2)])
    source = frame(spark, [("a", 9), ("b", 1), ("b", 2), (None, 3)])
    assert rows(incremental.new_rows(target, source, "k")) == [(None, 3), ("b", 1), ("b", 2)]
    assert incremental.insert_new(target, source, "k").count() == 5
    assert incremental.insert_new(frame(spark, []), source, "k").count() == 4


def test_upsert(spark):
    target = frame(spark, [("a", 1), ("b", 2), (None, 3)])
    source = frame(spark, [("b", 9), ("c", 4), (None, 5), (None, 6)])
    assert rows(incremental.upsert(target, source, "k")) == [
        (None, 3),
        (None, 5),
        (None, 6),
        ("a", 1),
        ("b", 9),
        ("c", 4),
    ]


def test_upsert_refuses_two_rows_for_one_key(spark):
    source = frame(spark, [("b", 9), ("b", 4)])
    with pytest.raises(Exception, match="duplicate key"):
        incremental.upsert(frame(spark, []), source, "k").collect()


def test_require_unique_by_two_columns(spark):
    df = frame(spark, [("a", 1), ("a", 2)])
    assert rows(incremental.require_unique(df, ["k", "v"])) == rows(df)
    with pytest.raises(Exception, match="duplicate key"):
        incremental.require_unique(df, "k").count()


def test_first_per_key(spark):
    df = frame(spark, [("a", 2), ("a", 1), ("b", 5)])
    assert rows(incremental.first_per_key(df, "k", ["v"])) == [("a", 1), ("b", 5)]


pairs = st.lists(
    st.tuples(st.one_of(st.none(), st.sampled_from("abcdef")), st.integers(0, 3)), max_size=8
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs, pairs)
def test_inserting_again_changes_nothing(spark, target, source):
    known = {k for k, _ in target if k is not None}
    once = incremental.insert_new(frame(spark, target), frame(spark, source), "k")
    expected = target + [r for r in source if r[0] not in known]
    assert rows(once) == rows(frame(spark, expected))

    keyed = frame(spark, [r for r in source if r[0] is not None])
    assert rows(incremental.insert_new(once, keyed, "k")) == rows(once)
