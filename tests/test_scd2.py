from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators import scd2

SCHEMA = "k string, v int, w string, note string"
CHECKS = ["v", "w"]
T = [f"2020-01-0{i} 00:00:00" for i in range(1, 8)]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def moment(text):
    return dt.datetime.strptime(text, "%Y-%m-%d %H:%M:%S")


def state(df):
    """(key, v, w, note, from, to) with moments as the index in T."""
    index = {moment(t): i for i, t in enumerate(T)} | {None: None}
    found = [(r.k, r.v, r.w, r.note, index[r.valid_from], index[r.valid_to]) for r in df.collect()]
    return sorted(found, key=lambda r: [(x is not None, str(x)) for x in r])


def apply(spark, current, data, i, **options):
    return scd2.apply_snapshot(current, frame(spark, data), "k", CHECKS, T[i], **options)


def test_contract(spark):
    first = [
        ("same", 1, "x", "n"),
        ("changed", 1, "x", "n"),
        ("gets_null", 1, "x", "n"),
        ("gets_value", None, "x", "n"),
        ("note_only", 1, "x", "n"),
        ("gone", 1, "x", "n"),
        ("both_null", None, None, "n"),
    ]
    second = [
        ("same", 1, "x", "n"),
        ("changed", 2, "x", "n"),
        ("gets_null", None, "x", "n"),
        ("gets_value", 5, "x", "n"),
        ("note_only", 1, "x", "other"),
        ("both_null", None, None, "n"),
        ("new", 1, "x", "n"),
        (None, 1, "x", "n"),
    ]
    one = apply(spark, None, first, 0)
    two = apply(spark, one, second, 1)
    assert state(two) == sorted(
        [
            ("same", 1, "x", "n", 0, None),
            ("changed", 1, "x", "n", 0, 1),
            ("changed", 2, "x", "n", 1, None),
            ("gets_null", 1, "x", "n", 0, 1),
            ("gets_null", None, "x", "n", 1, None),
            ("gets_value", None, "x", "n", 0, 1),
            ("gets_value", 5, "x", "n", 1, None),
            ("note_only", 1, "x", "n", 0, None),
            ("gone", 1, "x", "n", 0, 1),
            ("both_null", None, None, "n", 0, None),
            ("new", 1, "x", "n", 1, None),
        ],
        key=lambda r: [(x is not None, str(x)) for x in r],
    )
    assert rows(scd2.quarantine(frame(spark, second), "k")) == [(None, 1, "x", "n")]

    back = apply(spark, two, [*first, ("new", 1, "x", "n")], 2)
    assert [r[4:] for r in state(back) if r[0] == "gone"] == [(0, 1), (2, None)]


def test_missing_rows_stay_open_without_hard_deletes(spark):
    one = apply(spark, None, [("a", 1, "x", "n")], 0)
    assert state(apply(spark, one, [], 1, hard_deletes=False)) == [("a", 1, "x", "n", 0, None)]
    assert state(apply(spark, one, [], 1)) == [("a", 1, "x", "n", 0, 1)]


def test_duplicate_keys(spark):
    twice = [("a", 2, "x", "n"), ("a", 1, "y", "n")]
    with pytest.raises(Exception, match="duplicate key"):
        apply(spark, None, twice, 0).collect()
    first = apply(spark, None, twice, 0, on_duplicate="first", order=["v"])
    assert state(first) == [("a", 1, "y", "n", 0, None)]
    with pytest.raises(ValueError, match="order"):
        apply(spark, None, twice, 0, on_duplicate="first")


def test_columns_must_agree(spark):
    one = apply(spark, None, [("a", 1, "x", "n")], 0)
    other = spark.createDataFrame([("a", 1, "x")], "k string, v int, w string")
    with pytest.raises(ValueError, match="note"):
        scd2.apply_snapshot(one, other, "k", CHECKS, T[1])


def test_names_ids_and_composite_keys(spark):
    df = frame(spark, [("a", 1, "x", "n")])
    row = scd2.apply_snapshot(None, df, ["k", "v"], ["w"], moment(T[0]), prefix="dbt_").first()
    assert row.dbt_scd_id == hashlib.md5(b"a|1|1577836800000000").hexdigest()
    assert (row.dbt_valid_from, row.dbt_updated_at) == (moment(T[0]), moment(T[0]))
    assert row.dbt_valid_to is None


sources = st.lists(
    st.dictionaries(
        st.sampled_from("abcd"),
        st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["x", "y", None])),
        max_size=4,
    ),
    min_size=1,
    max_size=4,
)


def brute_force(batches):
    versions = []
    for i, batch in enumerate(batches):
        opened = {v[0]: v for v in versions if v[4] is None}
        for k, old in opened.items():
            if k not in batch or batch[k] != (old[1], old[2]):
                old[4] = i
        for k, (v, w) in batch.items():
            if k not in opened or opened[k][4] is not None:
                versions.append([k, v, w, i, None])
    return versions


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(sources)
def test_any_sequence_equals_brute_force(spark, batches):
    current = None
    for i, batch in enumerate(batches):
        current = apply(spark, current, [(k, v, w, "n") for k, (v, w) in batch.items()], i)
        current = spark.createDataFrame(current.collect(), current.schema)
    found = state(current)
    expected = [(k, v, w, "n", f, t) for k, v, w, f, t in brute_force(batches)]
    assert found == sorted(expected, key=lambda r: [(x is not None, str(x)) for x in r])

    # At most one open version per key, and versions follow each other without overlap.
    for key in {r[0] for r in found}:
        spans = sorted((r[4], r[5]) for r in found if r[0] == key)
        assert sum(end is None for _, end in spans) <= 1
        assert all(a[1] is not None and a[1] <= b[0] for a, b in zip(spans, spans[1:]))

    # The same source at a later moment changes nothing.
    last = [(k, v, w, "n") for k, (v, w) in batches[-1].items()]
    assert state(apply(spark, current, last, 6)) == found
