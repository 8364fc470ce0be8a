from __future__ import annotations

import hashlib
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeloom.operators import dims, gold

FLIGHT = (
    "aircraft_id string, airplane_model string, origin_airport string, destination_airport string, "
    "flight_cost decimal(10,0), distance int, fuel_consumed_litre float, "
    "avg_flight_speed_kmps double, engine_performance int, passenger_flight_class string"
)


def flights(spark, *data):
    return spark.createDataFrame(
        [
            (craft, model, here, there, Decimal(cost), 10, 1.5, 700.0, cost, cls)
            for craft, model, here, there, cost, cls in data
        ],
        FLIGHT,
    )


@pytest.fixture(scope="module")
def sample(spark):
    return flights(
        spark,
        ("1", "m", "AAA", "BBB", 1, "economy"),
        ("1", "m", "AAA", "BBB", 2, "first"),
        ("1", "n", "CCC", "BBB", 4, "first"),
        ("2", "m", "BBB", "AAA", 5, None),
        ("3", "m", None, None, 5, "business"),
        (None, "m", "AAA", "BBB", 9, "first"),
        ("4", "m", "ZZZ", None, 5, "first"),
    )


def test_airports(spark, sample):
    expected = [(None,), ("AAA",), ("BBB",), ("CCC",), ("ZZZ",)]
    for how in ("stack", "union", "union_all"):
        assert rows(dims.airports(sample, how)) == expected
    assert rows(dims.dim_airport(sample)) == [
        (1, None),
        (2, "AAA"),
        (3, "BBB"),
        (4, "CCC"),
        (5, "ZZZ"),
    ]


def test_home_airport_is_the_same_in_every_form(spark, sample):
    expected = [(None, "BBB"), ("1", "BBB"), ("2", "BBB"), ("3", None), ("4", "ZZZ")]
    for how in ("stack", "union", "union_all"):
        assert rows(dims.home_airport(sample, how)) == expected


legs = st.lists(
    st.tuples(
        st.sampled_from(["1", "2", None]),
        st.sampled_from(["A", "B", "C", None]),
        st.sampled_from(["A", "B", "C", None]),
    ),
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(legs)
def test_home_airport_equals_brute_force(spark, data):
    df = flights(spark, *[(craft, "m", here, there, 1, "x") for craft, here, there in data])

    def best(counts):
        return max(counts.items(), key=lambda c: (c[1], c[0][-1] is not None, c[0][-1] or ""))[0][-1]

    for combine in ("max", "sum"):
        expected = []
        for craft in {leg[0] for leg in data}:
            counts = Counter()
            for _, here, there in (leg for leg in data if leg[0] == craft):
                for side, airport in (("o", here), ("d", there)):
                    counts[(side, airport) if combine == "max" else (airport,)] += 1
            expected.append((craft, best(counts)))
        for how in ("stack", "union", "union_all"):
            assert sorted(map(str, rows(dims.home_airport(df, how, combine)))) == sorted(
                map(str, expected)
            )
    homes = {r["aircraft_id"]: r["airport"] for r in dims.home_airport(df).collect()}
    profile = dims.dim_aircraft_profile(df)
    assert {r["aircraft_id"]: r["airport"] for r in profile.collect()} == {
        craft: airport for craft, airport in homes.items() if craft is not None
    }
    assert rows(profile) == rows(dims.dim_aircraft_profile(df, one_pass=False))


def test_home_airport_compares_sides_or_adds_them_up(spark):
    df = flights(
        spark,
        ("1", "m", "AAA", "BBB", 1, "x"),
        ("1", "m", "AAA", "CCC", 1, "x"),
        ("1", "m", "CCC", "DDD", 1, "x"),
        ("1", "m", "DDD", "CCC", 1, "x"),
    )
    # Per side: AAA 2 and CCC 2 as destination; together: CCC 3.
    assert rows(dims.home_airport(df)) == [("1", "CCC")]
    df = flights(
        spark,
        ("1", "m", "ZZZ", "BBB", 1, "x"),
        ("1", "m", "ZZZ", "AAA", 1, "x"),
        ("1", "m", "AAA", "CCC", 1, "x"),
        ("1", "m", "AAA", "DDD", 1, "x"),
    )
    assert rows(dims.home_airport(df)) == [("1", "ZZZ")]
    for how in ("stack", "union", "union_all"):
        assert rows(dims.home_airport(df, how, combine="sum")) == [("1", "AAA")]


def test_profile_equals_the_join_of_its_parts(spark, sample):
    joined = dims.dim_aircraft_profile(sample, one_pass=False)
    profile = dims.dim_aircraft_profile(sample)
    assert profile.dtypes == joined.dtypes
    assert dict(profile.dtypes)["avg_flight_cost"] == "decimal(14,4)"
    assert dict(profile.dtypes)["total_distance"] == "bigint"
    assert rows(profile) == rows(joined)
    assert [r[:4] for r in rows(profile)] == [
        ("1", "BBB", "m", Decimal("1.5000")),
        ("1", "BBB", "n", Decimal("4.0000")),
        ("2", "BBB", "m", Decimal("5.0000")),
        ("3", None, "m", Decimal("5.0000")),
        ("4", "ZZZ", "m", Decimal("5.0000")),
    ]


def test_flights_without_known_airports_drop_out_of_the_roles(spark, sample):
    airports = dims.dim_airport(sample)
    both = dims.with_airport_ids(sample, airports)
    assert both.count() == 5
    assert both.columns[-2:] == ["origin_airport_id", "destination_airport_id"]
    assert rows(both) == rows(dims.with_airport_ids(sample, airports, limit_mb=0))


def test_static_aircraft(spark, sample):
    static = dims.dim_aircraft_static(sample, dims.dim_airport(sample))
    assert rows(static.select("aircraft_id", "airplane_model", "avg_cost", "id"))[1:] == [
        ("1", "m", 1, 2),
        ("1", "n", 4, 3),
        ("2", "m", 5, 4),
    ]


def test_passenger_key_leaves_the_class_out(spark):
    df = spark.sql(
        "select 'n' passenger_name, 'c' passenger_country, date '2000-01-02' passenger_dob, "
        "explode(array('a', 'b', 'a')) passenger_flight_class"
    )
    found = dims.dim_passenger(df).collect()
    key = hashlib.md5(b"n-c-2000-01-02").hexdigest()
    assert sorted((r.passenger_key, r.passenger_flight_class) for r in found) == [
        (key, "a"),
        (key, "b"),
    ]


def test_gold_leaves_out_a_class_and_the_missing_one(spark, sample):
    report = gold.cost_by_aircraft_class(sample).collect()
    assert [(r.aircraft_id, r.passenger_flight_class) for r in report] == [
        (None, "first"),
        ("3", "business"),
        ("4", "first"),
        ("1", "first"),
    ]
    assert gold.class_costs(sample, None).count() == 6
    assert rows(gold.flight_classes(sample)) == [(None,), ("business",), ("economy",), ("first",)]


def test_top_cost_decides_ties_by_key(spark):
    data = [(str(i), "m", "A", "B", 9 if i < 4 else 7, "first") for i in range(8)]
    for order in (data, data[::-1]):
        top = gold.top_cost(flights(spark, *order), 5).collect()
        assert [r.aircraft_id for r in top] == ["0", "1", "2", "3", "4"]


def test_exact_mean_leaves_nothing_out(spark):
    from lakeloom.functions.structures import exact_mean

    def mean(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(exact_mean("v", 10).alias("ours"), F.avg("v").alias("avg")).first()

    nan, inf = float("nan"), float("inf")
    for values in ((nan, 2.0), (inf, 1.0), (1e20, 1.0), (-1e25,), (1e14, 1e14)):
        found = mean(*values)
        assert str(found.ours) == str(found.avg)
    assert mean(3e-7, 5e-7).ours == pytest.approx(4e-7, rel=1e-3)
    assert mean(None).ours is None
