from __future__ import annotations

import datetime as dt
from decimal import Decimal

from lakeloom.operators import silver
from lakeloom.schemas import FLIGHT_RAW, FLIGHT_RAW_COLUMNS, FLIGHT_SILVER_TYPES

FLIGHT = {
    "departure_time": "09:05:07",
    "arrival_time": "11:30",
    "flight_id": "F1",
    "aircraft_id": "A1",
    "itinerary_no": "12.7",
    "ticket_no": "T1",
    "flight_cost": "99.5",
    "origin_airport": "AAA",
    "destination_airport": "BBB",
    "frequent_flier": "True",
    "travel_date": "2020-1-2",
    "airplane_model": "M",
    "frequent_flier_no": "FF1",
    "passenger_name": "Name",
    "passenger_country": "Land",
    "tail_no": "N1",
    "distance": "100",
    "turbulance": "x",
    "temp_at_dept": "1.5",
    "fuel_consumed_litre": "2.5",
    "taxi_duration_mins": "",
    "avg_flight_speed_kmps": "700.25",
    "engine_performance": "3",
    "passenger_dob": "1980-12-31",
    "passenger_flight_class": "economy",
}


def raw(spark, *changes):
    data = [tuple({**FLIGHT, **c}[name] for name in FLIGHT_RAW_COLUMNS) for c in changes]
    return spark.createDataFrame(data, FLIGHT_RAW)


def test_conform_types_every_column(spark):
    typed = silver.conform(raw(spark, {}))
    types = dict(typed.dtypes)
    assert typed.columns == [*FLIGHT_RAW_COLUMNS, "departure_seconds", "uuid"]
    for name in FLIGHT_RAW_COLUMNS:
        assert types[name] == FLIGHT_SILVER_TYPES.get(name, "string"), name
    assert types["departure_seconds"] == "int"

    row = typed.first()
    assert row.departure_time == "09:05:07"
    assert row.departure_seconds == 32707
    assert row.arrival_time == dt.datetime(2020, 1, 2, 11, 30)
    assert row.itinerary_no == 12
    assert row.flight_cost == Decimal(100)
    assert row.frequent_flier is True
    assert row.travel_date == dt.date(2020, 1, 2)
    assert row.turbulance is None
    assert row.taxi_duration_mins is None
    assert row.avg_flight_speed_kmps == 700.25


def test_ids_are_stable_or_random(spark):
    one = raw(spark, {})
    assert silver.conform(one).first().uuid == silver.conform(one).first().uuid
    assert silver.conform(one, True).first().uuid != silver.conform(one, True).first().uuid


def test_dedupe_keeps_rows_that_differ_in_a_null(spark):
    copies = raw(spark, {}, {}, {"tail_no": None}, {"tail_no": None})
    assert silver.dedupe(copies).count() == 2


def test_dedupe_packs_rows_of_text_whatever_they_hold(spark):
    odd = [None, "", "\x01", "\x02", "a\x01b", "\x02\x01", "\x01\x02", "a", "ä€", "\\", "|", "."]
    pairs = [(a, b, c) for a in odd for b in odd for c in (None, "x", "")]
    df = spark.createDataFrame([p for p in pairs for _ in range(2)], "a string, b string, `c.d` string")
    seen = silver.dedupe(df)
    assert seen.schema == df.schema
    assert sorted(map(repr, map(tuple, seen.collect()))) == sorted(map(repr, pairs))
    # One text and its exception are what is shuffled.
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(packed" in plan

    bytes_ = spark.sql("select cast(x as string) a from values (X'C328'), (X'C328'), (X'FF'), (X'FE') t(x)")
    assert sorted(r.h for r in silver.dedupe(bytes_).selectExpr("hex(a) h").collect()) == ["C328", "FE", "FF"]
    mixed = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a")], "k int, s string")
    assert silver.dedupe(mixed).count() == 2


def test_dedupe_of_a_stored_table_shuffles_what_has_copies(spark, tmp_path):
    rows = [{"flight_id": f"F{n}", "tail_no": None if n % 7 == 0 else "N1"} for n in range(300)]
    stored = str(tmp_path / "raw")
    raw(spark, *rows, *rows[:20], *rows[:5]).write.parquet(stored)
    table = spark.read.parquet(stored)
    exact = sorted(map(str, silver.dedupe(table).collect()))
    seen = silver.dedupe_stored(table)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "LeftSemi" in plan
    # Only the copies meet the exchange, so the branch of the others has none.
    assert "Exchange" not in plan[plan.index("Union"):plan.index("LeftAnti")]
    assert len(exact) == 300 and sorted(map(str, seen.collect())) == exact
    # Beyond the limit every row is compared, with the same result.
    assert sorted(map(str, silver.dedupe_stored(table, limit_mb=0).collect())) == exact
