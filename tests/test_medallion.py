from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from test_silver import FLIGHT

from lakeloom.plans.medallion import Lake
from lakeloom.schemas import FLIGHT_RAW_COLUMNS
from lakeloom.sources import tables
from lakeloom.sources.ledger import Taken


def write(path, *changes):
    lines = [",".join({**FLIGHT, **c}[name] for name in FLIGHT_RAW_COLUMNS) for c in changes]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), f"w{abs(hash(tmp_path))}")
    lake.create()
    return lake


def test_a_lake_from_raw_files_to_gold(spark, tmp_path, lake):
    first = {"passenger_flight_class": "first", "turbulance": "1", "taxi_duration_mins": "2"}
    business = {**first, "passenger_flight_class": "business"}
    one = write(tmp_path / "one.csv", first, first, {**business, "aircraft_id": "A2"})
    lake.ingest(one)
    assert lake.source("raw_flight").count() == 3
    lake.refine("one")
    lake.refine("one")
    assert lake.flights().count() == 2

    lake.build_airports()
    assert rows(lake.table("dim_airport")) == [(1, "AAA"), (2, "BBB")]
    lake.build_aircraft()
    assert rows(lake.table("dim_aircraft").select("aircraft_id", "id")) == [("A1", 1), ("A2", 2)]

    lake.load_passengers()
    lake.load_passengers()
    assert lake.table("dim_passenger").count() == 2

    lake.snapshot_aircraft("2020-01-01 00:00:00")
    lake.snapshot_aircraft("2020-01-02 00:00:00")
    assert lake.table("scd_dim_aircraft").count() == 2

    # A second file changes one aircraft and brings a new passenger.
    two = write(
        tmp_path / "two.csv",
        {**first, "distance": "50", "passenger_name": "Other", "flight_id": "F2"},
    )
    lake.ingest(two)
    lake.refine("two")
    assert lake.flights().count() == 3
    lake.load_passengers()
    assert lake.table("dim_passenger").count() == 3

    for repeat in range(2):
        if repeat:
            with pytest.raises(ValueError, match="later"):
                lake.snapshot_aircraft("2020-01-03 00:00:00")
        else:
            lake.snapshot_aircraft("2020-01-03 00:00:00")
        versions = lake.table("scd_dim_aircraft")
        assert versions.columns[-4:] == [
            "dbt_scd_id",
            "dbt_updated_at",
            "dbt_valid_from",
            "dbt_valid_to",
        ]
        day = [None, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 3)]
        assert sorted(
            (r.aircraft_id, r.total_distance, day.index(r.dbt_valid_from), day.index(r.dbt_valid_to))
            for r in versions.collect()
        ) == [("A1", 100, 1, 2), ("A1", 150, 2, 0), ("A2", 100, 1, 0)]

    assert [r.aircraft_id for r in lake.top_cost().collect()] == ["A1", "A2"]

    # A flight without airports: the snapshot refuses it and the dimension stays as it was.
    no_airports = {"aircraft_id": "A9", "origin_airport": "", "destination_airport": ""}
    lake.ingest(write(tmp_path / "three.csv", {**first, **no_airports}))
    lake.refine("three")
    with pytest.raises(AssertionError, match="airport"):
        lake.snapshot_aircraft("2020-01-04 00:00:00")
    assert lake.table("scd_dim_aircraft").count() == 3
    lake.snapshot_aircraft("2020-01-04 00:00:00", check=False)
    assert lake.table("scd_dim_aircraft").count() == 4


def test_the_job(spark, tmp_path, monkeypatch):
    from lakeloom.plans import medallion

    first = {"passenger_flight_class": "first", "turbulance": "1", "taxi_duration_mins": "2"}
    path = write(tmp_path / "one.csv", first, {**first, "aircraft_id": "A2"})
    args = ["--root", str(tmp_path / "lake"), "--csv", path, "--batch", "one",
            "--as-of", "2020-01-01 00:00:00", "--database", "job"]
    monkeypatch.setattr("sys.argv", ["medallion.py", *args])
    medallion.main()
    assert spark.table("job.flight").count() == 2
    assert spark.table("job.scd_dim_aircraft").count() == 2


def profiles(spark, *rows):
    schema = ("aircraft_id string, airplane_model string, origin_airport string, destination_airport string, "
              "flight_cost decimal(10,0), distance int, fuel_consumed_litre float, avg_flight_speed_kmps double, "
              "engine_performance int")
    return spark.createDataFrame([(a, "M", "AAA", "BBB", Decimal(5), d, 1.0, 2.0, 3) for a, d in rows], schema)


def history(lake):
    rows = lake.table("scd_dim_aircraft").collect()
    return {(r.aircraft_id, r.total_distance, str(r.dbt_valid_from), r.dbt_valid_to and str(r.dbt_valid_to)) for r in rows}


def test_a_moment_is_taken_once_and_history_stays(spark, lake):
    lake.snapshot_aircraft("2020-01-01 00:00:00", flights=profiles(spark, ("A1", 1), ("A2", 1)))
    lake.snapshot_aircraft("2020-01-02 00:00:00", flights=profiles(spark, ("A1", 2), ("A2", 1)))
    before = history(lake)
    for moment in ("2020-01-02 00:00:00", "2019-01-01 00:00:00", "2020-01-01 12:00:00"):
        with pytest.raises(ValueError, match="later"):
            lake.snapshot_aircraft(moment, flights=profiles(spark, ("A1", 2), ("A2", 9)))
    assert history(lake) == before
    zone = dt.timezone(dt.timedelta(hours=5))
    lake.snapshot_aircraft(dt.datetime(2020, 1, 3, 5, 0, 0, 123456, zone), flights=profiles(spark, ("A1", 2), ("A2", 9)))
    assert ("A2", 9, "2020-01-03 00:00:00.123456", None) in history(lake)
    assert len({r.dbt_scd_id for r in lake.table("scd_dim_aircraft").collect()}) == 4


@pytest.mark.parametrize("step", [1, 2, 3])
def test_a_snapshot_that_breaks_off_shows_nothing(spark, lake, monkeypatch, step):
    """The run breaks off before its closed versions, its open ones or the view are written."""
    from pyspark.sql import DataFrameWriter, SparkSession

    lake.snapshot_aircraft("2020-01-01 00:00:00", flights=profiles(spark, ("A1", 1), ("A2", 1)))
    lake.snapshot_aircraft("2020-01-02 00:00:00", flights=profiles(spark, ("A1", 2), ("A2", 1)))
    before = history(lake)
    changed = profiles(spark, ("A1", 2), ("A2", 5))

    with monkeypatch.context() as patch:
        parquet, sql, save = DataFrameWriter.parquet, SparkSession.sql, DataFrameWriter.saveAsTable

        def breaking(self, path, *args, **kwargs):
            if (step == 1 and "/run=" in path) or (step == 2 and "/v-" in path):
                raise RuntimeError("broke off")
            return parquet(self, path, *args, **kwargs)

        def silent(self, text, *args, **kwargs):
            if step == 3 and "create or replace view" in text:
                raise RuntimeError("broke off")
            return sql(self, text, *args, **kwargs)

        # Open versions are written as a table, in buckets.
        def unsaved(self, name, *args, **kwargs):
            if step == 2 and "_open_" in name:
                raise RuntimeError("broke off")
            return save(self, name, *args, **kwargs)

        patch.setattr(DataFrameWriter, "saveAsTable", unsaved)
        patch.setattr(DataFrameWriter, "parquet", breaking)
        patch.setattr(SparkSession, "sql", silent)
        with pytest.raises(RuntimeError, match="broke off"):
            lake.snapshot_aircraft("2020-01-03 00:00:00", flights=changed)
    assert history(lake) == before
    # The next run may take another moment; nothing of the broken one is seen.
    lake.snapshot_aircraft("2020-01-05 00:00:00", flights=profiles(spark, ("A1", 2), ("A2", 7)))
    after = history(lake)
    assert {h for h in before if h[3]} <= after
    assert ("A2", 1, "2020-01-01 00:00:00", "2020-01-05 00:00:00") in after
    assert ("A2", 7, "2020-01-05 00:00:00", None) in after
    assert len(after) == 4


def test_ingest_deals_out_what_cannot_be_split(spark, tmp_path, lake, monkeypatch):
    import gzip

    from lakeloom.sources import layout

    path = tmp_path / "one.csv.gz"
    line = ",".join(FLIGHT[name] for name in FLIGHT_RAW_COLUMNS)
    path.write_bytes(gzip.compress(("\n".join([line] * 100) + "\n").encode()))
    monkeypatch.setattr(layout, "estimated_bytes", lambda df: 2000 << 20)
    lake.ingest(str(path))
    raw = lake.source("raw_flight")
    assert raw.count() == 100
    assert len(raw.inputFiles()) == 10


def test_passengers_of_one_batch_read_its_partition(spark, tmp_path, lake):
    lake.ingest(write(tmp_path / "one.csv", FLIGHT))
    lake.refine("one")
    flights = lake.source("stage_flight").where("batch_id = 'one'")
    plan = flights._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_id" in plan
    lake.load_passengers("other")
    assert lake.table("dim_passenger").count() == 0
    lake.load_passengers("one")
    assert lake.table("dim_passenger").count() == 1


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path, lake):
    path = write(tmp_path / "one.csv", {}, {"flight_id": "F2"})
    with open(path, "a") as file:
        file.write("too,short\n")
    lake.ingest(path, set_aside=True)
    assert lake.source("raw_flight").count() == 2
    assert rows(lake.table("flight_rejected").select("line", "n_fields", "reason")) == [("too,short", 2, "short")]
    lake.ingest(path)
    assert lake.source("raw_flight").count() == 3


def test_one_snapshot_at_a_time(spark, tmp_path, lake, monkeypatch):
    first, second = profiles(spark, ("A1", 1)), profiles(spark, ("A1", 2))
    take = Lake._take_snapshot

    def interrupted(self, *rest):
        # The other writer comes while this one runs.
        with pytest.raises(Taken, match="2020-01-01"):
            lake.snapshot_aircraft("2020-01-02 00:00:00", flights=second)
        return take(self, *rest)

    monkeypatch.setattr(Lake, "_take_snapshot", interrupted)
    lake.snapshot_aircraft("2020-01-01 00:00:00", flights=first)
    monkeypatch.setattr(Lake, "_take_snapshot", take)
    assert lake.table("scd_dim_aircraft").count() == 1
    lake.snapshot_aircraft("2020-01-02 00:00:00", flights=second)
    assert lake.table("scd_dim_aircraft").count() == 2


@pytest.mark.parametrize("kind", ["path", "managed", "external"])
def test_one_writer_of_a_batch(spark, tmp_path, monkeypatch, kind):
    path = str(tmp_path / "data") if kind == "external" else None
    table = str(tmp_path / "t") if kind == "path" else f"alone_{kind}"
    tables.write_append(spark.range(3), table, path, batch_id="a/b")
    held = tables.alone

    def second_comes(session, mark, content):
        monkeypatch.setattr(tables, "alone", held)
        hold = held(session, mark, content)
        hold.__enter__()
        with pytest.raises(Taken):
            tables.write_append(spark.range(100), table, path, batch_id="a/b")
        hold.__exit__(None, None, None)
        return held(session, mark, content)

    monkeypatch.setattr(tables, "alone", second_comes)
    tables.write_append(spark.range(5), table, path, batch_id="a/b")
    assert tables.read(spark, table).count() == 5
    # Another batch is free, and the marks do not show.
    tables.write_append(spark.range(2), table, path, batch_id="c")
    assert tables.read(spark, table).count() == 7


def test_refining_keeps_its_width(spark, tmp_path, lake, monkeypatch):
    path = write(tmp_path / "one.csv", *[{"flight_id": f"F{n}", "aircraft_id": f"A{n}"} for n in range(400)])
    lake.ingest(path)
    seen = []
    append = tables.write_append
    monkeypatch.setattr(tables, "write_append", lambda df, *a, **k: seen.append(df) or append(df, *a, **k))
    lake.refine("one")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    # The write is behind an exchange of its own, which leaves the dedupe at all shuffle partitions.
    assert "REBALANCE_PARTITIONS" in plan and "Coalesce" not in plan
    assert lake.flights().count() == 400


def test_the_raw_files_are_compressed_and_of_bounded_rows(spark, tmp_path):
    import glob
    import gzip

    from lakeloom.schemas import FLIGHT_RAW
    from lakeloom.sources import ingest

    data = [tuple({**FLIGHT, "flight_id": f"F{n}", "tail_no": None, "taxi_duration_mins": "5"}[name] for name in FLIGHT_RAW_COLUMNS) for n in range(95)]
    df = spark.createDataFrame(data, FLIGHT_RAW).coalesce(1)
    path = str(tmp_path / "csv")
    ingest.write_raw_csv(df, path, file_rows=10)
    files = glob.glob(f"{path}/*.csv.gz")
    assert len(files) == 10 and max(len(gzip.open(f).read().splitlines()) for f in files) == 10
    assert rows(ingest.read_raw_csv(spark, path)) == rows(df)


def test_csv_roundtrip_writes_compressed_files(spark):
    from lakeloom.plans.queries import QUERIES

    files = QUERIES["csv_roundtrip"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_ingest_is_as_wide_as_the_cores(spark, tmp_path, lake):
    for n in range(30):
        write(tmp_path / f"{n}.csv", *[{"flight_id": f"F{n}-{i}"} for i in range(5)])
    lake.ingest(str(tmp_path / "*.csv"))
    raw = lake.source("raw_flight")
    assert raw.count() == 150
    assert len(raw.inputFiles()) == 4


def test_a_first_batch_is_not_sorted_by_its_name(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    written = []
    save = DataFrameWriter.saveAsTable
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", lambda self, *a, **k: written.append(self._df) or save(self, *a, **k))
    both = spark.range(5).union(spark.range(5, 9))
    tables.write_append(both, "unsorted", str(tmp_path / "t"), batch_id="b")
    plan = written[0].orderBy("batch_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Sort" not in plan
    assert rows(spark.table("unsorted")) == [(n, "b") for n in range(9)]


def test_the_lake_shuffles_no_flight_without_a_copy(spark, tmp_path, lake, monkeypatch):
    lake.ingest(write(tmp_path / "one.csv", *[{"flight_id": f"F{n}"} for n in range(400)], {"flight_id": "F1"}))
    seen = []
    append = tables.write_append
    monkeypatch.setattr(tables, "write_append", lambda df, *a, **k: seen.append(df) or append(df, *a, **k))
    lake.refine("one")
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[plan.index("Union"):plan.index("LeftAnti")]
    assert all(f.endswith(".zstd.parquet") for f in lake.flights().inputFiles())
    assert lake.flights().count() == 400
    lake.refine("one")
    assert lake.flights().count() == 400
