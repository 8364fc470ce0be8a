"""Flight records over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeloom.operators.silver import conform
from lakeloom.schemas import FLIGHT_RAW_COLUMNS
from lakeloom.sources import layout
from lakeloom.sources.staging import file_system

#: The flights are written in slices by order, each of so many MB of line items, at most so many. More
#: of them would leave less on disk at a time, but each reads all line items.
SLICE_MB, MOST_SLICES = 512, 8


# Schemas by path and what the file system says of it: finding one out takes a job, and every query
# reads the same few tables.
_schemas: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    files, where = file_system(spark, path)
    status = files.getFileStatus(where)
    key = (path, status.getModificationTime(), status.getLen())
    if key not in _schemas:
        _schemas[key] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def slices(spark: SparkSession, sf_dir: str) -> list[tuple[int, int]]:
    """The parts for :func:`flight_raw` which together hold every flight once."""
    size = layout.estimated_bytes(table(spark, sf_dir, "lineitem"))
    count = layout.partitions_for(size, SLICE_MB, 1)
    count = min(count, MOST_SLICES)
    return [(nth, count) for nth in range(count)]


def flight_raw(spark: SparkSession, sf_dir: str, part: tuple[int, int] | None = None) -> DataFrame:
    """Raw flights, all text: a line item is a flight, its part the aircraft, its customer the
    passenger, and the nations of supplier and customer the airports.

    ``part`` (nth, count) gives the flights of one of ``count`` slices of the orders, by their hash.

    Line items meet parts and suppliers while they are narrow and the orders with their customers last, so
    the flights of an order lie together. The last join is sort-merge by hint: both sides grow with the
    data, so neither is ever broadcast. Suppliers are, where they are within the limit.
    """
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    if part is not None and part[1] > 1:
        of_part = lambda key: F.pmod(F.xxhash64(key), F.lit(part[1])) == part[0]
        items, orders = items.where(of_part("l_orderkey")), orders.where(of_part("o_orderkey"))
    nations = table(spark, sf_dir, "nation")
    home = nations.selectExpr("n_nationkey as c_nationkey", "n_name as c_nation")
    base = nations.selectExpr("n_nationkey as s_nationkey", "n_name as s_nation")

    passengers = table(spark, sf_dir, "customer").join(home, "c_nationkey")
    bookings = orders.join(passengers, F.col("o_custkey") == F.col("c_custkey"))
    carriers = layout.broadcast_within(table(spark, sf_dir, "supplier"))
    legs = (
        items.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(carriers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(base, "s_nationkey")
        .join(bookings.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .selectExpr(
            "*",
            "cast(l_shipdate as date) as ship_date",
            "(l_orderkey * 97 + l_linenumber * 61) % 86400 as sec",
        )
        .selectExpr(
            "*",
            "lpad(cast(cast(floor(sec / 3600) as int) as string), 2, '0') as hh",
            "lpad(cast(cast(floor(sec / 60) as int) % 60 as string), 2, '0') as mm",
            "lpad(cast(sec % 60 as string), 2, '0') as ss",
        )
    )
    text = {
        "departure_time": "concat(hh, ':', mm, ':', ss)",
        "arrival_time": "concat(cast(ship_date as string), ' ', hh, ':00:00')",
        "flight_id": "concat(cast(l_orderkey as string), '-', cast(l_linenumber as string))",
        "aircraft_id": "cast(l_partkey as string)",
        "itinerary_no": "cast(l_orderkey as string)",
        "ticket_no": "concat(cast(l_orderkey as string), '/', cast(l_suppkey as string))",
        "flight_cost": "cast(cast(l_extendedprice as decimal(12,2)) as string)",
        "origin_airport": "s_nation",
        "destination_airport": "c_nation",
        "frequent_flier": "if(c_acctbal > 0, 'true', 'false')",
        "travel_date": "cast(ship_date as string)",
        "airplane_model": "p_brand",
        "frequent_flier_no": "concat('FF', cast(c_custkey as string))",
        "passenger_name": "c_name",
        "passenger_country": "c_nation",
        "tail_no": "concat('N', cast(l_partkey as string))",
        "distance": "cast(cast(l_quantity as int) as string)",
        "turbulance": "cast(l_linenumber as string)",
        "temp_at_dept": "cast(cast(l_tax * 100 as int) as string)",
        "fuel_consumed_litre": "cast(cast(l_quantity as int) * 3 as string)",
        "taxi_duration_mins": "cast(l_linenumber * 5 as string)",
        "avg_flight_speed_kmps": "cast(cast(l_discount * 100 as int) + 700 as string)",
        "engine_performance": "cast(l_linenumber as string)",
        "passenger_dob": "cast(date '1950-01-01' + cast(c_custkey % 18000 as int) as string)",
        "passenger_flight_class": "o_orderpriority",
    }
    return legs.selectExpr(*[f"{text[name]} as {name}" for name in FLIGHT_RAW_COLUMNS])


def flight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flights, derived on the fly."""
    return conform(flight_raw(spark, sf_dir))
