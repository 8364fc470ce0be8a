"""The registered queries. Each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.functions import casts, keys, structures
from lakeloom.operators import dims, gold, incremental, numbering, profiles, quality, scd2, silver
from lakeloom.plans.flights import flight, flight_raw, slices, table
from lakeloom.plans.medallion import SNAPSHOT_CHECKS, SNAPSHOT_KEY, SNAPSHOT_SCALE, Lake
from lakeloom.schemas import FLIGHT_RAW
from lakeloom.sources import ingest, layout, merging, skipping, tables
from lakeloom.sources.staging import fresh_path, remove, scope, spent, stage

Query = Callable[[SparkSession, str], DataFrame]

# Passengers known before this date form the first load, the others the second.
PASSENGER_CUT = "1995-03-01"

# Snapshots of a sliding window of flights; together the windows hold every flight.
SNAPSHOTS = [
    ("1995-04-01 00:00:00", "travel_date < date '1995-04-01'"),
    (
        "1995-05-01 00:00:00",
        "travel_date >= date '1995-02-01' and travel_date < date '1995-05-01'",
    ),
    ("2002-01-01 00:00:00", "travel_date >= date '1995-05-01'"),
]

# What is looked for in the indexed orders, and the day from which orders come again.
WANTED_CUSTOMERS, WANTED_ORDERS, LATE_ORDERS = [1, 17, 44, 99], 5000, "2001-01-01"

# The class left out of the cost reports; the given tables have no "economy".
LEFT_OUT = "5-LOW"


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as double, for comparison with engines whose averages are double."""
    return df.select(
        *[
            F.col(c).cast("double").alias(c) if dtype.startswith("decimal") else F.col(c)
            for c, dtype in df.dtypes
        ]
    )


# -- bronze and silver ---------------------------------------------------------------------------


def bronze_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = flight_raw(spark, sf_dir)
    return raw.select("*").orderBy(*raw.columns).limit(3)


def silver_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(flight(spark, sf_dir))


def silver_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw flight arrives twice and is kept once."""
    raw = flight_raw(spark, sf_dir)
    delivered = raw.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2)))).drop("delivery")
    return silver.dedupe(delivered)


def lenient_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    return _plain(
        table(spark, sf_dir, "customer").select(
            "c_custkey",
            casts.typed(balance, "int").alias("balance_int"),
            casts.typed(balance, "decimal(10,0)").alias("balance_decimal"),
            casts.typed(balance, "double").alias("balance_double"),
            casts.typed(F.concat(F.lit(" "), balance, F.lit(" ")), "int").alias("padded_int"),
            casts.typed(F.concat(balance, F.lit("x")), "int").alias("bad_int"),
            casts.typed("c_name", "date").alias("bad_date"),
            casts.typed(F.when(F.col("c_acctbal") > 0, "Y").otherwise("f"), "boolean").alias(
                "in_credit"
            ),
        )
    )


def anchored_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the arrivals are a bare time, which belongs to the order's date."""
    day = F.col("o_orderdate").cast("date").cast("string")
    clock = F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":05"))
    text = F.when(F.col("o_orderstatus") == "O", clock).otherwise(F.concat(day, F.lit(" "), clock))
    arrival = casts.arrival_timestamp("arrival", "day")
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", text.alias("arrival"), day.alias("day")).select(
        "o_orderkey", arrival.alias("arrival_time")
    )


def key_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_profile(flight(spark, sf_dir), "itinerary_no")


def key_profile_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and orders profiled by the batches of a year each; distinct values are estimates, so
    what is compared is whether they are within four standard errors of the exact ones."""
    path = fresh_path(spark, "key-sketches")
    orders = table(spark, sf_dir, "orders")
    for name, batch in (("early", orders.where(f"o_orderdate < timestamp '{LATE_ORDERS}'")), ("late", orders.where(f"o_orderdate >= timestamp '{LATE_ORDERS}'"))):
        tables.write_append(profiles.sketch_keys(batch, ["o_custkey", "o_orderkey"], name).drop("batch_id"), path, batch_id=name)
    merged = profiles.merged_profile(tables.read(spark, path))
    exact = quality.key_profile(orders, "o_custkey").withColumn("column", F.lit("o_custkey")).unionByName(
        quality.key_profile(orders, "o_orderkey").withColumn("column", F.lit("o_orderkey"))
    ).select("column", F.col("cnt_dist").alias("exact"))
    close = F.abs(F.col("cnt_dist") - F.col("exact")) <= 4 * profiles.ERROR * F.col("exact")
    return merged.join(exact, "column").select("column", "num_records", "cnt", close.alias("within_error"))


# -- dimensions ----------------------------------------------------------------------------------


def _stored(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Flights written once, for plans that read them more than once, as the silver table is."""
    return stage(flight(spark, sf_dir).select(*columns), "flight")


def dim_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_airport(flight(spark, sf_dir))


def dim_airport_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_airport(flight(spark, sf_dir), how="union")


_ROLE_COLUMNS = ["flight_id", "ticket_no", "aircraft_id", "origin_airport", "destination_airport"]


def airport_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _stored(spark, sf_dir, *_ROLE_COLUMNS)
    return dims.with_airport_ids(flights, stage(dims.dim_airport(flights), "airport"))


def airport_roles_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both roles of a dimension that is kept in memory before its first use and let go after."""
    flights = _stored(spark, sf_dir, *_ROLE_COLUMNS)
    airports = layout.keep(dims.dim_airport(flights))
    try:
        airports.count()
        joined = dims.with_airport_ids(flights, airports)
        return stage(joined.select(*_ROLE_COLUMNS, "origin_airport_id", "destination_airport_id"), "roles")
    finally:
        airports.unpersist(blocking=True)


def dim_aircraft_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    flights = _stored(
        spark,
        sf_dir,
        "aircraft_id",
        "flight_cost",
        "origin_airport",
        "destination_airport",
        "airplane_model",
        "distance",
        "fuel_consumed_litre",
        "engine_performance",
    )
    return dims.dim_aircraft_static(flights, stage(dims.dim_airport(flights), "airport"))


def home_airport(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.home_airport(flight(spark, sf_dir))


def home_airport_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.home_airport(flight(spark, sf_dir), how="union")


def home_airport_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.home_airport(flight(spark, sf_dir), how="union_all")


def home_airport_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.home_airport(flight(spark, sf_dir), combine="sum")


def dim_aircraft_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(dims.dim_aircraft_profile(flight(spark, sf_dir)))


def dim_aircraft_profile_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(dims.dim_aircraft_profile(flight(spark, sf_dir), one_pass=False))


def surrogate_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    priority = F.nullif(F.col("o_orderpriority"), F.lit(LEFT_OUT))
    return orders.select(
        "o_orderkey", keys.surrogate_key("o_orderstatus", priority, "o_custkey").alias("order_key")
    )


# -- loads by key --------------------------------------------------------------------------------


def dim_passenger_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_passenger(flight(spark, sf_dir))


def _passenger_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The flights before and after the cut."""
    columns = [*dims.PASSENGER_COLUMNS, "travel_date"]
    flights = _stored(spark, sf_dir, *columns)
    return (
        flights.where(f"travel_date < date '{PASSENGER_CUT}'"),
        flights.where(f"travel_date >= date '{PASSENGER_CUT}'"),
    )


def dim_passenger_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = _passenger_batches(spark, sf_dir)
    return incremental.insert_new(
        dims.dim_passenger(first), dims.dim_passenger(second), "passenger_key"
    )


def passenger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per passenger with the greatest class; later flights replace earlier ones."""

    def one_row(flights: DataFrame) -> DataFrame:
        # Distinct by hash first: the greatest text is found by sorting, then over few rows.
        seen = flights.select(*dims.PASSENGER_KEY, "passenger_flight_class").distinct()
        grouped = seen.groupBy(*dims.PASSENGER_KEY).agg(
            F.max("passenger_flight_class").alias("passenger_flight_class")
        )
        return grouped.select(
            keys.surrogate_key(*dims.PASSENGER_KEY).alias("passenger_key"), *grouped.columns
        )

    first, second = _passenger_batches(spark, sf_dir)
    return incremental.upsert(one_row(first), one_row(second), "passenger_key")


def aircraft_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots in a row; the table is written after each, as in separate runs."""
    path = fresh_path(spark, "flight")
    columns = [
        "aircraft_id",
        "airplane_model",
        "origin_airport",
        "destination_airport",
        "travel_date",
        "flight_cost",
        "distance",
        "fuel_consumed_litre",
        "avg_flight_speed_kmps",
        "engine_performance",
    ]
    # By month, so that a window of dates reads its months only; a month with most flights is split.
    month = F.trunc("travel_date", "month").alias("travel_month")
    dated = flight(spark, sf_dir).select(*columns, month)
    dated.hint("rebalance", "travel_month").write.partitionBy("travel_month").parquet(path)
    flights = spark.read.schema(dated.schema).parquet(path)
    state = None
    for as_of, window in SNAPSHOTS:
        months = window.replace("travel_date >= ", "travel_month >= ").replace("travel_date < ", "travel_month < ")
        taken = flights.where(window).where(months).drop("travel_month")
        profile = dims.dim_aircraft_profile(taken, SNAPSHOT_SCALE, one_pass=False)
        state = scd2.apply_snapshot(state, profile, SNAPSHOT_KEY, SNAPSHOT_CHECKS, as_of)
        if as_of != SNAPSHOTS[-1][0]:
            state = stage(state, "snapshot")
    return _plain(state)


def snapshot_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose key is lost, as a snapshot by that key sets them aside."""
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    customers = table(spark, sf_dir, "customer").withColumn("c_mktsegment", segment)
    return scd2.quarantine(customers, "c_mktsegment")


def snapshot_first_of_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first snapshot by customer, where the dearest of a customer's orders counts."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return scd2.apply_snapshot(
        None,
        orders,
        "o_custkey",
        ["o_totalprice"],
        SNAPSHOTS[0][0],
        on_duplicate="first",
        order=[F.desc("o_totalprice"), F.col("o_orderkey")],
    )


# -- gold ----------------------------------------------------------------------------------------


def gold_cost_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.cost_by_aircraft_class(flight(spark, sf_dir), LEFT_OUT))


def gold_top_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(gold.top_cost(flight(spark, sf_dir), 5, LEFT_OUT))


def flight_classes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct classes in SQL over a session view."""
    view = f"flight_{uuid.uuid4().hex}"
    tables.as_view(flight(spark, sf_dir), view)
    classes = spark.sql(f"select distinct passenger_flight_class from {view}")
    spark.catalog.dropTempView(view)
    return classes


# -- windows -------------------------------------------------------------------------------------


def nth_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.nth_row(
        table(spark, sf_dir, "orders"), F.struct("o_totalprice", "o_orderkey"), 4
    )


def nth_row_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.nth_row(
        table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 5000
    )


def nth_row_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.nth_row(
        table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 4, ["o_custkey"]
    )


def nth_row_deep_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbering.nth_row(
        table(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 2000, ["o_orderpriority"]
    )


# -- quality -------------------------------------------------------------------------------------


def not_null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flights of one class lose it and are found."""
    gone = F.nullif(F.col("passenger_flight_class"), F.lit(LEFT_OUT))
    raw = flight_raw(spark, sf_dir).withColumn("passenger_flight_class", gone)
    return quality.null_violations(raw)


def file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every file of line items."""
    stats = quality.file_stats(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity", "l_returnflag", "l_shipdate"]
    )
    name = F.regexp_extract("file_path", "[^/]*$", 0).alias("file_name")
    return stats.select(name, *[c for c in stats.columns if c != "file_path"])


def log_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics kept as JSON text in a log of JSON lines, of every file of the log.

    The fourth line in order is the first file, since three lines of other kinds come before.
    """
    stats = quality.file_stats(table(spark, sf_dir, "lineitem"), ["l_orderkey"])
    added = stats.select(
        F.struct(
            F.regexp_extract("file_path", "[^/]*$", 0).alias("path"),
            F.to_json(
                F.struct(
                    F.col("num_records").alias("numRecords"),
                    F.struct(F.col("min_l_orderkey").alias("l_orderkey")).alias("minValues"),
                    F.struct(F.col("max_l_orderkey").alias("l_orderkey")).alias("maxValues"),
                    F.struct(F.col("nulls_l_orderkey").alias("l_orderkey")).alias("nullCount"),
                )
            ).alias("stats"),
        ).alias("add")
    )
    other = spark.range(3).select(F.col("id").alias("line"))
    path = fresh_path(spark, "log")
    added.unionByName(other, allowMissingColumns=True).write.json(path)

    schema = (
        "numRecords bigint, minValues struct<l_orderkey: bigint>, "
        "maxValues struct<l_orderkey: bigint>, nullCount struct<l_orderkey: bigint>"
    )
    log = ingest.read_json(spark, path)
    parsed = log.where("add is not null").select(
        F.col("add.path").alias("path"), structures.parse_json("add.stats", schema).alias("stats")
    )
    summed = parsed.agg(
        F.sum("stats.numRecords").alias("num_records"),
        F.min("stats.minValues.l_orderkey").alias("min_orderkey"),
        F.max("stats.maxValues.l_orderkey").alias("max_orderkey"),
        F.sum("stats.nullCount.l_orderkey").alias("null_orderkey"),
        F.min("path").alias("first"),
    )
    fourth = numbering.nth_row(log, "add", 4).select(F.col("add.path").alias("fourth"))
    # One row each, brought into one by an aggregate.
    both = summed.unionByName(fourth, allowMissingColumns=True)
    return both.agg(
        *[F.max(c).alias(c) for c in ("num_records", "min_orderkey", "max_orderkey", "null_orderkey")],
        (F.max("first") == F.max("fourth")).alias("fourth_line_is_first_file"),
    )


def _ranged_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Orders stored in files by ranges of their key."""
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    files = layout.partitions_for(layout.estimated_bytes(orders), floor=16)
    orders.repartitionByRange(files, "o_orderkey").write.parquet(path)
    return orders, path


def skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of some customers and dates, from the files that may hold some by their index."""
    _, path = _ranged_orders(spark, sf_dir)
    skipping.index_files(spark, path, ["o_orderkey", "o_orderdate"], bloom=["o_custkey"])
    wanted = {"o_custkey": WANTED_CUSTOMERS, "o_orderkey": (None, WANTED_ORDERS)}
    return tables.read(spark, path, where=wanted)


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = structures.parse_json("props", "k int")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"))


# -- sources and sinks ---------------------------------------------------------------------------


def _flight_csv(spark: SparkSession, sf_dir: str) -> str:
    """The folder of all raw flights as CSV, written slice by slice: the joins of one are spent before the next."""
    path = fresh_path(spark, "csv")
    for part in slices(spark, sf_dir):
        ingest.write_raw_csv(flight_raw(spark, sf_dir, part), path, mode="append")
    return path


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _flight_csv(spark, sf_dir)
    return ingest.read_raw_csv(spark, path, FLIGHT_RAW)


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    path = fresh_path(spark, "json")
    # The default text of a timestamp stops at milliseconds.
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    events.write.options(timestampFormat=micros, timestampNTZFormat=micros).json(path)
    return ingest.read_json(spark, path, events.schema)


def _damaged_lines(spark: SparkSession, sf_dir: str) -> str:
    """Orders as lines of CSV, some too short, too long, or with a quotation mark that is not closed."""
    path = fresh_path(spark, "lines")
    kind = F.col("o_orderkey") % 10
    line = F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        F.when(kind == 1, F.lit('"open')).when(kind == 2, F.lit('"a,b"')).otherwise(F.col("o_orderstatus")),
        F.when(kind != 3, F.col("o_custkey").cast("string")),
        F.when(kind == 4, F.lit("extra")),
    )
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return path


_LINE_SCHEMA = "o_orderkey string, o_orderstatus string, o_custkey string"


def csv_good_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ingest.read_raw_csv(spark, _damaged_lines(spark, sf_dir), _LINE_SCHEMA, line="_line")
    return ingest.good_lines(lines, "_line")


def csv_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that do not fit, kept whole with the reason."""
    lines = ingest.read_raw_csv(spark, _damaged_lines(spark, sf_dir), _LINE_SCHEMA, line="_line")
    return ingest.bad_lines(lines, "_line").drop("file_path")


def variant_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties of events of which some hold a number as text and some another field, read in one scan."""
    path = fresh_path(spark, "variants")
    kind, value = F.col("event_id") % 3, F.get_json_object("props", "$.k")
    props = (
        F.when(kind == 0, F.col("props")).when(kind == 1, F.concat(F.lit('{"k": "k'), value, F.lit('"}')))
        .otherwise(F.concat(F.lit('{"other": {"k": '), value, F.lit(".5}}")))
    )
    line = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', "props": '), props, F.lit("}"))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    fields = {"$.event_id": "bigint", "$.props.k": "string", "$.props.other.k": "double"}
    read = ingest.read_variant(spark, path, "event").select(ingest.variant_fields("event", fields).alias("f"))
    number = F.col("f.props_k").try_cast("int")
    return read.select("f.event_id", F.col("f.props_k").alias("k"), number.alias("k_number"), F.col("f.props_other_k").alias("other_k"))


def path_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read(spark, f"{sf_dir}/orders.parquet")


def path_scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_sql(spark, f"{sf_dir}/orders.parquet")


def _dropped(spark: SparkSession, name: str) -> DataFrame:
    """The rows of an external table, whose catalog entry goes."""
    rows = tables.read(spark, name)
    spark.sql(f"drop table {name}")
    return rows


def catalog_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing an external table twice leaves one copy."""
    name = f"lakeloom_{uuid.uuid4().hex}"
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    tables.write_overwrite(orders, name, path)
    tables.write_overwrite(orders, name, path)
    return _dropped(spark, name)


def _by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a code that looks like a number and is none; some have none."""
    code = F.lpad((F.col("o_custkey") % 40).cast("string"), 3, "0")
    return table(spark, sf_dir, "orders").withColumn("code", F.when(F.col("o_custkey") % 40 != 7, code))


def partitioned_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed table partitioned by code, overwritten twice, the second time from itself."""
    name, kept = f"lakeloom_{uuid.uuid4().hex}", fresh_path(spark, "orders")
    orders = _by_code(spark, sf_dir)
    tables.write_overwrite(orders, name, partition_by=["code"])
    doubled = tables.read(spark, name).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    tables.write_overwrite(doubled, name, partition_by=["code"])
    copy = _copied(spark, tables.read(spark, name), kept)
    spark.sql(f"drop table {name}")
    return copy


def partitioned_overwrite_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as an external table of CSV files, whose codes and types come from the catalog."""
    name, kept = f"lakeloom_{uuid.uuid4().hex}", fresh_path(spark, "orders")
    path = fresh_path(spark, "orders-csv")
    orders = _by_code(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "code")
    for _ in range(2):
        tables.write_overwrite(orders, name, path, "csv", ["code"])
    copy = _copied(spark, tables.read(spark, name), kept)
    spark.sql(f"drop table {name}")
    return copy


def merged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late orders come again with another state and price, and new ones follow; files of older orders
    are not written again."""
    orders, path = _ranged_orders(spark, sf_dir)
    again = orders.where(F.col("o_orderdate") >= F.lit(LATE_ORDERS).cast("timestamp")).select(
        *[F.lit("X").alias(c) if c == "o_orderstatus" else (F.col(c) + 1).alias(c) if c == "o_totalprice" else c for c in orders.columns]
    )
    new = again.withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    skipping.index_files(spark, path, ["o_orderkey"])
    merging.merge_files(path, again.unionByName(new), "o_orderkey")
    return tables.read(spark, path)


def table_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced by a result over its own content."""
    name = f"lakeloom_{uuid.uuid4().hex}"
    root = fresh_path(spark, "orders")
    tables.swap(table(spark, sf_dir, "orders"), name, root)
    priced = tables.read(spark, name).withColumn("o_totalprice", F.col("o_totalprice") * 2)
    tables.swap(priced, name, root)
    return _dropped(spark, name)


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plain append run twice holds every row twice."""
    path = fresh_path(spark, "orders")
    for _ in range(2):
        tables.write_append(table(spark, sf_dir, "orders"), path)
    return tables.read(spark, path)


def append_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run twice counts once."""
    path = fresh_path(spark, "orders")
    orders = table(spark, sf_dir, "orders")
    for _ in range(2):
        tables.write_append(orders, path, batch_id="first")
    return tables.read(spark, path).select(*orders.columns)


def sized_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return stage(layout.sized_repartition(lineitem), "lineitem")


def compacted_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return stage(layout.compact(lineitem, 2), "lineitem")


# -- the whole lake ------------------------------------------------------------------------------


@contextmanager
def _lake(spark: SparkSession, sf_dir: str) -> Iterator[Lake]:
    """A new lake with every flight taken in from CSV as one batch; it is gone afterwards."""
    with scope(spark), spent(spark):
        path = _flight_csv(spark, sf_dir)
        lake = Lake(spark, fresh_path(spark, "lake"), f"lakeloom_{uuid.uuid4().hex}")
        lake.create()
        try:
            lake.ingest(path)
            remove(spark, path)
            lake.refine("first")
            yield lake
        finally:
            spark.sql(f"drop database if exists {lake.database} cascade")


def _copied(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """A copy of rows that outlives the lake."""
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lake_top_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fresh_path(spark, "top-cost")
    with _lake(spark, sf_dir) as lake:
        return _copied(spark, _plain(lake.top_cost(5, LEFT_OUT)), kept)


def lake_aircraft(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = fresh_path(spark, "aircraft")
    with _lake(spark, sf_dir) as lake:
        lake.build_airports()
        lake.build_aircraft()
        return _copied(spark, lake.table("dim_aircraft"), kept)


def lake_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load, of the one batch, finds nothing new."""
    kept = fresh_path(spark, "passengers")
    with _lake(spark, sf_dir) as lake:
        lake.load_passengers()
        lake.load_passengers("first")
        return _copied(spark, lake.table("dim_passenger"), kept)


def lake_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second snapshot finds nothing changed."""
    kept = fresh_path(spark, "snapshot")
    with _lake(spark, sf_dir) as lake:
        for as_of, _ in SNAPSHOTS[:2]:
            lake.snapshot_aircraft(as_of)
        return _copied(spark, _plain(lake.table("scd_dim_aircraft")), kept)


def lake_snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three snapshots of changing flights, published one after the other."""
    kept = fresh_path(spark, "snapshot")
    with _lake(spark, sf_dir) as lake:
        for as_of, window in SNAPSHOTS:
            lake.snapshot_aircraft(as_of, flights=lake.flights().where(window))
        return _copied(spark, _plain(lake.table("scd_dim_aircraft")), kept)


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        bronze_head,
        silver_conform,
        silver_dedupe,
        lenient_casts,
        anchored_arrivals,
        key_profile,
        key_profile_batches,
        dim_airport,
        dim_airport_union,
        airport_roles,
        airport_roles_kept,
        dim_aircraft_static,
        home_airport,
        home_airport_union,
        home_airport_union_all,
        home_airport_sum,
        dim_aircraft_profile,
        dim_aircraft_profile_join,
        surrogate_key_nulls,
        dim_passenger_initial,
        dim_passenger_increment,
        passenger_upsert,
        aircraft_scd2,
        snapshot_quarantine,
        snapshot_first_of_duplicates,
        gold_cost_by_class,
        gold_top_cost,
        flight_classes_view,
        nth_row,
        nth_row_deep,
        nth_row_per_group,
        nth_row_deep_per_group,
        not_null_violations,
        file_stats,
        log_file_stats,
        json_props,
        csv_roundtrip,
        csv_good_lines,
        csv_bad_lines,
        json_roundtrip,
        variant_props,
        path_scan,
        path_scan_sql,
        catalog_overwrite,
        partitioned_overwrite,
        partitioned_overwrite_csv,
        merged_files,
        skipped_files,
        table_swap,
        append_batches,
        append_idempotent,
        sized_repartition,
        compacted_write,
        lake_top_cost,
        lake_aircraft,
        lake_passengers,
        lake_snapshot,
        lake_snapshot_changes,
    )
}
