"""The same results in DuckDB SQL over the same tables."""

from __future__ import annotations

from lakeloom.operators.dims import PROFILE_COLUMNS
from lakeloom.plans.queries import LATE_ORDERS, LEFT_OUT, PASSENGER_CUT, SNAPSHOTS, WANTED_CUSTOMERS, WANTED_ORDERS
from lakeloom.schemas import FLIGHT_RAW_COLUMNS

_RAW = """
raw as (
  select
    lpad(cast(cast(floor(sec / 3600) as int) as varchar), 2, '0') || ':'
      || lpad(cast(cast(floor(sec / 60) as int) % 60 as varchar), 2, '0') || ':'
      || lpad(cast(sec % 60 as varchar), 2, '0') as departure_time,
    cast(ship_date as varchar) || ' '
      || lpad(cast(cast(floor(sec / 3600) as int) as varchar), 2, '0') || ':00:00' as arrival_time,
    cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as flight_id,
    cast(l_partkey as varchar) as aircraft_id,
    cast(l_orderkey as varchar) as itinerary_no,
    cast(l_orderkey as varchar) || '/' || cast(l_suppkey as varchar) as ticket_no,
    cast(cast(l_extendedprice as decimal(12,2)) as varchar) as flight_cost,
    s_nation as origin_airport,
    c_nation as destination_airport,
    case when c_acctbal > 0 then 'true' else 'false' end as frequent_flier,
    cast(ship_date as varchar) as travel_date,
    p_brand as airplane_model,
    'FF' || cast(c_custkey as varchar) as frequent_flier_no,
    c_name as passenger_name,
    c_nation as passenger_country,
    'N' || cast(l_partkey as varchar) as tail_no,
    cast(cast(l_quantity as int) as varchar) as distance,
    cast(l_linenumber as varchar) as turbulance,
    cast(cast(l_tax * 100 as int) as varchar) as temp_at_dept,
    cast(cast(l_quantity as int) * 3 as varchar) as fuel_consumed_litre,
    cast(l_linenumber * 5 as varchar) as taxi_duration_mins,
    cast(cast(l_discount * 100 as int) + 700 as varchar) as avg_flight_speed_kmps,
    cast(l_linenumber as varchar) as engine_performance,
    cast(date '1950-01-01' + cast(c_custkey % 18000 as int) as varchar) as passenger_dob,
    o_orderpriority as passenger_flight_class
  from (
    select l.*, o_orderpriority, c_custkey, c_name, c_acctbal, p_brand,
           sn.n_name as s_nation, cn.n_name as c_nation,
           cast(l_shipdate as date) as ship_date,
           (l_orderkey * 97 + l_linenumber * 61) % 86400 as sec
    from lineitem l
    join orders on l_orderkey = o_orderkey
    join customer on o_custkey = c_custkey
    join nation cn on c_nationkey = cn.n_nationkey
    join supplier on l_suppkey = s_suppkey
    join nation sn on s_nationkey = sn.n_nationkey
    join part on l_partkey = p_partkey
  ) j
)"""

_FLIGHT = (
    _RAW
    + """,
flight as (
  select
    strftime(strptime(departure_time, '%H:%M:%S'), '%H:%M:%S') as departure_time,
    cast(arrival_time as timestamp) as arrival_time,
    flight_id,
    aircraft_id,
    cast(itinerary_no as int) as itinerary_no,
    ticket_no,
    cast(flight_cost as decimal(10,0)) as flight_cost,
    origin_airport,
    destination_airport,
    cast(frequent_flier as boolean) as frequent_flier,
    cast(travel_date as date) as travel_date,
    airplane_model,
    frequent_flier_no,
    passenger_name,
    passenger_country,
    tail_no,
    cast(distance as int) as distance,
    cast(turbulance as int) as turbulance,
    cast(temp_at_dept as float) as temp_at_dept,
    cast(fuel_consumed_litre as float) as fuel_consumed_litre,
    cast(taxi_duration_mins as float) as taxi_duration_mins,
    cast(avg_flight_speed_kmps as double) as avg_flight_speed_kmps,
    cast(engine_performance as int) as engine_performance,
    cast(passenger_dob as date) as passenger_dob,
    passenger_flight_class,
    cast(hour(strptime(departure_time, '%H:%M:%S')) * 3600
      + minute(strptime(departure_time, '%H:%M:%S')) * 60
      + second(strptime(departure_time, '%H:%M:%S')) as int) as departure_seconds,
    sha256(to_json(raw)) as uuid
  from raw
)"""
)

# Mean of whole numbers, rounded half up to four digits as a decimal(14,4) mean is.
_COST4 = (
    "cast((2 * 10000 * sum(cast(flight_cost as bigint)) + count(flight_cost)) "
    "// (2 * count(flight_cost)) as double) / 10000.0"
)

_AIRPORTS = """
airports as (
  select row_number() over (order by airport nulls first) as id, airport
  from (select origin_airport as airport from flight
        union select destination_airport from flight)
)"""

_ROLES = """
roles as (
  select f.*, a.id as origin_airport_id, b.id as destination_airport_id
  from flight f
  join airports a on a.airport = f.origin_airport
  join airports b on b.airport = f.destination_airport
)"""


def _raw(body: str) -> str:
    return f"with {_RAW}\n{body}"


def _flight(body: str, *ctes: str) -> str:
    return "with " + ",".join([_FLIGHT, *ctes]) + "\n" + body


def _home(where: str = "true", combine: str = "max") -> str:
    sides = f"""
      select aircraft_id, origin_airport as airport, count(*) as cnt
      from flight where {where} group by 1, 2
      union all
      select aircraft_id, destination_airport, count(*)
      from flight where {where} group by 1, 2"""
    if combine == "sum":
        sides = f"select aircraft_id, airport, sum(cnt) as cnt from ({sides}) group by 1, 2"
    return f"""
    select aircraft_id, airport from (
      select *, row_number() over (
        partition by aircraft_id order by cnt desc, airport desc nulls last) as rn
      from ({sides})
    ) where rn = 1"""


def _profile(where: str = "true") -> str:
    return f"""
    select f.aircraft_id, h.airport, f.airplane_model,
      {_COST4} as avg_flight_cost,
      cast(sum(distance) as bigint) as total_distance,
      avg(cast(fuel_consumed_litre as double)) as avg_fuel_consumption,
      avg(avg_flight_speed_kmps) as avg_flight_speed_kmps,
      max(engine_performance) as max_engine_performance,
      min(engine_performance) as min_engine_performance
    from flight f join ({_home(where)}) h on h.aircraft_id = f.aircraft_id
    where {where}
    group by f.aircraft_id, h.airport, f.airplane_model"""


def _passengers(where: str = "true") -> str:
    return f"""
    select md5(passenger_name || '-' || passenger_country || '-'
               || cast(passenger_dob as varchar)) as passenger_key, *
    from (select distinct passenger_name, passenger_country, passenger_dob, passenger_flight_class
          from flight where {where})"""


def _one_passenger(where: str) -> str:
    return f"""
    select passenger_key, passenger_name, passenger_country, passenger_dob,
           max(passenger_flight_class) as passenger_flight_class
    from ({_passengers(where)}) group by all"""


def _scd2(prefix: str = "") -> str:
    columns = ["aircraft_id", "airport", *PROFILE_COLUMNS]
    data = ", ".join(columns)
    changed = " or ".join(f"o.{c} is distinct from n.{c}" for c in columns[1:])

    def opened(alias: str, as_of: str) -> str:
        moment = f"timestamp '{as_of}'"
        own = ", ".join(f"{alias}.{c}" for c in columns)
        return (
            f"{own}, md5({alias}.aircraft_id || '|' || epoch_us({moment})) as scd_id, "
            f"{moment} as updated_at, {moment} as valid_from, cast(null as timestamp) as valid_to"
        )

    ctes = []
    for i, (as_of, where) in enumerate(SNAPSHOTS):
        ctes.append(f"p{i} as materialized ({_profile(where)})")
        if i == 0:
            ctes.append(f"t0 as materialized (select {opened('n', as_of)} from p0 n)")
            continue
        ctes.append(f"o{i} as materialized (select * from t{i - 1} where valid_to is null)")
        ctes.append(f"""t{i} as materialized (
          select * from t{i - 1} where valid_to is not null
          union all
          select {", ".join(f"o.{c}" for c in columns)}, o.scd_id, o.updated_at, o.valid_from,
            case when n.aircraft_id is null or {changed} then timestamp '{as_of}' end
          from o{i} o left join p{i} n on n.aircraft_id = o.aircraft_id
          union all
          select {opened("n", as_of)}
          from p{i} n left join o{i} o on n.aircraft_id = o.aircraft_id
          where o.aircraft_id is null or {changed}
        )""")
    last = len(SNAPSHOTS) - 1
    return _flight(
        f"select {data}, "
        + ", ".join(f"{c} as {prefix}{c}" for c in ("scd_id", "updated_at", "valid_from", "valid_to"))
        + f" from t{last}",
        *ctes,
    )


_GOLD = f"""
  select aircraft_id, passenger_flight_class, {_COST4} as avg_cost, max(distance) as max_distance
  from flight where passenger_flight_class <> '{LEFT_OUT}'
  group by aircraft_id, passenger_flight_class"""

_LOST_CLASS = ", ".join(
    f"nullif({c}, '{LEFT_OUT}') as {c}" if c == "passenger_flight_class" else c
    for c in FLIGHT_RAW_COLUMNS
)


def _nth(partition: str, n: int) -> str:
    return f"""
    select * from (
      select *, cast(row_number() over ({partition} order by o_totalprice, o_orderkey) as int) as rn
      from orders) where rn = {n}"""


def _first_versions(prefix: str, as_of: str, key: str) -> str:
    moment = f"timestamp '{as_of}'"
    return (
        f"md5(cast({key} as varchar) || '|' || epoch_us({moment})) as {prefix}scd_id, "
        f"{moment} as {prefix}updated_at, {moment} as {prefix}valid_from, "
        f"cast(null as timestamp) as {prefix}valid_to"
    )


_STATIC = f"""
select *, row_number() over (order by aircraft_id, airplane_model) as id
from (
  select aircraft_id, airplane_model,
    cast(floor({_COST4}) as int) as avg_cost,
    cast(sum(distance) as bigint) as total_distance_flown,
    avg(cast(fuel_consumed_litre as double)) as avg_fuel_consumed_litre,
    min(engine_performance) as min_engine_performance,
    max(engine_performance) as max_engine_performance,
    quantile_disc(origin_airport_id, 0.7) as origin_airport_id,
    quantile_disc(destination_airport_id, 0.7) as destination_airport_id
  from roles group by aircraft_id, airplane_model
)"""

_CODE = "case when o_custkey % 40 <> 7 then lpad(cast(o_custkey % 40 as varchar), 3, '0') end"

_TOP_COST = (
    f"select * from ({_GOLD}) order by avg_cost desc, aircraft_id, passenger_flight_class limit 5"
)


ORACLES: dict[str, str] = {
    "bronze_head": _raw(f"select * from raw order by {', '.join(FLIGHT_RAW_COLUMNS)} limit 3"),
    "silver_conform": _flight(
        "select * replace (cast(flight_cost as double) as flight_cost) from flight"
    ),
    "silver_dedupe": _raw("select distinct * from (select * from raw union all select * from raw)"),
    "lenient_casts": """
        select c_custkey,
          cast(trunc(cast(c_acctbal as decimal(12,2))) as int) as balance_int,
          cast(round(cast(c_acctbal as decimal(12,2)), 0) as double) as balance_decimal,
          cast(cast(c_acctbal as decimal(12,2)) as double) as balance_double,
          cast(trunc(cast(c_acctbal as decimal(12,2))) as int) as padded_int,
          cast(null as int) as bad_int,
          cast(null as date) as bad_date,
          c_acctbal > 0 as in_credit
        from customer""",
    "anchored_arrivals": """
        select o_orderkey,
          cast(cast(o_orderdate as date) as timestamp)
            + to_hours(o_orderkey % 24) + to_minutes(5) as arrival_time
        from orders""",
    "key_profile": _flight(
        "select count(itinerary_no) as cnt, count(distinct itinerary_no) as cnt_dist from flight"
    ),
    "dim_airport": _flight("select id, airport from airports", _AIRPORTS),
    "dim_airport_union": _flight("select id, airport from airports", _AIRPORTS),
    "airport_roles": _flight(
        "select flight_id, ticket_no, aircraft_id, origin_airport, destination_airport, "
        "origin_airport_id, destination_airport_id from roles",
        _AIRPORTS,
        _ROLES,
    ),
    "airport_roles_kept": _flight(
        "select flight_id, ticket_no, aircraft_id, origin_airport, destination_airport, "
        "origin_airport_id, destination_airport_id from roles",
        _AIRPORTS,
        _ROLES,
    ),
    "dim_aircraft_static": _flight(_STATIC, _AIRPORTS, _ROLES),
    "home_airport": _flight(_home()),
    "home_airport_union": _flight(_home()),
    "home_airport_union_all": _flight(_home()),
    "home_airport_sum": _flight(_home(combine="sum")),
    "dim_aircraft_profile": _flight(_profile()),
    "dim_aircraft_profile_join": _flight(_profile()),
    "surrogate_key_nulls": f"""
        select o_orderkey, md5(
          o_orderstatus || '-'
          || coalesce(nullif(o_orderpriority, '{LEFT_OUT}'), '_dbt_utils_surrogate_key_null_')
          || '-' || cast(o_custkey as varchar)) as order_key
        from orders""",
    "dim_passenger_initial": _flight(_passengers()),
    "dim_passenger_increment": _flight(
        """
        select * from first
        union all
        select * from second s
        where not exists (select 1 from first t where t.passenger_key = s.passenger_key)""",
        f"first as ({_passengers(f"travel_date < date '{PASSENGER_CUT}'")})",
        f"second as ({_passengers(f"travel_date >= date '{PASSENGER_CUT}'")})",
    ),
    "passenger_upsert": _flight(
        """
        select * from first t
        where not exists (select 1 from second s where s.passenger_key = t.passenger_key)
        union all
        select * from second""",
        f"first as ({_one_passenger(f"travel_date < date '{PASSENGER_CUT}'")})",
        f"second as ({_one_passenger(f"travel_date >= date '{PASSENGER_CUT}'")})",
    ),
    "aircraft_scd2": _scd2(),
    "snapshot_quarantine": """
        select * replace (nullif(c_mktsegment, 'BUILDING') as c_mktsegment)
        from customer where c_mktsegment = 'BUILDING'""",
    "snapshot_first_of_duplicates": f"""
        select o_custkey, o_orderkey, o_totalprice,
          {_first_versions("", SNAPSHOTS[0][0], "o_custkey")}
        from (
          select *, row_number() over (
            partition by o_custkey order by o_totalprice desc, o_orderkey) as nth
          from orders
        ) where nth = 1""",
    "gold_cost_by_class": _flight(_GOLD),
    "gold_top_cost": _flight(_TOP_COST),
    "flight_classes_view": _flight("select distinct passenger_flight_class from flight"),
    "nth_row": _nth("", 4),
    "nth_row_deep": _nth("", 5000),
    "nth_row_per_group": _nth("partition by o_custkey", 4),
    "nth_row_deep_per_group": _nth("partition by o_orderpriority", 2000),
    "not_null_violations": _raw(
        f"select * from (select {_LOST_CLASS} from raw) where "
        + " or ".join(f"{c} is null" for c in FLIGHT_RAW_COLUMNS)
    ),
    # Files are not seen in SQL; each of the given tables is one.
    "file_stats": "select 'lineitem.parquet' as file_name, count(*) as num_records, "
    + ", ".join(
        f"min({c}) as min_{c}, max({c}) as max_{c}, count(*) - count({c}) as nulls_{c}"
        for c in ("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate")
    )
    + " from lineitem",
    "log_file_stats": """
        select count(*) as num_records,
          min(l_orderkey) as min_orderkey, max(l_orderkey) as max_orderkey,
          count(*) - count(l_orderkey) as null_orderkey, true as fourth_line_is_first_file
        from lineitem""",
    "json_props": """
        select event_id, cast(json_extract(props, '$.k') as int) as k from events""",
    "csv_roundtrip": _raw("select * from raw"),
    "json_roundtrip": "select * from events",
    "key_profile_batches": """
        select 'o_custkey' as column, count(*) as num_records, count(o_custkey) as cnt, true as within_error from orders
        union all
        select 'o_orderkey', count(*), count(o_orderkey), true from orders""",
    "csv_good_lines": """
        select cast(o_orderkey as varchar) as o_orderkey,
          case when o_orderkey % 10 = 2 then 'a,b' else o_orderstatus end as o_orderstatus,
          cast(o_custkey as varchar) as o_custkey
        from orders where o_orderkey % 10 not in (1, 3, 4)""",
    "csv_bad_lines": """
        select case o_orderkey % 10 when 1 then o_orderkey || ',"open,' || o_custkey
            when 3 then o_orderkey || ',' || o_orderstatus
            else o_orderkey || ',' || o_orderstatus || ',' || o_custkey || ',extra' end as line,
          case o_orderkey % 10 when 1 then 3 when 3 then 2 else 4 end as n_fields,
          case o_orderkey % 10 when 1 then 'quote' when 3 then 'short' else 'long' end as reason
        from orders where o_orderkey % 10 in (1, 3, 4)""",
    "variant_props": """
        select event_id,
          case event_id % 3 when 0 then json_extract_string(props, '$.k') when 1 then 'k' || json_extract_string(props, '$.k') end as k,
          case event_id % 3 when 0 then cast(json_extract(props, '$.k') as int) end as k_number,
          case event_id % 3 when 2 then cast(json_extract_string(props, '$.k') || '.5' as double) end as other_k
        from events""",
    "path_scan": "select * from orders",
    "path_scan_sql": "select * from orders",
    "catalog_overwrite": "select * from orders",
    "partitioned_overwrite": f"select * replace (o_totalprice * 2 as o_totalprice), {_CODE} as code from orders",
    "partitioned_overwrite_csv": f"select o_orderkey, o_custkey, o_orderstatus, {_CODE} as code from orders",
    "merged_files": f"""
        select * from orders where o_orderdate < timestamp '{LATE_ORDERS}'
        union all
        select * replace ('X' as o_orderstatus, o_totalprice + 1 as o_totalprice)
        from orders where o_orderdate >= timestamp '{LATE_ORDERS}'
        union all
        select * replace (-o_orderkey - 1 as o_orderkey, 'X' as o_orderstatus, o_totalprice + 1 as o_totalprice)
        from orders where o_orderdate >= timestamp '{LATE_ORDERS}'""",
    "skipped_files": f"""
        select * from orders
        where o_custkey in ({", ".join(map(str, WANTED_CUSTOMERS))}) and o_orderkey <= {WANTED_ORDERS}""",
    "table_swap": "select * replace (o_totalprice * 2 as o_totalprice) from orders",
    "append_batches": "select * from orders union all select * from orders",
    "append_idempotent": "select * from orders",
    "sized_repartition": "select * from lineitem",
    "compacted_write": "select * from lineitem",
    "lake_top_cost": _flight(_TOP_COST),
    "lake_aircraft": _flight(_STATIC, _AIRPORTS, _ROLES),
    "lake_passengers": _flight(_passengers()),
    "lake_snapshot_changes": _scd2("dbt_"),
    "lake_snapshot": _flight(
        f"select *, {_first_versions('dbt_', SNAPSHOTS[0][0], 'aircraft_id')} from ({_profile()})"
    ),
}
