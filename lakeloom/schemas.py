"""Schemas of the flight tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the raw file. "turbulance" is the name used in the data.
FLIGHT_RAW_COLUMNS = """
    departure_time arrival_time flight_id aircraft_id itinerary_no ticket_no flight_cost
    origin_airport destination_airport frequent_flier travel_date airplane_model
    frequent_flier_no passenger_name passenger_country tail_no distance turbulance temp_at_dept
    fuel_consumed_litre taxi_duration_mins avg_flight_speed_kmps engine_performance
    passenger_dob passenger_flight_class
""".split()

# Silver types of the columns that do not stay text.
FLIGHT_SILVER_TYPES = {
    "arrival_time": "timestamp",
    "itinerary_no": "int",
    "flight_cost": "decimal(10,0)",
    "frequent_flier": "boolean",
    "travel_date": "date",
    "distance": "int",
    "turbulance": "int",
    "temp_at_dept": "float",
    "fuel_consumed_litre": "float",
    "taxi_duration_mins": "float",
    "avg_flight_speed_kmps": "double",
    "engine_performance": "int",
    "passenger_dob": "date",
}

FLIGHT_RAW = T.StructType([T.StructField(name, T.StringType(), True) for name in FLIGHT_RAW_COLUMNS])
