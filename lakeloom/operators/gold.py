"""Business aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GROUP = ["aircraft_id", "passenger_flight_class"]


def class_costs(flights: DataFrame, exclude: str | None = "economy") -> DataFrame:
    """Mean cost and greatest distance per aircraft and class, without the excluded class.

    A missing class drops out with the excluded one, before anything is aggregated.
    """
    kept = flights if exclude is None else flights.where(F.col(_GROUP[1]) != exclude)
    return kept.groupBy(*_GROUP).agg(
        F.avg("flight_cost").alias("avg_cost"), F.max("distance").alias("max_distance")
    )


def cost_by_aircraft_class(flights: DataFrame, exclude: str | None = "economy") -> DataFrame:
    """:func:`class_costs` from the dearest down."""
    return dearest_first(class_costs(flights, exclude))


def dearest_first(costs: DataFrame) -> DataFrame:
    """Rows of :func:`class_costs` from the dearest down."""
    return costs.orderBy(F.desc("avg_cost"), *_GROUP)


def top_cost(flights: DataFrame, k: int = 5, exclude: str | None = "economy") -> DataFrame:
    """The ``k`` dearest rows; the grouping columns decide ties, so every run agrees."""
    return cost_by_aircraft_class(flights, exclude).limit(k)


def flight_classes(flights: DataFrame) -> DataFrame:
    """The distinct flight classes."""
    return flights.select("passenger_flight_class").distinct()
