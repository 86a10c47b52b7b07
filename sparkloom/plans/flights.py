"""Air-traffic questions on the flights, carriers and airports tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import aggregates, cleaning, joins, statistics
from ..schemas import FLIGHTS
from ..sources.files import read_csv, register


def load_flights(spark: SparkSession, path: str, name: str = "airtraffic") -> DataFrame:
    return register(read_csv(spark, path, FLIGHTS), name)


def flight_count(flights: DataFrame) -> DataFrame:
    """Flights per airplane, busiest first."""
    return aggregates.count_per_key(flights, "TailNum")


def cancelled_due_to_security(flights: DataFrame) -> DataFrame:
    return cleaning.where_equal(flights, "CancellationCode", "D", ["FlightNum", "Dest"])


def longest_weather_delay(flights: DataFrame) -> DataFrame:
    """Longest weather delay from January to March."""
    return aggregates.max_where(flights, "WeatherDelay", F.col("Month") < 4, "longest")


def did_not_fly(carriers: DataFrame, flights: DataFrame) -> DataFrame:
    return joins.without_match(carriers, flights, "Code", "UniqueCarrier")


def flights_on_route(carriers: DataFrame, flights: DataFrame, origin: str = "LAS", dest: str = "JFK") -> DataFrame:
    """Flights per airline on one route."""
    route = cleaning.where_all(flights, {"Origin": origin, "Dest": dest})
    return joins.count_by_dimension(route, carriers, "UniqueCarrier", "Code", "Description")


def time_spent_taxiing(flights: DataFrame) -> DataFrame:
    return joins.mean_of_two_sides(flights, "Origin", "TaxiIn", "Dest", "TaxiOut")


def distance_median(flights: DataFrame, exact: bool = True) -> DataFrame:
    return statistics.percentile_of(flights, "Distance", 0.5, "median", exact=exact)


def carrier_delay_p95(flights: DataFrame, exact: bool = True) -> DataFrame:
    return statistics.percentile_of(flights, "CarrierDelay", 0.95, "p95", exact=exact)


def cancelled_share(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Share of cancelled flights per departure airport."""
    return joins.share_by_dimension(flights, airports, "Origin", "iata", F.col("Cancelled") == 1, ["airport", "city"])


def weather_delay_line(flights: DataFrame) -> DataFrame:
    """Intercept and slope of weather delay over departure delay."""
    return statistics.least_squares(flights, "DepDelay", "WeatherDelay")
