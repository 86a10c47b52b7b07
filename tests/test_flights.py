"""Golden answers of the air-traffic questions on a small table made to give them."""

import pytest
from pyspark.sql import Row

from sparkloom.plans import flights as fl


def flight(**values):
    base = dict(Month=1, FlightNum=1, TailNum=None, UniqueCarrier="AA", Origin="XXX", Dest="YYY", DepDelay=-1,
                WeatherDelay=None, CarrierDelay=None, Distance=None, TaxiIn=None, TaxiOut=None, Cancelled=0,
                CancellationCode=None)
    return {**base, **values}


@pytest.fixture(scope="module")
def flights(spark):
    rows = [flight(TailNum=t) for t, n in (("N881AS", 5), ("N886AS", 3), ("N824AS", 2)) for _ in range(n)]
    rows += [flight(), flight(UniqueCarrier=None)]
    rows += [flight(FlightNum=4794, Dest="JFK", CancellationCode="D"), flight(FlightNum=4794, Dest="ATL", CancellationCode="D"),
             flight(FlightNum=5, CancellationCode="A")]
    rows += [flight(WeatherDelay=7, Month=3), flight(WeatherDelay=99, Month=4)]
    rows += [flight(DepDelay=15, WeatherDelay=112, Month=5), flight(DepDelay=16, WeatherDelay=50, Month=5),
             flight(DepDelay=16, WeatherDelay=62, Month=5), flight(DepDelay=-3, WeatherDelay=1000, Month=5)]
    rows += [flight(UniqueCarrier="ZB", Origin="LAS", Dest="JFK", TaxiIn=10, TaxiOut=14, Cancelled=1),
             flight(UniqueCarrier="EV", Origin="LAS", Dest="JFK", TaxiIn=8, TaxiOut=13)]
    rows += [flight(Origin="JFK", Dest="LAS", TaxiIn=13, TaxiOut=12), flight(Origin="JFK", Dest="LAS", TaxiIn=13, TaxiOut=14)]
    rows += [flight(Origin="ROA", Cancelled=int(i == 0)) for i in range(4)]
    schema = ("Month int, FlightNum int, TailNum string, UniqueCarrier string, Origin string, Dest string, DepDelay int,"
              "WeatherDelay int, CarrierDelay int, Distance int, TaxiIn int, TaxiOut int, Cancelled int, CancellationCode string")
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


@pytest.fixture(scope="module")
def carriers(spark):
    return spark.createDataFrame([("AA", "American"), ("ZB", "Titan Airways"), ("EV", "Atlantic Southeast Airlines"),
                                  ("QQ", "Never Airborne")], "Code string, Description string")


@pytest.fixture(scope="module")
def airports(spark):
    return spark.createDataFrame([("LAS", "McCarran International", "Las Vegas"), ("ROA", "Roanoke Regional/ Woodrum ", "Roanoke"),
                                  ("JFK", "John F Kennedy Intl", "New York")], "iata string, airport string, city string")


def test_flight_count(flights):
    assert fl.flight_count(flights).take(3) == [Row(TailNum="N881AS", count=5), Row(TailNum="N886AS", count=3),
                                                Row(TailNum="N824AS", count=2)]


def test_cancelled_due_to_security(flights):
    assert {tuple(r) for r in fl.cancelled_due_to_security(flights).collect()} == {(4794, "JFK"), (4794, "ATL")}


def test_longest_weather_delay(flights):
    assert fl.longest_weather_delay(flights).first()[0] == 7


def test_did_not_fly_ignores_null_carriers(carriers, flights):
    found = fl.did_not_fly(carriers, flights)
    assert [r.Code for r in found.collect()] == ["QQ"]
    assert "LeftAnti" in found._jdf.queryExecution().executedPlan().toString()


def test_flights_on_route(carriers, flights):
    assert fl.flights_on_route(carriers, flights).collect() == [
        Row(Description="Titan Airways", Num=1), Row(Description="Atlantic Southeast Airlines", Num=1)]


def test_time_spent_taxiing(flights):
    assert [tuple(r) for r in fl.time_spent_taxiing(flights.where("TaxiIn is not null")).collect()] == [("LAS", 11.0), ("JFK", 13.25)]


def test_percentiles(spark, flights):
    distances = spark.createDataFrame([(d,) for d in (100, 357, None, 900)], "Distance int")
    assert fl.distance_median(distances).first()[0] == 357.0
    delays = spark.createDataFrame([(float(d),) for d in range(0, 19)], "CarrierDelay double")
    assert fl.carrier_delay_p95(delays).first()[0] == pytest.approx(17.1)


def test_cancelled_share(flights, airports):
    assert fl.cancelled_share(flights, airports).collect() == [
        Row(airport="McCarran International", city="Las Vegas", percentage=0.5),
        Row(airport="Roanoke Regional/ Woodrum ", city="Roanoke", percentage=0.25)]


def test_weather_delay_line(flights):
    assert tuple(fl.weather_delay_line(flights).first()) == pytest.approx((952.0, -56.0))
    assert tuple(fl.weather_delay_line(flights.where("DepDelay < 0")).first()) == (0.0, 0.0)
