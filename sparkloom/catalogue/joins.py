"""Joins."""

from pyspark.sql import functions as F

from ..operators import joins as ops
from .registry import query


@query("j01_did_not_fly", """
SELECT Code, Description FROM {carriers} c
WHERE NOT EXISTS (SELECT 1 FROM {flights} f WHERE f.UniqueCarrier = c.Code)""")
def _(t):
    return ops.without_match(t.carriers, t.flights, "Code", "UniqueCarrier")


@query("j01_did_not_fly_null_aware", """
SELECT Code, Description FROM {carriers} c WHERE Code NOT IN (SELECT UniqueCarrier FROM {flights})""")
def _(t):
    return ops.without_match(t.carriers, t.flights, "Code", "UniqueCarrier", null_aware=True)


@query("j01_customers_without_orders", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def _(t):
    return ops.without_match(t.customer, t.orders, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query("j02_route_carriers", """
SELECT Description, COUNT(*) AS Num FROM {flights} f JOIN {carriers} c ON f.UniqueCarrier = c.Code
WHERE Origin = 'A3' AND Dest = 'A5' GROUP BY Description""")
def _(t):
    route = t.flights.where((F.col("Origin") == "A3") & (F.col("Dest") == "A5"))
    return ops.count_by_dimension(route, t.carriers, "UniqueCarrier", "Code", "Description")


@query("j03_taxi_time", """
SELECT i.airport, ROUND((i.x + o.x) / 2, 4) AS taxi
FROM (SELECT Origin AS airport, AVG(TaxiIn) AS x FROM {flights} GROUP BY Origin) i
JOIN (SELECT Dest AS airport, AVG(TaxiOut) AS x FROM {flights} GROUP BY Dest) o ON i.airport = o.airport""")
def _(t):
    return ops.mean_of_two_sides(t.flights, "Origin", "TaxiIn", "Dest", "TaxiOut")


@query("j04_cancelled_share", """
SELECT airport, city, ROUND(AVG(Cancelled), 4) AS percentage
FROM {flights} f JOIN {airports} a ON f.Origin = a.iata GROUP BY iata, airport, city HAVING SUM(Cancelled) > 0""")
def _(t):
    return ops.share_by_dimension(t.flights, t.airports, "Origin", "iata", F.col("Cancelled") == 1, ["airport", "city"])


@query("j05_lookup", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    return ops.lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), dim, "l_partkey").drop("l_partkey")


@query("j05_lookup_salted", """
SELECT p_brand, COUNT(*) AS n, ROUND(SUM(l_quantity), 4) AS quantity FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def _(t):
    dim = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    joined = ops.lookup(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), dim, "l_partkey", salt=8)
    return joined.groupBy("p_brand").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query("j06_within_km", """
SELECT a_id, b_id, ROUND(12742 * asin(sqrt(least(1.0, h))), 2) AS distance_km FROM (
  SELECT a.iata AS a_id, b.iata AS b_id, pow(sin(radians(b.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.long - a.long) / 2), 2) AS h
  FROM {airports} a, {airports} b WHERE a.iata < b.iata)
WHERE 12742 * asin(sqrt(least(1.0, h))) <= 1500""")
def _(t):
    pairs = ops.within_km(t.airports, t.airports, 1500.0, "iata", "iata", ("lat", "long"), ("lat", "long"), salt=2)
    return pairs.where("a_id < b_id").withColumn("distance_km", F.round("distance_km", 2))


@query("j06_customers_near_airports", """
SELECT b_id, COUNT(*) AS n, ROUND(MIN(km), 2) AS nearest FROM (
  SELECT b.iata AS b_id, 12742 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.long - a.lon) / 2), 2)))) AS km
  FROM (SELECT c_custkey, (c_custkey % 1700) / 10.0E0 - 85 AS lat, (c_custkey * 7 % 3600) / 10.0E0 - 180 AS lon FROM customer) a,
       {airports} b) WHERE km <= 600 GROUP BY b_id""")
def _(t):
    homes = t.customer.select("c_custkey", ((F.col("c_custkey") % 1700) / 10 - 85).alias("lat"),
                              ((F.col("c_custkey") * 7 % 3600) / 10 - 180).alias("lon"))
    near = ops.within_km(homes, t.airports, 600.0, "c_custkey", "iata", ("lat", "lon"), ("lat", "long"))
    return near.groupBy("b_id").agg(F.count("*").alias("n"), F.round(F.min("distance_km"), 2).alias("nearest"))


@query("j07_reattach", """
SELECT row_id, ROUND(predicted, 4) AS predicted, species FROM {scored} WHERE row_id % 5 = 0""")
def _(t):
    part = t.scored.where("row_id % 5 = 0").select("row_id", "predicted")
    return ops.reattach(part, t.scored, "row_id", ["species"])
