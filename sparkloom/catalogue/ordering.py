"""Sorting, top-k and set operations."""

from pyspark.sql import functions as F

from ..functions.text import same_set
from ..operators import aggregates as agg, joins, ordering as ops
from .registry import query, stamp


@query("t01_sort", """
SELECT airport, ROUND(AVG(Cancelled), 4) AS percentage FROM {flights} f JOIN {airports} a ON f.Origin = a.iata
GROUP BY iata, airport HAVING SUM(Cancelled) > 0 ORDER BY 2 DESC, 1 DESC""")
def _(t):
    shares = joins.share_by_dimension(t.flights, t.airports, "Origin", "iata", F.col("Cancelled") == 1, ["airport"])
    return ops.sort_by(shares, [("percentage", "desc"), ("airport", "desc")])


@query("t02_top_k", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, lineitem.l_linenumber LIMIT 10""")
def _(t):
    return ops.top_k(t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"),
                     [("l_extendedprice", "desc"), ("l_orderkey", "asc"), ("l_linenumber", "asc")], 10)


@query("t03_page", f"""
SELECT id, station_id, {stamp('r.timestamp')} AS timestamp, ROUND(temperature, 4) AS temperature FROM {{readings}} r WHERE station_id = '8'
ORDER BY r.timestamp DESC, id DESC LIMIT 100""")
def _(t):
    return ops.page(t.readings.select("id", "station_id", "timestamp", "temperature"), "timestamp", "id", 100,
                    F.col("station_id") == "8")


@query("t04_most_common", """
SELECT Species, COUNT(*) AS count FROM {fish} GROUP BY Species ORDER BY 2 DESC, 1 LIMIT 1""")
def _(t):
    return ops.most_common(t.fish, "Species")


@query("t06_largest_group", """
SELECT station_id, COUNT(*) AS n FROM {readings} GROUP BY station_id ORDER BY 2 DESC, 1 LIMIT 1""")
def _(t):
    return ops.top_k(agg.count_per_key(t.readings, "station_id", "n"), [("n", "desc"), ("station_id", "asc")], 1)


@query("u01_union_all", """
SELECT o_orderkey AS k, 'order' AS kind, o_totalprice AS amount FROM orders
UNION ALL SELECT l_orderkey, 'line', l_extendedprice FROM lineitem""")
def _(t):
    orders = t.orders.select(F.col("o_orderkey").alias("k"), F.lit("order").alias("kind"), F.col("o_totalprice").alias("amount"))
    lines = t.lineitem.select(F.col("l_extendedprice").alias("amount"), F.lit("line").alias("kind"), F.col("l_orderkey").alias("k"))
    return ops.union_all(orders, lines)


@query("u02_union_distinct", "SELECT Origin AS airport FROM {flights} UNION SELECT Dest FROM {flights}")
def _(t):
    return ops.union_distinct(t.flights.select(F.col("Origin").alias("airport")), t.flights.select(F.col("Dest").alias("airport")))


@query("u03_distinct", "SELECT DISTINCT Origin, Dest FROM {flights}")
def _(t):
    return ops.distinct(t.flights, ["Origin", "Dest"])


@query("u04_same_set", """
SELECT event_id, event_type = 'click' AS same FROM events""")
def _(t):
    left = F.array(F.col("event_type"), F.lit("view"), F.col("event_type"))
    right = F.array(F.lit("view"), F.lit("click"))
    return t.events.select("event_id", same_set(left, right).alias("same"))
