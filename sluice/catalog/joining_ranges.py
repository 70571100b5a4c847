"""Joins by range and by nearest value."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import range_joins, values


def _of_type(t, kind):
    return values.filter_rows(t.events, Condition("event_type", "EQ", kind))


@query(
    "join_range",
    """SELECT e.event_id, e.user_id, e.ts, p.event_id AS purchase, p.value AS paid
       FROM (SELECT * FROM events WHERE event_type = 'error') e
       JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
       ON e.user_id = p.user_id AND e.ts >= p.ts AND e.ts < p.ts + INTERVAL 12 HOUR""",
)
def join_range(t):
    bought = _of_type(t, "purchase").withColumn("until", F.expr("ts + INTERVAL 12 HOURS"))
    errors = _of_type(t, "error").select("event_id", "user_id", "ts")
    return range_joins.join_range(
        errors, bought, "ts", "ts", "until", ["user_id"], select=[("event_id", "purchase"), ("value", "paid")], ends="LOW"
    )


@query(
    "join_range_bands",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, p_partkey, p_size FROM lineitem
       LEFT JOIN (SELECT * FROM part WHERE p_size <= 10) p
       ON l_extendedprice BETWEEN p_retailprice * 40 AND p_retailprice * 40 + p_size""",
)
def join_range_bands(t):
    small = values.filter_rows(t.part, Condition("p_size", "LTE", 10))
    bands = small.withColumns({"low": F.col("p_retailprice") * 40, "high": F.col("p_retailprice") * 40 + F.col("p_size")})
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice")
    return range_joins.join_range(lines, bands, "l_extendedprice", "low", "high", join_type="LEFT", select=["p_partkey", "p_size"])


@query(
    "join_overlap",
    """SELECT a.o_orderkey, a.o_custkey, b.o_orderkey AS other FROM (SELECT * FROM orders WHERE o_orderstatus = 'F') a
       JOIN (SELECT * FROM orders WHERE o_orderstatus = 'O') b ON a.o_custkey = b.o_custkey
       AND a.o_orderdate <= b.o_orderdate + INTERVAL 45 DAY AND b.o_orderdate <= a.o_orderdate + INTERVAL 90 DAY""",
)
def join_overlap(t):
    def open_for(status, days):
        some = values.filter_rows(t.orders, Condition("o_orderstatus", "EQ", status))
        return some.select("o_orderkey", "o_custkey", "o_orderdate").withColumn("until", F.expr(f"o_orderdate + INTERVAL {days} DAYS"))

    days = ("o_orderdate", "until")
    met = range_joins.join_overlap(open_for("F", 90), open_for("O", 45), days, days, ["o_custkey"], select=[("o_orderkey", "other")])
    return met.select("o_orderkey", "o_custkey", "other")


@query(
    "join_nearest",
    """SELECT p.event_id, p.user_id, p.ts, CASE WHEN v.ts >= p.ts - INTERVAL 6 HOUR THEN v.event_id END AS seen,
       CASE WHEN v.ts >= p.ts - INTERVAL 6 HOUR THEN v.ts END AS seen_at
       FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY ALL) v
       ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def join_nearest(t):
    bought = _of_type(t, "purchase").select("event_id", "user_id", "ts")
    return range_joins.join_nearest(
        bought, _of_type(t, "view"), "ts", "ts", ["user_id"], select=[("event_id", "seen"), ("ts", "seen_at")], within="6 hours"
    )


@query(
    "join_nearest_whole",
    """SELECT p.event_id, p.ts, e.event_id AS next_error FROM (SELECT * FROM events WHERE event_type = 'purchase') p
       ASOF JOIN (SELECT ts, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY ALL) e ON p.ts <= e.ts""",
)
def join_nearest_whole(t):
    bought = _of_type(t, "purchase").select("event_id", "ts")
    return range_joins.join_nearest(
        bought, _of_type(t, "error"), "ts", "ts", direction="FORWARD", join_type="INNER", select=[("event_id", "next_error")]
    )
