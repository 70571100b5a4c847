"""Joins, lookups, unions, set operations and filled calendars."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import date_ops, joins, values


def _key_sql(how):
    return f"""SELECT o_orderkey, o_custkey, o_totalprice, c_name, c_mktsegment AS segment
        FROM orders {how} JOIN (SELECT * FROM customer WHERE c_acctbal > 2000) c
        ON o_custkey = c_custkey"""


def _joined(t, how):
    rich = values.filter_rows(t.customer, Condition("c_acctbal", "GT", 2000))
    return joins.join(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
        rich,
        [("o_custkey", "c_custkey")],
        how,
        select=["c_name", ("c_mktsegment", "segment")],
    )


for _how, _sql in (("INNER", "INNER"), ("LEFT", "LEFT"), ("RIGHT", "RIGHT"), ("OUTER", "FULL")):
    query(f"join_{_how.lower()}", _key_sql(_sql))(lambda t, how=_how: _joined(t, how))


@query(
    "join_multi_key",
    """SELECT l.*, r.l_quantity AS other_quantity, r.l_tax AS other_l_tax FROM lineitem l
       JOIN (SELECT * FROM lineitem WHERE l_linestatus = 'F') r
       ON l.l_orderkey = r.l_orderkey AND l.l_linenumber = r.l_linenumber""",
)
def join_multi_key(t):
    closed = values.filter_rows(t.lineitem, Condition("l_linestatus", "EQ", "F"))
    return joins.join(
        t.lineitem,
        closed,
        ["l_orderkey", "l_linenumber"],
        "INNER",
        select=[("l_quantity", "quantity"), "l_tax"],
        column_prefix="other_",
    )


@query(
    "join_name_collision",
    """SELECT n.*, r.r_name, s.n_name AS n_name_1 FROM nation n JOIN region r ON n_regionkey = r_regionkey
       JOIN nation s ON n.n_regionkey = s.n_nationkey""",
)
def join_name_collision(t):
    df = joins.join(t.nation, t.region, [("n_regionkey", "r_regionkey")], "INNER", ["r_name"])
    return joins.join(df, t.nation, [("n_regionkey", "n_nationkey")], "INNER", ["n_name"])


@query(
    "lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       (SELECT min(p_brand) FROM part WHERE p_partkey = l_partkey) AS brand,
       (SELECT min(o_totalprice) FROM orders WHERE o_custkey = l_partkey) AS cheapest FROM lineitem""",
)
def lookup(t):
    df = joins.lookup(t.lineitem, "l_partkey", t.part, "p_partkey", "p_brand", "brand")
    df = joins.lookup(
        df, "l_partkey", t.orders, "o_custkey", "o_totalprice", "cheapest", new_column_type="NUMERIC"
    )
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "brand", "cheapest")


@query(
    "lookup_mapping",
    """SELECT *, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1.0 WHEN '2-HIGH' THEN 2.0 END::DOUBLE AS level FROM orders""",
)
def lookup_mapping(t):
    df = joins.lookup_mapping(t.orders, "o_orderstatus", {"F": "finished", "O": "open"}, "status")
    return joins.lookup_mapping(
        df, "o_orderpriority", {"1-URGENT": 1, "2-HIGH": 2}, "level", new_column_type="NUMERIC"
    )


@query(
    "semi_anti",
    """SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
       AND o_totalprice > 450000) AS large FROM customer""",
)
def semi_anti(t):
    large = values.filter_rows(t.orders, Condition("o_totalprice", "GT", 450000))
    on = [("c_custkey", "o_custkey")]
    hit = joins.matching(t.customer, large, on).select("c_custkey", F.lit(True).alias("large"))
    miss = joins.matching(t.customer, large, on, matched=False)
    return hit.union(miss.select("c_custkey", F.lit(False)))


@query(
    "append_union",
    """SELECT c_name AS name, c_acctbal AS balance, c_nationkey AS nation FROM customer
       UNION ALL SELECT s_name, s_acctbal, s_nationkey FROM supplier""",
)
def append_union(t):
    customers = t.customer.select(
        F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("nation"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return joins.append(customers, suppliers)


_PAIRS = {
    "union": ("UNION", "UNION"),
    "union_all": ("UNION ALL", "UNION ALL"),
    "intersect": ("INTERSECT", "INTERSECT"),
    "except": ("EXCEPT", "EXCEPT"),
    "except_all": ("EXCEPT ALL", "EXCEPT ALL"),
}
for _name, (_operation, _sql) in _PAIRS.items():
    query(
        f"set_{_name}",
        f"""SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'R' {_sql}
            SELECT l_partkey FROM lineitem WHERE l_discount > 0.08""",
    )(
        lambda t, operation=_operation: joins.combine_sets(
            t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("k")),
            t.lineitem.filter("l_discount > 0.08").select(F.col("l_partkey").alias("k")),
            operation,
        )
    )


@query(
    "date_scaffold",
    """WITH daily AS (SELECT user_id, date_trunc('day', ts) AS day, count(*) AS n FROM events
         WHERE event_type = 'purchase' GROUP BY ALL),
       spans AS (SELECT user_id, min(day) AS a, max(day) AS b FROM daily GROUP BY user_id),
       spine AS (SELECT user_id, unnest(generate_series(a, b, INTERVAL 1 DAY)) AS day FROM spans)
       SELECT user_id, day, coalesce(n, 0) AS n FROM spine LEFT JOIN daily USING (user_id, day)""",
)
def date_scaffold(t):
    bought = values.filter_rows(t.events, Condition("event_type", "EQ", "purchase"))
    bought = date_ops.extract_date(bought, "ts", "year_month_day_as_date", "day")
    daily = bought.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    return date_ops.date_scaffold(daily, "day", "day", ["user_id"], fill={"n": 0})
