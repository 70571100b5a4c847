"""Filters and predicates."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition, condition_from_dict
from sluice.operators.values import filter_rows


@query(
    "filter_cmp",
    """SELECT * FROM lineitem WHERE l_quantity >= 25 AND l_discount < 0.05 AND l_tax <> 0.02
       AND l_extendedprice > 20000 AND l_linenumber <= 5""",
)
def filter_cmp(t):
    return filter_rows(
        t.lineitem,
        Condition("l_quantity", "GTE", 25)
        & Condition("l_discount", "LT", 0.05)
        & Condition("l_tax", "NE", 0.02)
        & Condition("l_extendedprice", "GT", 20000)
        & Condition("l_linenumber", "LTE", 5),
    )


@query(
    "filter_in",
    """SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
       AND o_orderstatus NOT IN ('P')""",
)
def filter_in(t):
    return filter_rows(
        t.orders,
        Condition("o_orderpriority", "IN_LIST", ["1-URGENT", "2-HIGH"])
        & Condition("o_orderstatus", "NOT_IN_LIST", "P"),
    )


@query(
    "filter_text_eq",
    "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_name <> 'Customer#000000007'",
)
def filter_text_eq(t):
    return filter_rows(
        t.customer,
        Condition("c_mktsegment", "EQ", "BUILDING") & Condition("c_name", "NE", "Customer#000000007"),
    )


@query(
    "filter_contains",
    """SELECT * FROM part WHERE (contains(p_name, 'ring') OR contains(p_name, 'bolt'))
       AND NOT contains(p_name, 'old') AND contains(lower(p_type), 'econ')""",
)
def filter_contains(t):
    return filter_rows(
        t.part,
        Condition("p_name", "CONTAINS", ["ring", "bolt"])
        & Condition("p_name", "NOT_CONTAINS", "old")
        & Condition("p_type", "ICONTAINS", "econ"),
    )


@query(
    "filter_prefix_suffix",
    """SELECT * FROM part WHERE (starts_with(p_name, 'small') OR ends_with(p_name, 'rod'))
       AND NOT starts_with(p_type, 'PRO') AND NOT ends_with(p_brand, '7')""",
)
def filter_prefix_suffix(t):
    return filter_rows(
        t.part,
        (Condition("p_name", "STARTS_WITH", "small") | Condition("p_name", "ENDS_WITH", "rod"))
        & Condition("p_type", "NOT_STARTS_WITH", "PRO")
        & Condition("p_brand", "NOT_ENDS_WITH", "7"),
    )


@query(
    "filter_empty",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)
       WHERE l.quality IS NULL AND trim(d.text) <> ''""",
)
def filter_empty(t):
    both = t.documents.join(t.labels, "doc_id", "left")
    return filter_rows(
        both, Condition("quality", "IS_EMPTY") & Condition("text", "IS_NOT_EMPTY")
    ).select("doc_id", "quality")


@query(
    "filter_minmax",
    """SELECT * FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)
       OR l_shipdate = (SELECT min(l_shipdate) FROM lineitem)""",
)
def filter_minmax(t):
    return filter_rows(
        t.lineitem, Condition("l_quantity", "IS_MAXVAL") | Condition("l_shipdate", "IS_MINVAL")
    )


@query(
    "filter_not_minmax",
    """SELECT * FROM part WHERE p_size <> (SELECT max(p_size) FROM part)
       AND p_size <> (SELECT min(p_size) FROM part)""",
)
def filter_not_minmax(t):
    return filter_rows(
        t.part, Condition("p_size", "IS_NOT_MAXVAL") & Condition("p_size", "IS_NOT_MINVAL")
    )


@query(
    "filter_range",
    """SELECT * FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000
       AND o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-12-31'""",
)
def filter_range(t):
    return filter_rows(
        t.orders,
        Condition("o_totalprice", "IN_RANGE", [100000, 200000])
        & Condition("o_orderdate", "IN_RANGE", ["1997-01-01", "1998-12-31"]),
    )


@query(
    "filter_column",
    """SELECT l.*, o_orderdate FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
       WHERE l_shipdate < o_orderdate AND l_discount >= l_tax""",
)
def filter_column(t):
    both = t.lineitem.join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    ).drop("o_orderkey")
    return filter_rows(
        both,
        Condition("l_shipdate", "LT", "o_orderdate", value_is_column=True)
        & Condition("l_discount", "GTE", "l_tax", value_is_column=True),
    )


@query(
    "filter_date_component",
    """SELECT * FROM orders WHERE year(o_orderdate) = 1998 AND monthname(o_orderdate) = 'March'
       AND dayofweek(o_orderdate) >= 2""",
)
def filter_date_component(t):
    return filter_rows(
        t.orders,
        Condition("o_orderdate", "EQ", 1998, component="year")
        & Condition("o_orderdate", "EQ", "March", component="month_text")
        & Condition("o_orderdate", "GTE", 2, component="day_of_week"),
    )


@query(
    "filter_date_trunc",
    """SELECT * FROM events WHERE date_trunc('day', ts) >= TIMESTAMP '2024-01-10'
       AND date_trunc('hour', ts) <> TIMESTAMP '2024-01-12 05:00:00'""",
)
def filter_date_trunc(t):
    return filter_rows(
        t.events,
        Condition("ts", "GTE", "2024-01-10 13:00:00", truncate="DAY")
        & Condition("ts", "NE", "2024-01-12 05:30:00", truncate="HOUR"),
    )


@query(
    "filter_date_fn",
    """SELECT * FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
       OR (o_orderdate > (SELECT min(o_orderdate) FROM orders) AND o_totalprice > 400000
           AND o_orderdate < now()::TIMESTAMP)""",
)
def filter_date_fn(t):
    def on(op, fn):
        return Condition("o_orderdate", op, fn, value_is_date_fn=True)

    rich = Condition("o_totalprice", "GT", 400000)
    return filter_rows(t.orders, on("EQ", "MAX") | (on("GT", "MIN") & rich & on("LT", "NOW")))


@query(
    "filter_case",
    """SELECT * FROM part WHERE lower(p_type) IN ('economy', 'promo')
       AND contains(lower(p_name), 'anvil')""",
)
def filter_case(t):
    return filter_rows(
        t.part,
        Condition("p_type", "IN_LIST", ["Economy", "promo"], case_sensitive=False)
        & Condition("p_name", "CONTAINS", "ANVIL"),
    )


@query(
    "filter_compound",
    """SELECT * FROM lineitem WHERE NOT ((l_returnflag = 'R' AND l_quantity > 10)
       OR (l_linestatus = 'F' AND NOT (l_discount < 0.03 OR l_tax > 0.06)))""",
)
def filter_compound(t):
    light = ~(Condition("l_discount", "LT", 0.03) | Condition("l_tax", "GT", 0.06))
    returned = Condition("l_returnflag", "EQ", "R") & Condition("l_quantity", "GT", 10)
    return filter_rows(t.lineitem, ~(returned | (Condition("l_linestatus", "EQ", "F") & light)))


@query(
    "filter_remove",
    "SELECT * FROM orders WHERE NOT (o_orderstatus = 'F' OR o_totalprice < 50000)",
)
def filter_remove(t):
    done = Condition("o_orderstatus", "EQ", "F") | Condition("o_totalprice", "LT", 50000)
    return filter_rows(t.orders, done, filter_type="REMOVE")


@query(
    "filter_json_form",
    """SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY'
       OR (c_mktsegment = 'BUILDING' AND c_acctbal >= 5000)""",
)
def filter_json_form(t):
    return filter_rows(
        t.customer,
        condition_from_dict(
            {
                "logic": "OR",
                "conditions": [
                    {"column": "c_mktsegment", "operator": "EQ", "value": "MACHINERY"},
                    {
                        "logic": "AND",
                        "conditions": [
                            {"column": "c_mktsegment", "operator": "EQ", "value": "BUILDING"},
                            {"column": "c_acctbal", "operator": "GTE", "value": 5000},
                        ],
                    },
                ],
            }
        ),
    )
