"""Results too large for one cell, one row or one sort: parts, pages of columns, pages of rows, sets of widgets."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import quality
from sluice.operators.aggregate import Aggregation, Cell, concat_parts, crosstab_pages
from sluice.operators.paging import PageIndex
from sluice.operators.quality import Widget
from sluice.session import scratch_path


@query(
    "concat_parts",
    """WITH v AS (SELECT o_orderpriority, o_orderkey::VARCHAR AS t FROM orders),
       placed AS (SELECT *, sum(length(t) + 1) OVER (PARTITION BY o_orderpriority ORDER BY t ROWS UNBOUNDED PRECEDING) AS stop FROM v),
       parts AS (SELECT o_orderpriority, (stop - length(t) - 1) // 1000 AS cell, min(stop - length(t) - 1) AS start, max(stop) AS stop,
         string_agg(t, ';' ORDER BY t) AS t FROM placed GROUP BY ALL)
       SELECT o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY cell) - 1 AS part, start::BIGINT AS "begin",
         t || CASE WHEN stop < max(stop) OVER (PARTITION BY o_orderpriority) THEN ';' ELSE '' END AS text FROM parts""",
)
def concat_in_parts(t):
    return concat_parts(t.orders, ["o_orderpriority"], "o_orderkey", ";", part_chars=1000)


@query(
    "crosstab_pages",
    """WITH c AS (SELECT l_returnflag, l_partkey AS k, count(*) AS "COUNT", max(l_quantity) AS "MAX_l_quantity" FROM lineitem GROUP BY ALL),
       d AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS position FROM (SELECT DISTINCT k FROM c))
       SELECT l_returnflag, k::VARCHAR AS value, position, position // 60 AS page, "COUNT", "MAX_l_quantity" FROM c JOIN d USING (k)""",
)
def crosstab_in_pages(t):
    return crosstab_pages(t.lineitem, ["l_returnflag"], "l_partkey", [Cell("COUNT"), Cell("MAX", "l_quantity")], width=60).cells


@query(
    "page_index",
    """SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_returnflag = 'R'
       ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 250 OFFSET 900""",
)
def page_index(t):
    index = PageIndex(t.spark, scratch_path(t.spark, "pages"))
    order = [["l_extendedprice", "DESC"], "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    index.build(t.lineitem, order, Condition("l_returnflag", "EQ", "R"), bucket_rows=2000)
    return index.page(250, 901, ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query(
    "widget_set",
    """WITH o AS (SELECT *, CASE WHEN o_totalprice > 100000 THEN 'large' ELSE 'small' END AS band FROM orders WHERE o_orderdate >= '1997-01-01')
       SELECT 'status' AS widget, o_orderstatus AS label, count(o_orderkey)::DOUBLE AS amount FROM o GROUP BY ALL
       UNION ALL SELECT 'customers', o_orderstatus, count(DISTINCT o_custkey) FROM o GROUP BY ALL
       UNION ALL SELECT 'middle', band, median(o_totalprice) FROM o WHERE o_orderstatus <> 'F' GROUP BY ALL
       UNION ALL SELECT 'dearest', o_orderpriority, max(o_totalprice) FROM o GROUP BY ALL
       UNION ALL SELECT 'all', NULL, count(o_orderkey) FROM o
       UNION ALL SELECT 'none', NULL, count(o_orderkey) FROM o WHERE o_totalprice < 0""",
)
def widget_set(t):
    orders = t.orders.withColumn("band", F.when(F.col("o_totalprice") > 100000, F.lit("large")).otherwise("small"))
    one = lambda column, function, groups, condition=None: Widget(groups, [Aggregation(column, function, "amount")], condition)
    data = quality.widget_data(
        orders,
        {
            "status": one("o_orderkey", "COUNT", ["o_orderstatus"]),
            "customers": one("o_custkey", "COUNT_DISTINCT", ["o_orderstatus"]),
            "middle": one("o_totalprice", "MEDIAN", ["band"], Condition("o_orderstatus", "NE", "F")),
            "dearest": one("o_totalprice", "MAX", ["o_orderpriority"]),
            "all": one("o_orderkey", "COUNT", []),
            "none": one("o_orderkey", "COUNT", [], Condition("o_totalprice", "LT", 0)),
        },
        [Condition("o_orderdate", "GTE", "1997-01-01")],
    )
    rows = []
    for name, table in data.items():
        label = F.col(table.columns[0]) if len(table.columns) > 1 else F.lit(None)
        rows.append(table.select(F.lit(name).alias("widget"), label.cast("string").alias("label"), F.col("amount").cast("double").alias("amount")))
    return reduce(DataFrame.unionAll, rows)
