"""Window functions: Spark's own plan and the bucketed one."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query, steadied, steady_sql
from sluice.functions.conditions import Condition
from sluice.operators import values, windows
from sluice.operators.values import Value

_BY_CUSTOMER = "OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"
_ALL_ORDERS = "OVER (ORDER BY o_totalprice DESC, o_orderkey)"
_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def _several(df, functions, column, **options):
    for function in functions:
        source = None if function in windows.RANKS else column
        df = windows.window(df, function, source, function.lower(), **options)
    return df


@query(
    "win_rank",
    f"""SELECT o_orderkey, o_custkey, row_number() {_BY_CUSTOMER} AS row_number,
        rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS rank,
        dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS dense_rank,
        {steady_sql(f"percent_rank() {_BY_CUSTOMER}")} AS percent_rank, ntile(4) {_BY_CUSTOMER} AS ntile
        FROM orders""",
)
def win_rank(t):
    by = {"partition_by": ["o_custkey"]}
    df = _several(
        t.orders,
        ["ROW_NUMBER", "PERCENT_RANK", "NTILE"],
        None,
        order_by=["o_orderdate", "o_orderkey"],
        **by,
    )
    df = _several(df, ["RANK", "DENSE_RANK"], None, order_by=["o_orderpriority"], **by)
    df = steadied(df, "percent_rank")
    return df.select(
        "o_orderkey",
        "o_custkey",
        *[F.col(c) for c in ("row_number", "rank", "dense_rank", "percent_rank", "ntile")],
    )


@query(
    "win_rank_split",
    f"""SELECT o_orderkey, row_number() {_ALL_ORDERS} AS row_number,
        rank() OVER (ORDER BY o_orderdate) AS rank,
        dense_rank() OVER (ORDER BY o_orderdate) AS dense_rank,
        {steady_sql("percent_rank() OVER (ORDER BY o_orderdate)", 6)} AS percent_rank,
        ntile(7) {_ALL_ORDERS} AS ntile FROM orders""",
)
def win_rank_split(t):
    """Ranks over the whole table, without one task sorting it."""
    total = [["o_totalprice", "DESC"], "o_orderkey"]
    df = _several(t.orders.select("o_orderkey", "o_totalprice", "o_orderdate"), ["ROW_NUMBER"], None, order_by=total)
    df = windows.window(df, "NTILE", None, "ntile", order_by=total, buckets=7)
    df = _several(df, ["RANK", "DENSE_RANK", "PERCENT_RANK"], None, order_by=["o_orderdate"])
    return steadied(df, "percent_rank", digits=6).drop("o_totalprice", "o_orderdate")


@query(
    "win_offset",
    f"""SELECT o_orderkey, lag(o_totalprice, 1) {_BY_CUSTOMER} AS prev,
        lead(o_orderdate, 2) {_BY_CUSTOMER} AS next_but_one FROM orders""",
)
def win_offset(t):
    options = {"partition_by": ["o_custkey"], "order_by": ["o_orderdate", "o_orderkey"]}
    df = windows.window(t.orders, "LAG", "o_totalprice", "prev", **options)
    df = windows.window(df, "LEAD", "o_orderdate", "next_but_one", offset=2, **options)
    return df.select("o_orderkey", "prev", "next_but_one")


@query(
    "win_offset_split",
    """SELECT event_id, lag(value, 3) OVER (ORDER BY ts, event_id) AS before,
       lead(event_type, 1) OVER (PARTITION BY event_type = 'error' ORDER BY ts, event_id) AS after
       FROM events""",
)
def win_offset_split(t):
    order = ["ts", "event_id"]
    df = windows.window(t.events, "LAG", "value", "before", order_by=order, offset=3)
    df = df.withColumn("failed", F.col("event_type") == "error")
    df = windows.window(
        df, "LEAD", "event_type", "after", partition_by=["failed"], order_by=order, split=True
    )
    return df.select("event_id", "before", "after")


@query(
    "win_value",
    """SELECT o_orderkey, first_value(o_totalprice) OVER w AS first_price,
       last_value(o_totalprice) OVER w AS last_price, nth_value(o_totalprice, 3) OVER w AS third_price,
       last_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS latest
       FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def win_value(t):
    by = {"partition_by": ["o_custkey"], "order_by": ["o_orderdate", "o_orderkey"]}
    df = windows.window(t.orders, "FIRST_VALUE", "o_totalprice", "first_price", **by)
    df = windows.window(df, "LAST_VALUE", "o_totalprice", "last_price", **by)
    df = windows.window(df, "NTH_VALUE", "o_totalprice", "third_price", offset=3, **by)
    df = windows.window(df, "LAST_VALUE", "o_orderkey", "latest", range_type="RUNNING", **by)
    return df.select("o_orderkey", "first_price", "last_price", "third_price", "latest")


@query(
    "win_value_split",
    """SELECT event_id, first_value(value) OVER w AS first_value, last_value(value) OVER w AS last_value,
       nth_value(value, 5) OVER w AS fifth FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def win_value_split(t):
    by = {"partition_by": ["event_type"], "order_by": ["ts", "event_id"], "split": True}
    df = windows.window(t.events, "FIRST_VALUE", "value", "first_value", **by)
    df = windows.window(df, "LAST_VALUE", "value", "last_value", **by)
    df = windows.window(df, "NTH_VALUE", "value", "fifth", offset=5, **by)
    return df.select("event_id", "first_value", "last_value", "fifth")


_AGGREGATES = ("SUM", "AVG", "MIN", "MAX", "COUNT", "STDDEV", "VARIANCE")
_SQL_NAMES = {"STDDEV": "stddev_samp", "VARIANCE": "var_samp"}


def _aggregate_sql(window, column):
    out = []
    for f in _AGGREGATES:
        value = f"{_SQL_NAMES.get(f, f.lower())}({column}) {window}"
        if f in ("AVG", "STDDEV", "VARIANCE"):
            out.append(f"{steady_sql(value)} AS {f.lower()}")
        else:
            out.append(f"round({value}, 2)::DOUBLE AS {f.lower()}")
    return ", ".join(out)


def _aggregates(df, column, **options):
    df = _several(df, _AGGREGATES, column, **options)
    df = rounded(df, 2, "sum", "min", "max", "count")
    return steadied(df, "avg", "stddev", "variance")


@query(
    "win_agg",
    f"""SELECT event_id, {_aggregate_sql("OVER (PARTITION BY user_id)", "value")} FROM events""",
)
def win_agg(t):
    df = _aggregates(t.events, "value", partition_by=["user_id"])
    return df.select("event_id", *[f.lower() for f in _AGGREGATES])


@query(
    "win_agg_running",
    f"""SELECT event_id, {_aggregate_sql(f"OVER (PARTITION BY user_id ORDER BY ts, event_id {_RUN})", "value")}
        FROM events""",
)
def win_agg_running(t):
    df = _aggregates(
        t.events,
        "value",
        partition_by=["user_id"],
        order_by=["ts", "event_id"],
        range_type="RUNNING",
    )
    return df.select("event_id", *[f.lower() for f in _AGGREGATES])


@query(
    "win_agg_hot",
    f"""SELECT event_id, {_aggregate_sql("OVER (PARTITION BY event_type)", "value")},
        round(sum(value) OVER (), 2) AS grand FROM events""",
)
def win_agg_hot(t):
    """Group totals on rows through partial sums and a join, and the grand total."""
    df = _aggregates(t.events, "value", partition_by=["event_type"], split=True)
    df = rounded(windows.window(df, "SUM", "value", "grand"), 2, "grand")
    return df.select("event_id", *[f.lower() for f in _AGGREGATES], "grand")


@query(
    "win_running_split",
    f"""SELECT event_id, {_aggregate_sql(f"OVER (ORDER BY ts, event_id {_RUN})", "value")} FROM events""",
)
def win_running_split(t):
    """Running aggregates over the whole table, bucket by bucket."""
    functions = {f.lower(): f for f in _AGGREGATES}
    df = windows.running_aggregates(t.events, "value", functions, order_by=["ts", "event_id"])
    df = rounded(df, 2, "sum", "min", "max", "count")
    df = steadied(df, "avg", "stddev", "variance")
    return df.select("event_id", *[f.lower() for f in _AGGREGATES])


@query(
    "win_running_hot",
    f"""SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_orderstatus
        ORDER BY o_orderpriority DESC, o_orderkey {_RUN}), 2) AS total FROM orders""",
)
def win_running_hot(t):
    """Three hot groups whose first order key has five values only."""
    df = windows.window(
        t.orders,
        "SUM",
        "o_totalprice",
        "total",
        partition_by=["o_orderstatus"],
        order_by=[["o_orderpriority", "DESC"], "o_orderkey"],
        range_type="RUNNING",
        split=True,
    )
    return rounded(df, 2, "total").select("o_orderkey", "total")


_MOVING = steady_sql(
    """avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""
)


@query(
    "win_moving",
    f"""SELECT event_id, {_MOVING} AS moving,
       round(max(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 2) AS peak
       FROM events""",
)
def win_moving(t):
    order = ["ts", "event_id"]
    df = windows.window(
        t.events, "AVG", "value", "moving", partition_by=["user_id"], order_by=order, rows=7
    )
    df = windows.window(df, "MAX", "value", "peak", order_by=order, rows=10)
    return rounded(steadied(df, "moving"), 2, "peak").select("event_id", "moving", "peak")


@query(
    "win_group_reset",
    f"""SELECT event_id, round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END)
        OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id {_RUN}), 2) AS spent_today
        FROM events""",
)
def win_group_reset(t):
    from sluice.operators import date_ops

    bought = Condition("event_type", "EQ", "purchase")
    df = values.set_values(t.events, [Value(0)], "spent", column_type="NUMERIC")
    df = values.math(df, "value", existing_column="spent", condition=bought)
    df = date_ops.extract_date(df, "ts", "year_month_day_as_date", "day")
    df = windows.window(
        df,
        "SUM",
        "spent",
        "spent_today",
        partition_by=["user_id", "day"],
        order_by=["ts", "event_id"],
        range_type="RUNNING",
    )
    return rounded(df, 2, "spent_today").select("event_id", "spent_today")


@query(
    "win_topn",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (
       PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
)
def win_topn(t):
    return windows.top_per_group(
        t.orders, 3, ["o_custkey"], [["o_totalprice", "DESC"], "o_orderkey"]
    ).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "win_growth",
    f"""WITH m AS (SELECT date_trunc('month', o_orderdate) AS period, sum(o_totalprice) AS total
         FROM orders GROUP BY 1)
       SELECT period, round(total, 2) AS total, round(lag(total) OVER (ORDER BY period), 2) AS previous,
         {steady_sql("(total - lag(total) OVER (ORDER BY period)) / lag(total) OVER (ORDER BY period) * 100", 3)}
           AS growth_pct FROM m""",
)
def win_growth(t):
    df = windows.growth(t.orders, "o_orderdate", "o_totalprice", "month", digits=9)
    return steadied(rounded(df, 2, "total", "previous"), "growth_pct", digits=3)


@query(
    "win_cohort",
    """WITH firsts AS (SELECT o_custkey, min(date_trunc('month', o_orderdate)) AS cohort
         FROM orders GROUP BY 1)
       SELECT cohort, CAST(date_diff('month', cohort, date_trunc('month', o_orderdate)) AS DOUBLE) AS period_offset,
         count(DISTINCT o_custkey) AS active
       FROM orders JOIN firsts USING (o_custkey) GROUP BY 1, 2""",
)
def win_cohort(t):
    return windows.cohorts(t.orders, "o_custkey", "o_orderdate")


@query(
    "win_rfm",
    """SELECT o_custkey, CAST(date_diff('day', max(o_orderdate), TIMESTAMP '2001-12-31') AS DOUBLE) AS recency,
       count(*) AS frequency, round(sum(o_totalprice), 2) AS monetary,
       CASE WHEN count(*) >= 12 AND sum(o_totalprice) >= 3000000 THEN 'VIP'
            WHEN date_diff('day', max(o_orderdate), TIMESTAMP '2001-12-31') > 700 THEN 'Lapsed'
            ELSE 'Regular' END AS segment FROM orders GROUP BY o_custkey""",
)
def win_rfm(t):
    df = windows.recency_frequency_monetary(
        t.orders, "o_custkey", "o_orderdate", "o_totalprice", "2001-12-31"
    )
    vip = Condition("frequency", "GTE", 12) & Condition("monetary", "GTE", 3000000)
    lapsed = Condition("recency", "GT", 700)
    df = values.set_values(
        df, [Value("VIP", vip), Value("Lapsed", lapsed), Value("Regular")], "segment"
    )
    return rounded(df, 2, "monetary")
