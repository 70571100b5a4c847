"""Aggregates, crosstabs, profiles and checks of keys."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query, steadied, steady_sql
from sluice.functions.conditions import Condition
from sluice.operators import aggregate, quality
from sluice.operators.aggregate import Aggregation, Cell


def rounded(df, digits, *names):
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


@query(
    "agg_sum_avg_min_max",
    f"""SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS total,
       {steady_sql("avg(l_quantity)")} AS mean, min(l_shipdate) AS first_ship, max(l_discount) AS most
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY ALL""",
)
def agg_sum_avg_min_max(t):
    df = aggregate.pivot(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        [
            Aggregation("l_extendedprice", "SUM", "total"),
            Aggregation("l_quantity", "AVG", "mean"),
            Aggregation("l_shipdate", "MIN", "first_ship"),
            Aggregation("l_discount", "MAX", "most"),
        ],
        condition=Condition("l_shipdate", "GTE", "1996-01-01"),
    )
    return steadied(rounded(df, 2, "total"), "mean")


@query(
    "agg_count",
    """SELECT lang, count(quality) AS "COUNT_quality", count(doc_id) AS "COUNT_doc_id"
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""",
)
def agg_count(t):
    df = t.documents.join(t.labels, "doc_id", "left")
    return aggregate.pivot(
        df, ["lang"], [Aggregation("quality", "COUNT"), Aggregation("doc_id", "COUNT")]
    )


@query(
    "agg_count_distinct",
    """SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type""",
)
def agg_count_distinct(t):
    return aggregate.pivot(
        t.events, ["event_type"], [Aggregation("user_id", "COUNT_DISTINCT", "users")]
    )


@query(
    "agg_null_group",
    """SELECT quality, count(doc_id) AS docs, sum(n_chars)::BIGINT AS chars
       FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality""",
)
def agg_null_group(t):
    df = t.documents.join(t.labels, "doc_id", "left")
    return aggregate.pivot(
        df,
        ["quality"],
        [Aggregation("doc_id", "COUNT", "docs"), Aggregation("n_chars", "SUM", "chars")],
    )


@query(
    "agg_stddev_variance",
    f"""SELECT o_orderpriority, {steady_sql("stddev_samp(o_totalprice)", 3)} AS sd,
       {steady_sql("var_samp(o_totalprice) / 1000000", 3)} AS var FROM orders GROUP BY o_orderpriority""",
)
def agg_stddev_variance(t):
    df = aggregate.pivot(
        t.orders,
        ["o_orderpriority"],
        [
            Aggregation("o_totalprice", "STDDEV", "sd"),
            Aggregation("o_totalprice", "VARIANCE", "var"),
        ],
    )
    return steadied(df.withColumn("var", F.col("var") / 1000000), "sd", "var", digits=3)


@query(
    "agg_median",
    """SELECT l_returnflag, round(median(l_extendedprice), 3) AS mid, count(l_tax) AS n
       FROM lineitem GROUP BY l_returnflag""",
)
def agg_median(t):
    df = aggregate.pivot(
        t.lineitem,
        ["l_returnflag"],
        [Aggregation("l_extendedprice", "MEDIAN", "mid"), Aggregation("l_tax", "COUNT", "n")],
    )
    return rounded(df, 3, "mid")


@query(
    "agg_median_split",
    """SELECT l_linestatus, round(median(l_extendedprice), 3) AS mid, round(median(l_quantity), 3) AS qty,
       round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY l_linestatus""",
)
def agg_median_split(t):
    """Medians of hot groups by rank, next to ordinary aggregates."""
    df = aggregate.pivot(
        t.lineitem,
        ["l_linestatus"],
        [
            Aggregation("l_extendedprice", "MEDIAN", "mid"),
            Aggregation("l_quantity", "MEDIAN", "qty"),
            Aggregation("l_quantity", "SUM", "total"),
        ],
        split=True,
    )
    return rounded(rounded(df, 3, "mid", "qty"), 2, "total")


@query(
    "agg_first_last",
    """SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_event,
       arg_max(event_type, (ts, event_id)) AS last_event FROM events GROUP BY user_id""",
)
def agg_first_last(t):
    return aggregate.pivot(
        t.events,
        ["user_id"],
        [
            Aggregation("event_type", "FIRST", "first_event"),
            Aggregation("event_type", "LAST", "last_event"),
        ],
        order_by=["ts", "event_id"],
    )


@query(
    "agg_concat",
    """SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names,
       string_agg(CAST(n_nationkey AS VARCHAR), '|' ORDER BY CAST(n_nationkey AS VARCHAR)) AS keys
       FROM nation GROUP BY n_regionkey""",
)
def agg_concat(t):
    return aggregate.pivot(
        t.nation,
        ["n_regionkey"],
        [
            Aggregation("n_name", "CONCAT", "names"),
            Aggregation("n_nationkey", "CONCAT", "keys", delimiter="|"),
        ],
    )


@query(
    "agg_conditional",
    """SELECT o_orderpriority, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS done,
       count(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS pending FROM orders GROUP BY 1""",
)
def agg_conditional(t):
    df = aggregate.pivot(
        t.orders,
        ["o_orderpriority"],
        [
            Aggregation("o_totalprice", "SUM", "done", None, Condition("o_orderstatus", "EQ", "F")),
            Aggregation("o_orderkey", "COUNT", "pending", None, Condition("o_orderstatus", "EQ", "P")),
        ],
    )
    return rounded(df, 2, "done")


@query(
    "agg_categories",
    f"""SELECT c_mktsegment, {steady_sql("sum(c_acctbal) / count(c_custkey)")} AS per_customer,
       count(CASE WHEN c_acctbal < 0 THEN 1 END) AS in_debt, count(c_custkey) AS customers,
       round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment""",
)
def agg_categories(t):
    """Category aggregates plus a column derived from the results."""
    df = aggregate.pivot(
        t.customer,
        ["c_mktsegment"],
        [
            Aggregation("c_acctbal", "SUM", "balance"),
            Aggregation("c_custkey", "COUNT", "customers"),
            Aggregation("c_custkey", "COUNT", "in_debt", None, Condition("c_acctbal", "LT", 0)),
        ],
        derived={"per_customer": "balance / customers"},
    )
    return rounded(steadied(df, "per_customer"), 2, "balance")


@query(
    "agg_percentile",
    """SELECT l_shipmode, round(p95, 3) AS p95 FROM (SELECT l_returnflag AS l_shipmode,
       quantile_cont(l_extendedprice, 0.95) AS p95 FROM lineitem GROUP BY l_returnflag)""",
)
def agg_percentile(t):
    df = t.lineitem.withColumnRenamed("l_returnflag", "l_shipmode")
    return rounded(
        aggregate.percentile(df, "l_extendedprice", 0.95, ["l_shipmode"], "p95"), 3, "p95"
    )


@query(
    "agg_having",
    """SELECT o_custkey, count(o_orderkey) AS orders, round(sum(o_totalprice), 2) AS spent FROM orders
       GROUP BY o_custkey HAVING count(o_orderkey) >= 12 AND sum(o_totalprice) > 3000000""",
)
def agg_having(t):
    df = aggregate.pivot(
        t.orders,
        ["o_custkey"],
        [
            Aggregation("o_orderkey", "COUNT", "orders"),
            Aggregation("o_totalprice", "SUM", "spent"),
        ],
        having=Condition("orders", "GTE", 12) & Condition("spent", "GT", 3000000),
    )
    return rounded(df, 2, "spent")


@query(
    "metric", "SELECT round(sum(l_extendedprice * l_discount), 2) AS lost FROM lineitem"
)
def metric(t):
    return aggregate.metric(t.lineitem, "round(sum(l_extendedprice * l_discount), 2)", "lost")


@query(
    "crosstab",
    """SELECT o_orderpriority, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS "F",
       round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS "O",
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS "P"
       FROM orders WHERE o_totalprice > 1000 GROUP BY o_orderpriority""",
)
def crosstab(t):
    df = aggregate.crosstab(
        t.orders,
        ["o_orderpriority"],
        "o_orderstatus",
        Cell("SUM", "o_totalprice"),
        condition=Condition("o_totalprice", "GT", 1000),
    )
    return rounded(df, 2, "F", "O", "P")


@query(
    "crosstab_multi",
    "SELECT l_returnflag, "
    + ", ".join(
        f"count(CASE WHEN l_linestatus = '{s}' THEN 1 END) AS \"{s}_COUNT\", "
        f"{steady_sql(f"avg(CASE WHEN l_linestatus = '{s}' THEN l_quantity END)")} AS \"{s}_AVG_l_quantity\""
        for s in ("F", "O")
    )
    + " FROM lineitem GROUP BY l_returnflag",
)
def crosstab_multi(t):
    df = aggregate.crosstab(
        t.lineitem,
        ["l_returnflag"],
        "l_linestatus",
        [Cell("COUNT"), Cell("AVG", "l_quantity")],
        values=["F", "O"],
    )
    return steadied(df, "F_AVG_l_quantity", "O_AVG_l_quantity")


def _profile_sql(table, kinds):
    parts, tops = [], []
    for name, kind in kinds.items():
        text = {
            "DATE": f"strftime({{}}({name}), '%Y-%m-%d %H:%M:%S')",
            "NUMERIC": f"CAST({{}}({name}) AS VARCHAR)",
            "TEXT": f"{{}}({name})",
        }[kind]
        value = text.replace("{}", "")
        number = kind == "NUMERIC"
        parts.append(
            f"""SELECT '{name}' AS "column", '{kind}' AS kind, count(*) AS rows,
            count(*) - count({name}) AS nulls, count(DISTINCT {name}) AS distinct_values,
            {text.format("min")} AS min, {text.format("max")} AS max,
            {steady_sql(f"avg({name})") if number else "CAST(NULL AS DOUBLE)"} AS mean,
            {steady_sql(f"stddev_samp({name})") if number else "CAST(NULL AS DOUBLE)"} AS stddev,
            round((count(*) - count({name})) * 100.0 / count(*), 2)::DOUBLE AS null_pct FROM {table}"""
        )
        tops.append(
            f"""SELECT '{name}' AS "column", string_agg(v || ' (' || n || ')', ', ' ORDER BY n DESC, v) AS top_values
            FROM (SELECT {value} AS v, count(*) AS n FROM {table} WHERE {name} IS NOT NULL GROUP BY 1
                  ORDER BY n DESC, v LIMIT 5)"""
        )
    return (
        f'SELECT * FROM ({" UNION ALL ".join(parts)}) JOIN ({" UNION ALL ".join(tops)}) USING ("column")'
    )


@query(
    "profile",
    _profile_sql(
        "orders",
        {
            "o_orderkey": "NUMERIC",
            "o_custkey": "NUMERIC",
            "o_orderstatus": "TEXT",
            "o_totalprice": "NUMERIC",
            "o_orderdate": "DATE",
            "o_orderpriority": "TEXT",
        },
    ),
)
def profile(t):
    return steadied(quality.profile(t.orders, exact=True), "mean", "stddev")


_FREQUENT = ("l_returnflag", "l_linenumber", "l_quantity", "l_discount", "l_suppkey")


@query(
    "profile_frequent",
    "WITH "
    + ", ".join(
        f"""t{i} AS (SELECT '{c}' AS "column", {c} AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY ALL)""" for i, c in enumerate(_FREQUENT)
    )
    + ", every AS ("
    + " UNION ALL ".join(f'SELECT "column", v::VARCHAR AS v, n FROM t{i}' for i in range(len(_FREQUENT)))
    + """), ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, v) AS place FROM every)
       SELECT "column", string_agg(v || ' (' || n || ')', ', ' ORDER BY place) AS top_values FROM ranked WHERE place <= 3 GROUP BY ALL""",
)
def profile_frequent(t):
    """Columns with fewer values than a sketch holds: their lists are those of an exact count."""
    return quality.frequent_values(t.lineitem, _FREQUENT, 3).select("column", "top_values")


@query("profile_sketched")
def profile_sketched(t):
    return quality.profile(t.lineitem)


@query(
    "summary_derivative",
    f"""SELECT lang, count(doc_id) AS docs, {steady_sql("avg(n_chars)")} AS mean FROM documents
       WHERE ('0x' || left(md5('0|' || doc_id), 8))::BIGINT < floor(0.5 * 4294967296) GROUP BY lang""",
)
def summary_derivative(t):
    """An aggregate over a repeatable sample of the rows."""
    sampled = aggregate.sample_rows(t.documents, 0.5, ["doc_id"])
    df = aggregate.pivot(
        sampled,
        ["lang"],
        [Aggregation("doc_id", "COUNT", "docs"), Aggregation("n_chars", "AVG", "mean")],
    )
    return steadied(df, "mean")


@query(
    "join_key_quality",
    """WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
       r AS (SELECT o_orderkey AS k, count(*) AS n FROM orders GROUP BY 1),
       m AS (SELECT l.n AS ln, r.n AS rn FROM l JOIN r ON l.k = r.k)
       SELECT (SELECT sum(n) FROM l)::BIGINT AS left_rows, (SELECT sum(n) FROM r)::BIGINT AS right_rows,
         (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL) AS left_nulls,
         (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS right_nulls,
         (SELECT count(k) FROM l) AS left_keys, (SELECT count(k) FROM r) AS right_keys,
         (SELECT count(*) FROM m) AS matched_keys, (SELECT max(n) FROM l) AS left_most_per_key,
         (SELECT max(n) FROM r) AS right_most_per_key,
         (SELECT sum(ln * rn) FROM m)::BIGINT AS inner_join_rows""",
)
def join_key_quality(t):
    return quality.join_key_quality(t.lineitem, t.orders, "l_orderkey", "o_orderkey")
