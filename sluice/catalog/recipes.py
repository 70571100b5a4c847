"""SQL steps, recipes, checkpoints, parameters and governance."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import quality, sql
from sluice.operators.aggregate import Aggregation
from sluice.operators.quality import Check, Widget
from sluice.plans.recipe import Recipe
from sluice.session import scratch_path

_SPENDERS = """WITH spent AS (SELECT o_custkey AS "Customer", SUM(o_totalprice) AS total, COUNT(*) AS n
    FROM {table} GROUP BY o_custkey HAVING COUNT(*) > 5)
  SELECT "Customer", round(total, 2) AS total, n, CASE WHEN total > 2500000 THEN 'big' ELSE 'small' END AS size
  FROM spent WHERE total > (SELECT AVG(total) FROM spent)
  UNION ALL SELECT c_custkey, 0.0, 0, 'none' FROM {other}
  WHERE NOT EXISTS (SELECT 1 FROM {table} o WHERE o.o_custkey = c_custkey)"""


@query("sql_query", _SPENDERS.format(table="orders", other="customer"))
def sql_query(t):
    text = _SPENDERS.format(table="dataview", other="customer")
    return sql.sql_query(t.orders, text, tables={"customer": t.customer})


@query(
    "sql_functions",
    r"""SELECT "o_orderkey", o_orderpriority || '/' || o_orderstatus AS tag,
        split_part(o_orderpriority, '-', 2) AS word, strftime(o_orderdate, '%Y-%m-%d') AS day,
        regexp_matches(o_orderpriority, '^[12]') AS urgent, o_orderpriority ILIKE '%high%' AS high,
        date_trunc('month', o_orderdate)::TIMESTAMP AS month, extract(year FROM o_orderdate)::BIGINT AS y,
        coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status, o_custkey::VARCHAR AS customer
        FROM orders""",
)
def sql_functions(t):
    df = sql.sql_query(
        t.orders,
        r"""SELECT "o_orderkey", o_orderpriority || '/' || o_orderstatus AS tag,
        split_part(o_orderpriority, '-', 2) AS word, strftime(o_orderdate, '%Y-%m-%d') AS day,
        regexp_matches(o_orderpriority, '^[12]') AS urgent, o_orderpriority ILIKE '%high%' AS high,
        date_trunc('month', o_orderdate) AS month, extract(year FROM o_orderdate)::BIGINT AS y,
        coalesce(nullif(o_orderstatus, 'P'), 'pending') AS status, o_custkey::STRING AS customer
        FROM this""",
    )
    return df.withColumn("month", F.col("month").cast("timestamp_ntz"))


_STRINGS = """SELECT page_id, upper(left(url, 5)) AS head, lower(trim('  ' || url)) AS low,
    regexp_extract(url, '://([^/]+)', 1) AS host, split_part(url, '/', 4) AS lang,
    substring(url, 3, 4) AS part, replace(url, 'http', 'x') AS short, concat(page_id, '-', 'p') AS tag,
    url LIKE 'https%' AS secure, url ILIKE '%EXAMPLE.ORG%' AS org, rtrim(ltrim(' a ')) AS a,
    CASE WHEN regexp_matches(url, '[?]') THEN 'query' ELSE coalesce(nullif(split_part(url, '#', 2), ''), 'none')
    END AS extra FROM {table}"""


@query("sql_strings", _STRINGS.format(table="pages"))
def sql_strings(t):
    return sql.sql_query(t.pages, _STRINGS.format(table="dataview"))


@query(
    "sql_aggregates",
    """SELECT r.n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names, count(DISTINCT n_name) AS n,
       (SELECT median(o_totalprice) FROM orders) AS mid,
       (SELECT round(quantile_cont(o_totalprice, 0.95), 2) FROM orders) AS p95
       FROM nation r GROUP BY r.n_regionkey""",
)
def sql_aggregates(t):
    return sql.sql_query(
        t.nation,
        """SELECT r.n_regionkey, string_agg(n_name, ', ') WITHIN GROUP (ORDER BY n_name) AS names,
           count(DISTINCT n_name) AS n, (SELECT median(o_totalprice) FROM orders) AS mid,
           (SELECT round(percentile_cont(0.95) WITHIN GROUP (ORDER BY o_totalprice), 2) FROM orders) AS p95
           FROM dataview r GROUP BY r.n_regionkey""",
        tables={"orders": t.orders},
    )


_RANKED = """WITH ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn,
      LAG(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before,
      NTILE(10) OVER (PARTITION BY event_type ORDER BY value, event_id) AS decile
    FROM {table})
  SELECT event_id, user_id, before, decile FROM ranked WHERE rn <= 5
  EXCEPT SELECT event_id, user_id, before, decile FROM ranked WHERE event_type = 'error'"""


@query("sql_windows", _RANKED.format(table="events"))
def sql_windows(t):
    return sql.sql_query(t.events, _RANKED.format(table="dataview"))


@query(
    "sql_date_gaps",
    """WITH days AS (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day
         FROM orders)
       SELECT day::TIMESTAMP AS day, count(o_orderkey) AS n FROM days LEFT JOIN orders ON o_orderdate = day
       GROUP BY day""",
)
def sql_date_gaps(t):
    return sql.sql_query(
        t.orders,
        """WITH days AS (SELECT explode(sequence(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS day
             FROM dataview)
           SELECT day, count(o_orderkey) AS n FROM days LEFT JOIN dataview ON o_orderdate = day GROUP BY day""",
    )


@query(
    "sql_grouping_sets",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
       GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
)
def sql_grouping_sets(t):
    return sql.sql_query(
        t.orders,
        """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM dataview
       GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())""",
    )


@query(
    "adhoc_query",
    """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def adhoc_query(t):
    return sql.sql_query(
        t.customer,
        """SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
       JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
        tables={"customer": t.customer, "nation": t.nation},
    )


@query(
    "snippet",
    """SELECT l_returnflag, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY l_returnflag""",
)
def snippet(t):
    stored = {"net": "l_extendedprice * {keep}", "keep": "1 - l_discount"}
    text = """SELECT l_returnflag, round(sum({net}), 2) AS net FROM dataview
              WHERE l_shipdate >= :since GROUP BY l_returnflag"""
    return sql.sql_query(t.lineitem, text, {"since": "1997-01-01"}, stored)


def _flagship() -> Recipe:
    """Revenue by market segment, labelled and ranked."""
    recent = Condition("o_orderdate", "GTE", "1998-01-01")
    return (
        Recipe()
        .add(
            "join",
            other={"view": "orders"},
            on=[["l_orderkey", "o_orderkey"]],
            join_type="INNER",
            select=["o_orderdate", "o_custkey"],
        )
        .add("filter_rows", condition=recent)
        .add(
            "join",
            other={"view": "customer"},
            on=[["o_custkey", "c_custkey"]],
            join_type="INNER",
            select=["c_mktsegment"],
        )
        .add("math", expression="l_extendedprice * (1 - l_discount)", new_column="revenue")
        .add(
            "pivot",
            group_by=["c_mktsegment"],
            aggregations=[
                Aggregation("revenue", "SUM", "revenue"),
                Aggregation("l_orderkey", "COUNT", "lines"),
            ],
        )
        .add(
            "set_values",
            values=[
                {"value": "high", "condition": Condition("lines", "GTE", 6500)},
                {"value": "normal"},
            ],
            new_column="tier",
        )
        .add("limit_rows", n=3, order_by=[["revenue", "DESC"]])
    )


_FLAGSHIP_SQL = """SELECT c_mktsegment, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
    count(*) AS lines, CASE WHEN count(*) >= 6500 THEN 'high' ELSE 'normal' END AS tier
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY c_mktsegment"""


@query(
    "revenue_by_segment",
    f"SELECT * FROM ({_FLAGSHIP_SQL}) ORDER BY revenue DESC LIMIT 3",
)
def revenue_by_segment(t):
    tables = {"orders": t.orders, "customer": t.customer}
    return _flagship().apply(t.lineitem, tables).withColumn("revenue", F.round("revenue", 2))


@query("steps_at", _FLAGSHIP_SQL)
def steps_at(t):
    """The same recipe read as of the step before the limit."""
    tables = {"orders": t.orders, "customer": t.customer}
    df = _flagship().at(6).apply(t.lineitem, tables)
    return df.withColumn("revenue", F.round("revenue", 2))


@query("steps_edit", _FLAGSHIP_SQL)
def steps_edit(t):
    """Saved as JSON, loaded, the limit deleted and the label step replaced."""
    loaded = Recipe.from_json(_flagship().to_json()).delete(7).delete(6)
    edited = loaded.add(
        "set_values",
        values=[
            {"value": "normal", "condition": Condition("lines", "LT", 6500)},
            {"value": "high"},
        ],
        new_column="tier",
    )
    tables = {"orders": t.orders, "customer": t.customer}
    return edited.apply(t.lineitem, tables).withColumn("revenue", F.round("revenue", 2))


def _cleaning() -> Recipe:
    """Fifteen steps of column work, filters and a summary over orders."""
    late = Condition("o_orderstatus", "EQ", "P")
    return (
        Recipe(parameters={"rate": "NUMERIC", "cut": "DATE"})
        .add("copy_columns", copies=[{"source": "o_orderpriority", "as_name": "priority"}])
        .add("split_column", column="priority", delimiter="-", new_columns=["code", "word"])
        .add("convert_type", conversions=[{"column": "code", "to": "NUMERIC"}])
        .add("text_transform", columns=["word"], case="LOWER", trim=True)
        .add("replace_values", columns=["word"], find="not specified", replace="none")
        .add("add_column", name="rate", column_type="NUMERIC", default="$rate")
        .add("math", expression="o_totalprice * rate", new_column="fee")
        .add("math", expression="fee + code", new_column="score")
        .add(
            "set_values",
            values=[{"value": "late", "condition": late}, {"value": "ok"}],
            new_column="state",
        )
        .add("extract_date", column="o_orderdate", component="year", new_column="year")
        .add(
            "filter_rows",
            condition={"column": "o_orderdate", "operator": "GTE", "value": "$cut"},
        )
        .add("increment_date", column="o_orderdate", delta={"days": 30}, new_column="due")
        .add("date_diff", unit="DAY", start="o_orderdate", end="due", new_column="days")
        .add("delete_columns", columns=["priority", "rate"])
        .add(
            "pivot",
            group_by=["year", "word", "state"],
            aggregations=[
                Aggregation("score", "SUM", "score"),
                Aggregation("days", "MAX", "days"),
                Aggregation("o_orderkey", "COUNT", "n"),
            ],
        )
    )


_CLEANING_SQL = """SELECT CAST(year(o_orderdate) AS DOUBLE) AS year,
    replace(lower(split_part(o_orderpriority, '-', 2)), 'not specified', 'none') AS word,
    CASE WHEN o_orderstatus = 'P' THEN 'late' ELSE 'ok' END AS state,
    round(sum(o_totalprice * 0.25 + CAST(left(o_orderpriority, 1) AS DOUBLE)), 3) AS score,
    30.0::DOUBLE AS days, count(*) AS n
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01' GROUP BY 1, 2, 3"""
_GIVEN = {"rate": 0.25, "cut": "1997-06-01"}


@query("parameterize", _CLEANING_SQL)
def parameterize(t):
    return _cleaning().apply(t.orders, params=_GIVEN).withColumn("score", F.round("score", 3))


@query("steps_checkpoint", _CLEANING_SQL)
def steps_checkpoint(t):
    """The second run starts from what the first one wrote after step 13."""
    folder = scratch_path(t.spark, "checkpoints")
    _cleaning().at(13).checkpointed(t.orders, folder, t.folder, every=[13], params=_GIVEN)
    df = _cleaning().checkpointed(t.orders, folder, t.folder, every=[13], params=_GIVEN)
    return df.withColumn("score", F.round("score", 3))


def _checks(t):
    return [
        Check("language known", "in_set", "lang", values=["en", "de", "fr"]),
        Check("text unique", "unique", "text"),
        Check("not short", "range", "n_chars", low=200),
        Check("has letters", "regex", "text", pattern="[A-Za-z]"),
        Check("labelled", "reference", "doc_id", reference=t.labels),
        Check("source given", "not_null", "source"),
        Check("no marker", "condition", condition=Condition("text", "NOT_CONTAINS", "http")),
        Check("enough rows", "row_count", low=10),
    ]


_FAILED = {
    "language known": "lang NOT IN ('en', 'de', 'fr')",
    "text unique": "count(*) OVER (PARTITION BY text) > 1",
    "not short": "n_chars < 200",
    "has letters": "NOT regexp_matches(text, '[A-Za-z]')",
    "labelled": "doc_id NOT IN (SELECT doc_id FROM labels)",
    "source given": "source IS NULL OR trim(source) = ''",
    "no marker": "contains(text, 'http')",
}


@query(
    "data_checks",
    "SELECT doc_id, failed_checks FROM (SELECT doc_id, concat_ws(', ', "
    + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in _FAILED.items())
    + ") AS failed_checks FROM documents) WHERE failed_checks <> ''",
)
def data_checks(t):
    return quality.flag_rows(t.documents, _checks(t)).select("doc_id", "failed_checks")


@query(
    "data_checks_summary",
    "WITH f AS (SELECT "
    + ", ".join(f"{test} AS c{i}" for i, test in enumerate(_FAILED.values()))
    + " FROM documents) "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS \"check\", count(*) AS rows, count(*) FILTER (c{i}) AS failed, "
        f"count(*) FILTER (c{i}) = 0 AS passed FROM f"
        for i, name in enumerate(_FAILED)
    )
    + " UNION ALL SELECT 'enough rows', count(*), 0, true FROM f",
)
def data_checks_summary(t):
    return quality.check_summary(t.documents, _checks(t))


@query(
    "conditional_format",
    """SELECT o_orderkey, concat_ws(', ', CASE WHEN o_totalprice > 400000 THEN 'o_totalprice:red' END,
       CASE WHEN o_orderstatus = 'P' THEN 'o_orderstatus:bold' END) AS format_tags FROM orders""",
)
def conditional_format(t):
    rules = [
        ("red", "o_totalprice", Condition("o_totalprice", "GT", 400000)),
        ("bold", "o_orderstatus", Condition("o_orderstatus", "EQ", "P")),
    ]
    return quality.conditional_format(t.orders, rules).select("o_orderkey", "format_tags")


def _assignments(t):
    """Each supplier may see the customers of its nation; rich suppliers see all."""
    return t.supplier.select(
        F.col("s_name").alias("viewer"),
        F.col("s_nationkey").alias("value"),
        (F.col("s_acctbal") > 9000).alias("all_access"),
    )


@query(
    "row_level_security",
    """SELECT c.*, s_name AS seen_by FROM customer c JOIN supplier s
       ON s_name = 'Supplier#000000003' AND (s_nationkey = c_nationkey OR s_acctbal > 9000)
       UNION ALL SELECT c.*, 'all' FROM customer c
       WHERE (SELECT max(s_acctbal) FROM supplier) > 9000
         OR c_nationkey IN (SELECT s_nationkey FROM supplier)""",
)
def row_level_security(t):
    one = quality.row_level_security(
        t.customer, "c_nationkey", "Supplier#000000003", _assignments(t)
    )
    everyone = _assignments(t).withColumn("viewer", F.lit("all"))
    every = quality.row_level_security(t.customer, "c_nationkey", "all", everyone)
    return one.withColumn("seen_by", F.lit("Supplier#000000003")).union(
        every.withColumn("seen_by", F.lit("all"))
    )


@query("distinct_values", "SELECT DISTINCT c_nationkey FROM customer")
def distinct_values(t):
    return quality.distinct_values(t.customer, "c_nationkey")


@query(
    "widget_data",
    """SELECT 'status' AS widget, o_orderstatus AS label, round(sum(o_totalprice), 2) AS amount FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice > 5000 GROUP BY ALL
       UNION ALL SELECT 'urgent', o_orderpriority, count(o_orderkey)::DOUBLE FROM orders
       WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_totalprice > 5000
       AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL""",
)
def widget_data(t):
    urgent = Condition("o_orderpriority", "IN_LIST", ["1-URGENT", "2-HIGH"])
    data = quality.widget_data(
        t.orders,
        {
            "status": Widget(["o_orderstatus"], [Aggregation("o_totalprice", "SUM", "amount")]),
            "urgent": Widget(
                ["o_orderpriority"], [Aggregation("o_orderkey", "COUNT", "amount")], urgent
            ),
        },
        [
            Condition("o_orderdate", "GTE", "1998-01-01"),
            {"column": "o_totalprice", "operator": "GT", "value": 5000},
        ],
    )
    out = None
    for name, table in data.items():
        row = table.select(
            F.lit(name).alias("widget"),
            F.col(table.columns[0]).alias("label"),
            F.round(F.col("amount").cast("double"), 2).alias("amount"),
        )
        out = row if out is None else out.union(row)
    return out


_STAMPS = "%a %A %b %B %d %-d %f %G %H %-H %I %j %-j %m %-m %M %p %S %u %U %V %w %W %x %X %y %Y 100%% at"


@query(
    "sql_strftime",
    f"SELECT event_id, strftime(ts, '{_STAMPS}') AS stamp, strftime(ts, '%Y at %H') AS hour FROM events",
)
def sql_strftime(t):
    """Every specifier, with text between them."""
    return sql.sql_query(
        t.events, f"SELECT event_id, strftime(ts, '{_STAMPS}') AS stamp, strftime(ts, '%Y at %H') AS hour FROM this"
    )


_UNITS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")
_DIFFERENCES = ", ".join(f"date_diff('{u}', ts, TIMESTAMP '2025-03-01 00:00:30') AS {u}s" for u in _UNITS)


@query("sql_date_diff", f"SELECT event_id, {_DIFFERENCES} FROM events")
def sql_date_diff(t):
    """Units in quotes count the boundaries between two moments."""
    return sql.sql_query(t.events, f"SELECT event_id, {_DIFFERENCES} FROM this")
