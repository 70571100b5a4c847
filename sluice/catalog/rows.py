"""Sorting, limiting, de-duplicating, filling and reshaping rows."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import columns, rows, similar, values, windows
from sluice.operators.values import Value

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("sort", "SELECT * FROM orders ORDER BY o_orderpriority DESC, o_totalprice, o_orderkey")
def sort(t):
    return rows.sort(t.orders, [["o_orderpriority", "DESC"], "o_totalprice", "o_orderkey"])


@query(
    "limit_top", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100"
)
def limit_top(t):
    return rows.limit_rows(t.orders, 100, order_by=[["o_totalprice", "DESC"], "o_orderkey"])


@query(
    "limit_bottom",
    """SELECT * FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 50)
       ORDER BY o_orderdate, o_orderkey""",
)
def limit_bottom(t):
    return rows.limit_rows(t.orders, 50, bottom=True, order_by=["o_orderdate", "o_orderkey"])


@query(
    "page",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
       ORDER BY o_totalprice DESC, o_orderkey LIMIT 400 OFFSET 100""",
)
def page(t):
    return rows.page(
        t.orders,
        offset=101,
        columns=["o_orderkey", "o_totalprice"],
        condition=Condition("o_orderstatus", "EQ", "O"),
        order_by=[["o_totalprice", "DESC"], "o_orderkey"],
    )


@query(
    "preview",
    """SELECT o_orderkey, o_custkey, upper(o_orderstatus) AS o_orderstatus FROM orders
       ORDER BY o_orderkey LIMIT 10""",
)
def preview(t):
    return rows.preview(rows.sort(t.orders, ["o_orderkey"]), rows=10, columns=3)


@query(
    "discard_duplicates", "SELECT DISTINCT text, lang FROM documents"
)
def discard_duplicates(t):
    return rows.discard_duplicates(t.documents.select("text", "lang"))


@query(
    "discard_duplicates_ignoring",
    """SELECT doc_id, text, lang, source FROM documents
       QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1""",
)
def discard_duplicates_ignoring(t):
    return rows.discard_duplicates(
        t.documents.select("doc_id", "text", "lang", "source"), ["doc_id", "source"]
    )


@query(
    "dedupe_latest",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def dedupe_latest(t):
    return rows.dedupe_latest(t.events, ["user_id", "event_type"], [["ts", "DESC"], "event_id"])


@query(
    "dedupe_fuzzy",
    """WITH RECURSIVE named AS (SELECT p_partkey, p_name, trim(p_name) AS v FROM part),
       vals AS (SELECT DISTINCT v FROM named),
       near AS (SELECT a.v AS a, b.v AS b FROM vals a JOIN vals b
                ON a.v <> b.v AND levenshtein(a.v, b.v) <= 2
                AND 1 - levenshtein(a.v, b.v) / greatest(length(a.v), length(b.v)) >= 0.8),
       reach(a, b) AS (SELECT v, v FROM vals UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
       label AS (SELECT a AS v, min(b) AS g FROM reach GROUP BY a)
       SELECT p_partkey, p_name FROM named JOIN label USING (v)
       QUALIFY row_number() OVER (PARTITION BY g ORDER BY p_partkey) = 1""",
)
def dedupe_fuzzy(t):
    return similar.dedupe_fuzzy(
        t.part, ["p_name"], ["p_partkey"], max_edits=2, min_similarity=0.8
    ).select("p_partkey", "p_name")


def _gappy(t):
    """Events whose value is missing for two of the event types."""
    seen = Condition("event_type", "NOT_IN_LIST", ["view", "click"])
    df = columns.copy_columns(t.events, [columns.Copy("value", "filled", "NUMERIC", seen)])
    return df.select("event_id", "ts", "user_id", "event_type", "filled")


_GAPPY = """SELECT event_id, ts, user_id, event_type,
    CASE WHEN event_type NOT IN ('view', 'click') THEN value END AS filled FROM events"""


@query(
    "fill_missing",
    f"""SELECT event_id, ts, user_id, event_type, last_value(filled IGNORE NULLS) OVER (ORDER BY ts, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM ({_GAPPY})""",
)
def fill_missing(t):
    return windows.fill_missing(_gappy(t), "filled", order_by=["ts", "event_id"])


@query(
    "fill_missing_up",
    f"""SELECT event_id, ts, user_id, event_type, first_value(filled IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled FROM ({_GAPPY})""",
)
def fill_missing_up(t):
    return windows.fill_missing(
        _gappy(t), "filled", "FIRST_VALUE", partition_by="user_id", order_by=["ts", "event_id"]
    )


@query(
    "fill_missing_split",
    f"""SELECT event_id, ts, user_id, event_type, last_value(filled IGNORE NULLS) OVER (
        PARTITION BY event_type = 'view' ORDER BY ts DESC, event_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM ({_GAPPY})""",
)
def fill_missing_split(t):
    """Few hot groups: the bucketed plan inside a partitioned fill."""
    df = _gappy(t).withColumn("viewed", F.col("event_type") == "view")
    order = [["ts", "DESC"], "event_id"]
    return windows.fill_missing(
        df, "filled", partition_by="viewed", order_by=order, split=True
    ).drop("viewed")


@query(
    "unnest",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, measure, amount FROM (
         SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax FROM lineitem)
       UNPIVOT (amount FOR measure IN (l_quantity, l_discount, l_tax))""",
)
def unnest(t):
    df = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax"
    )
    return rows.unnest(df, ["l_quantity", "l_discount", "l_tax"], "measure", "amount")


@query(
    "unnest_mixed",
    """SELECT p_partkey, 'p_brand' AS "Label", p_brand AS "Value" FROM part UNION ALL
       SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part UNION ALL
       SELECT p_partkey, 'gap', CAST(NULL AS VARCHAR) FROM part""",
)
def unnest_mixed(t):
    df = columns.add_column(t.part.select("p_partkey", "p_brand", "p_size"), "gap")
    return rows.unnest(df, ["p_brand", "p_size", "gap"])


@query(
    "flatten",
    """SELECT page_id, unnest(string_split(url, '/')) AS url FROM pages""",
)
def flatten(t):
    return rows.flatten(t.pages.select("page_id", "url"), "url", delimiter="/")


@query(
    "flatten_nested",
    "SELECT conv_id, turn, role FROM conversations",
)
def flatten_nested(t):
    turns = F.collect_list(F.struct("turn", "role")).alias("turns")
    return rows.flatten(t.conversations.groupBy("conv_id").agg(turns), "turns")


@query(
    "sample_rows",
    """SELECT * FROM orders WHERE ('0x' || left(md5('7|' || o_orderkey), 8))::BIGINT
       < floor(0.1 * 4294967296)""",
)
def sample_rows(t):
    from sluice.operators.aggregate import sample_rows as sampled

    return sampled(t.orders, 0.1, ["o_orderkey"], seed=7)


@query(
    "label_then_limit",
    f"""SELECT {ORDERS}, CASE WHEN o_totalprice > 300000 THEN 'top' ELSE 'rest' END AS label
        FROM orders QUALIFY row_number() OVER (
        PARTITION BY CASE WHEN o_totalprice > 300000 THEN 'top' ELSE 'rest' END
        ORDER BY o_orderdate, o_orderkey) <= 20""",
)
def label_then_limit(t):
    top = Value("top", Condition("o_totalprice", "GT", 300000))
    df = values.set_values(t.orders, [top, Value("rest")], "label")
    return windows.top_per_group(df, 20, ["label"], ["o_orderdate", "o_orderkey"])
