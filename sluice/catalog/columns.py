"""Column structure."""

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import columns as ops
from sluice.operators import text


@query(
    "add_column",
    """SELECT *, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS DOUBLE) AS score,
       CAST(NULL AS TIMESTAMP) AS due, 'new' AS state FROM customer""",
)
def add_column(t):
    df = ops.add_column(t.customer, "note")
    df = ops.add_column(df, "score", "NUMERIC")
    df = ops.add_column(df, "due", "DATE")
    return ops.add_column(df, "state", "TEXT", default="new")


@query("delete_columns", "SELECT * EXCLUDE (l_tax, l_linestatus) FROM lineitem")
def delete_columns(t):
    return ops.delete_columns(t.lineitem, ["l_tax", "l_linestatus"])


@query(
    "copy_columns",
    """SELECT p_partkey, p_name, p_brand,
       CASE WHEN p_size > 25 THEN p_brand ELSE p_type END AS p_type, p_size, p_retailprice,
       p_name AS "p_name Copy", CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END AS size_text
       FROM part""",
)
def copy_columns(t):
    return ops.copy_columns(
        t.part,
        [
            ops.Copy("p_name"),
            ops.Copy("p_size", "size_text", "TEXT", Condition("p_size", "GT", 10)),
            ops.Copy("p_brand", destination="p_type", condition=Condition("p_size", "GT", 25)),
        ],
    )


@query(
    "combine_columns",
    """SELECT *, concat_ws(' - ', p_brand, 'part', p_name) AS label,
       CASE WHEN p_size < 20 THEN concat_ws('/', CAST(p_size AS VARCHAR), p_type) END AS small_label
       FROM part""",
)
def combine_columns(t):
    df = ops.combine_columns(t.part, ["p_brand", "__literal__:part", "p_name"], "label", separator=" - ")
    return ops.combine_columns(
        df,
        ["p_size", "p_type"],
        "small_label",
        separator="/",
        condition=Condition("p_size", "LT", 20),
    )


@query(
    "combine_columns_nulls",
    """SELECT doc_id, concat_ws('|', lang, CAST(quality AS VARCHAR), source) AS skipped,
       lang || '|' || coalesce(CAST(quality AS VARCHAR), '') || '|' || source AS kept
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def combine_columns_nulls(t):
    df = t.documents.select("doc_id", "lang", "source").join(
        t.labels.select("doc_id", "quality"), "doc_id", "left"
    )
    parts = ["lang", "quality", "source"]
    df = ops.combine_columns(df, parts, "skipped", separator="|")
    df = ops.combine_columns(df, parts, "kept", separator="|", nulls="empty")
    return df.select("doc_id", "skipped", "kept")


@query(
    "convert_type",
    """SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS level,
       CAST(o_custkey AS VARCHAR) AS o_custkey,
       strftime(o_orderdate, '%m/%d/%Y') AS o_orderdate,
       TRY_CAST(o_orderpriority AS DOUBLE) AS o_orderpriority FROM orders""",
)
def convert_type(t):
    df = ops.split_column(t.orders, "o_orderpriority", "-", ["level"])
    df = ops.convert_type(
        df,
        [
            ops.Conversion("level", "NUMERIC"),
            ops.Conversion("o_custkey", "TEXT"),
            ops.Conversion("o_orderdate", "TEXT", "MM/DD/YYYY"),
            ops.Conversion("o_orderpriority", "NUMERIC"),
        ],
    )
    return df.select("o_orderkey", "level", "o_custkey", "o_orderdate", "o_orderpriority")


@query(
    "normalize_date",
    """SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP AS us,
       date_trunc('day', o_orderdate)::TIMESTAMP AS auto FROM orders""",
)
def normalize_date(t):
    df = ops.copy_columns(
        t.orders, [ops.Copy("o_orderdate", "us", "DATE"), ops.Copy("o_orderdate", "auto", "DATE")]
    )
    df = ops.convert_type(
        df,
        [ops.Conversion("us", "TEXT", "MM/DD/YYYY"), ops.Conversion("auto", "TEXT", "MMM d, yyyy")],
    )
    df = ops.normalize_date(df, "us", ["YYYY-MM-DD", "MM/DD/YYYY"])
    return ops.normalize_date(df, "auto").select("o_orderkey", "us", "auto")


@query(
    "select_columns", "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem"
)
def select_columns(t):
    return ops.select_columns(t.lineitem, ["l_orderkey", "l_quantity", "l_shipdate"])


@query(
    "split_column",
    """SELECT *, split_part(o_orderpriority, '-', 1)::DOUBLE AS level,
       split_part(o_orderpriority, '-', 2) AS priority, CAST(NULL AS VARCHAR) AS extra FROM orders""",
)
def split_column(t):
    return ops.split_column(
        t.orders, "o_orderpriority", "-", [ops.Part("level", "NUMERIC"), "priority", "extra"]
    )


@query(
    "arrange_columns",
    """SELECT c_mktsegment AS segment, c_custkey AS id, c_name, c_acctbal FROM customer""",
)
def arrange_columns(t):
    return ops.arrange(
        t.customer,
        rename={"c_custkey": "id", "c_mktsegment": "segment"},
        hide=["c_nationkey"],
        first=["c_mktsegment"],
    )


@query(
    "split_positions",
    """SELECT o_orderkey, left(o_orderpriority, 1) AS number, substr(o_orderpriority, 2, 1) AS mark,
       substr(o_orderpriority, 3) AS rest FROM orders""",
)
def split_positions(t):
    df = ops.split_column(t.orders, "o_orderpriority", positions=[1, 2], new_columns=["number", "mark", "rest"])
    return df.select("o_orderkey", "number", "mark", "rest")


@query(
    "trim_sides",
    r"""SELECT doc_id, regexp_replace(t, '^\s+', '') AS l, regexp_replace(t, '\s+$', '') AS r, regexp_replace(t, '\s+', '', 'g') AS a
       FROM (SELECT doc_id, '  ' || chr(9) || lang || ' ' || source || chr(10) || ' ' AS t FROM documents)""",
)
def trim_sides(t):
    df = t.documents.selectExpr("doc_id", "'  ' || chr(9) || lang || ' ' || source || chr(10) || ' ' AS t")
    df = df.selectExpr("doc_id", "t AS l", "t AS r", "t AS a")
    for name, side in (("l", "left"), ("r", "right"), ("a", "all")):
        df = text.text_transform(df, [name], trim=side)
    return df
