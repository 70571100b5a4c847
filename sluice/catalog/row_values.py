"""Row-value transformations."""

import pandas as pd
from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions import dates
from sluice.functions.conditions import Condition
from sluice.functions.dates import Delta
from sluice.operators import ai, columns, date_ops, json_ops, similar, text, values
from sluice.operators.text import Variants
from sluice.operators.values import Value


@query(
    "set_values",
    """SELECT *, CASE WHEN l_quantity >= 40 AND l_discount > 0.05 THEN 'bulk deal'
       WHEN l_quantity >= 40 THEN 'bulk' WHEN l_quantity >= 20 THEN 'medium' ELSE 'small' END AS tier
       FROM lineitem""",
)
def set_values(t):
    big = Condition("l_quantity", "GTE", 40)
    return values.set_values(
        t.lineitem,
        [
            Value("bulk deal", big & Condition("l_discount", "GT", 0.05)),
            Value("bulk", big),
            Value("medium", Condition("l_quantity", "GTE", 20)),
            Value("small"),
        ],
        new_column="tier",
    )


@query(
    "set_values_existing",
    """SELECT o_orderkey, o_custkey,
       CASE WHEN o_totalprice > 100000 AND o_orderpriority = '5-LOW' THEN 'L'
            WHEN o_totalprice > 100000 AND o_orderpriority = '1-URGENT' THEN 'U'
            ELSE o_orderstatus END AS o_orderstatus,
       o_totalprice, o_orderdate, o_orderpriority FROM orders""",
)
def set_values_existing(t):
    return values.set_values(
        t.orders,
        [
            Value("L", Condition("o_orderpriority", "EQ", "5-LOW")),
            Value("U", Condition("o_orderpriority", "EQ", "1-URGENT")),
        ],
        existing_column="o_orderstatus",
        condition=Condition("o_totalprice", "GT", 100000),
    )


@query(
    "set_now",
    "SELECT o_orderkey, CAST(1 AS DOUBLE) AS stamped FROM orders",
)
def set_now(t):
    df = values.set_values(
        t.orders, [Value("__TIME__", provider="EXPRESSION")], "loaded_at", column_type="DATE"
    )
    recent = Condition("loaded_at", "LTE", "NOW", value_is_date_fn=True)
    df = values.set_values(df, [Value(1, recent), Value(0)], "stamped", column_type="NUMERIC")
    return df.select("o_orderkey", F.col("stamped").cast("double"))


@query(
    "fill_value",
    """SELECT doc_id, coalesce(quality, -1) AS quality,
       CASE WHEN lang = 'de' THEN 'n/a' ELSE lang END AS lang
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def fill_value(t):
    df = t.documents.select("doc_id", "lang").join(
        t.labels.select("doc_id", "quality"), "doc_id", "left"
    )
    df = values.set_values(
        df, [Value("  ", Condition("lang", "EQ", "de"))], existing_column="lang"
    )
    return values.fill_value(values.fill_value(df, "quality", -1), "lang", "n/a")


@query(
    "math",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge,
       round(l_extendedprice / nullif(l_quantity, 0), 8) AS unit_price,
       CAST(l_linenumber % 3 AS DOUBLE) AS m,
       round(CASE WHEN l_quantity > 25 THEN -l_extendedprice + l_quantity * 2 ELSE l_tax END, 4) AS l_tax
       FROM lineitem""",
)
def math(t):
    df = values.math(t.lineitem, "l_extendedprice * (1 - l_discount) * (1 + l_tax)", "charge")
    df = values.math(df, "l_extendedprice / l_quantity", "unit_price")
    df = values.math(df, "l_linenumber % 3", "m")
    df = values.math(
        df,
        "-l_extendedprice + l_quantity * 2",
        existing_column="l_tax",
        condition=Condition("l_quantity", "GT", 25),
    )
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.round("charge", 6).alias("charge"),
        F.round("l_tax", 4).alias("l_tax"),
        F.round("unit_price", 8).alias("unit_price"),
        F.col("m").cast("double"),
    )


@query(
    "math_functions",
    """SELECT p_partkey, abs(p_size - 25)::DOUBLE AS a, trunc(p_retailprice / 7)::DOUBLE AS i,
       round(p_retailprice / 3, 2) AS r, ceil(p_retailprice / 3)::DOUBLE AS c,
       floor(p_retailprice / 3)::DOUBLE AS f, round(sqrt(p_retailprice), 6) AS q,
       pow(p_size, 2)::DOUBLE AS p, round(p_size + p_retailprice + 1, 4) AS s,
       round((p_size + p_retailprice) / 2, 4) AS v, least(p_size, 10)::DOUBLE AS lo,
       greatest(p_size, 10)::DOUBLE AS hi, 2.0::DOUBLE AS n,
       (CASE WHEN p_size > 20 THEN 1 ELSE 0 END)::DOUBLE AS b FROM part""",
)
def math_functions(t):
    df = t.part
    for name, expression in (
        ("a", "ABS(p_size - 25)"),
        ("i", "INT(p_retailprice / 7)"),
        ("r", "ROUND(p_retailprice / 3, 2)"),
        ("c", "CEILING(p_retailprice / 3)"),
        ("f", "FLOOR(p_retailprice / 3)"),
        ("q", "ROUND(SQRT(p_retailprice), 6)"),
        ("p", "POWER(p_size, 2)"),
        ("s", "ROUND(SUM(p_size, p_retailprice, 1), 4)"),
        ("v", "ROUND(AVG(p_size, p_retailprice), 4)"),
        ("lo", "MIN(p_size, 10)"),
        ("hi", "MAX(p_size, 10)"),
        ("n", "COUNT(p_size, p_retailprice)"),
        ("b", "IF(p_size > 20, 1, 0)"),
    ):
        df = values.math(df, expression, name)
    names = [c for c in df.columns if not c.startswith("p_")]
    return df.select("p_partkey", *[F.col(c).cast("double").alias(c) for c in names])


@query(
    "small_large",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       list_sort([l_quantity, l_discount * 1.0, l_tax, 0.5::DOUBLE])[1] AS smallest,
       list_sort([l_quantity, l_discount, l_tax, 0.5::DOUBLE])[3] AS second_largest FROM lineitem""",
)
def small_large(t):
    sources = ["l_quantity", "l_discount", "l_tax", 0.5]
    df = values.small_large(t.lineitem, "SMALL", sources, 1, "smallest")
    df = values.small_large(df, "LARGE", sources, 2, "second_largest")
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "smallest", "second_largest"
    )


@query(
    "text_transform",
    """SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '),
       lambda w: upper(w[1]) || lower(w[2:])), ' ') AS p_name, lower(p_brand) AS p_brand,
       lower(p_type) AS p_type, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS copy
       FROM part""",
)
def text_transform(t):
    df = columns.copy_columns(t.part, [columns.Copy("p_name", "copy")])
    df = text.text_transform(df, ["p_name"], case="TITLE", trim=True)
    df = text.text_transform(df, ["p_brand", "p_type"], case="LOWER", trim=True)
    df = text.text_transform(df, ["copy"], case="UPPER", condition=Condition("p_size", "GT", 25))
    return df.select("p_partkey", "p_name", "p_brand", "p_type", "copy")


@query(
    "clean_text",
    r"""SELECT doc_id, trim(regexp_replace(text, '[\x00-\x1F\x7F]', '', 'g')) AS text
        FROM documents""",
)
def clean_text(t):
    return text.text_transform(t.documents, ["text"], trim=True, clean=True).select(
        "doc_id", "text"
    )


@query(
    "replace_values",
    r"""SELECT p_partkey, regexp_replace(p_name, '(?i)\bRED\b', 'crimson', 'g') AS p_name,
        replace(p_brand, 'Brand#', '$') AS p_brand, regexp_replace(p_type, '(?i)o', '0', 'g') AS p_type
        FROM part""",
)
def replace_values(t):
    df = text.replace_values(t.part, ["p_name"], "RED", "crimson", match_words=True)
    df = text.replace_values(df, ["p_brand"], "Brand#", "$", match_case=True)
    df = text.replace_values(df, ["p_type"], "o", "0")
    return df.select("p_partkey", "p_name", "p_brand", "p_type")


@query(
    "bulk_replace",
    """SELECT p_partkey, replace(replace(replace(replace(p_name, 'red', '@'), 'hot', '@'),
       'cold', 'hot'), '@', 'cold') AS p_name,
       CASE WHEN lower(p_type) IN ('small', 'medium') THEN 'COMPACT' ELSE p_type END AS p_type
       FROM part""",
)
def bulk_replace(t):
    # what one mapping writes is not replaced again by the next
    df = text.bulk_replace(
        t.part, ["p_name"], [Variants(["red", "hot"], "cold"), Variants(["cold"], "hot")]
    )
    df = text.bulk_replace(
        df, ["p_type"], [Variants(["small", "Medium"], "COMPACT")], match_case=False, match_words=True
    )
    return df.select("p_partkey", "p_name", "p_type")


@query(
    "bulk_replace_from",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, p_name AS item
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def bulk_replace_from(t):
    """Whole-cell replacement by a table: part numbers become part names."""
    df = columns.copy_columns(t.lineitem, [columns.Copy("l_partkey", "item", "TEXT")])
    names = t.part.select(F.col("p_partkey").cast("string").alias("variant"), "p_name")
    out = text.bulk_replace_from(df, ["item"], names, "variant", "p_name")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "item")


@query(
    "substring_pos",
    """SELECT c_custkey, left(c_name, 8) AS head, right(c_name, 4) AS tail,
       substring(c_name, 1, 9) AS before, substring(c_name, 10) AS after FROM customer""",
)
def substring_pos(t):
    df = text.substring(t.customer, "c_name", "START", num_char=8, new_column="head")
    df = text.substring(df, "c_name", "END", num_char=4, new_column="tail")
    df = text.substring(df, "c_name", "LEFT", char_position=10, new_column="before")
    df = text.substring(df, "c_name", "RIGHT", char_position=10, new_column="after")
    return df.select("c_custkey", "head", "tail", "before", "after")


@query(
    "substring_wildcard",
    """SELECT page_id, CASE WHEN contains(url, '://') THEN left(url, strpos(url, '://') - 1) END AS scheme,
       CASE WHEN contains(url, '?') THEN substring(url, strpos(url, '?')) END AS query,
       CASE WHEN contains(url, '://') THEN substring(url, strpos(url, '://') + 3) END AS rest
       FROM pages""",
)
def substring_wildcard(t):
    df = text.substring(t.pages, "url", "LEFT", wildcard="://", new_column="scheme")
    df = text.substring(
        df, "url", "RIGHT", wildcard="?", include_wildcard=True, new_column="query"
    )
    df = text.substring(df, "url", "RIGHT", wildcard="://", new_column="rest")
    return df.select("page_id", "scheme", "query", "rest")


@query(
    "substring_regex",
    """SELECT page_id, regexp_extract(url, '://([^/]+)', 1) AS host,
       regexp_extract(url, '[0-9]+', 0) AS number,
       regexp_replace(url, '[?#].*$', '', 'g') AS plain FROM pages""",
)
def substring_regex(t):
    df = text.substring(t.pages, "url", regex_pattern="://([^/]+)", new_column="host")
    df = text.substring(df, "url", regex_pattern="[0-9]+", new_column="number")
    df = text.substring(
        df, "url", regex_pattern="[?#].*$", regex_invert=True, new_column="plain"
    )
    return df.select("page_id", "host", "number", "plain")


# fixed values: SQL for each component, one query per result kind
_NUMERIC_SQL = {
    "year": "year(ts)",
    "month": "month(ts)",
    "day": "day(ts)",
    "hour": "hour(ts)",
    "minute": "minute(ts)",
    "second": "second(ts)",
    "week": "week(ts)",
    "quarter": "quarter(ts)",
    "day_of_week": "dayofweek(ts)",
    "day_of_year": "dayofyear(ts)",
}
_TEXT_SQL = {
    "weekday_text": "strftime(d, '%A')",
    "month_text": "strftime(d, '%B')",
    "year_month": "strftime(d, '%Y-%m')",
    "year_month_number": "strftime(d, '%Y%m')",
    "year_week": "strftime(d, '%G-W%V')",
    "year_quarter": "year(d) || '-Q' || quarter(d)",
    "month_day": "strftime(d, '%m-%d')",
    "hour_minute": "strftime(d, '%H:%M')",
    "hour_minute_second": "strftime(d, '%H:%M:%S')",
    "year_month_day": "strftime(d, '%Y-%m-%d')",
    "month_day_year_hour_minute_second": "strftime(d, '%m-%d-%Y %H:%M:%S')",
    "date_only": "strftime(d, '%Y-%m-%d')",
}


def _sql_list(parts):
    return ", ".join(f"{sql} AS {name}" for name, sql in parts.items())


@query(
    "extract_date_numeric",
    "SELECT event_id, "
    + _sql_list({n: f"CAST({s} AS DOUBLE)" for n, s in _NUMERIC_SQL.items()})
    + " FROM events",
)
def extract_date_numeric(t):
    df = t.events.select("event_id", "ts")
    for name in _NUMERIC_SQL:
        df = date_ops.extract_date(df, "ts", name, name)
    return df.drop("ts")


@query(
    "extract_date_text",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_sql_list(_TEXT_SQL)} "
    "FROM (SELECT *, l_shipdate + to_hours(l_linenumber) AS d FROM lineitem)",
)
def extract_date_text(t):
    df = t.lineitem.withColumn("d", F.expr("l_shipdate + make_dt_interval(0, l_linenumber)"))
    for name in _TEXT_SQL:
        df = date_ops.extract_date(df, "d", name, name)
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *_TEXT_SQL)


@query(
    "extract_date_date",
    "SELECT event_id, date_trunc('day', ts) AS day FROM events",
)
def extract_date_date(t):
    return date_ops.extract_date(t.events, "ts", "year_month_day_as_date", "day").select(
        "event_id", "day"
    )


@query(
    "date_diff",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    + ", ".join(
        f"CAST(date_diff('{u.lower()}', l_shipdate, d) AS DOUBLE) AS in_{u.lower()}"
        for u in dates.DIFF_UNITS
        if u != "WEEK"
    )
    + ", CAST(CAST(trunc(date_diff('day', l_shipdate, d) / 7) AS BIGINT) AS DOUBLE) AS in_week "
    "FROM (SELECT *, o_orderdate + to_seconds(l_partkey * 7) AS d "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
)
def date_diff(t):
    df = t.lineitem.join(
        t.orders.select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    df = df.withColumn("d", F.expr("o_orderdate + make_dt_interval(0, 0, 0, l_partkey * 7)"))
    for unit in dates.DIFF_UNITS:
        df = date_ops.date_diff(df, unit, "l_shipdate", "d", f"in_{unit.lower()}")
    made = [f"in_{u.lower()}" for u in dates.DIFF_UNITS]
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *made)


@query(
    "increment_date",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderdate - INTERVAL 1 MONTH
       ELSE o_orderdate END AS o_orderdate,
       o_orderdate + INTERVAL 1 YEAR + INTERVAL 2 WEEK - INTERVAL 3 DAY AS due,
       o_orderdate + INTERVAL 90 MINUTE - INTERVAL 5 SECOND AS later FROM orders""",
)
def increment_date(t):
    df = date_ops.increment_date(t.orders, "o_orderdate", Delta(years=1, weeks=2, days=-3), "due")
    df = date_ops.increment_date(df, "o_orderdate", Delta(hours=1, minutes=30, seconds=-5), "later")
    df = date_ops.increment_date(
        df,
        "o_orderdate",
        Delta(months=-1),
        existing_column="o_orderdate",
        condition=Condition("o_orderstatus", "EQ", "F"),
    )
    return df.select("o_orderkey", "o_orderdate", "due", "later")


@query(
    "business_days",
    """WITH spans AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderdate,
         CAST(least(l_shipdate, o_orderdate) AS DATE) AS a,
         CAST(greatest(l_shipdate, o_orderdate) AS DATE) AS b
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
     days AS (SELECT CAST(range AS DATE) AS day FROM range(DATE '1994-12-01', DATE '2002-02-01', INTERVAL 1 DAY)),
     free AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
              WHERE day(o_orderdate) = 1 AND month(o_orderdate) IN (1, 5, 10)),
     cum AS (SELECT d.day, sum(CASE WHEN isodow(d.day) < 6 AND f.day IS NULL THEN 1 ELSE 0 END)
               OVER (ORDER BY d.day) AS upto FROM days d LEFT JOIN free f ON d.day = f.day)
     SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
       CAST((y.upto - x.upto) * CASE WHEN l_shipdate < o_orderdate THEN -1 ELSE 1 END AS DOUBLE) AS work_days
     FROM spans s JOIN cum x ON x.day = s.a - 1 JOIN cum y ON y.day = s.b""",
)
def business_days(t):
    spans = t.lineitem.join(
        t.orders.select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    free = values.filter_rows(
        t.orders,
        Condition("o_orderdate", "EQ", 1, component="day")
        & Condition("o_orderdate", "IN_LIST", [1, 5, 10], component="month"),
    )
    out = date_ops.business_days(
        spans, "o_orderdate", "l_shipdate", "work_days", free, "o_orderdate"
    )
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "work_days"
    )


@query(
    "json_extract_object",
    """SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
       json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.none') AS missing
       FROM events""",
)
def json_extract_object(t):
    part = columns.Part
    return json_ops.json_extract(
        t.events.select("event_id", "user_id", "props"),
        "props",
        [part("k", "NUMERIC"), part("k_text", key="k"), part("missing", key="none")],
    )


@query(
    "json_list_to_rows",
    "SELECT conv_id, CAST(turn AS DOUBLE) AS turn, role, text FROM conversations",
)
def json_list_to_rows(t):
    """Conversations folded into one JSON list each, then back into rows."""
    turns = F.to_json(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    folded = t.conversations.groupBy("conv_id").agg(turns)
    return json_ops.json_list_to_rows(
        folded, "turns", [columns.Part("turn", "NUMERIC"), "role", "text"]
    )


def _rule_model(prompt: str, context: pd.DataFrame) -> list[str]:
    """Stands in for a hosted model: a rule that any model could follow."""
    sizes = context["n_chars"]
    return [f"{lang}:{'long' if n > 2000 else 'short'}" for lang, n in zip(context["lang"], sizes, strict=True)]


@query(
    "ai_transform",
    """SELECT doc_id, lang || ':' || CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS "AI Result"
       FROM documents""",
)
def ai_transform(t):
    prompt = "Give the language and whether the text is long or short, as lang:size."
    out = ai.ai_transform(t.documents, prompt, ["lang", "n_chars"], _rule_model)
    return out.select("doc_id", "AI Result")


@query(
    "suggest_replacements",
    """WITH names AS (SELECT p_name AS v FROM part UNION ALL
         SELECT upper(p_name) || ' Inc.' FROM part WHERE p_size > 25 UNION ALL
         SELECT 'The ' || replace(p_name, ' ', ', ') FROM part WHERE p_type = 'PROMO'),
       counts AS (SELECT v, count(*) AS n, trim(regexp_replace(regexp_replace(
           lower(v), '[^a-z0-9]+', ' ', 'g'), '(^the )|( inc ?$)', '', 'g')) AS key
         FROM names GROUP BY v),
       best AS (SELECT key, v AS suggested FROM counts
         QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, v) = 1)
       SELECT v AS variant, suggested, n AS occurrences FROM counts JOIN best USING (key)
       WHERE v <> suggested""",
)
def suggest_replacements(t):
    """Spellings of part names with entity words, capitals and commas."""
    plain = t.part.select(F.col("p_name").alias("v"))
    firm = t.part.filter("p_size > 25").select(F.concat(F.upper("p_name"), F.lit(" Inc.")))
    title = t.part.filter("p_type = 'PROMO'").select(
        F.concat(F.lit("The "), F.replace("p_name", F.lit(" "), F.lit(", ")))
    )
    return similar.suggest_replacements(plain.union(firm).union(title), "v", "patterns")


@query(
    "suggest_spelling",
    """WITH counts AS (SELECT p_name AS v, count(*) AS n FROM part GROUP BY p_name),
       near AS (SELECT a.v AS variant, b.v AS suggested, a.n AS occurrences,
           row_number() OVER (PARTITION BY a.v ORDER BY b.n DESC, b.v) AS place
         FROM counts a JOIN counts b ON a.v <> b.v AND levenshtein(a.v, b.v) <= 2
           AND (b.n > a.n OR (b.n = a.n AND b.v < a.v)))
       SELECT variant, suggested, occurrences FROM near WHERE place = 1""",
)
def suggest_spelling(t):
    return similar.suggest_replacements(t.part, "p_name", "spelling", max_edits=2)


def _soundex_sql(word):
    """First letter and three digits: letters to sound classes, runs to one, vowels dropped."""
    code = f"translate(upper({word}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    code = f"replace({code}, '7', '')"
    for digit in "123456":
        code = f"regexp_replace({code}, '{digit}+', '{digit}', 'g')"
    rest = f"CASE WHEN {word}[1] IN ('h', 'w') THEN {code} ELSE {code}[2:] END"
    return f"upper({word}[1]) || rpad(left(replace({rest}, '0', ''), 3), 3, '0')"


@query(
    "suggest_phonetic",
    f"""WITH counts AS (SELECT regexp_extract(url, '://([^/]+)', 1) AS v, count(*) AS n FROM pages GROUP BY 1),
       keyed AS (SELECT v, n, array_to_string(list_transform(string_split(
           trim(regexp_replace(lower(v), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: {_soundex_sql("w")}), ' ') AS key
         FROM counts),
       best AS (SELECT key, v AS suggested FROM keyed
         QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, v) = 1)
       SELECT v AS variant, suggested, n AS occurrences FROM keyed JOIN best USING (key)
       WHERE v <> suggested""",
)
def suggest_phonetic(t):
    """Host names of pages that sound alike."""
    df = text.substring(t.pages, "url", regex_pattern="://([^/]+)", new_column="host")
    return similar.suggest_replacements(df, "host", "phonetic")


@query(
    "suggest_tfidf",
    """WITH counts AS (SELECT p_name || ' ' || p_type AS v, count(*) AS n FROM part GROUP BY 1),
       words AS (SELECT DISTINCT v, n, unnest(string_split(lower(v), ' ')) AS w FROM counts),
       rare AS (SELECT w FROM words GROUP BY w
                HAVING count(*) <= 0.14 * (SELECT count(*) FROM counts)),
       keyed AS (SELECT v, n, string_agg(w, ' ' ORDER BY w) AS key FROM words
                 WHERE w IN (SELECT w FROM rare) GROUP BY v, n),
       best AS (SELECT key, v AS suggested FROM keyed
         QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, v) = 1)
       SELECT v AS variant, suggested, n AS occurrences FROM keyed JOIN best USING (key)
       WHERE v <> suggested""",
)
def suggest_tfidf(t):
    df = columns.combine_columns(t.part, ["p_name", "p_type"], "v")
    return similar.suggest_replacements(df, "v", "tfidf", common_share=0.14)


_TITLES = """titles AS (SELECT concat_ws(' ', p_name, lower(p_type), 'of', replace(p_brand, '#', ' '), CASE WHEN p_size % 9 = 0 THEN 'the best' END) AS v
  FROM part),
  counts AS (SELECT v, count(*) AS n FROM titles GROUP BY v)"""


def _titles(t):
    best = F.when(F.col("p_size") % 9 == 0, F.lit("the best"))
    return t.part.select(
        F.concat_ws(" ", "p_name", F.lower("p_type"), F.lit("of"), F.replace("p_brand", F.lit("#"), F.lit(" ")), best).alias("v")
    )


@query(
    "suggest_cosine",
    f"""WITH {_TITLES},
       words AS (SELECT v, w, count(*) AS tf FROM (SELECT v, unnest(string_split(trim(regexp_replace(lower(v), '[^\\pL\\pN]+', ' ', 'g')), ' ')) AS w FROM counts)
         WHERE w <> '' GROUP BY ALL),
       idf AS (SELECT w, ln(1 + (SELECT count(*) FROM counts) / count(*)) AS idf FROM words GROUP BY w),
       vec AS (SELECT v, w, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY v)) AS x FROM words JOIN idf USING (w)),
       near AS (SELECT a.v AS variant, b.v AS suggested FROM vec a JOIN vec b ON a.w = b.w AND a.v <> b.v
         GROUP BY ALL HAVING round(sum(a.x * b.x), 9) >= 0.9),
       ranked AS (SELECT variant, suggested, a.n AS occurrences, b.n AS m, row_number() OVER (PARTITION BY variant ORDER BY b.n DESC, suggested) AS place
         FROM near JOIN counts a ON a.v = variant JOIN counts b ON b.v = suggested WHERE b.n > a.n OR (b.n = a.n AND suggested < variant))
       SELECT variant, suggested, occurrences FROM ranked WHERE place = 1""",
)
def suggest_cosine(t):
    """The best of the titles whose weighted words are at least 0.9 alike."""
    return similar.suggest_replacements(_titles(t), "v", "tfidf", min_similarity=0.9)


@query(
    "suggest_similar_spelling",
    f"""WITH {_TITLES},
       near AS (SELECT a.v AS variant, b.v AS suggested FROM counts a JOIN counts b ON a.v <> b.v
         AND 1 - levenshtein(a.v, b.v) / greatest(length(a.v), length(b.v)) >= 0.85 - 1e-9),
       ranked AS (SELECT variant, suggested, a.n AS occurrences, b.n AS m, row_number() OVER (PARTITION BY variant ORDER BY b.n DESC, suggested) AS place
         FROM near JOIN counts a ON a.v = variant JOIN counts b ON b.v = suggested WHERE b.n > a.n OR (b.n = a.n AND suggested < variant))
       SELECT variant, suggested, occurrences FROM ranked WHERE place = 1""",
)
def suggest_similar_spelling(t):
    """The best of the titles that differ in at most 15 of 100 characters."""
    return similar.suggest_replacements(_titles(t), "v", "spelling", min_similarity=0.85)
