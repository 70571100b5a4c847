"""Files, batches and writers: each query writes to the scratch folder and reads back."""

from pyspark.sql import functions as F

from sluice.catalog.registry import query
from sluice.functions.conditions import Condition
from sluice.operators import values
from sluice.operators.rows import dedupe_latest
from sluice.session import scratch_path
from sluice.sources import datasets, readers, writers
from sluice.sources.datasets import Dataset

HALF = "TIMESTAMP '2024-01-16'"
_HALF = Condition("ts", "LT", "2024-01-16")


def _dataset(t, label):
    return Dataset(t.spark, scratch_path(t.spark, label))


def _halves(t):
    early = values.filter_rows(t.events, _HALF)
    late = values.filter_rows(t.events, _HALF, "REMOVE")
    return early, late


@query("read_parquet", "SELECT * FROM supplier")
def read_parquet(t):
    return readers.read_parquet(t.spark, f"{t.folder}/supplier.parquet")


@query("read_csv", "SELECT * FROM orders")
def read_csv(t):
    path = scratch_path(t.spark, "csv")
    writers.write_file(t.orders, path, "csv")
    df = readers.read_csv(t.spark, path)
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("o_orderkey", "o_custkey")})


@query(
    "file_settings",
    """SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP AS us,
       date_trunc('day', o_orderdate)::TIMESTAMP AS uk, o_orderpriority FROM orders""",
)
def file_settings(t):
    """Pipe-separated files with two lines of preamble and two styles of dates."""
    path = scratch_path(t.spark, "settings")
    line = F.concat_ws(
        "|",
        F.col("o_orderkey").cast("string"),
        F.date_format("o_orderdate", "MM/dd/yyyy"),
        F.date_format("o_orderdate", "dd/MM/yyyy"),
        F.concat(F.lit("'"), F.col("o_orderpriority"), F.lit("'")),
    )
    head = "# exported\n# by nobody\no_orderkey|us|uk|o_orderpriority"
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(8))
    body = t.orders.select(part.alias("part"), F.lit(1).alias("place"), line.alias("value"))
    # each file's head comes first, and a part is one file
    tops = t.spark.range(8).select(F.col("id").alias("part"), F.lit(0).alias("place"), F.lit(head).alias("value"))
    laid = tops.unionByName(body).repartition(8, "part").sortWithinPartitions("part", "place")
    laid.drop("place").write.partitionBy("part").text(path)
    return readers.read_csv(
        t.spark,
        f"{path}/part=*",
        delimiter="|",
        skip_rows=2,
        quote="'",
        date_format="US",
        date_formats={"uk": "UK"},
    )


_ODD_TEXT = """CASE WHEN doc_id % 7 = 0 THEN '' WHEN doc_id % 7 = 1 THEN NULL
       WHEN doc_id % 7 = 2 THEN ' "' || text || '", he said, ' ELSE text END AS text"""


@query("csv_documents", f"SELECT doc_id, {_ODD_TEXT}, lang FROM documents")
def csv_documents(t):
    """Texts with line ends, quotes, blanks around them and nothing in them, written and read back."""
    path = scratch_path(t.spark, "csv")
    writers.write_file(t.documents.selectExpr("doc_id", _ODD_TEXT, "lang"), path, "csv")
    return readers.read_csv(t.spark, path, schema="doc_id bigint, text string, lang string", multiline=True)


@query("csv_documents_skip", f"SELECT doc_id, {_ODD_TEXT}, lang FROM documents")
def csv_documents_skip(t):
    """The same with a line to skip in every file; the head is read as any other record."""
    path = scratch_path(t.spark, "csv")
    writers.write_file(t.documents.selectExpr("doc_id", _ODD_TEXT, "lang"), path, "csv")
    return readers.read_csv(
        t.spark, path, schema="doc_id bigint, text string, lang string", multiline=True, skip_rows=1, has_header=False
    )


@query("merge_null_keys", "SELECT user_id, event_type, max(event_id) AS event_id FROM (SELECT event_id, event_type, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id END AS user_id FROM events) GROUP BY ALL")
def merge_null_keys(t):
    """Keys that are NULL match each other, so merging twice changes nothing."""
    keys = ["user_id", "event_type"]
    user = F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user_id")
    rows = t.events.select(user, "event_type", "event_id")
    target = _dataset(t, "merge")
    target.replace(rows.filter("event_id % 2 = 0").groupBy(*keys).agg(F.max("event_id").alias("event_id")))
    for _ in range(2):
        target.merge(rows.groupBy(*keys).agg(F.max("event_id").alias("event_id")), keys)
    return target.read()


@query(
    "read_folder",
    """SELECT event_id, event_type, value, event_type AS folder FROM events""",
)
def read_folder(t):
    path = scratch_path(t.spark, "folder")
    df = t.events.select("event_id", "event_type", "value", F.col("event_type").alias("kind"))
    df.write.partitionBy("kind").option("header", True).csv(path)
    read = readers.read_folder(t.spark, path, "csv", pattern="*.csv")
    folder = F.regexp_extract(readers.FILE_COLUMN, "kind=([a-z]+)", 1)
    return read.select(
        F.col("event_id").cast("bigint"), "event_type", "value", folder.alias("folder")
    )


@query("read_json", "SELECT doc_id, text, lang FROM documents")
def read_json(t):
    path = scratch_path(t.spark, "json")
    writers.write_file(t.documents.select("doc_id", "text", "lang"), path, "json")
    return readers.read_json(t.spark, path, "doc_id bigint, text string, lang string")


@query("append_batch", "SELECT event_id, ts, value AS amount FROM events")
def append_batch(t):
    early, late = _halves(t)
    target = _dataset(t, "append")
    target.append(early.select("event_id", "ts", F.col("value").alias("amount")), batch="early")
    mapping = {"event_id": "event_id", "ts": "ts", "value": "amount"}
    target.append(late, mapping, batch="late")
    # the same batch again replaces itself
    target.append(late, mapping, batch="late")
    return target.read()


@query(
    "replace_batch",
    f"SELECT * FROM events WHERE NOT ts < {HALF}",
)
def replace_batch(t):
    early, late = _halves(t)
    target = _dataset(t, "replace")
    target.append(early, batch="early")
    target.replace(late, batch="late")
    return target.read()


@query(
    "delete_batch",
    f"SELECT * FROM events WHERE ts < {HALF}",
)
def delete_batch(t):
    early, late = _halves(t)
    target = _dataset(t, "delete")
    target.append(early, batch="early")
    target.append(late, batch="late")
    target.delete(["late"])
    return target.read()


_MERGED = f"""SELECT user_id, event_type, event_id, ts FROM events QUALIFY row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY NOT ts < {HALF} DESC, ts DESC, event_id) = 1"""


@query("merge_by_key", _MERGED)
def merge_by_key(t):
    """The latest event per user and type, first of one half, then merged with the other."""
    order = [["ts", "DESC"], "event_id"]
    keys = ["user_id", "event_type"]
    early, late = (h.select(*keys, "event_id", "ts") for h in _halves(t))
    target = _dataset(t, "merge")
    target.replace(dedupe_latest(early, keys, order))
    target.merge(late, keys, order)
    return target.read()


@query("incremental_pull", "SELECT * FROM events")
def incremental_pull(t):
    """The second pull scans only rows past the last time stamp of the first."""
    early, _ = _halves(t)
    target = _dataset(t, "pull")
    target.pull(early, "ts", batch="first-pull")
    target.pull(t.events, "ts", batch="second-pull")
    target.pull(t.events, "ts", batch="third-pull")
    return target.read()


@query(
    "branch_out",
    """SELECT o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
)
def branch_out(t):
    target = _dataset(t, "branch")
    mapping = {"o_orderkey": "id", "o_totalprice": "price"}
    finished, pending = (Condition("o_orderstatus", "EQ", s) for s in "FP")
    datasets.branch_out(t.orders, target, "REPLACE", mapping, finished)
    return datasets.branch_out(t.orders, target, "APPEND", mapping, pending)


@query(
    "write_file",
    """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%d.%m.%Y') AS o_orderdate FROM orders""",
)
def write_file(t):
    path = scratch_path(t.spark, "written")
    writers.write_file(
        t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus"),
        path,
        "parquet",
        hidden=["o_orderstatus"],
        formats={"o_orderdate": "dd.MM.yyyy"},
    )
    return t.spark.read.parquet(path)


@query(
    "write_table_modes",
    f"""SELECT *, strftime(ts, '%Y-%m') AS part FROM ({_MERGED})""",
)
def write_table_modes(t):
    """REPLACE, COMBINE and UPSERT into month partitions."""
    keys = ["user_id", "event_type"]
    order = [["ts", "DESC"], "event_id"]
    month = {"partition_column": "ts", "granularity": "MONTH"}
    early, late = (h.select(*keys, "event_id", "ts") for h in _halves(t))
    early = dedupe_latest(early, keys, order)
    late = dedupe_latest(late, keys, order)
    first = scratch_path(t.spark, "table")
    second = scratch_path(t.spark, "table")
    errors, others = (
        values.filter_rows(early, Condition("event_type", "EQ", "error"), kept)
        for kept in ("SHOW", "REMOVE")
    )
    writers.write_table(errors, first, "REPLACE", **month)
    writers.write_table(others, first, "COMBINE", **month)
    writers.write_table(late, second, "UPSERT", keys, current=first, **month)
    df = t.spark.read.parquet(second)
    return df.withColumn("part", F.col(writers.PARTITION).cast("string")).drop(writers.PARTITION)


@query(
    "write_integer_partitions",
    """SELECT p_partkey, p_name, floor((p_partkey - 100) / 500)::BIGINT AS part FROM part""",
)
def write_integer_partitions(t):
    path = scratch_path(t.spark, "ranges")
    writers.write_table(
        t.part.select("p_partkey", "p_name"),
        path,
        partition_column="p_partkey",
        interval=500,
        start=100,
    )
    df = t.spark.read.parquet(path)
    return df.withColumn("part", F.col(writers.PARTITION).cast("bigint")).drop(writers.PARTITION)


@query(
    "write_rest_batches",
    """SELECT batch_no, count(*) AS records, '{"data":{"rows":[' || string_agg('{"c_custkey":' || c_custkey ||
         ',"c_name":"' || c_name || '"}', ',' ORDER BY c_custkey) || ']},"origin":"sluice"}' AS body
       FROM (SELECT *, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 250) AS BIGINT) AS batch_no
             FROM customer) GROUP BY batch_no""",
)
def write_rest_batches(t):
    df = writers.request_bodies(
        t.customer.select("c_custkey", "c_name"),
        ["c_custkey"],
        batch_size=250,
        wrap_path="data.rows",
        extra_body_fields={"origin": "sluice"},
    )
    return df.withColumn("records", F.col("records").cast("bigint"))


@query(
    "conditional_export",
    "SELECT * FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'",
)
def conditional_export(t):
    path = scratch_path(t.spark, "export")
    wanted = Condition("c_acctbal", "LT", 0) | Condition("c_mktsegment", "EQ", "BUILDING")
    writers.conditional_export(t.customer, path, wanted)
    return t.spark.read.parquet(path)
