"""Streams over landing folders filled from the test tables."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.catalog.registry import query
from sluice.catalog.sources import _MERGED, _halves
from sluice.functions.conditions import Condition
from sluice.operators import values
from sluice.operators.aggregate import Aggregation, pivot
from sluice.operators.values import Value
from sluice.session import scratch_path
from sluice.sources import writers
from sluice.sources.datasets import Dataset
from sluice.streaming import ingest
from sluice.streaming.incremental import KeptPivot, KeptTop, deleted_increment

_EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def _places(t, label):
    root = scratch_path(t.spark, label)
    return f"{root}/landing", Dataset(t.spark, f"{root}/target"), f"{root}/progress"


def _events(df):
    return df.select("event_id", "ts", "user_id", "event_type", "value")


@query("stream_webhook", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_webhook(t):
    """Rows pushed as JSON in two waves; the second run sees only the second wave."""
    landing, target, progress = _places(t, "webhook")
    for half in _halves(t):
        writers.write_file(_events(half), landing, "json", mode="append")
        ingest.land_pushed_rows(t.spark, landing, _EVENT, target, progress)
    return target.read()


@query("stream_two_sources", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_two_sources(t):
    """Two landing folders, each with a query of its own, into one dataset."""
    root = scratch_path(t.spark, "two")
    target = Dataset(t.spark, f"{root}/target")
    for k, half in enumerate(_halves(t)):
        writers.write_file(_events(half), f"{root}/landing-{k}", "json")
        ingest.land_pushed_rows(t.spark, f"{root}/landing-{k}", _EVENT, target, f"{root}/progress-{k}")
    return target.read()


@query("stream_quoted_lines", "SELECT doc_id, text FROM documents")
def stream_quoted_lines(t):
    """Arriving CSV files whose cells hold line ends and quotes."""
    landing, target, progress = _places(t, "quoted")
    writers.write_file(t.documents.select("doc_id", "text"), landing)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    ingest.consolidate_files(t.spark, landing, schema, target, progress, multiline=True)
    return target.read()


@query(
    "stream_webhook_replace",
    "SELECT event_id, ts, user_id, event_type, value FROM events WHERE NOT ts < TIMESTAMP '2024-01-16'",
)
def stream_webhook_replace(t):
    landing, target, progress = _places(t, "webhook")
    for half in _halves(t):
        writers.write_file(_events(half), landing, "json", mode="append")
        ingest.land_pushed_rows(t.spark, landing, _EVENT, target, progress, mode="replace")
    return target.read()


@query(
    "stream_consolidate",
    """SELECT o_orderkey, o_totalprice, 'good' AS kind FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL SELECT NULL, NULL, 'bad' FROM orders WHERE o_orderstatus = 'P'""",
)
def stream_consolidate(t):
    """Files named part-* are appended; rows off the schema are set aside."""
    landing, target, progress = _places(t, "consolidate")
    aside = f"{landing}-aside"
    price = F.col("o_totalprice").cast("string")
    odd = F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(price)
    rows = t.orders.select("o_orderkey", odd.alias("o_totalprice"))
    rows.write.option("header", True).csv(landing)
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType())]
    )
    ingest.consolidate_files(
        t.spark,
        landing,
        schema,
        target,
        progress,
        name="PART-",
        match="starts_with",
        case_sensitive=False,
        quarantine=aside,
    )
    bad = t.spark.read.option("recursiveFileLookup", True).parquet(aside)
    empty = bad.select(
        F.lit(None).cast("bigint").alias("o_orderkey"),
        F.lit(None).cast("double").alias("o_totalprice"),
        F.lit("bad").alias("kind"),
    )
    return target.read().withColumn("kind", F.lit("good")).unionByName(empty)


@query("consolidate_folder", "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'")
def consolidate_folder(t):
    """Files of five subfolders; only those with a wanted name ending are appended."""
    landing, target, progress = _places(t, "folder")
    rows = t.events.select("event_id", "user_id", "value", "event_type")
    wanted, other = (
        values.filter_rows(rows, Condition("event_type", "NE", "error"), kept)
        for kept in ("SHOW", "REMOVE")
    )
    wanted.write.partitionBy("event_type").option("compression", "snappy").parquet(landing)
    errors = other.write.partitionBy("event_type").option("compression", "gzip")
    errors.mode("append").parquet(landing)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    ingest.consolidate_files(
        t.spark,
        landing,
        schema,
        target,
        progress,
        name=".snappy.parquet",
        match="ends_with",
        file_format="parquet",
    )
    return target.read()


@query("stream_refresh", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_refresh(t):
    """The second wave brings all rows again; only those past the last time are added."""
    landing, target, progress = _places(t, "refresh")
    early, _ = _halves(t)
    for wave in (early, t.events):
        _events(wave).write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(_EVENT).parquet(landing)
        ingest.refresh(stream, target, progress, "ts")
    return target.read()


@query(
    "stream_steps",
    """SELECT event_type, band, count(*) AS n, round(sum(value), 2) AS total FROM (
       SELECT *, CASE WHEN value >= 20 THEN 'high' ELSE 'low' END AS band FROM events
       WHERE event_type <> 'error') GROUP BY ALL""",
)
def stream_steps(t):
    """Row-wise steps per increment, a summary over all rows after each."""
    landing, target, progress = _places(t, "steps")
    result = Dataset(t.spark, scratch_path(t.spark, "summary"))

    def each(df):
        df = values.filter_rows(df, Condition("event_type", "NE", "error"))
        high = Value("high", Condition("value", "GTE", 20))
        return values.set_values(df, [high, Value("low")], "band")

    def whole(df):
        return pivot(
            df,
            ["event_type", "band"],
            [Aggregation("event_id", "COUNT", "n"), Aggregation("value", "SUM", "total")],
        )

    for half in _halves(t):
        _events(half).write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(_EVENT).parquet(landing)
        ingest.run_steps(stream, each, target, progress, whole, result)
    return result.read().withColumn("total", F.round("total", 2))


@query("stream_merge", _MERGED)
def stream_merge(t):
    landing, target, progress = _places(t, "merge")
    keys = ["user_id", "event_type"]
    schema = "user_id bigint, event_type string, event_id bigint, ts timestamp_ntz"
    for half in _halves(t):
        half.select(*keys, "event_id", "ts").write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(schema).parquet(landing)
        ingest.merge_increments(stream, target, progress, keys, [["ts", "DESC"], "event_id"])
    return target.read()


_LATEST = """SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1"""


def _kept(t, label, build):
    """Two increments merged by key, then some rows deleted; what is kept follows, and is opened again each time."""
    landing, target, progress = _places(t, label)
    root, keys = scratch_path(t.spark, f"{label}-kept"), ["user_id", "event_type"]
    for half in _halves(t):
        _events(half).write.mode("append").parquet(landing)
        stream = t.spark.readStream.schema(_EVENT).parquet(landing)
        ingest.merge_increments(stream, target, progress, keys, [["ts", "DESC"], "event_id"], [build(root)])
    deleted_increment(target, lambda df: F.col("user_id") % 10 == 0, [build(root)], "closed-accounts")
    build(root).fold()
    return build(root).result()


@query(
    "stream_kept_pivot",
    f"""SELECT event_type, count(event_id) AS n, count(DISTINCT value) AS different, min(value) AS low, max(ts) AS last, median(value) AS middle,
       sum(CASE WHEN value >= 20 THEN user_id END)::BIGINT AS high_users FROM ({_LATEST}) WHERE user_id % 10 <> 0 GROUP BY event_type""",
)
def stream_kept_pivot(t):
    def build(root):
        aggregations = [
            Aggregation("event_id", "COUNT", "n"),
            Aggregation("value", "COUNT_DISTINCT", "different"),
            Aggregation("value", "MIN", "low"),
            Aggregation("ts", "MAX", "last"),
            Aggregation("value", "MEDIAN", "middle"),
            Aggregation("user_id", "SUM", "high_users", condition=Condition("value", "GTE", 20)),
        ]
        return KeptPivot(t.spark, root, ["event_type"], aggregations)

    return _kept(t, "kept-pivot", build)


@query(
    "stream_kept_top",
    f"""SELECT event_id, ts, user_id, event_type, value FROM ({_LATEST}) WHERE user_id % 10 <> 0
       QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) <= 5""",
)
def stream_kept_top(t):
    return _kept(t, "kept-top", lambda root: KeptTop(t.spark, root, 5, ["event_type"], [["value", "DESC"], "event_id"]))
