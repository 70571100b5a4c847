"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that matter for the operators in this package. Everything else is
# left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split hot join keys even where that costs one more shuffle downstream
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: str | int = "*", **extra: str) -> SparkSession:
    """A local session with the package's settings, for tests and benches."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("sluice")
    options = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **extra,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    for held in _open:
        held.append(path)
    return path


# the paths handed out within each open ``intermediates``
_open: list[list[str]] = []


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what operators wrote to the scratch folder inside.

    Results read these copies, so write or count them inside as well.
    """
    held: list[str] = []
    _open.append(held)
    try:
        yield
    finally:
        _open.remove(held)
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in held:
            made = hadoop.Path(path)
            made.getFileSystem(spark._jsc.hadoopConfiguration()).delete(made, True)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, so that loops do not replan or recompute what came
    before, and survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget_shuffles(spark: SparkSession) -> None:
    """Let Spark remove shuffle files that nothing refers to any more.

    It does so when the driver collects its garbage, which may be long after a
    step is done whose result has been written. The last step is still referred to
    for a moment, until its end has been told to all listeners, so this is done twice.
    """
    for wait in (0.5, 0.0):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(wait)


def finished(spark: SparkSession, label: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` returns, written to the shared folder; all else it wrote there goes."""
    path = scratch_path(spark, label)
    with intermediates(spark):
        made = make()
        made.write.parquet(path)
    forget_shuffles(spark)
    return spark.read.schema(made.schema).parquet(path)


def with_row_keys(df: DataFrame) -> DataFrame:
    """``df`` with ``__row``, a number no other row has, and ``__hash`` of the text.

    Written once, so that every read sees the same numbers.
    """
    keys = {"__row": F.monotonically_increasing_id(), "__hash": F.xxhash64(F.col("text").cast("string"))}
    return materialize(df.withColumns(keys), "rows")


def with_row_names(df: DataFrame) -> DataFrame:
    """``df`` with ``__row``, a number no other row has, and ``__hash`` of the text, written only if need be.

    Rows that come straight from Parquet files are named by a hash of their file and place in it.
    """
    lines = df._jdf.queryExecution().optimizedPlan().toString().strip().split("\n")
    place = ("_metadata.file_path", "_metadata.row_index")
    if not (all(re.match(r"[\s:+-]*(Project|Filter|Relation)\b", line) for line in lines) and lines[-1].endswith("parquet")):
        return with_row_keys(df)
    return df.select("*", F.xxhash64(*place).alias("__row"), F.xxhash64(F.col("text").cast("string")).alias("__hash"))


# plan nodes that cost more than reading and reshaping rows in place
_COSTLY = re.compile(r"(?m)^[\s:+-]*(Join|Aggregate|Window|Sort|Distinct|Deduplicate|Intersect|Except|Generate|\w*Python|\w*InPandas|LogicalRDD)")


def settled(df: DataFrame, label: str = "step") -> DataFrame:
    """``df`` in a form that is cheap to read several times.

    Filters and projections over files stay as they are, since each read prunes
    its columns. Anything with a shuffle behind it is written once.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return materialize(df, label) if _COSTLY.search(plan) else df


def planned_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``; costs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
