"""Pages of a large table in an order, from a stored index.

The index cuts the order into buckets of about equal length and keeps the table
in these buckets, with how many rows come before each. A page then reads the one
or two buckets it lies in, wherever in the table that is.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import col
from sluice.operators.joins import unused
from sluice.operators.ordering import Key, order_keys, sorts, with_buckets
from sluice.operators.rows import PAGE_ROWS
from sluice.session import settled

BUCKET_ROWS = 100_000


class PageIndex:
    """The rows of a table in an order, stored in buckets below a folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def build(
        self,
        df: DataFrame,
        order_by: Sequence,
        condition: Predicate | dict | None = None,
        bucket_rows: int = BUCKET_ROWS,
    ) -> PageIndex:
        """Store the rows that meet the condition in the given order.

        Rows that tie in ``order_by`` are ordered by their other columns, so that
        a row is on one page only. The folder must not exist yet.
        """
        predicate = as_predicate(condition)
        if predicate is not None:
            df = df.filter(predicate.column(df))
        df = settled(df, "paged")
        named = order_keys(df, order_by, needed_by="PageIndex")
        given = {k.name for k in named}
        orderable = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        keys = [*named, *(Key(c) for c in orderable if c not in given)]
        rows = df.count()
        bucket = unused("_bucket", df.columns)
        placed = with_buckets(df, keys, bucket, max(2, -(-rows // bucket_rows)))
        placed = placed.repartition(max(1, -(-rows // bucket_rows)), F.col(bucket)).sortWithinPartitions(bucket, *sorts(keys))
        placed.write.partitionBy(bucket).parquet(f"{self.root}/rows")
        # one row per bucket
        counts = self.spark.read.parquet(f"{self.root}/rows").groupBy(F.col(bucket).cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        counts.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{self.root}/counts")
        about = {"schema": df.schema.jsonValue(), "bucket": bucket, "keys": [[k.name, k.descending] for k in keys]}
        self.spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{self.root}/about")
        return self

    def _about(self) -> tuple[T.StructType, str, list[Key]]:
        about = json.loads("".join(r["value"] for r in self.spark.read.text(f"{self.root}/about").collect()))
        return T.StructType.fromJson(about["schema"]), about["bucket"], [Key(*k) for k in about["keys"]]

    def rows(self) -> int:
        return self.spark.read.parquet(f"{self.root}/counts").agg(F.sum("n")).first()[0] or 0

    def page(self, limit: int = PAGE_ROWS, offset: int = 1, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows ``offset`` (counted from 1) to ``offset + limit - 1``, in order."""
        if offset < 1 or limit < 0:
            raise ValueError(f"the offset counts from 1 and the limit from 0, got {offset} and {limit}")
        schema, bucket, keys = self._about()
        counts = self.spark.read.parquet(f"{self.root}/counts")
        hit = counts.filter((F.col("before") < offset - 1 + limit) & (F.col("before") + F.col("n") >= offset)).orderBy("bucket").collect()
        if not hit or not limit:
            df = self.spark.createDataFrame([], schema)
        else:
            # the folders of the buckets, and no others
            paths = [f"{self.root}/rows/{bucket}={r['bucket']}" for r in hit]
            df = self.spark.read.schema(schema).parquet(*paths).orderBy(*sorts(keys)).offset(offset - 1 - hit[0]["before"]).limit(limit)
        return df.select(*[col(c) for c in columns]) if columns else df
