"""Sorting, limiting, paging, de-duplicating and reshaping rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.conditions import Predicate, as_predicate
from sluice.functions.kinds import TEXT, col, converted, kind_of, require, spark_type
from sluice.functions.text import literal_pattern
from sluice.operators import scan
from sluice.operators.ordering import order_keys, sorts

# Beyond this a limit is cut by distributed row numbers, not by one task.
LARGE_LIMIT = 1_000_000
PAGE_ROWS = 400  # fixed value: rows per page unless told otherwise


def sort(df: DataFrame, order_by: Sequence) -> DataFrame:
    """Order rows; NULLs last in both directions."""
    return df.orderBy(*sorts(order_keys(df, order_by, needed_by="sort")))


def limit_rows(
    df: DataFrame, n: int, bottom: bool = False, order_by: Sequence | None = None
) -> DataFrame:
    """The top or bottom ``n`` rows of an order, in that order."""
    if n < 0:
        raise ValueError(f"the number of rows is negative: {n}")
    keys = order_keys(df, order_by, needed_by="limit_rows")
    if n > LARGE_LIMIT:
        rows = scan.numbered(df, [], keys)
        kept = F.col(scan.ROW) <= n
        if bottom:
            kept = F.col(scan.ROW) > df.agg(F.count(F.lit(1))).scalar() - n
        return rows.filter(kept).drop(scan.ROW, scan.GROUP).orderBy(*sorts(keys))
    if not bottom:
        return df.orderBy(*sorts(keys)).limit(n)
    return df.orderBy(*sorts(keys, reverse=True)).limit(n).orderBy(*sorts(keys))


def page(
    df: DataFrame,
    limit: int = PAGE_ROWS,
    offset: int = 1,
    columns: Sequence[str] | None = None,
    condition: Predicate | dict | None = None,
    order_by: Sequence | None = None,
) -> DataFrame:
    """Rows ``offset`` (counted from 1) to ``offset + limit - 1`` of an order."""
    if offset < 1:
        raise ValueError(f"the offset counts from 1, got {offset}")
    predicate = as_predicate(condition)
    if predicate is not None:
        df = df.filter(predicate.column(df))
    keys = order_keys(df, order_by, needed_by="page")
    if offset + limit > LARGE_LIMIT:
        numbered = scan.numbered(df, [], keys)
        kept = F.col(scan.ROW).between(offset, offset + limit - 1)
        df = numbered.filter(kept).drop(scan.ROW, scan.GROUP).orderBy(*sorts(keys))
    else:
        df = df.orderBy(*sorts(keys)).offset(offset - 1).limit(limit)
    return df.select(*[col(c) for c in columns]) if columns else df


def preview(
    df: DataFrame,
    rows: int = 10,
    columns: int | None = None,
    task: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """A few rows of a table, or of a candidate step tried on a few rows."""
    head = df.limit(rows)
    if task is not None:
        head = task(head)
    return head.select(*[col(c) for c in head.columns[:columns]])


def discard_duplicates(
    df: DataFrame,
    ignore_columns: Sequence[str] = (),
    order_by: Sequence | None = None,
) -> DataFrame:
    """Keep the first row of each set of equal rows.

    With ``ignore_columns`` the survivor is the first in ``order_by``, or in the
    order of the ignored columns, so that it is the same on every run.
    """
    if not ignore_columns:
        return df.dropDuplicates()
    require(df, *ignore_columns)
    compared = [c for c in df.columns if c not in ignore_columns]
    return keep_first(df, compared, order_by or list(ignore_columns))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """One row per key. Each task keeps one row per key before the shuffle."""
    require(df, *keys)
    order = sorts(order_keys(df, order_by, needed_by="keep_first"))
    spec = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(spec)).filter("_place = 1").drop("_place")


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """The newest record per key; ``order_by`` names the newest first."""
    return keep_first(df, keys, order_by)


def unnest(
    df: DataFrame,
    columns: Sequence[str],
    label_column: str = "Label",
    value_column: str = "Value",
    value_type: str | None = None,
) -> DataFrame:
    """Wide to long: one row per row and listed column.

    The value type is the common type of the columns, else TEXT. Empty cells
    stay as rows with a NULL value.
    """
    require(df, *columns)
    kinds = {kind_of(df, c) for c in columns}
    kind = value_type or (kinds.pop() if len(kinds) == 1 else TEXT)
    cast = [
        converted(col(c), kind_of(df, c), kind).cast(spark_type(kind)).alias(c) for c in columns
    ]
    kept = [c for c in df.columns if c not in columns]
    narrow = df.select(*[col(c) for c in kept], *cast)
    return narrow.unpivot(
        [col(c) for c in kept], [col(c) for c in columns], label_column, value_column
    )


def flatten(
    df: DataFrame, column: str, delimiter: str | None = None, prefix: str = ""
) -> DataFrame:
    """Nested or multi-value cells to rows and columns.

    Text with a ``delimiter`` and arrays become one row per item, structs one
    column per field, arrays of structs both. Rows without items are kept.
    """
    require(df, column)
    dtype = df.schema[column].dataType
    others = [col(c) for c in df.columns if c != column]
    if delimiter is not None:
        items = F.split(col(column), literal_pattern(delimiter))
        return df.withColumn(column, F.explode_outer(items))
    if isinstance(dtype, T.ArrayType):
        rows = df.withColumn(column, F.explode_outer(col(column)))
        nested = isinstance(dtype.elementType, T.StructType)
        return flatten(rows, column, None, prefix) if nested else rows
    if isinstance(dtype, T.StructType):
        fields = [col(column).getField(f.name).alias(prefix + f.name) for f in dtype.fields]
        return df.select(*others, *fields)
    raise ValueError(f"{column!r} holds {dtype.simpleString()}; give a delimiter to split text")
