"""JSON text to columns and rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.kinds import DATE, TEXT, col, converted, require
from sluice.operators.columns import Part, as_part


def _parts(items: Sequence[Part | dict | str]) -> list[Part]:
    parts = [as_part(i) for i in items]
    if any(p.type == DATE for p in parts):
        raise ValueError("JSON values are TEXT or NUMERIC; convert to DATE in a later step")
    return parts


def _schema(parts: Sequence[Part]) -> T.StructType:
    keys = dict.fromkeys(p.key or p.name for p in parts)
    return T.StructType([T.StructField(k, T.StringType()) for k in keys])


def _values(parsed: Column, parts: Sequence[Part]) -> list[Column]:
    return [
        converted(parsed.getField(p.key or p.name), TEXT, p.type).alias(p.name) for p in parts
    ]


def json_extract(
    df: DataFrame,
    column: str,
    keys: Sequence[Part | dict | str],
    keep_source: bool = False,
) -> DataFrame:
    """Keys of a JSON object as typed columns; the text is parsed once per row."""
    require(df, column)
    parts = _parts(keys)
    parsed = df.withColumn("_parsed", F.from_json(col(column), _schema(parts)))
    kept = [col(c) for c in df.columns if keep_source or c != column]
    return parsed.select(*kept, *_values(F.col("_parsed"), parts))


def json_list_to_rows(
    df: DataFrame,
    column: str,
    keys: Sequence[Part | dict | str] = (),
    as_name: str | None = None,
    keep_source: bool = False,
) -> DataFrame:
    """One row per element of a JSON list; rows without elements are kept.

    With ``keys`` the elements are objects and their keys become columns, else
    the element itself goes into ``as_name``.
    """
    require(df, column)
    parts = _parts(keys)
    item = _schema(parts) if parts else T.StringType()
    items = F.from_json(col(column), T.ArrayType(item))
    name = as_name or (f"{column} item" if keep_source else column)
    kept = [col(c) for c in df.columns if keep_source or c != column]
    rows = df.select(*kept, F.explode_outer(items).alias("_item"))
    kept_names = [col(c) for c in rows.columns if c != "_item"]
    if parts:
        return rows.select(*kept_names, *_values(F.col("_item"), parts))
    return rows.select(*kept_names, F.col("_item").alias(name))
