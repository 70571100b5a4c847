"""Adding, copying, combining, converting, splitting and arranging columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate
from sluice.functions.kinds import (
    DATE,
    NUMERIC,
    TEXT,
    col,
    converted,
    kind_of,
    parse_date,
    require,
    spark_type,
)
from sluice.functions.text import literal_pattern
from sluice.operators.targets import Expressions, assigned, column_step

LITERAL_PREFIX = "__literal__:"  # fixed value: marks constant parts in combine_columns


@dataclass(frozen=True)
class Copy:
    """One copy: into a new column (``"<source> Copy"`` by default) or an existing one."""

    source: str
    as_name: str | None = None
    type: str | None = None
    condition: Predicate | dict | None = None
    destination: str | None = None


@dataclass(frozen=True)
class Conversion:
    column: str
    to: str
    format: str | None = None


@dataclass(frozen=True)
class Part:
    """One output column of a split or a JSON extraction."""

    name: str
    type: str = TEXT
    key: str | None = None


@column_step
def add_column(
    df: DataFrame, name: str, column_type: str = TEXT, default: object = None
) -> Expressions:
    """A new column, empty or filled with a constant."""
    return assigned(df, F.lit(default).cast(spark_type(column_type)), column_type, name)


def delete_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require(df, *columns)
    return df.drop(*columns)


@column_step
def copy_columns(df: DataFrame, copies: Sequence[Copy | dict]) -> Expressions:
    out: Expressions = {}
    for spec in copies:
        copy = Copy(**spec) if isinstance(spec, dict) else spec
        if copy.as_name and copy.destination:
            raise ValueError(f"copy of {copy.source!r}: give as_name or destination, not both")
        new = None if copy.destination else copy.as_name or f"{copy.source} Copy"
        kind = kind_of(df, copy.source)
        out |= assigned(
            df, col(copy.source), kind, new, copy.destination, copy.type, copy.condition
        )
    return out


@column_step
def combine_columns(
    df: DataFrame,
    sources: Sequence[str],
    new_column: str | None = None,
    existing_column: str | None = None,
    separator: str = " ",
    nulls: str = "skip",
    condition: Predicate | dict | None = None,
) -> Expressions:
    """Join columns and ``__literal__:`` constants into one text.

    NULL parts are left out together with their separator, or count as empty
    text with ``nulls="empty"``.
    """
    if nulls not in ("skip", "empty"):
        raise ValueError(f"nulls is skip or empty, not {nulls!r}")

    def part(source: str) -> Column:
        if source.startswith(LITERAL_PREFIX):
            return F.lit(source.removeprefix(LITERAL_PREFIX))
        text = converted(col(source), kind_of(df, source), TEXT)
        return F.coalesce(text, F.lit("")) if nulls == "empty" else text

    value = F.concat_ws(separator, *[part(s) for s in sources])
    return assigned(df, value, TEXT, new_column, existing_column, TEXT, condition)


@column_step
def convert_type(df: DataFrame, conversions: Sequence[Conversion | dict]) -> Expressions:
    """Change column types in place; values that do not convert become NULL."""
    out = {}
    for spec in conversions:
        change = Conversion(**spec) if isinstance(spec, dict) else spec
        source = kind_of(df, change.column)
        out[change.column] = converted(col(change.column), source, change.to, change.format)
    return out


@column_step
def normalize_date(
    df: DataFrame, column: str, formats: Sequence[str] | None = None
) -> Expressions:
    """TEXT to DATE: the first format that reads a value wins; without formats, auto-detect."""
    if kind_of(df, column) == DATE:
        return {column: col(column)}
    return {column: parse_date(F.trim(col(column)), list(formats) if formats else None)}


@column_step
def split_column(
    df: DataFrame,
    column: str,
    delimiter: str | None = None,
    new_columns: Sequence[Part | dict | str] = (),
    positions: Sequence[int] | None = None,
) -> Expressions:
    """Split at a literal delimiter, or after the given numbers of characters.

    Missing parts are NULL, surplus parts are dropped.
    """
    require(df, column)
    if (not delimiter) == (not positions):
        raise ValueError("split_column takes a delimiter or positions; the delimiter is empty" if delimiter == "" else "split_column takes either a delimiter or positions")
    if positions:
        cuts = [0, *positions]
        if any(b <= a for a, b in zip(cuts, cuts[1:], strict=False)):
            raise ValueError("positions grow and start above 0")
        text, length = col(column), F.length(col(column))
        ends = [*(b - a for a, b in zip(cuts, cuts[1:], strict=False)), 2**31 - 1]
        parts = [F.when(length > a, F.substring(text, a + 1, n)) for a, n in zip(cuts, ends, strict=True)]
        pieces = F.array(*parts)
    else:
        pieces = F.split(col(column), literal_pattern(delimiter))
    out: Expressions = {}
    for index, spec in enumerate(new_columns, start=1):
        part = as_part(spec)
        piece = F.try_element_at(pieces, F.lit(index))
        out |= assigned(df, piece, TEXT, part.name, None, part.type)
    return out


def as_part(spec: Part | dict | str) -> Part:
    if isinstance(spec, str):
        return Part(spec)
    return Part(**spec) if isinstance(spec, dict) else spec


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    require(df, *columns)
    return df.select(*[col(c) for c in columns])


def arrange(
    df: DataFrame,
    rename: dict[str, str] | None = None,
    hide: Sequence[str] = (),
    first: Sequence[str] = (),
) -> DataFrame:
    """Presentation only: new names, hidden columns, and columns moved to the front."""
    rename = rename or {}
    require(df, *rename, *hide, *first)
    order = [*first, *[c for c in df.columns if c not in first]]
    return df.select(*[col(c).alias(rename.get(c, c)) for c in order if c not in hide])


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if kind_of(df, c) == NUMERIC]
