"""The three column kinds (TEXT, NUMERIC, DATE) and conversions between them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT, NUMERIC, DATE = "TEXT", "NUMERIC", "DATE"

# fixed values: Spark type written for each kind
SPARK_TYPE = {TEXT: "string", NUMERIC: "double", DATE: "timestamp_ntz"}

# fixed values: layouts tried, in this order, when a date column has no format
DATE_LAYOUTS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
    "MM-dd-yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "dd.MM.yyyy",
)

# fixed values: regional reading of slash dates
REGION_LAYOUT = {"US": "MM/dd/yyyy", "UK": "dd/MM/yyyy"}


def col(name: str) -> Column:
    """Column by its exact name; dots and blanks are part of the name."""
    return F.col("`" + name.replace("`", "``") + "`")


def require(df: DataFrame, *names: str) -> None:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"unknown column(s) {unknown}; columns are {df.columns}")


def kind_of_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return NUMERIC
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return DATE
    return TEXT


def kind_of(df: DataFrame, name: str) -> str:
    require(df, name)
    return kind_of_type(df.schema[name].dataType)


def spark_type(kind: str) -> str:
    if kind not in SPARK_TYPE:
        raise ValueError(f"unknown column type {kind!r}; one of {sorted(SPARK_TYPE)}")
    return SPARK_TYPE[kind]


def java_layout(layout: str) -> str:
    """``MM/DD/YYYY`` style layouts to Spark datetime patterns."""
    spelled = {"YYYY": "yyyy", "YY": "yy", "DD": "dd", "D": "d", "A": "a", "AM": "a", "MI": "mm"}
    return re.sub(
        r"YYYY|YY|DD|D|AM|A|MI", lambda m: spelled[m.group()], REGION_LAYOUT.get(layout, layout)
    )


# what a run of one pattern letter looks like in a text
_SHAPES = {
    "yyyy": r"\d{4}",
    "MMMM": "[^ 0-9]+",
    "MMM": "[^ 0-9]+",
    "a": "[^ 0-9]+",
    **{two: r"\d{2}" for two in ("yy", "MM", "dd", "HH", "hh", "mm", "ss")},
    **{one: r"\d{1,2}" for one in ("M", "d", "H", "h", "m", "s")},
}


def _shape(pattern: str) -> str | None:
    """A regular expression that every text of the layout matches, if one is known."""
    out = ""
    for run in re.findall(r"([A-Za-z])(\1*)|(.)", pattern):
        letters = run[0] + run[1]
        if letters and letters not in _SHAPES:
            return None
        out += _SHAPES[letters] if letters else re.escape(run[2])
    return f"^{out}$"


def _read(text: Column, pattern: str) -> Column:
    """A failed attempt is slow, so only texts of the right shape are tried."""
    parsed = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    shape = None if "'" in pattern else _shape(pattern)
    return parsed if shape is None else F.when(text.rlike(shape), parsed)


def parse_date(text: Column, layouts: list[str] | None = None) -> Column:
    """TEXT to DATE; a value no layout reads becomes NULL."""
    tried = [_read(text, java_layout(f)) for f in (layouts or DATE_LAYOUTS)]
    if not layouts:
        tried.insert(0, text.try_cast("timestamp_ntz"))
    return F.coalesce(*tried)


def converted(value: Column, source: str, target: str, layout: str | None = None) -> Column:
    """``value`` of kind ``source`` as kind ``target``; failures become NULL."""
    spark_type(target)
    if source == target:
        return value
    if target == TEXT:
        if source == DATE:
            return F.date_format(value, java_layout(layout or "yyyy-MM-dd HH:mm:ss"))
        return number_text(value)
    if target == NUMERIC:
        if source == DATE:
            return F.unix_timestamp(value.cast("timestamp")).cast("double")
        return F.trim(value).try_cast("double")
    if source == NUMERIC:
        # digits of a date by its layout, else the seconds that DATE to NUMERIC gives
        read = parse_date(value.cast("decimal(38,0)").cast("string"), [layout] if layout else None)
        seconds = F.timestamp_micros((value * 1_000_000).try_cast("bigint")).cast("timestamp_ntz")
        return read if layout else F.coalesce(read, seconds)
    return parse_date(F.trim(value), [layout] if layout else None)


def number_text(value: Column) -> Column:
    """A number's digits, without an exponent where 38 digits suffice."""
    plain = value.cast("string")
    digits = value.try_cast("decimal(38,18)").cast("string")
    whole = F.regexp_replace(F.regexp_replace(digits, "0+$", ""), r"\.$", ".0")
    return F.when(plain.rlike("^-?[0-9.]+E"), F.coalesce(whole, plain)).otherwise(plain)


def literal(value: object, kind: str) -> Column:
    """A constant of the given kind."""
    return F.lit(value).cast(spark_type(kind)) if value is None else _typed(value, kind)


def _typed(value: object, kind: str) -> Column:
    if kind == NUMERIC:
        if isinstance(value, str):
            return F.lit(value).try_cast("double")
        return F.lit(value)
    if kind == DATE:
        return F.lit(str(value)).cast("timestamp_ntz")
    return F.lit(value if isinstance(value, str) else str(value))


def is_empty(value: Column, kind: str) -> Column:
    """NULL, or blank in a TEXT column."""
    return (value.isNull() | (F.trim(value) == "")) if kind == TEXT else value.isNull()
