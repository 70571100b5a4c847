"""SQL steps over the current table."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# fixed values: names the current table goes by in a query
TABLE_NAMES = ("dataview", "__TABLE__", "this")
_DOUBLE_QUOTES = "spark.sql.ansi.doubleQuotedIdentifiers"

# fixed values: format specifiers of strftime, as expressions of ``moment``
_SPECIFIERS = {
    "%a": "date_format(moment, 'EEE')",
    "%A": "date_format(moment, 'EEEE')",
    "%b": "date_format(moment, 'MMM')",
    "%B": "date_format(moment, 'MMMM')",
    "%c": "date_format(moment, 'yyyy-MM-dd HH:mm:ss')",
    "%d": "date_format(moment, 'dd')",
    "%-d": "date_format(moment, 'd')",
    "%f": "date_format(moment, 'SSSSSS')",
    "%g": "date_format(moment, 'SSS')",
    "%G": "CAST(extract(YEAROFWEEK FROM moment) AS STRING)",
    "%H": "date_format(moment, 'HH')",
    "%-H": "date_format(moment, 'H')",
    "%I": "date_format(moment, 'hh')",
    "%-I": "date_format(moment, 'h')",
    "%j": "date_format(moment, 'DDD')",
    "%-j": "date_format(moment, 'D')",
    "%m": "date_format(moment, 'MM')",
    "%-m": "date_format(moment, 'M')",
    "%M": "date_format(moment, 'mm')",
    "%-M": "date_format(moment, 'm')",
    "%p": "CASE WHEN hour(moment) < 12 THEN 'AM' ELSE 'PM' END",
    "%S": "date_format(moment, 'ss')",
    "%-S": "date_format(moment, 's')",
    "%u": "CAST(weekday(moment) + 1 AS STRING)",
    "%U": "lpad(CAST(floor((dayofyear(moment) + 6 - (weekday(moment) + 1) % 7) / 7) AS STRING), 2, '0')",
    "%V": "lpad(CAST(weekofyear(moment) AS STRING), 2, '0')",
    "%w": "CAST((weekday(moment) + 1) % 7 AS STRING)",
    "%W": "lpad(CAST(floor((dayofyear(moment) + 6 - weekday(moment)) / 7) AS STRING), 2, '0')",
    "%x": "date_format(moment, 'yyyy-MM-dd')",
    "%X": "date_format(moment, 'HH:mm:ss')",
    "%y": "date_format(moment, 'yy')",
    "%-y": "CAST(year(moment) % 100 AS STRING)",
    "%Y": "date_format(moment, 'yyyy')",
    "%%": "'%'",
}
_PIECES = " ".join(f"WHEN '{k}' THEN {v}" for k, v in _SPECIFIERS.items())

# fixed values: units of date_diff written in quotes, as boundaries between two moments (weeks: whole ones between the days)
_BOUNDARIES = {
    "second": "CAST(unix_seconds(date_trunc('SECOND', b)) - unix_seconds(date_trunc('SECOND', a)) AS BIGINT)",
    "minute": "CAST((unix_seconds(date_trunc('MINUTE', b)) - unix_seconds(date_trunc('MINUTE', a))) / 60 AS BIGINT)",
    "hour": "CAST((unix_seconds(date_trunc('HOUR', b)) - unix_seconds(date_trunc('HOUR', a))) / 3600 AS BIGINT)",
    "day": "CAST(datediff(b, a) AS BIGINT)",
    "week": "CAST(datediff(b, a) / 7 AS BIGINT)",
    "month": "CAST((year(b) - year(a)) * 12 + month(b) - month(a) AS BIGINT)",
    "quarter": "CAST((year(b) - year(a)) * 4 + quarter(b) - quarter(a) AS BIGINT)",
    "year": "CAST(year(b) - year(a) AS BIGINT)",
}

# Names that Spark spells differently; created once per session as SQL functions.
_ALIASES = (
    """CREATE OR REPLACE TEMPORARY FUNCTION regexp_matches(text STRING, pattern STRING)
       RETURNS BOOLEAN RETURN text RLIKE pattern""",
    f"""CREATE OR REPLACE TEMPORARY FUNCTION strftime(moment TIMESTAMP, layout STRING)
       RETURNS STRING RETURN CASE WHEN moment IS NOT NULL AND layout IS NOT NULL THEN array_join(transform(
         regexp_extract_all(layout, '%-?.|[^%]+|%', 0), piece -> CASE piece {_PIECES} ELSE piece END), '') END""",
    *[
        f"""CREATE OR REPLACE TEMPORARY FUNCTION date_diff_{unit}(a TIMESTAMP, b TIMESTAMP)
            RETURNS BIGINT RETURN {text}"""
        for unit, text in _BOUNDARIES.items()
    ],
)
_QUOTED_UNIT = re.compile(r"(?i)\bdate_diff\s*\(\s*'(" + "|".join(_BOUNDARIES) + r")s?'\s*,")


def sql_query(
    df: DataFrame,
    query: str,
    args: Mapping[str, object] | None = None,
    snippets: Mapping[str, str] | None = None,
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One read-only statement; the table is ``dataview`` (or ``__TABLE__``, ``this``).

    Double quotes enclose column names. ``:name`` parameters come from ``args``
    as values, ``{name}`` from ``snippets`` as text, further tables by name.
    """
    text = expand(query, snippets or {}).strip().rstrip(";").strip()
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|/\*.*?\*/", " ", text, flags=re.S)
    if ";" in bare:
        raise ValueError("only a single statement is allowed")
    if not re.match(r"(?is)[\s(]*(select|with|values|from)\b", bare):
        raise ValueError("only queries are allowed")
    # both WITH and FROM may lead to a statement that writes
    if re.search(r"(?i)\binsert\s+(overwrite|into)\b|\b(merge\s+into|delete\s+from|update\s+\S+\s+set)\b", bare):
        raise ValueError("only queries are allowed, nothing that writes")
    text = _QUOTED_UNIT.sub(lambda m: f"date_diff_{m[1].lower()}(", text)
    spark = df.sparkSession
    views = {name: df for name in TABLE_NAMES} | dict(tables or {})
    before = spark.conf.get(_DOUBLE_QUOTES)
    own = _temporary_views(spark, list(views))
    spark.conf.set(_DOUBLE_QUOTES, "true")
    try:
        for statement in _ALIASES:
            spark.sql(statement)
        for name, table in views.items():
            table.createOrReplaceTempView(name)
        return spark.sql(text, args=dict(args or {}))
    finally:
        spark.conf.set(_DOUBLE_QUOTES, before)
        for name in views:
            # the caller's views of the same names come back
            if name in own:
                own[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def _temporary_views(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """The session's own temporary views among the names."""
    known = {t.name.lower() for t in spark.catalog.listTables() if t.isTemporary}
    return {n: spark.table(n) for n in names if n.lower() in known}


def expand(text: str, snippets: Mapping[str, str]) -> str:
    """Put stored fragments in place of ``{name}``; fragments may use fragments."""
    for _ in range(len(snippets) + 1):
        found = re.findall(r"\{(\w+)\}", text)
        if not found:
            return text
        missing = [f for f in found if f not in snippets]
        if missing:
            raise ValueError(f"unknown snippet {missing[0]!r}")
        text = re.sub(r"\{(\w+)\}", lambda m: f"({snippets[m[1]]})", text)
    raise ValueError("snippets refer to each other in a circle")
