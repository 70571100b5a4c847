"""Date components, unit differences and increments."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.kinds import DATE, NUMERIC, TEXT


def truncated(unit: str, value: Column) -> Column:
    """``date_trunc`` that keeps the naive timestamp type."""
    return F.date_trunc(unit.lower(), value).cast("timestamp_ntz")


def _layout(pattern: str) -> Callable[[Column], Column]:
    return lambda value: F.date_format(value, pattern)


def _iso_week_label(value: Column) -> Column:
    iso_year = F.extract(F.lit("YEAROFWEEK"), value).cast("string")
    return F.concat(iso_year, F.lit("-W"), F.lpad(F.weekofyear(value).cast("string"), 2, "0"))


# fixed values: component name -> (kind of the result, expression)
COMPONENTS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "year": (NUMERIC, F.year),
    "month": (NUMERIC, F.month),
    "day": (NUMERIC, F.dayofmonth),
    "hour": (NUMERIC, F.hour),
    "minute": (NUMERIC, F.minute),
    "second": (NUMERIC, F.second),
    "week": (NUMERIC, F.weekofyear),
    "quarter": (NUMERIC, F.quarter),
    "day_of_week": (NUMERIC, lambda value: F.dayofweek(value) - 1),
    "day_of_year": (NUMERIC, F.dayofyear),
    "weekday_text": (TEXT, _layout("EEEE")),
    "month_text": (TEXT, _layout("MMMM")),
    "year_month": (TEXT, _layout("yyyy-MM")),
    "year_month_number": (TEXT, _layout("yyyyMM")),
    "year_week": (TEXT, _iso_week_label),
    "year_quarter": (TEXT, _layout("yyyy-'Q'q")),
    "month_day": (TEXT, _layout("MM-dd")),
    "hour_minute": (TEXT, _layout("HH:mm")),
    "hour_minute_second": (TEXT, _layout("HH:mm:ss")),
    "year_month_day": (TEXT, _layout("yyyy-MM-dd")),
    "year_month_day_as_date": (DATE, lambda value: truncated("day", value)),
    "month_day_year_hour_minute_second": (TEXT, _layout("MM-dd-yyyy HH:mm:ss")),
    "date_only": (TEXT, _layout("yyyy-MM-dd")),
}


def component(value: Column, name: str) -> Column:
    kind = component_kind(name)
    build = COMPONENTS[name.lower()][1]
    result = build(value)
    return result.cast("double") if kind == NUMERIC else result


def component_kind(name: str) -> str:
    if name.lower() not in COMPONENTS:
        raise ValueError(f"unknown date component {name!r}; one of {sorted(COMPONENTS)}")
    return COMPONENTS[name.lower()][0]


def _clock_units(unit: str, seconds: int) -> Callable[[Column, Column], Column]:
    def between(start: Column, end: Column) -> Column:
        def ticks(value: Column) -> Column:
            return F.unix_timestamp(F.date_trunc(unit, value))

        return F.floor((ticks(end) - ticks(start)) / F.lit(seconds))

    return between


def _months(value: Column, per_year: int, part: Callable[[Column], Column]) -> Column:
    return F.year(value) * per_year + part(value)


# Differences count unit boundaries crossed, so Jan 31 -> Feb 1 is one month.
# Weeks are whole runs of seven days.
_BETWEEN: dict[str, Callable[[Column, Column], Column]] = {
    "YEAR": lambda a, b: F.year(b) - F.year(a),
    "QUARTER": lambda a, b: _months(b, 4, F.quarter) - _months(a, 4, F.quarter),
    "MONTH": lambda a, b: _months(b, 12, F.month) - _months(a, 12, F.month),
    "WEEK": lambda a, b: (F.datediff(b, a) / F.lit(7)).cast("bigint"),
    "DAY": lambda a, b: F.datediff(b, a),
    "HOUR": _clock_units("hour", 3600),
    "MINUTE": _clock_units("minute", 60),
    "SECOND": _clock_units("second", 1),
}

DIFF_UNITS = tuple(_BETWEEN)


def between(unit: str, start: Column, end: Column) -> Column:
    """Number of ``unit`` steps from ``start`` to ``end``, as NUMERIC."""
    key = unit.upper()
    if key not in _BETWEEN:
        raise ValueError(f"unknown date unit {unit!r}; one of {DIFF_UNITS}")
    return _BETWEEN[key](start, end).cast("double")


@dataclass(frozen=True)
class Delta:
    """An amount of calendar time; parts may be negative."""

    years: int = 0
    months: int = 0
    weeks: int = 0
    days: int = 0
    hours: int = 0
    minutes: int = 0
    seconds: int = 0

    def shift(self, value: Column) -> Column:
        return value + F.make_interval(
            F.lit(self.years),
            F.lit(self.months),
            F.lit(self.weeks),
            F.lit(self.days),
            F.lit(self.hours),
            F.lit(self.minutes),
            F.lit(self.seconds),
        )
