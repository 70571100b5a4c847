"""Row conditions: comparison leaves joined with ``&``, ``|`` and ``~``.

A condition is plain data (see ``to_dict``); ``column(df)`` turns it into one
Spark predicate, which Catalyst pushes into the scan where it can.
"""

from __future__ import annotations

import datetime as dt
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import dates
from sluice.functions.kinds import DATE, TEXT, col, is_empty, kind_of, literal, require

# fixed values: operator names
COMPARISONS = ("EQ", "NE", "GT", "GTE", "LT", "LTE")
LISTS = ("IN_LIST", "NOT_IN_LIST")
TEXTS = (
    "CONTAINS",
    "NOT_CONTAINS",
    "ICONTAINS",
    "STARTS_WITH",
    "NOT_STARTS_WITH",
    "ENDS_WITH",
    "NOT_ENDS_WITH",
)
EMPTINESS = ("IS_EMPTY", "IS_NOT_EMPTY")
EXTREMES = ("IS_MAXVAL", "IS_NOT_MAXVAL", "IS_MINVAL", "IS_NOT_MINVAL")
OPERATORS = (*COMPARISONS, *LISTS, *TEXTS, *EMPTINESS, *EXTREMES, "IN_RANGE")
DATE_FUNCTIONS = ("NOW", "TODAY", "MAX", "MIN", "SYSTEM_DATE", "SYSTEM_TIME")


class Predicate:
    """Shared operators of leaves, groups and negations."""

    def __and__(self, other: Predicate) -> Predicate:
        return Group.joined("AND", self, other)

    def __or__(self, other: Predicate) -> Predicate:
        return Group.joined("OR", self, other)

    def __invert__(self) -> Predicate:
        return Negation(self)

    def leaves(self) -> Iterator[Condition]:
        raise NotImplementedError

    def to_dict(self) -> dict[str, Any]:
        raise NotImplementedError

    def _predicate(self, scope: _Scope) -> Column:
        raise NotImplementedError

    def column(self, df: DataFrame, run_at: dt.datetime | None = None) -> Column:
        """The predicate over ``df``.

        The first leaf that sets ``case_sensitive`` decides for the whole tree.
        ``run_at`` is the time behind SYSTEM_DATE and SYSTEM_TIME.
        """
        chosen = [x.case_sensitive for x in self.leaves() if x.case_sensitive is not None]
        return self._predicate(_Scope(df, not (chosen and chosen[0] is False), run_at))

    def names(self) -> set[str]:
        """All columns the condition reads."""
        found = set()
        for leaf in self.leaves():
            found.add(leaf.column_name)
            if leaf.value_is_column:
                found.add(leaf.value)
        return found


@dataclass(frozen=True)
class _Scope:
    df: DataFrame
    case_sensitive: bool
    run_at: dt.datetime | None

    def extreme(self, name: str, largest: bool) -> Column:
        """MAX or MIN of a column as a scalar subquery: one partial aggregate."""
        pick = F.max if largest else F.min
        return self.df.agg(pick(col(name))).scalar()

    def moment(self, function: str, name: str) -> Column:
        if function in ("MAX", "MIN"):
            return self.extreme(name, function == "MAX")
        if function in ("NOW", "TODAY") or self.run_at is None:
            now = F.localtimestamp()
        else:
            now = F.lit(self.run_at.isoformat(sep=" ")).cast("timestamp_ntz")
        return dates.truncated("day", now) if function in ("TODAY", "SYSTEM_DATE") else now


@dataclass(frozen=True)
class Condition(Predicate):
    """One comparison of a column with a value, a column or a date function."""

    column_name: str
    operator: str
    value: Any = None
    case_sensitive: bool | None = None
    value_is_column: bool = False
    component: str | None = None
    truncate: str | None = None
    value_is_date_fn: bool = False

    def __post_init__(self) -> None:
        if not isinstance(self.column_name, str) or not self.column_name:
            raise ValueError("a condition needs the name of a column")
        operator = str(getattr(self.operator, "value", self.operator)).upper()
        object.__setattr__(self, "operator", operator)
        if operator not in OPERATORS:
            raise ValueError(f"unknown operator {operator!r}; one of {OPERATORS}")
        if operator in EMPTINESS + EXTREMES:
            if self.value is not None:
                warnings.warn(f"{operator} takes no value; {self.value!r} is ignored", stacklevel=3)
        elif self.value is None:
            raise ValueError(f"{operator} needs a value")
        if operator == "IN_RANGE" and (
            not isinstance(self.value, (list, tuple)) or len(self.value) != 2
        ):
            raise ValueError(f"IN_RANGE needs a list of two bounds, not {self.value!r}")
        if self.value_is_date_fn and str(self.value) not in DATE_FUNCTIONS:
            raise ValueError(f"unknown date function {self.value!r}; one of {DATE_FUNCTIONS}")

    def leaves(self) -> Iterator[Condition]:
        yield self

    def to_dict(self) -> dict[str, Any]:
        out: dict[str, Any] = {"column": self.column_name, "operator": self.operator}
        for key in (
            "value",
            "case_sensitive",
            "value_is_column",
            "component",
            "truncate",
            "value_is_date_fn",
        ):
            if getattr(self, key) not in (None, False) or (
                key == "case_sensitive" and self.case_sensitive is False
            ):
                out[key] = getattr(self, key)
        if self.value is not None:
            out["value"] = self.value
        return out

    def _predicate(self, scope: _Scope) -> Column:
        require(scope.df, self.column_name)
        left, kind = col(self.column_name), kind_of(scope.df, self.column_name)
        op = self.operator
        if op in EMPTINESS:
            empty = is_empty(left, kind)
            return empty if op == "IS_EMPTY" else ~empty
        if op in EXTREMES:
            extreme = scope.extreme(self.column_name, "MAX" in op)
            return left != extreme if "NOT" in op else left == extreme

        fold = kind == TEXT and (not scope.case_sensitive or op == "ICONTAINS")

        def side(value: Column) -> Column:
            return F.lower(value) if fold else value

        if self.value_is_column:
            require(scope.df, self.value)
            return _compare(op, side(left), side(col(self.value)))
        if self.value_is_date_fn:
            return _compare(op, left, scope.moment(str(self.value), self.column_name))
        bounded = self._on_the_bare_column(left)
        if bounded is not None:
            return bounded
        if self.component is not None:
            left = dates.component(left, self.component)
            kind = dates.component_kind(self.component)
        if self.truncate is not None:
            left = dates.truncated(self.truncate, left)

        def constant(value: Any) -> Column:
            made = literal(value, kind)
            return side(dates.truncated(self.truncate, made) if self.truncate else made)

        values = list(self.value) if isinstance(self.value, (list, tuple, set)) else [self.value]
        if op == "IN_RANGE":
            if kind == TEXT:
                raise ValueError("IN_RANGE works on NUMERIC and DATE columns only")
            return left.between(constant(values[0]), constant(values[1]))
        if op in LISTS:
            found = side(left).isin([constant(v) for v in values])
            return ~found if op == "NOT_IN_LIST" else found
        if op in TEXTS:
            text = side(left if kind == TEXT else left.cast("string"))
            tests = {"CONTAINS": F.contains, "STARTS": F.startswith, "ENDS": F.endswith}
            word = op.replace("NOT_", "").replace("_WITH", "").replace("ICONTAINS", "CONTAINS")
            found = reduce(
                lambda a, b: a | b,
                [tests[word](text, side(F.lit(str(v)))) for v in values],
            )
            return ~found if op.startswith("NOT_") else found
        return _compare(op, side(left), constant(self.value))


    def _on_the_bare_column(self, left: Column) -> Column | None:
        """A comparison of a truncated date or a year as bounds of the date itself, which scans can use."""
        values = list(self.value) if isinstance(self.value, (list, tuple, set)) else [self.value]
        if self.operator not in (*_BOUNDS, "IN_RANGE") or None in values:
            return None
        if self.truncate is not None and self.component is None:
            unit = self.truncate
            starts = [dates.truncated(unit, literal(v, DATE)) for v in values]
        elif self.component is not None and self.component.lower() == "year" and self.truncate is None:
            unit = "year"
            if not all(isinstance(v, int) and not isinstance(v, bool) and 1 <= v < 9999 for v in values):
                return None
            starts = [F.lit(f"{v:04d}-01-01").cast("timestamp_ntz") for v in values]
        else:
            return None
        ends = [F.timestamp_add(unit.upper(), F.lit(1), s) for s in starts]
        if self.operator == "IN_RANGE":
            return (left >= starts[0]) & (left < ends[1])
        return _BOUNDS[self.operator](left, starts[0], ends[0])


# comparisons of a moment's unit with a unit from ``start`` to before ``end``
_BOUNDS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "EQ": lambda left, start, end: (left >= start) & (left < end),
    "NE": lambda left, start, end: (left < start) | (left >= end),
    "GT": lambda left, start, end: left >= end,
    "GTE": lambda left, start, end: left >= start,
    "LT": lambda left, start, end: left < start,
    "LTE": lambda left, start, end: left < end,
}


def _compare(op: str, left: Column, right: Column) -> Column:
    if op == "EQ":
        return left == right
    if op == "NE":
        return left != right
    if op == "GT":
        return left > right
    if op == "GTE":
        return left >= right
    if op == "LT":
        return left < right
    if op == "LTE":
        return left <= right
    raise ValueError(f"{op} does not compare with a column or a date function")


@dataclass(frozen=True)
class Group(Predicate):
    """AND or OR over at least two conditions."""

    logic: str
    parts: tuple[Predicate, ...]

    def __post_init__(self) -> None:
        if self.logic not in ("AND", "OR"):
            raise ValueError(f"logic is AND or OR, not {self.logic!r}")
        if len(self.parts) < 2:
            raise ValueError(f"{self.logic} needs two conditions or more")
        wrong = [p for p in self.parts if not isinstance(p, Predicate)]
        if wrong:
            raise TypeError(f"not a condition: {wrong[0]!r}")

    @classmethod
    def joined(cls, logic: str, *parts: Predicate) -> Group:
        """Flatten members of the same logic into one group."""
        flat: list[Predicate] = []
        for part in parts:
            flat.extend(part.parts if isinstance(part, Group) and part.logic == logic else [part])
        return cls(logic, tuple(flat))

    def leaves(self) -> Iterator[Condition]:
        for part in self.parts:
            yield from part.leaves()

    def to_dict(self) -> dict[str, Any]:
        return {"logic": self.logic, "conditions": [p.to_dict() for p in self.parts]}

    def _predicate(self, scope: _Scope) -> Column:
        sides = [p._predicate(scope) for p in self.parts]
        return reduce((lambda a, b: a & b) if self.logic == "AND" else (lambda a, b: a | b), sides)


@dataclass(frozen=True)
class Negation(Predicate):
    part: Predicate

    def __post_init__(self) -> None:
        if not isinstance(self.part, Predicate):
            raise TypeError(f"not a condition: {self.part!r}")

    def __invert__(self) -> Predicate:
        return self.part

    def leaves(self) -> Iterator[Condition]:
        yield from self.part.leaves()

    def to_dict(self) -> dict[str, Any]:
        return {"logic": "NOT", "conditions": [self.part.to_dict()]}

    def _predicate(self, scope: _Scope) -> Column:
        return ~self.part._predicate(scope)


def all_of(*parts: Predicate) -> Predicate:
    return Group.joined("AND", *parts) if len(parts) > 1 else parts[0]


def any_of(*parts: Predicate) -> Predicate:
    return Group.joined("OR", *parts) if len(parts) > 1 else parts[0]


def condition_from_dict(data: dict[str, Any]) -> Predicate:
    """The inverse of ``to_dict``; also the JSON form users write by hand."""
    if "logic" in data:
        parts = [condition_from_dict(d) for d in data["conditions"]]
        logic = data["logic"].upper()
        if logic == "NOT":
            return ~all_of(*parts)
        return all_of(*parts) if logic == "AND" else any_of(*parts)
    rest = {k: v for k, v in data.items() if k not in ("column", "operator", "value")}
    return Condition(data["column"], data["operator"], data.get("value"), **rest)


def as_predicate(condition: Predicate | dict[str, Any] | None) -> Predicate | None:
    return condition_from_dict(condition) if isinstance(condition, dict) else condition


def needs_date(df: DataFrame, name: str) -> None:
    if kind_of(df, name) != DATE:
        raise ValueError(f"{name!r} is not a DATE column; convert it first")
