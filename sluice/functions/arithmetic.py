"""Arithmetic text such as ``Price * (1 - Discount)`` to a Spark column.

Column names may hold blanks; they are swapped for plain identifiers, longest
name first, and Python's own expression grammar then gives the usual precedence.
"""

from __future__ import annotations

import ast
import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.kinds import col


def ordered_pick(values: list[Column], k: int, smallest: bool) -> Column:
    """The k-th smallest or largest of several values in one row, NULLs left out."""
    if k < 1:
        raise ValueError(f"the rank counts from 1, got {k}")
    ranked = F.sort_array(
        F.array_compact(F.array(*[v.cast("double") for v in values])), asc=smallest
    )
    return F.try_element_at(ranked, F.lit(k))


def _filled(values: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(v, F.lit(0)) for v in values])


def _present(values: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(v.isNull(), 0).otherwise(1) for v in values])


def _row_sum(*values: Column) -> Column:
    return F.when(_present(list(values)) > 0, _filled(list(values)))


def _row_mean(*values: Column) -> Column:
    return F.try_divide(_filled(list(values)), _present(list(values)))


def _several(function: Callable[..., Column]) -> Callable[..., Column]:
    return lambda *values: function(*values) if len(values) > 1 else values[0]


def _rounded(value: Column, digits: Column | None = None) -> Column:
    return F.round(value, 0 if digits is None else digits)


# fixed values: function names usable in an expression
FUNCTIONS: dict[str, Callable[..., Column]] = {
    "ABS": F.abs,
    "INT": lambda value: value.try_cast("bigint"),
    "SUM": _row_sum,
    "AVG": _row_mean,
    "MIN": _several(F.least),
    "MAX": _several(F.greatest),
    "COUNT": lambda *values: _present(list(values)),
    "ROUND": _rounded,
    "CEILING": F.ceil,
    "FLOOR": F.floor,
    "POWER": lambda base, exponent: F.pow(base, exponent),
    "SQRT": lambda value: F.when(value >= 0, F.sqrt(value)),
    "IF": lambda test, yes, no: F.when(test, yes).otherwise(no),
}
RANKED = ("SMALL", "LARGE")

_BINARY: dict[type, Callable[[Column, Column], Column]] = {
    ast.Add: lambda a, b: a + b,
    ast.Sub: lambda a, b: a - b,
    ast.Mult: lambda a, b: a * b,
    ast.Div: F.try_divide,
    ast.Mod: F.try_mod,
}
_TESTS: dict[type, Callable[[Column, Column], Column]] = {
    ast.Eq: lambda a, b: a == b,
    ast.NotEq: lambda a, b: a != b,
    ast.Lt: lambda a, b: a < b,
    ast.LtE: lambda a, b: a <= b,
    ast.Gt: lambda a, b: a > b,
    ast.GtE: lambda a, b: a >= b,
}


def expression(text: str, names: list[str]) -> Column:
    """The column ``text`` computes over columns ``names``.

    Division and modulo by zero give NULL, and so does any NULL operand.
    """
    marked, used = _mark(text, names)
    try:
        tree = ast.parse(marked.strip(), mode="eval").body
    except SyntaxError as error:
        raise ValueError(f"cannot read expression {text!r}: {error.msg}") from None
    return _build(tree, used, text)


def columns_in(text: str, names: list[str]) -> set[str]:
    """Names of the columns an expression reads."""
    return set(_mark(text, names)[1].values())


def _mark(text: str, names: list[str]) -> tuple[str, dict[str, str]]:
    calls = "|".join([*FUNCTIONS, *RANKED])
    known = "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    quoted = r"'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\""
    # names inside quoted text are text
    pattern = re.compile(rf"(?P<text>{quoted})|(?<!\w)(?:(?P<call>{calls})(?=\s*\()|(?P<name>{known})(?!\w))")
    used: dict[str, str] = {}

    def mark(match: re.Match[str]) -> str:
        if match["call"] or match["text"]:
            return match[0]
        key = f"_column_{names.index(match['name'])}_"
        used[key] = match["name"]
        return key

    return pattern.sub(mark, text), used


def _build(node: ast.expr, used: dict[str, str], text: str) -> Column:
    def sub(child: ast.expr) -> Column:
        return _build(child, used, text)

    match node:
        case ast.Constant(value=int() | float() as number) if not isinstance(number, bool):
            return F.lit(number)
        case ast.Constant(value=str() as word):
            return F.lit(word)
        case ast.Name(id=key) if key in used:
            return col(used[key])
        case ast.UnaryOp(op=ast.USub(), operand=inner):
            return -sub(inner)
        case ast.UnaryOp(op=ast.UAdd(), operand=inner):
            return sub(inner)
        case ast.BinOp(left=left, op=op, right=right) if type(op) in _BINARY:
            return _BINARY[type(op)](sub(left), sub(right))
        case ast.Compare(left=left, ops=[op], comparators=[right]) if type(op) in _TESTS:
            return _TESTS[type(op)](sub(left), sub(right))
        case ast.Call(func=ast.Name(id=name), args=[*args], keywords=[]) if name in RANKED:
            rank = args[-1]
            if len(args) < 2 or not isinstance(rank, ast.Constant):
                raise ValueError(f"{name} needs values and then a rank: {text!r}")
            return ordered_pick([sub(a) for a in args[:-1]], rank.value, name == "SMALL")
        case ast.Call(func=ast.Name(id=name), args=[*args], keywords=[]) if name in FUNCTIONS:
            return FUNCTIONS[name](*[sub(a) for a in args])
    raise ValueError(f"cannot read {ast.unparse(node)!r} in expression {text!r}")
