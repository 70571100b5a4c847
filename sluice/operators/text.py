"""Case, trimming, cleaning, replacement and extraction of text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.conditions import Predicate
from sluice.functions.kinds import TEXT, col, require
from sluice.functions.text import literal_replacement, replaced
from sluice.operators.targets import Expressions, assigned, column_step, rewritten

# fixed values: case names
_CASES = {"UPPER": F.upper, "LOWER": F.lower, "TITLE": F.initcap}
# fixed values: what the ways of trimming remove
_TRIMS = {"left": r"^\s+", "right": r"\s+$", "both": r"^\s+|\s+$", "all": r"\s+"}
# A value written for one target must not be searched again for the next. Until
# all are searched it is a mark of three characters: one that begins marks, and
# two for the number of the target. The first one, where a text has it already,
# becomes a mark too.
_MARK, _OWN, _FIRST, _BASE = "\uf8ff", "\uf8fe", 0xE000, 4096


@dataclass(frozen=True)
class Variants:
    """Spellings that all become one value."""

    search: tuple[str, ...] | list[str]
    replace: str


@column_step
def text_transform(
    df: DataFrame,
    columns: Sequence[str],
    case: str | None = None,
    trim: bool | str = False,
    clean: bool = False,
    collapse: bool = False,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """Change case, trim the ends, drop non-printable characters, collapse inner blanks.

    ``trim`` is true (blanks at both ends), ``left``, ``right``, ``both`` (any white
    space at the ends) or ``all`` (all white space).
    """
    if not isinstance(trim, bool) and trim not in _TRIMS:
        raise ValueError(f"trim is true, false or one of {tuple(_TRIMS)}, not {trim!r}")
    if case is not None and case not in _CASES:
        raise ValueError(f"case is one of {tuple(_CASES)}, not {case!r}")

    def change(value: Column) -> Column:
        if clean:
            value = F.regexp_replace(value, r"[\p{Cntrl}]", "")
        if collapse:
            value = F.regexp_replace(value, r"\s+", " ")
        if trim is True:
            value = F.trim(value)
        elif trim:
            value = F.regexp_replace(value, _TRIMS[trim], "")
        return _CASES[case](value) if case else value

    return rewritten(df, list(columns), change, condition)


@column_step
def replace_values(
    df: DataFrame,
    columns: Sequence[str],
    find: str,
    replace: str,
    match_case: bool = False,
    match_words: bool = False,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """Replace every occurrence of a literal text."""
    return rewritten(
        df,
        list(columns),
        lambda value: replaced(value, [find], replace, match_case, match_words),
        condition,
    )


@column_step
def bulk_replace(
    df: DataFrame,
    columns: Sequence[str],
    mapping: Sequence[Variants | dict],
    match_case: bool = True,
    match_words: bool = False,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """Replace many variants by few values, all at once.

    One expression per target value; for mappings with thousands of whole-cell
    variants use ``bulk_replace_from``, which joins instead.
    """
    targets = [Variants(**m) if isinstance(m, dict) else m for m in mapping]
    marks = [_MARK + chr(_FIRST + i // _BASE) + chr(_FIRST + i % _BASE) for i in range(len(targets))]

    def change(value: Column) -> Column:
        value = F.replace(value, F.lit(_MARK), F.lit(_MARK + _OWN))
        marked = reduce(
            lambda v, pair: replaced(v, list(pair[0].search), pair[1], match_case, match_words),
            zip(targets, marks, strict=True),
            value,
        )
        # marks give way all in one pass, so that no replacement is taken for a mark
        pieces = F.split(marked, f"(?={_MARK})")
        written = F.create_map(*[F.lit(x) for m, t in zip(marks, targets, strict=True) for x in (m, t.replace)])
        length = len(marks[0])

        def read(piece: Column) -> Column:
            found = F.try_element_at(written, F.substring(piece, 1, length))
            rest = F.substring(piece, length + 1, 2**31 - 1)
            own = F.concat(F.lit(_MARK), F.substring(piece, 3, 2**31 - 1))
            escaped = F.startswith(piece, F.lit(_MARK + _OWN))
            return F.when(escaped, own).when(found.isNotNull(), F.concat(found, rest)).otherwise(piece)

        return F.array_join(F.transform(pieces, read), "")

    return rewritten(df, list(columns), change, condition)


def bulk_replace_from(
    df: DataFrame,
    columns: Sequence[str],
    mapping: DataFrame,
    search: str = "variant",
    replace: str = "suggested",
    match_case: bool = True,
) -> DataFrame:
    """Whole-cell replacement from a table of any size, one left join per column.

    Spark broadcasts the table when its size allows and shuffles otherwise.
    """
    require(df, *columns)
    key = col(search) if match_case else F.lower(col(search))
    table = (
        mapping.filter(col(search).isNotNull())
        .groupBy(key.alias("_variant"))
        .agg(F.min(col(replace)).alias("_value"))
    )
    for name in columns:
        cell = col(name) if match_case else F.lower(col(name))
        joined = df.join(table, cell == F.col("_variant"), "left")
        df = joined.withColumn(name, F.coalesce(F.col("_value"), col(name))).drop(
            "_variant", "_value"
        )
    return df


@column_step
def substring(
    df: DataFrame,
    column: str,
    direction: str | None = None,
    num_char: int | None = None,
    char_position: int | None = None,
    wildcard: str | None = None,
    include_wildcard: bool = False,
    regex_pattern: str | None = None,
    regex_invert: bool = False,
    new_column: str | None = None,
    existing_column: str | None = None,
    condition: Predicate | dict | None = None,
) -> Expressions:
    """Part of a text by length, position, keyword or regular expression.

    START/END take ``num_char`` characters from one end. LEFT/RIGHT take what
    lies before, or from, ``char_position``. With ``wildcard`` they take what
    lies before or after a keyword. A pattern yields its first group, or the
    whole match; inverted, what is left without the matches.
    """
    require(df, column)
    value = _part(
        col(column),
        direction,
        num_char,
        char_position,
        wildcard,
        include_wildcard,
        regex_pattern,
        regex_invert,
    )
    return assigned(df, value, TEXT, new_column, existing_column, TEXT, condition)


def _part(
    text: Column,
    direction: str | None,
    num_char: int | None,
    char_position: int | None,
    wildcard: str | None,
    include_wildcard: bool,
    pattern: str | None,
    invert: bool,
) -> Column:
    if pattern is not None:
        if invert:
            return F.regexp_replace(text, pattern, literal_replacement(""))
        return F.regexp_extract(text, pattern, 1 if _has_group(pattern) else 0)
    if direction not in ("START", "END", "LEFT", "RIGHT"):
        raise ValueError(f"direction is START, END, LEFT or RIGHT, not {direction!r}")
    if wildcard is not None:
        return _around(text, wildcard, direction in ("START", "LEFT"), include_wildcard)
    if num_char is not None:
        take = F.left if direction in ("START", "LEFT") else F.right
        return take(text, F.lit(num_char))
    if char_position is None:
        raise ValueError("give num_char, char_position, wildcard or regex_pattern")
    if direction in ("START", "LEFT"):
        return F.left(text, F.lit(max(char_position - 1, 0)))
    return F.substring(text, F.lit(char_position), F.length(text))


def _around(text: Column, keyword: str, before: bool, include: bool) -> Column:
    """What lies before or after the first ``keyword``; NULL where it does not occur."""
    at = F.locate(keyword, text)
    if before:
        part = F.left(text, at - 1 + (len(keyword) if include else 0))
    else:
        part = F.substring(text, at + (0 if include else len(keyword)), F.length(text))
    return F.when(at > 0, part)


def _has_group(pattern: str) -> bool:
    import re

    return re.compile(pattern).groups > 0
