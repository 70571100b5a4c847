"""Order keys and balanced order buckets.

A running result over a long sequence must not pull the sequence into one task.
``with_buckets`` cuts the order into ranges of about equal row counts; results are
then computed inside each bucket and completed with what earlier buckets carry
over (see ``scan``). Cut points are constants in the plan, so a lost task that
runs again puts every row into the same bucket.
"""

from __future__ import annotations

import json
import math
import sys
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.kinds import DATE, NUMERIC, col, kind_of, require
from sluice.session import planned_bytes

BUCKET_BYTES = 128 << 20
# what is sampled for cut points: at least this much, and so much for each bucket
SAMPLED_BYTES, SAMPLED_PER_BUCKET = 64 << 20, 256 << 10
# cut points of a text key per bucket, rows sampled for each, and the text they may hold together
_FINER, _SAMPLED_ROWS, _SAMPLED_TEXT = 4, 8, 256 << 20
# Catalyst plans rows that came from the driver as if they were endless
UNKNOWN_BYTES = 1 << 60
_FAR = sys.float_info.max


@dataclass(frozen=True)
class Key:
    name: str
    descending: bool = False

    def sort(self, reverse: bool = False) -> Column:
        """NULLs come last in both directions, and first once reversed."""
        if self.descending:
            return col(self.name).asc_nulls_first() if reverse else col(self.name).desc_nulls_last()
        return col(self.name).desc_nulls_first() if reverse else col(self.name).asc_nulls_last()


def order_keys(df: DataFrame, order_by: Sequence | None, needed_by: str = "") -> list[Key]:
    """``["a", ["b", "DESC"]]`` to keys."""
    keys = []
    for item in order_by or ():
        if isinstance(item, Key):
            keys.append(item)
            continue
        name, direction = (item, "ASC") if isinstance(item, str) else item
        word = str(getattr(direction, "value", direction)).upper()
        if word not in ("ASC", "DESC"):
            raise ValueError(f"direction is ASC or DESC, not {direction!r}")
        keys.append(Key(name, word == "DESC"))
    require(df, *[k.name for k in keys])
    if needed_by and not keys:
        raise ValueError(f"{needed_by} needs order_by: rows of a table have no order of their own")
    return keys


def sorts(keys: Sequence[Key], reverse: bool = False) -> list[Column]:
    return [k.sort(reverse) for k in keys]


class _Codes:
    """Numbers that order rows as the keys do, one level after the other.

    Equal numbers on one level are told apart by the next. The levels of a key
    end only when equal numbers mean equal keys; where that cannot be had, the
    list stops and later keys are not used. The number of a text is how many cut
    points lie at or below it; a text that is frequent in the sample has a number
    of its own, and the others of a number fill a part of a bucket only.
    """

    def __init__(self, df: DataFrame, keys: Sequence[Key], sampled: DataFrame, count: int) -> None:
        self.df, self.keys, self.sampled, self.count = df, keys, sampled, count
        self._all: list[tuple[Column, bool]] | None = None

    def first(self) -> tuple[Column, bool]:
        key = self.keys[0]
        dtype = self.df.schema[key.name].dataType
        if kind_of(self.df, key.name) in (NUMERIC, DATE):
            return _numeric_codes(col(key.name), dtype, key.descending)[0], key.descending
        return self.all()[0]

    def all(self) -> list[tuple[Column, bool]]:
        if self._all is not None:
            return self._all
        self._all = []
        for key in self.keys:
            dtype = self.df.schema[key.name].dataType
            if kind_of(self.df, key.name) in (NUMERIC, DATE):
                codes, exact = _numeric_codes(col(key.name), dtype, key.descending), True
                if isinstance(dtype, T.DecimalType) and dtype.precision > 15:
                    exact = False
            else:
                codes, exact = [self._text_code(key)], True
            self._all += [(c, key.descending) for c in codes]
            if not exact:
                break
        return self._all

    def _text_code(self, key: Key) -> Column:
        text = col(key.name).cast("string")
        points = _text_points(self.sampled.select(text.alias("t")), self.count * _FINER)
        reached = _reached_text(text, points).cast("double")
        return F.when(text.isNotNull(), reached).otherwise(_far(key.descending))


def _text_points(sampled: DataFrame, wanted: int) -> list[str]:
    """Cut points on the real values of a sample; frequent values are cut on both sides.

    The sample is sorted on the driver: some rows per cut point, bounded in text.
    """
    sizes = sampled.agg(F.count("t"), F.sum(F.octet_length("t"))).first()
    if not sizes[0]:
        return []
    rows = min(wanted * _SAMPLED_ROWS, sizes[0], max(1000, _SAMPLED_TEXT * sizes[0] // max(sizes[1], 1)))
    few = sampled.filter("t IS NOT NULL").sample(fraction=min(1.0, rows / sizes[0]), seed=11)
    # Spark orders text by its bytes
    texts = sorted((r["t"] for r in few.collect()), key=lambda t: t.encode())
    step = max(1, len(texts) // wanted)
    picked = texts[::step]
    points: dict[str, None] = {}
    for text, n in Counter(picked).items():
        points[text] = None
        if n > 1:  # the next text in order after this one
            points[text + "\0"] = None
    return list(points)


def _reached_text(text: Column, points: list[str]) -> Column:
    """How many points lie at or below a text, by steps through a tree of a few levels."""
    if not points:
        return F.lit(0)
    fan = 16
    levels = [points]
    while len(levels[-1]) > fan:
        levels.append(levels[-1][::fan])
    reached: Column | None = None
    # from the coarsest level down: position among the points of each level
    for depth in range(len(levels) - 1, -1, -1):
        level = levels[depth]
        if reached is None:
            reached = F.size(F.filter(_array(level, "array<string>"), lambda p: p <= text))
            continue
        groups = [level[i : i + fan] for i in range(0, len(level), fan)]
        inside = F.element_at(_array(groups, "array<array<string>>"), F.greatest(reached, F.lit(1)))
        here = F.size(F.filter(inside, lambda p: p <= text))
        reached = F.when(reached == 0, 0).otherwise((reached - 1) * fan + here)
    return reached


def _array(values: list, kind: str) -> Column:
    """A constant array; one literal, however many values."""
    return F.from_json(F.lit(json.dumps(values)), kind)


def _far(descending: bool) -> Column:
    """NULLs sort last whatever the direction."""
    return F.lit(-_FAR if descending else _FAR)


def _numeric_codes(value: Column, dtype: T.DataType, descending: bool) -> list[Column]:
    far = _far(descending)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        number = F.nanvl(value.cast("double"), F.lit(_FAR))
        inside = F.greatest(F.least(number, F.lit(_FAR)), F.lit(-_FAR))
        code = F.when(value.isNotNull(), inside).otherwise(far)
        outside = (
            F.when(value.isNull(), -4.0 if descending else 4.0)
            .when(F.isnan(value), 3.0)
            .when(value == float("inf"), 2.0)
            .when(value == float("-inf"), -2.0)
            .otherwise(0.0)
        )
        return [code, outside]
    if isinstance(dtype, T.DecimalType):
        return [F.coalesce(value.cast("double"), far)]
    if not isinstance(dtype, T.IntegralType):
        value = F.unix_micros(value.cast("timestamp"))
    code = F.coalesce(value.cast("double"), far)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return [code]
    # what a double cannot hold of a 64-bit number
    rest = value.cast("decimal(38,0)") - value.cast("double").cast("decimal(38,0)")
    return [code, F.coalesce(rest.cast("double"), F.lit(0.0))]


def _shares(count: int) -> list[float]:
    return [i / count for i in range(1, count)]


def with_buckets(
    df: DataFrame, keys: Sequence[Key], out: str, count: int | None = None
) -> DataFrame:
    """Add bucket numbers that grow with the order of ``keys``, about ``count`` equal buckets.

    One aggregate over a sample of the first key finds the cut points. Rows that
    tie on a value which fills whole buckets are cut again along what follows in
    the order, level by level.
    """
    size = planned_bytes(df)
    if size >= UNKNOWN_BYTES:
        size = SAMPLED_BYTES
    if count is None:
        setting = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        parallel = int(setting) if setting.isdigit() else 200
        count = max(size // BUCKET_BYTES, parallel, 2)
    sampled, wanted = df, max(SAMPLED_BYTES, count * SAMPLED_PER_BUCKET)
    if size > wanted:
        sampled = df.sample(fraction=wanted / size, seed=7)
    codes = _Codes(df, keys, sampled, count)
    code, descending = codes.first()
    found = sampled.agg(F.percentile_approx(code, _shares(count), 10 * count)).first()[0] or []
    # a value that fills more than a bucket is cut again
    least = 2

    cuts = {(): sorted(set(found))}
    tied = {(v,): n for v, n in Counter(found).items() if n >= least}
    names = ["_code_0"]
    rows = df.withColumn(names[0], code)
    rows = _place(rows, names, descending, cuts, tied).withColumn(out, F.col("_place"))
    levels = codes.all() if tied else []
    for depth in range(1, len(levels)):
        if not tied:
            break
        before = [c for c, _ in levels[:depth]]
        code, descending = levels[depth]
        cuts, tied = _cut_ties(sampled, before, code, tied, least)
        names.append(f"_code_{depth}")
        rows = _place(rows.withColumn(names[-1], code), names, descending, cuts, tied)
        width = 2 * max((len(c) for c in cuts.values()), default=0) + 2
        rows = rows.withColumn(out, F.col(out) * width + F.col("_place"))
    return rows.drop(*names, "_place")


def _cut_ties(
    df: DataFrame, before: list[Column], code: Column, tied: dict[tuple, int], least: int
) -> tuple[dict[tuple, list[float]], dict[tuple, int]]:
    """Cut points inside each tie, and the ties that remain."""
    names = [f"c{i}" for i in range(len(before))]
    parts = max(tied.values()) + 1
    rows = df.select(*[c.alias(n) for c, n in zip(before, names, strict=True)], code.alias("code"))
    for i, name in enumerate(names):
        rows = rows.filter(F.col(name).isin(sorted({t[i] for t in tied})))
    found = rows.groupBy(*names).agg(F.percentile_approx("code", _shares(parts), 10 * parts))
    cuts, left = {}, {}
    for *prefix, points in found.collect():
        tie = tuple(prefix)
        if tie not in tied:
            continue
        cuts[tie] = sorted(set(points))
        for value, n in Counter(points).items():
            share = round(tied[tie] * n / parts)
            if n > 1 and share >= least:
                left[(*tie, value)] = share
    return cuts, left


def _place(
    rows: DataFrame,
    names: list[str],
    descending: bool,
    cuts: dict[tuple, list[float]],
    tied: dict[tuple, int],
) -> DataFrame:
    """``rows`` with their place on one level; ``names`` are its code and those before it.

    Places are even for values that are cut again and odd for the rest.
    """
    code, before = F.col(names[-1]), [F.col(n) for n in names[:-1]]
    width = 2 * max((len(c) for c in cuts.values()), default=0) + 2
    if len(cuts) == 1:
        (points,) = cuts.values()
        rows, reached = _reached(rows, names[-1], points)
    else:
        reached = None
    place = None
    for tie, points in cuts.items():
        at = reached if reached is not None else _reached_in(code, points)
        again = [t[-1] for t in tied if t[:-1] == tie]
        one = 2 * at + 1
        if again:
            one -= F.when(code.isin(again), 1).otherwise(0)
        one = (F.lit(width - 1) - one if descending else one).cast("bigint")
        if not tie:
            place = one
            break
        hit = reduce(lambda a, b: a & b, [c == v for c, v in zip(before, tie, strict=True)])
        place = F.when(hit, one) if place is None else place.when(hit, one)
    if place is None:
        place = F.lit(0)
    elif before:
        place = place.otherwise(0)
    return rows.withColumn("_place", place.cast("bigint")).drop("_reached")


def _reached(rows: DataFrame, name: str, points: list[float]) -> tuple[DataFrame, Column]:
    """How many cut points lie at or below a code, by binary search."""
    if not points:
        return rows, F.lit(0)
    ends = [float("-inf"), *points, float("inf")]
    cutter = Bucketizer(splits=ends, inputCol=name, outputCol="_reached")
    return cutter.transform(rows), F.col("_reached").cast("bigint")


def _reached_in(code: Column, points: list[float]) -> Column:
    """The same as an expression, for the few rows of one of several ties."""
    width = math.isqrt(len(points)) + 1
    groups = [points[i : i + width] for i in range(0, len(points), width)]
    if len(groups) < 2:
        return F.size(F.filter(F.lit(points), lambda p: p <= code)) if points else F.lit(0)
    group = F.size(F.filter(F.lit([g[0] for g in groups[1:]]), lambda p: p <= code))
    inner = F.element_at(F.lit(groups), group + 1)
    return group * width + F.size(F.filter(inner, lambda p: p <= code))
