"""Joins by range and by nearest order value.

A range join is an equality join in disguise. The values of both sides are cut
into cells at shared points; a range is split at cell edges into few aligned
runs of cells of sizes 1, 2, 4, ..., and a value meets the run of each size that
its cell lies in. Every pair meets exactly once, and only pairs that meet in a
range's outermost cells can fail the exact comparison. Texts are cut by the bytes
that follow the beginning that all of them share. Where there are equal keys as
well, only keys with more rows than a cell holds are cut; the others meet by key.

A nearest join is one pass over both sides in one order: each row of the left
side takes the last row of the right side that came before it, carried over the
order buckets of a long group (see ``scan``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from os.path import commonprefix

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.kinds import DATE, TEXT, col, kind_of, require
from sluice.operators.joins import _pair, brought, unused
from sluice.operators.ordering import Key, _numeric_codes
from sluice.operators.scan import last_present
from sluice.session import materialize, settled

# fixed values: which ends belong to a range
ENDS = ("BOTH", "LOW", "HIGH", "NEITHER")
DIRECTIONS = ("BACKWARD", "FORWARD")
# shared cut points from quantiles; cells between them are of equal width
POINTS = 1024
CELL_ROWS = 256
_RUN = 1 << 48  # numbers of runs of one size


def join_range(
    df: DataFrame,
    other: DataFrame,
    value: str,
    low: str,
    high: str,
    on: Sequence[tuple[str, str] | str | Mapping[str, str]] = (),
    join_type: str = "INNER",
    select: Sequence[str | tuple[str, str] | Mapping[str, str]] = (),
    column_prefix: str | None = None,
    ends: str = "BOTH",
) -> DataFrame:
    """Rows of ``df`` with the rows of ``other`` whose range ``low`` to ``high`` holds ``value``.

    ``on`` adds equal keys, ``ends`` says which ends belong to a range. A NULL
    value, bound or key matches nothing. LEFT keeps rows without a match.
    """
    how = _checked(join_type, ends)
    pairs, chosen = [_pair(item, "left", "right") for item in on], brought(df, other, select, column_prefix)
    require(df, value, *[left for left, _ in pairs])
    require(other, low, high, *[right for _, right in pairs])
    _same_kind(df, value, other, low, high)
    left = _Side(df, how)
    points = left.rows.select(left.whole, *_keys(pairs, 0), col(value).alias("at"))
    ranges = settled(other.select(*_keys(pairs, 1), col(low).alias("low"), col(high).alias("high"), _found(chosen)), "ranges")
    inside = {"BOTH": ("<=", "<="), "LOW": ("<=", "<"), "HIGH": ("<", "<="), "NEITHER": ("<", "<")}[ends]
    exact = F.expr(f"low {inside[0]} at AND at {inside[1]} high")
    met = _meet(points, ranges, [f"key{k}" for k in range(len(pairs))], exact)
    return left.result(met, chosen)


def join_overlap(
    df: DataFrame,
    other: DataFrame,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    on: Sequence[tuple[str, str] | str | Mapping[str, str]] = (),
    join_type: str = "INNER",
    select: Sequence[str | tuple[str, str] | Mapping[str, str]] = (),
    column_prefix: str | None = None,
    ends: str = "BOTH",
) -> DataFrame:
    """Rows of both sides whose ranges share a value.

    Of two ranges that overlap one begins in the other: pairs whose right range
    begins in the left one, and pairs whose left range begins in the right one
    and later. ``ends`` is BOTH (ranges that touch overlap) or LOW (they do not;
    an empty range overlaps nothing). Ranges whose low end lies above the high
    end, and NULLs, match nothing.
    """
    how = _checked(join_type, ends)
    if ends not in ("BOTH", "LOW"):
        raise ValueError(f"ends is BOTH or LOW, not {ends!r}")
    pairs, chosen = [_pair(item, "left", "right") for item in on], brought(df, other, select, column_prefix)
    (a, b), (c, d) = left_range, right_range
    require(df, a, b, *[left for left, _ in pairs])
    require(other, c, d, *[right for _, right in pairs])
    _same_kind(df, a, other, c, d)
    _same_kind(df, b, other, c, d)
    left, keys = _Side(df, how), [f"key{k}" for k in range(len(pairs))]
    fits = "low <= high" if ends == "BOTH" else "low < high"
    ones = settled(left.rows.select(left.whole, *_keys(pairs, 0), col(a).alias("low"), col(b).alias("high")).filter(fits), "ranges")
    twos = other.select(*_keys(pairs, 1), col(c).alias("low"), col(d).alias("high"), _found(chosen)).filter(fits)
    twos = settled(twos, "ranges")
    below = "<=" if ends == "BOTH" else "<"
    right_begins = _meet(twos.select(*keys, "found", F.col("low").alias("at")), ones, keys, F.expr(f"low <= at AND at {below} high"))
    left_begins = _meet(ones.select(*keys, "row", F.col("low").alias("at")), twos, keys, F.expr(f"low < at AND at {below} high"))
    return left.result(right_begins.select("row", "found").unionAll(left_begins.select("row", "found")), chosen)


def _checked(join_type: str, ends: str) -> str:
    how = str(getattr(join_type, "value", join_type)).upper()
    if how not in ("INNER", "LEFT"):
        raise ValueError(f"join_type is INNER or LEFT, not {join_type!r}")
    if ends not in ENDS:
        raise ValueError(f"ends is one of {ENDS}, not {ends!r}")
    return how


def _same_kind(df: DataFrame, value: str, other: DataFrame, *bounds: str) -> None:
    kinds = {kind_of(df, value), *(kind_of(other, b) for b in bounds)}
    if len(kinds) > 1:
        raise ValueError(f"values and bounds are of one kind, not {sorted(kinds)}")


def _keys(pairs: Sequence[tuple[str, str]], side: int) -> list[Column]:
    return [col(pair[side]).alias(f"key{k}") for k, pair in enumerate(pairs)]


def _found(chosen: Mapping[str, Column]) -> Column:
    """What a match brings, as one column that is never empty."""
    return F.struct(*[c.alias(n) for n, c in chosen.items()], F.lit(0).alias(unused("none", list(chosen)))).alias("found")


class _Side:
    """The left table; each row travels as one column, and has a number if rows without a match are kept."""

    def __init__(self, df: DataFrame, how: str) -> None:
        self.names = df.columns
        self.number = unused("row_number", df.columns) if how == "LEFT" else None
        self.rows = df
        if self.number:
            # written once, so that every read sees the same numbers
            self.rows = materialize(df.withColumn(self.number, F.monotonically_increasing_id()), "rows")
        self.whole = F.struct(*[col(c) for c in self.rows.columns]).alias("row")

    def result(self, met: DataFrame, chosen: Mapping[str, Column]) -> DataFrame:
        taken = list(dict.fromkeys(self.names))
        own = [F.col("row")[c].alias(c) for c in taken]
        extra = list(chosen)
        matched = met.select(*own, *([F.col("row")[self.number].alias(self.number)] if self.number else []), *[F.col("found")[c].alias(c) for c in extra])
        if not self.number:
            return matched
        seen = matched.select(col(self.number)).distinct()
        alone = self.rows.join(seen, self.number, "left_anti")
        kinds = {c: matched.schema[c].dataType for c in extra}
        alone = alone.select(*[col(c) for c in taken], *[F.lit(None).cast(kinds[c]).alias(c) for c in extra])
        return matched.drop(self.number).unionAll(alone)


class _Cells:
    """Cells of the order of numbers: between two cut points each is as wide as the next."""

    def __init__(self, codes: DataFrame, rows: int) -> None:
        """``codes`` has one column of numbers, taken from ``rows`` rows."""
        wanted = max(1, min(POINTS, rows // CELL_ROWS))
        # a fixed number of rows for each cut point
        share = min(1.0, 2000 * wanted / max(rows, 1))
        sampled = codes if share == 1.0 else codes.sample(fraction=share, seed=13)
        name = codes.columns[0]
        found = sampled.agg(F.percentile_approx(name, [k / wanted for k in range(wanted + 1)], 20 * wanted)).first()[0] or []
        self.points = sorted(set(found))
        self.bits = max(0, (rows // CELL_ROWS // max(len(self.points), 1)).bit_length())

    def of(self, df: DataFrame, code: str, out: str) -> DataFrame:
        """``df`` with the cell of a number, from 0 up."""
        if not self.points:
            return df.withColumn(out, F.lit(0).cast("long"))
        ends = [float("-inf"), *self.points, float("inf")]
        placed = Bucketizer(splits=ends, inputCol=code, outputCol="reached").transform(df)
        reached = F.col("reached").cast("long")
        lows, widths = [0.0, *self.points], [0.0, *(b - a for a, b in zip(self.points, self.points[1:], strict=False)), 0.0]
        at = F.col("reached").cast("int")
        low, width = F.get(_doubles(lows), at), F.get(_doubles(widths), at)
        part = F.when(width > 0, F.floor((F.col(code) - low) / width * (1 << self.bits))).otherwise(0)
        cell = reached * (1 << self.bits) + F.least(F.greatest(part, F.lit(0)), F.lit((1 << self.bits) - 1))
        return placed.withColumn(out, cell.cast("long")).drop("reached")


def _doubles(values: list[float]) -> Column:
    """A constant array; one literal, however many values."""
    return F.from_json(F.lit("[" + ",".join(repr(float(v)) for v in values) + "]"), "array<double>")


def _code(df: DataFrame, name: str, shared: int) -> Column:
    """A number that grows with the value; equal numbers are told apart by the exact comparison."""
    if kind_of(df, name) != TEXT:
        return _numeric_codes(F.col(name), df.schema[name].dataType, False)[0]
    following = F.hex(F.substring(F.encode(F.col(name).cast("string"), "UTF-8"), shared + 1, 6))
    return F.conv(F.rpad(following, 12, "0"), 16, 10).cast("double")


def _shared(points: DataFrame, ranges: DataFrame) -> int:
    """Bytes that all values and bounds have in common at the beginning."""
    if kind_of(points, "at") != TEXT:
        return 0
    ends = [*points.agg(F.min("at"), F.max("at")).first(), *ranges.agg(F.min("low"), F.max("high")).first()]
    return len(commonprefix([str(e).encode() for e in ends if e is not None] or [b""]))


def _meet(points: DataFrame, ranges: DataFrame, keys: Sequence[str], exact: Column) -> DataFrame:
    """Pairs of rows with equal keys for which ``exact`` holds: ``at`` of one in ``low`` to ``high`` of the other."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("at", *keys)])
    points = settled(points.filter(present), "points")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("low", "high", *keys)])
    ranges = ranges.filter(whole)
    if not keys:
        return _meet_in_runs(points, ranges, keys, exact)
    # keys with few rows need no cells: each row is shuffled once, however many rows there are in all
    hot = _hot_keys(points, ranges, keys)
    if hot.isEmpty():
        return points.withColumn("run", F.lit(-1).cast("long")).join(ranges, [*keys]).filter(exact)
    few = points.join(hot, [*keys], "left_anti").withColumn("run", F.lit(-1).cast("long"))
    few = few.join(ranges.join(hot, [*keys], "left_anti"), [*keys]).filter(exact)
    many = [settled(side.join(hot, [*keys], "left_semi"), "hot-rows") for side in (points, ranges)]
    return _meet_in_runs(*many, keys, exact).unionByName(few)


def _hot_keys(points: DataFrame, ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that both sides have, with more rows than a cell should hold, written once."""
    counted = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("points"))
    joined = counted.join(ranges.groupBy(*keys).agg(F.count(F.lit(1)).alias("ranges")), [*keys])
    return materialize(joined.filter(F.col("points") + F.col("ranges") > CELL_ROWS).select(*keys), "hot-keys")


def _meet_in_runs(points: DataFrame, ranges: DataFrame, keys: Sequence[str], exact: Column) -> DataFrame:
    """The same by runs of cells, for rows without nulls."""
    shared = _shared(points, ranges)
    points = points.withColumn("code", _code(points, "at", shared))
    bounds = {"code_low": _code(ranges, "low", shared), "code_high": _code(ranges, "high", shared)}
    ranges = ranges.withColumns(bounds).filter("code_low <= code_high")
    counted = points.agg(F.count(F.lit(1))).first()[0] + ranges.agg(F.count(F.lit(1))).first()[0]
    both = points.select("code").unionAll(ranges.select("code_low")).unionAll(ranges.select("code_high"))
    cells = _Cells(both, counted)

    ranges = cells.of(cells.of(ranges, "code_low", "first"), "code_high", "last")
    # sizes of runs: the aligned runs of 2^k cells that a range consists of
    sizes = F.sequence(F.lit(0), F.lit(cells.bits + len(cells.points).bit_length() + 1))

    def runs(k: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        begin = F.call_function("div", F.col("first") + size - 1, size)
        end = F.call_function("div", F.col("last") + 1, size)
        left = F.when((begin < end) & (begin % 2 == 1), k * _RUN + begin)
        right = F.when((begin < end) & (end % 2 == 1), k * _RUN + end - 1)
        # one run for both only if the range is that run
        return F.array_distinct(F.array_compact(F.array(left, right)))

    split = ranges.withColumn("run", F.explode(F.flatten(F.transform(sizes, runs)))).drop("first", "last", "code_low", "code_high")
    split = settled(split, "runs")
    used = sorted(r["size"] for r in split.select(F.expr(f"run div {_RUN}").alias("size")).distinct().collect())
    placed = cells.of(points, "code", "cell").drop("code")
    run = F.array(*[F.lit(k * _RUN) + F.shiftright("cell", k) for k in used]) if used else F.array().cast("array<bigint>")
    return placed.withColumn("run", F.explode(run)).drop("cell").join(split, [*keys, "run"]).filter(exact)


def join_nearest(
    df: DataFrame,
    other: DataFrame,
    left_value: str,
    right_value: str,
    on: Sequence[tuple[str, str] | str | Mapping[str, str]] = (),
    direction: str = "BACKWARD",
    join_type: str = "LEFT",
    select: Sequence[str | tuple[str, str] | Mapping[str, str]] = (),
    column_prefix: str | None = None,
    within: object = None,
) -> DataFrame:
    """Each row of ``df`` with the nearest row of ``other`` at or before its value (at or after, FORWARD).

    Of rows of ``other`` with equal keys and values the one whose selected
    columns are the largest counts. ``within`` is the largest distance: a number,
    or an interval text such as ``"2 hours"`` for dates. NULL values and keys
    match nothing; LEFT keeps rows without a match. Nothing in the plan depends
    on the size of groups: a group that holds everything is cut like a table.
    """
    how = _checked(join_type, "BOTH")
    word = str(getattr(direction, "value", direction)).upper()
    if word not in DIRECTIONS:
        raise ValueError(f"direction is one of {DIRECTIONS}, not {direction!r}")
    pairs, chosen = [_pair(item, "left", "right") for item in on], brought(df, other, select, column_prefix)
    require(df, left_value, *[left for left, _ in pairs])
    require(other, right_value, *[right for _, right in pairs])
    _same_kind(df, left_value, other, right_value)
    if within is not None and kind_of(df, left_value) == TEXT:
        raise ValueError("texts have no distance")
    keys = [f"key{k}" for k in range(len(pairs))]
    names = list(df.columns)
    left = df.select(F.struct(*[col(c) for c in names]).alias("row"), *_keys(pairs, 0), col(left_value).alias("at"))
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("at", *keys)])
    right = other.select(*_keys(pairs, 1), col(right_value).alias("at"), _found(chosen))
    right = right.filter(present).groupBy(*keys, "at").agg(F.max(F.struct("found", F.col("at").alias("here"))).alias("near"))
    # where values are equal, the right side comes first in the direction of the search
    side = 0 if word == "BACKWARD" else 2
    merged = left.filter(present).withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(side)), allowMissingColumns=True)
    order = [Key("at"), Key("side")]
    done = last_present(merged, F.col("near"), keys, order, "match", reverse=word == "FORWARD").filter("side = 1")
    near = F.col("match")
    if within is not None:
        far = F.col("at") - F.col("match.here") if word == "BACKWARD" else F.col("match.here") - F.col("at")
        if kind_of(df, left_value) == DATE:
            reach = F.expr(f"INTERVAL {within}")
            inside = F.col("at") <= F.col("match.here") + reach if word == "BACKWARD" else F.col("match.here") <= F.col("at") + reach
        else:
            inside = far <= F.lit(within)
        near = F.when(inside, near)
    found = done.select("row", near["found"].alias("found"))
    if how == "INNER":
        found = found.filter("found IS NOT NULL")
    else:
        nothing = F.lit(None).cast(found.schema["found"].dataType).alias("found")
        found = found.unionAll(left.filter(~present).select("row", nothing))
    return found.select(*[F.col("row")[c].alias(c) for c in names], *[F.col("found")[c].alias(c) for c in chosen])
