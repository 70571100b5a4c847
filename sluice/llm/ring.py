"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring of 2^32 positions. A row goes to the shard
of the first point at or after its own position; when that shard is full, the row
goes on clockwise to the next point whose shard has room. Capacities add up to
the number of rows and differ by one at most, so the shards are exactly level,
and a row only leaves its first shard when that shard is full.

All rows between two points walk the same way, so who is placed where follows
from the number of rows in each arc. The walk over these counts (one per point,
bounded by ``shards * points``) is done once; rows then read off their place from
their rank in their arc. Ranks come from per-bucket counts of the ring, so no
window holds more than one bucket of positions.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import materialize

RING = 1 << 32
#: pieces of the ring that are ranked on their own
BUCKETS = 1 << 14


def ring_points(shards: int, points: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order."""
    made = {}
    for shard in range(shards):
        for k in range(points):
            at = int(hashlib.md5(f"shard-{shard}-{k}".encode()).hexdigest()[:8], 16)
            made[at] = min(shard, made.get(at, shard))
    return sorted(made.items())


def position(key: Column) -> Column:
    """The place of a key on the ring; a null key has the place of the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def walk(counts: dict[int, int], points: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: (arc, from rank, to rank, shard, first slot).

    Each round, every arc offers its unplaced rows to the next open shard
    clockwise; a shard takes offers in ring order up to its capacity. A shard
    that turned rows away is full, so there are at most ``shards`` rounds.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    placed = dict.fromkeys(counts, 0)
    at = {arc: arc for arc in counts}
    segments = []
    open_arcs = sorted(a for a in counts if counts[a])
    while open_arcs:
        left = []
        for arc in open_arcs:
            shard = points[at[arc]][1]
            take = min(counts[arc] - placed[arc], room[shard] - used[shard])
            if take:
                segments.append((arc, placed[arc], placed[arc] + take, shard, used[shard]))
                placed[arc] += take
                used[shard] += take
            if placed[arc] < counts[arc]:
                left.append(arc)
        for arc in left:
            while used[points[at[arc]][1]] >= room[points[at[arc]][1]]:
                at[arc] = (at[arc] + 1) % len(points)
        open_arcs = left
    return segments


def shard_rows(df: DataFrame, key: str = "doc_id", shards: int = 8, points: int = 128) -> DataFrame:
    """Add ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 within it).

    Counts of rows per shard differ by one at most. Rows with equal keys follow
    each other on the ring in an order given by all other columns; entirely
    equal rows are interchangeable. A null key counts as the empty text. An
    empty table gives an empty result. Columns of the input keep their names;
    the input must not have columns ``shard`` and ``slot``.
    """
    if shards < 1 or points < 1:
        raise ValueError("shards and points start at 1")
    clash = {"shard", "slot"} & set(df.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    nodes = ring_points(shards, points)
    starts = [p for p, _ in nodes]
    spark = df.sparkSession
    place = position(F.col(key))
    arc = _arc_of(F.col("_at"), starts)
    placed = df.withColumn("_at", place).withColumn("_arc", arc)
    placed = materialize(placed.withColumn("_bucket", (F.col("_at") * BUCKETS / RING).cast("int")), "ring")
    sizes = placed.groupBy("_arc", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # rows whose position lies behind the last point wrap to arc 0 and come first there
    ahead = Window.partitionBy("_arc").orderBy(F.col("_bucket") <= starts[0] * BUCKETS // RING, "_bucket")
    before = materialize(
        sizes.withColumn("_before", F.sum("_n").over(ahead.rowsBetween(Window.unboundedPreceding, -1))), "ranks"
    )
    counts = {r["_arc"]: r["n"] for r in before.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    segments = walk(counts, nodes, shards)
    table = spark.createDataFrame(segments or [(0, 0, 0, 0, 0)], "_arc int, _from long, _to long, shard int, _slot long")
    rest = [F.col(c) for c in df.columns if c != key]
    order = Window.partitionBy("_arc", "_bucket").orderBy("_at", key, *rest)
    ranked = (
        placed.withColumn("_rank", F.row_number().over(order))
        .join(F.broadcast(before.drop("_n")), ["_arc", "_bucket"])
        .withColumn("_rank", F.col("_rank") - 1 + F.coalesce("_before", F.lit(0)))
    )
    # bounded by shards * (points + shards)
    joined = ranked.alias("r").join(
        F.broadcast(table).alias("s"),
        (F.col("r._arc") == F.col("s._arc")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    slot = (F.col("_slot") + F.col("_rank") - F.col("_from")).cast("long")
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], "shard", slot.alias("slot"))


def _longs(values: Iterable[int]) -> str:
    return f"cast(array({', '.join(map(str, values))}) as array<bigint>)"


def _arc_of(at: Column, starts: list[int]) -> Column:
    """Number of the first point at or after a position, 0 beyond the last."""
    # coarse cells keep the search to the few points of one cell
    cells = [[] for _ in range(256)]
    for k, p in enumerate(starts):
        cells[p * 256 // RING].append((p, k))
    below = F.expr(f"array({', '.join(str(bisect_left(starts, c * (RING // 256))) for c in range(256))})")
    inside = F.expr(f"array({', '.join(_longs(p for p, _ in cell) for cell in cells)})")
    cell = (at * 256 / RING).cast("int") + 1
    passed = F.size(F.filter(F.element_at(inside, cell), lambda p: p < at))
    number = F.element_at(below, cell) + passed
    return F.when(number >= len(starts), F.lit(0)).otherwise(number)
