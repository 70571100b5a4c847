"""Fill-in-middle documents, cut at ranks of a learned index of line ends.

The places where a text may be cut are its line ends. A learned rank index keeps
them as line segments that predict the place of the k-th end within a bound of
error, together with what each prediction is off by. Segments are as long as the
bound allows: a segment ends where no slope through its first end meets all
others. A cut is then a prediction and a correction, exact for every rank, and
the residuals take a byte each instead of a place of eight.

Cuts, form and order come from a hash of a document's identifier and a seed, so
they are the same wherever the document lies and however often it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.vectors import Texts, slices, texts

#: how far a prediction may be off, in bytes
ERROR = 127
#: steps of a slope per byte: predictions are integers
FINE = 1 << 20


@dataclass(frozen=True)
class Marks:
    """What announces the parts; none may hold another."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        each = [self.prefix, self.suffix, self.middle]
        if any(not a or (i != j and a in b) for i, a in enumerate(each) for j, b in enumerate(each)):
            raise ValueError("marks are not empty and none holds another")
        if any(a[-k:] == b[:k] for a in each for b in each for k in range(1, min(len(a), len(b)))):
            raise ValueError("no mark ends as a mark begins")


@dataclass(frozen=True)
class RankIndex:
    """Places of ranks 0, 1, ... as segments of bounded error with residuals."""

    #: first rank of each segment, the place there, and the slope in parts of FINE
    rank: np.ndarray
    place: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.rank, ranks, "right") - 1
        return self.place[k] + ((ranks - self.rank[k]) * self.slope[k] >> 20)

    def places(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residual[ranks]


def fit(places: np.ndarray, error: int = ERROR) -> RankIndex:
    """The index of ascending places; at most ``error`` off before residuals are added."""
    rank, place, slope = [], [], []
    first, n = 0, len(places)
    while first < n:
        # slopes that keep every end so far within the bound, over windows that grow
        size, low, high, stop = 64, 0, 1 << 62, first + 1
        while stop < n:
            steps = np.arange(stop - first, min(stop + size, n) - first)
            rise = (places[stop : stop + size] - places[first]) * FINE
            # a product of the slope is rounded down, so the upper bound is not met itself
            lows = np.maximum(np.maximum.accumulate(-(-(rise - error * FINE) // steps)), low)
            highs = np.minimum(np.minimum.accumulate((rise + error * FINE) // steps), high)
            bad = np.flatnonzero(lows > highs)
            good = int(bad[0]) if len(bad) else len(steps)
            if good:
                low, high, stop = int(lows[good - 1]), int(highs[good - 1]), stop + good
            if len(bad):
                break
            size *= 2
        rank.append(first)
        place.append(int(places[first]))
        slope.append((low + min(high, 1 << 62)) // 2 if stop > first + 1 else 0)
        first = stop
    made = [np.array(x, np.int64) for x in (rank, place, slope)]
    draft = RankIndex(*made, np.zeros(n, np.int8))
    off = places - draft.predicted(np.arange(n)) if n else np.zeros(0, np.int64)
    kind = np.int8 if error <= 127 else np.int16 if error <= 32767 else np.int64
    return RankIndex(*made, off.astype(kind))


def line_ends(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Place after each line of each text, in the bytes of all, and each text's first line."""
    newline = np.flatnonzero(t.data == 10) + 1
    last = t.bounds[1:][np.diff(t.bounds) > 0]
    ends = np.union1d(newline, last)
    return ends, np.searchsorted(ends, t.bounds, "right")


OUT = "key long, n long, form string, prefix_chars long, middle_chars long, output string, segments array<struct<rank:long,place:long,slope:long>>, residuals binary"


def fill_in_middle(
    df: DataFrame, seed: int = 7, plain_below: int = 100, spm_below: int = 50, marks: Marks = Marks(), error: int = ERROR, index: bool = False
) -> DataFrame:
    """Turn the documents ``doc_id, text`` into prefix, suffix and middle.

    Returns doc_id, n (lines of the text), form, prefix_chars, middle_chars
    (characters, null if plain) and output, and with ``index`` the rank index of
    the line ends as segments and residuals. ``psm`` has the parts as prefix,
    suffix, middle, ``spm`` as suffix, prefix, middle, each after its mark, and
    ``plain`` is the text itself: empty texts, texts that hold a mark, and those
    whose third number modulo 100 is ``plain_below`` or more. The numbers are the
    first four groups of 8 digits of the SHA-256 of seed, colon and doc_id.

    A null text is empty, a null doc_id counts as no digits, repeated rows give
    the same result each, other columns are left out and an empty table gives an
    empty result.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    number = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = df.select(F.col("doc_id").cast("long").alias("key"), text.alias("text"), *[number(k) for k in range(4)])
    sentinels = [m.encode() for m in (marks.prefix, marks.suffix, marks.middle)]

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                yield pa.RecordBatch.from_arrays([part.column("key"), *_turned(part, sentinels, plain_below, spm_below, error, index)], names)

    names = [c.split()[0] for c in OUT.split(", ")]
    made = rows.mapInArrow(turn, OUT).withColumnRenamed("key", "doc_id")
    return made if index else made.drop("segments", "residuals")


def _turned(part: pa.RecordBatch, marks: list[bytes], plain_below: int, spm_below: int, error: int, index: bool) -> list[pa.Array]:
    t = texts(part.column("text"))
    ends, first = line_ends(t)
    lines = np.diff(first)
    h = [part.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4)]
    one, two = h[0] % (lines + 1), h[1] % (lines + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    letters = np.concatenate([[0], np.cumsum((t.data & 0xC0) != 0x80)])
    raw = t.data.tobytes()
    held = [m in raw for m in marks]
    form, prefix, middle, output, segments, residuals = [], [], [], [], [], []
    for k in range(len(t)):
        begin, stop = int(t.bounds[k]), int(t.bounds[k + 1])
        body = raw[begin:stop]
        # rank 0 is the beginning of the text
        places = np.concatenate([[0], ends[first[k] : first[k + 1]] - begin])
        ranks = fit(places, error)
        a, b = ranks.places(np.array([low[k], high[k]])).tolist()
        if index:
            segments.append([{"rank": r, "place": p, "slope": s} for r, p, s in zip(ranks.rank.tolist(), ranks.place.tolist(), ranks.slope.tolist(), strict=True)])
            residuals.append(ranks.residual.tobytes())
        if not body or h[2][k] % 100 >= plain_below or any(is_held and m in body for is_held, m in zip(held, marks, strict=True)):
            form.append("plain")
            prefix.append(None)
            middle.append(None)
            output.append(body)
            continue
        prefix.append(int(letters[begin + a] - letters[begin]))
        middle.append(int(letters[begin + b] - letters[begin + a]))
        of_prefix, of_suffix = marks[0] + body[:a], marks[1] + body[b:]
        spm = h[3][k] % 100 < spm_below
        form.append("spm" if spm else "psm")
        output.append((of_suffix + of_prefix if spm else of_prefix + of_suffix) + marks[2] + body[a:b])
    segment = pa.list_(pa.struct([("rank", pa.int64()), ("place", pa.int64()), ("slope", pa.int64())]))
    return [
        pa.array(lines.astype(np.int64)),
        pa.array(form, pa.string()),
        pa.array(prefix, pa.int64()),
        pa.array(middle, pa.int64()),
        pa.array(output, pa.binary()).cast(pa.string()),
        pa.array(segments, segment) if index else pa.nulls(len(t), segment),
        pa.array(residuals, pa.binary()) if index else pa.nulls(len(t), pa.binary()),
    ]


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output was made of."""
    # each mark occurs once in an output that is not plain: after it is what it announces
    parts = F.split(output, "|".join(f"\\Q{m}\\E" for m in (marks.prefix, marks.suffix, marks.middle)), -1)
    one, two, middle = (F.get(parts, k) for k in (1, 2, 3))
    turned = F.when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two))
    return F.when(form == "plain", output).otherwise(turned)
