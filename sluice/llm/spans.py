"""Substring dedup by sliding runs of sentences.

Every run of consecutive sentences that is just long enough is hashed, and runs
with equal hashes meet across the whole corpus. All but the first occurrence (by
doc_id, then row, then place) cover their sentences, and covered sentences go.
Every row has a number of its own, so rows may share a doc_id or have none.

A task settles runs that repeat among its own documents and passes on one
occurrence of each, so a passage that a third of all documents share reaches its
shard once per block. Blocks travel as packed arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.counts import by_shard, pack, pack_sorted, shard_bits, unpack, unpack_sorted
from sluice.llm.vectors import Texts, mixed, slices, span_hashes, split_words, texts, tidy
from sluice.session import materialize, with_row_keys

LAST = np.int64(2**63 - 1)
#: fixed values: bytes that end a sentence, and that may stand after its end
ENDS = b".!?"
CLOSING = b"\"')]"


@dataclass(frozen=True)
class Run:
    """How long a run is at least; a sentence of ``alone`` words is a run by itself."""

    sentences: int = 2
    words: int = 25
    alone: int = 40


def sentences(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    r"""Sentences of all texts: hash, words, first byte, end byte, and each text's first sentence.

    A sentence ends with a word that ends in ``. ! ?`` (quotes and brackets may
    follow), at a line end, or with the text. Upper and lower case A-Z and the
    kind of white space make no difference.
    """
    w = split_words(t)
    n = len(w.start)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, np.zeros(len(t) + 1, np.int64)
    low = t.lowered()
    ends, closing = np.zeros(256, bool), np.zeros(256, bool)
    ends[list(ENDS)], closing[list(CLOSING)] = True, True
    tail = w.end - 1
    for _ in range(2):
        tail = np.where(closing[t.data[tail]] & (tail > w.start), tail - 1, tail)
    lines = np.concatenate([[0], np.cumsum((t.data == 10) | (t.data == 13))])
    final = ends[t.data[tail]]
    final[:-1] |= lines[w.start[1:]] > lines[w.end[:-1]]
    final[w.first[1:][w.first[1:] > 0] - 1] = True
    stop = np.flatnonzero(final) + 1
    begin = np.concatenate([[0], stop[:-1]])
    words = span_hashes(low.data, w.start, w.end)
    # a sentence's hash from its words' hashes, in order
    place = np.arange(n) - np.repeat(begin, stop - begin)
    with np.errstate(over="ignore"):
        each = mixed(words + mixed(place.astype(np.uint64)))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)])
        hashes = mixed(total[stop] - total[begin])
    return hashes, stop - begin, w.start[begin], w.end[stop - 1], np.searchsorted(begin, w.first)


def runs(hashes: np.ndarray, words: np.ndarray, first: np.ndarray, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shortest long-enough runs from each and up to each sentence: hash, begin, end (exclusive)."""
    n = len(hashes)
    if n == 0:
        return hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    upto = np.concatenate([[0], np.cumsum(words)])
    here = np.arange(n)
    ahead = np.maximum(np.searchsorted(upto, upto[:-1] + run.words), here + run.sentences)
    back = np.minimum(np.searchsorted(upto, upto[1:] - run.words, "right") - 1, here + 1 - run.sentences)
    long = np.flatnonzero(words >= run.alone)
    begin = np.concatenate([here, back, long])
    end = np.concatenate([ahead, here + 1, long + 1])
    owner = np.concatenate([doc, doc, doc[long]])
    fits = (begin >= first[owner]) & (end <= first[owner + 1])
    both = np.unique(np.stack([begin[fits], end[fits]], axis=1), axis=0) if fits.any() else np.zeros((0, 2), np.int64)
    begin, end = both[:, 0], both[:, 1]
    place = np.uint64(0x9E3779B97F4A7C55)
    with np.errstate(over="ignore"):
        powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, place), dtype=np.uint64)])
        inverse = np.uint64(pow(int(place), -1, 1 << 64))
        inverses = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, inverse), dtype=np.uint64)])
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers[:n], dtype=np.uint64)])
        made = mixed((total[end] - total[begin]) * inverses[begin] + (end - begin).astype(np.uint64))
    return made, begin, end


def settle(h: np.ndarray, doc: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which occurrences are the first of their run, and which repeat it elsewhere."""
    order = np.lexsort((begin, doc, h))
    hs, ds, bs = h[order], doc[order], begin[order]
    new = np.concatenate([[True], hs[1:] != hs[:-1]]) if len(hs) else np.zeros(0, bool)
    lead = np.flatnonzero(new)[np.cumsum(new) - 1] if len(hs) else np.zeros(0, np.int64)
    same = (ds == ds[lead]) & (bs == bs[lead])
    first, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
    first[order[new]] = True
    later[order[~same]] = True
    return first, later


def _ranked(doc: np.ndarray, mix: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each occurrence's place among the rows by doc_id, hash of the text and number, and the rows in this order."""
    row, at, which = np.unique(row, return_index=True, return_inverse=True)
    doc, mix = doc[at], mix[at]
    order = np.lexsort((row, mix, doc))
    rank = np.empty(len(row), np.int64)
    rank[order] = np.arange(len(row))
    return rank[which], doc[order], mix[order], row[order]


def _ranges(doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of one document as one, in order."""
    order = np.lexsort((begin, doc))
    doc, begin, end = doc[order], begin[order], end[order]
    if len(doc) == 0:
        return doc, begin, end
    # the furthest end so far within the document
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    group = np.cumsum(new)
    span = int(end.max()) + 1
    far = np.maximum.accumulate(end + group * span) - group * span
    start = new | np.concatenate([[False], begin[1:] > far[:-1]])
    at = np.flatnonzero(start)
    return doc[at], begin[at], np.maximum.reduceat(far, at)


def _grouped(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, groups: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Packed ranges by group of documents."""
    group = (mixed(doc.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    for g in np.unique(group):
        some = group == g
        yield int(g), pack(doc[some].astype(np.int64)), pack(begin[some].astype(np.int64)), pack(end[some].astype(np.int64))


def repeated_ranges(df: DataFrame, run: Run = Run(), block_runs: int = 400_000) -> DataFrame:
    """Sentence ranges of each row that later occurrences of a run cover.

    Returns ``doc_id, cuts``, one row per input row with any; ranges of sentences
    in order, without overlaps.
    """
    keyed = with_row_keys(df.select("doc_id", "text"))
    return keyed.join(row_ranges(keyed, run, block_runs), "__row").select("doc_id", "cuts")


def row_ranges(keyed: DataFrame, run: Run, block_runs: int = 400_000) -> DataFrame:
    """The same as ``__row, cuts``, for rows with keys.

    Ranges travel in packed rows by groups of rows, as one copied document is
    covered by many runs.
    """
    df = keyed
    size = df.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shard_bits(size / 30, 2_000_000)
    groups = 1 << shard_bits(size / 30, 1_000_000)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def block() -> pa.RecordBatch:
            h, doc, mix, row, begin, end = (np.concatenate(c) for c in zip(*held, strict=True))
            place, ids, mixes, numbers = _ranked(doc, mix, row)
            first, later = settle(h, place, begin)
            gone = _ranges(row[later], begin[later], end[later])
            rows: list[tuple] = []
            h, place, begin, end = h[first], place[first], begin[first], end[first]
            order = np.argsort(h)
            h, place, begin, end = h[order], place[order], begin[order], end[order]
            small = np.uint16 if len(ids) < 1 << 16 else np.uint32
            for shard, part in by_shard(h, bits):
                named, inside = np.unique(place[part], return_inverse=True)
                rows.append(
                    (
                        shard,
                        pack_sorted(h[part]),
                        pack(inside.astype(small)),
                        pack_sorted(ids[named]),
                        pack(begin[part].astype(np.uint32)),
                        pack((end - begin)[part].astype(np.uint32)),
                        pack(mixes[named]),
                        pack(numbers[named]),
                    )
                )
            rows += [(-1 - group, b"", b"", *packed, b"", b"") for group, *packed in _grouped(*gone, groups)]
            kinds = (pa.int32(), *[pa.binary()] * 7)
            out = list(zip(*rows, strict=True)) or [[]] * 8
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds, strict=True)],
                ["shard", "hashes", "inside", "docs", "begins", "lengths", "mixes", "rows"],
            )

        for whole in batches:
            for part in slices(whole):
                h, words, _, _, first = sentences(texts(part.column("text")))
                made, begin, end = runs(h, words, first, run)
                ids = part.column("doc_id")
                ids = np.where(np.asarray(ids.is_null()), LAST, np.asarray(ids.fill_null(0)))
                owner = np.searchsorted(first, begin, "right") - 1
                mix, row = (part.column(c).to_numpy()[owner] for c in ("mix", "row"))
                held.append((made, ids[owner], mix, row, begin - first[owner], end - first[owner]))
                count += len(made)
                if count > block_runs:
                    yield block()
                    held, count = [], 0
        if held:
            yield block()

    schema = "shard int, hashes binary, inside binary, docs binary, begins binary, lengths binary, mixes binary, rows binary"
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("__row").alias("row")]
    # half of the hash orders rows of one doc_id, their numbers tell them apart
    columns.append(F.shiftright("__hash", 32).cast("int").alias("mix"))
    blocks = materialize(df.select(*columns).mapInArrow(tidy(gather), schema), "runs")

    def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([unpack_sorted(b) for b in pdf["hashes"]])
        inside = [unpack(i) for i in pdf["inside"]]
        doc = np.concatenate([unpack_sorted(d)[i] for d, i in zip(pdf["docs"], inside, strict=True)])
        mix, row = (np.concatenate([unpack(b)[i] for b, i in zip(pdf[c], inside, strict=True)]) for c in ("mixes", "rows"))
        begin = np.concatenate([unpack(b) for b in pdf["begins"]]).astype(np.int64)
        end = begin + np.concatenate([unpack(b) for b in pdf["lengths"]])
        _, later = settle(h, _ranked(doc, mix, row)[0], begin)
        found = _ranges(row[later], begin[later], end[later])
        return pd.DataFrame(list(_grouped(*found, groups)), columns=["group", "docs", "begins", "ends"])

    def collect(pdf: pd.DataFrame) -> pd.DataFrame:
        doc, begin, end = (np.concatenate([unpack(b) for b in pdf[c]]) for c in ("docs", "begins", "ends"))
        doc, begin, end = _ranges(doc, begin, end)
        at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        stops = np.append(at[1:], len(doc))
        cuts = [[{"begin": b, "end": e} for b, e in zip(begin[x:y], end[x:y], strict=True)] for x, y in zip(at, stops, strict=True)]
        return pd.DataFrame({"__row": doc[at], "cuts": cuts})

    across = blocks.filter("shard >= 0").groupBy("shard").applyInPandas(tidy(resolve), "group int, docs binary, begins binary, ends binary")
    within = blocks.filter("shard < 0").selectExpr("-1 - shard AS group", "docs", "begins", "lengths AS ends")
    found = across.unionByName(within)
    return found.groupBy("group").applyInPandas(collect, "__row long, cuts array<struct<begin:long,end:long>>")


def remove_repeats(df: DataFrame, run: Run = Run()) -> DataFrame:
    """Drop repeated sentences from ``text``; adds ``n_sentences`` and ``n_removed``.

    The first occurrence is the one with the smallest doc_id, then the earliest
    place; later ones lose their sentences, also within one document. Every row
    is a document of its own: of rows that share a doc_id the hash of the text
    decides, of equal rows one is the first, and rows without a doc_id come last.
    What remains of a text stays as it is, with the white space after a removed
    sentence gone with it. Null texts stay null with 0 sentences, texts shorter
    than a run are never changed, and an empty table gives an empty result. All
    columns of the input stay; it must not have columns of the two new names.
    """
    clash = {"n_sentences", "n_removed"} & set(df.columns)
    if clash:
        raise ValueError(f"the input has columns {sorted(clash)} already")
    keyed = with_row_keys(df)
    cuts = row_ranges(keyed, run).withColumnRenamed("cuts", "__cuts")
    joined = keyed.join(cuts, "__row", "left").select(*df.columns, "__cuts")
    place, width = df.columns.index("text"), len(df.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                column = part.column(place)
                new, n, removed = cut_texts(column, part.column(width).to_pylist())
                arrays = [new if k == place else part.column(k) for k in range(width)]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(n, pa.int64()), pa.array(removed, pa.int64())], names)

    names = [*df.columns, "n_sentences", "n_removed"]
    kinds = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in df.schema)
    return joined.mapInArrow(tidy(cut), f"{kinds}, n_sentences long, n_removed long")


def cut_texts(column: pa.Array, cuts: list) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Texts without the sentences in the given ranges, how many they had and lost."""
    t = texts(column)
    _, _, start, end, first = sentences(t)
    counts = np.diff(first)
    removed = np.zeros(len(t), np.int64)
    out: list = [None] * len(t)
    for k in range(len(t)):
        if t.null[k]:
            continue
        raw = t.data[t.bounds[k] : t.bounds[k + 1]].tobytes()
        if cuts[k]:
            gone = np.zeros(counts[k] + 1, np.int64)
            for c in cuts[k]:
                gone[min(c["begin"], counts[k])] += 1
                gone[min(c["end"], counts[k])] -= 1
            covered = np.cumsum(gone[:-1]) > 0
            removed[k] = covered.sum()
            begin = start[first[k] : first[k + 1]] - t.bounds[k]
            # a removed sentence takes along the white space up to the next one
            stop = np.append(begin[1:], len(raw))
            kept = [raw[: begin[0]]] if counts[k] else [raw]
            kept += [raw[b:s] for b, s, c in zip(begin, stop, covered, strict=True) if not c]
            raw = b"".join(kept) if not covered.all() else b""
        out[k] = raw.decode("utf-8", "replace")
    return pa.array(out, pa.string()), counts, removed
