"""Quality rules by distribution: how far is a document from its language?

Two histograms of every document, of character classes and of the language's
most common words, are compared to those of all documents of the language with
the Jensen-Shannon distance. Counting rules come first, and texts too short to
have a distribution are judged by these alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.counts import by_shard, counted, merged, pack, pack_sorted, shard_bits, unpack, unpack_sorted
from sluice.llm.vectors import Texts, Words, ragged, run_hashes, slices, span_hashes, split_words, sums_by, texts

SYMBOLS = b"#*$%&|<>"
#: fixed values: characters that end or wrap a word without belonging to it
WRAPPING = b".,;:!?\"'()"


@dataclass(frozen=True)
class Limits:
    """Bounds of the rules; distances lie between 0 and 1."""

    min_words: int = 20
    repeat_percent: int = 30
    window: int = 8
    common_words: int = 100
    #: texts with fewer words have no distribution to compare
    judged_words: int = 50
    class_distance: float = 0.30
    word_distance: float = 0.39
    #: a text of n words drawn from its language still lies this share / n (squared) away
    sampling: float = 6.0


def _classes() -> np.ndarray:
    kinds = np.full(256, 10, np.int64)
    kinds[ord("a") : ord("z") + 1] = 0
    kinds[ord("A") : ord("Z") + 1] = 1
    kinds[ord("0") : ord("9") + 1] = 2
    kinds[0xC0:] = 3  # the first byte of a character outside ASCII
    kinds[[9, 11, 12, 13, 32]] = 4
    kinds[10] = 5
    kinds[[ord(c) for c in ".,"]] = 6
    kinds[[ord(c) for c in ";:!?"]] = 7
    kinds[[ord(c) for c in "\"'()[]{}-"]] = 8
    kinds[list(SYMBOLS)] = 9
    kinds[0x80:0xC0] = 11  # later bytes of a character: not counted
    return kinds


CLASS_OF = _classes()
CLASSES = 11


def base_counts(t: Texts, w: Words, hashes: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """The counting rules' numbers of each text."""
    n_words = np.diff(w.first)
    starts = (t.data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(starts)])
    symbol = np.isin(t.data, np.frombuffer(SYMBOLS, np.uint8))
    run, at = run_hashes(hashes, w.first, window)
    again = repeated(run, at)
    begin = np.arange(len(run)) + np.repeat(w.first[:-1] - at[:-1], np.diff(at))
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, begin[again], 1)
    np.add.at(edge, begin[again] + window, -1)
    return {
        "n_words": n_words,
        "word_chars": sums_by(chars[w.end] - chars[w.start], w.first),
        "n_symbols": sums_by(symbol, t.bounds),
        "n_dup_lines": duplicate_lines(t, w),
        "n_repeat_words": sums_by(np.cumsum(edge[:-1]) > 0, w.first),
    }


def repeated(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which items occur twice or more in their own text."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    same = (h[1:] == h[:-1]) & (d[1:] == d[:-1])
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def duplicate_lines(t: Texts, w: Words) -> np.ndarray:
    r"""Lines (split at ``\n``) with a word that equal an earlier line of their text."""
    docs = len(t)
    newline = np.flatnonzero(t.data == 10)
    start, owner = _line_starts(newline, t.bounds)
    end = np.append(start[1:], len(t.data))
    last = np.append(owner[1:] != owner[:-1], True)
    end = np.where(last, t.bounds[owner + 1], end - 1)
    worded = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, owner = start[worded], end[worded], owner[worded]
    h = span_hashes(t.data, start, end)
    order = np.lexsort((h, owner))
    same = (h[order][1:] == h[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    return np.bincount(owner[order][1:][same], minlength=docs)


def _line_starts(newline: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    docs = len(bounds) - 1
    owner = np.searchsorted(bounds, newline, "right") - 1
    start = np.concatenate([bounds[:-1], newline + 1])
    owner = np.concatenate([np.arange(docs), owner])
    order = np.lexsort((start, owner))
    return start[order], owner[order]


def bare_words(t: Texts, w: Words) -> np.ndarray:
    """Hashes of the words in lower case, without punctuation around them."""
    low = t.lowered()
    wrap = np.zeros(256, bool)
    wrap[list(WRAPPING)] = True
    edge = np.append(~wrap[low.data], True)
    # the first byte at or after a position, and the last before one, that is no punctuation
    solid = np.flatnonzero(edge)
    start = np.minimum(solid[np.searchsorted(solid, w.start)], w.end)
    at = np.searchsorted(solid, w.end) - 1
    end = np.where(at >= 0, solid[np.maximum(at, 0)] + 1, w.start)
    return span_hashes(low.data, start, np.maximum(start, np.minimum(end, w.end)))


def class_histogram(t: Texts) -> np.ndarray:
    doc = np.repeat(np.arange(len(t)), np.diff(t.bounds))
    counts = np.bincount(doc * 12 + CLASS_OF[t.data], minlength=12 * len(t))
    return counts.reshape(len(t), 12)[:, :CLASSES]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of rows of counts and one reference of shares."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


def _failed(base: dict[str, np.ndarray], limits: Limits) -> np.ndarray:
    n = base["n_words"]
    return (n < limits.min_words) | (100 * base["n_repeat_words"] > limits.repeat_percent * n)


def language_references(df: DataFrame, limits: Limits = Limits()) -> dict[str | None, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per language: class shares, keys of its common words in order, their shares (others last).

    Counted over all documents that pass the counting rules. The result holds a
    few kilobytes per language code.
    """
    chunk = 4_000_000

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes: dict[str | None, np.ndarray] = {}
        words: dict[str | None, list[np.ndarray]] = {}
        held = 0

        def rows() -> Iterator[tuple]:
            for lang, counts in classes.items():
                yield lang, -1, None, pack(counts)
            for lang, parts in words.items():
                keys, counts = counted(np.concatenate(parts))
                for shard, part in by_shard(keys, bits):
                    yield lang, shard, pack_sorted(keys[part]), pack(counts[part])

        def batch() -> pa.RecordBatch:
            out = list(zip(*rows(), strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                ["lang", "shard", "keys", "counts"],
            )

        for whole in batches:
            for part in slices(whole):
                t = texts(part.column("text"))
                w = split_words(t)
                base = base_counts(t, w, span_hashes(t.data, w.start, w.end), limits.window)
                good = ~_failed(base, limits)
                bare, histogram = bare_words(t, w), class_histogram(t)
                langs = part.column("lang").to_pylist()
                for lang in set(langs):
                    mine = np.flatnonzero(good & np.array([x == lang for x in langs]))
                    if len(mine):
                        classes[lang] = classes.get(lang, 0) + histogram[mine].sum(axis=0)
                        words.setdefault(lang, []).append(bare[ragged(w.first[mine], base["n_words"][mine])])
                held += len(bare)
                if held > chunk:
                    yield batch()
                    classes, words, held = {}, {}, 0
        yield batch()

    k = limits.common_words
    # shards of words by how much text there is; a character is about a fifth of a word
    size = df.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = shard_bits(size / 5)
    schema = "lang string, shard int, keys binary, counts binary"
    parts = df.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(gather, schema)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        lang, shard = pdf["lang"].iloc[0], int(pdf["shard"].iloc[0])
        if shard < 0:
            total = np.sum([unpack(b) for b in pdf["counts"]], axis=0)
            return pd.DataFrame({"lang": lang, "kind": 0, "key": np.arange(CLASSES), "n": total})
        keys, counts = merged(
            np.concatenate([unpack_sorted(b) for b in pdf["keys"]]),
            np.concatenate([unpack(b) for b in pdf["counts"]]).astype(np.int64),
        )
        best = np.lexsort((keys, -counts))[:k]
        shown = pd.DataFrame({"lang": lang, "kind": 1, "key": keys[best].view(np.int64), "n": counts[best]})
        return pd.concat([shown, pd.DataFrame({"lang": [lang], "kind": [2], "key": [0], "n": [counts.sum()]})])

    found = parts.groupBy("lang", "shard").applyInPandas(merge, "lang string, kind int, key long, n long")
    summed = found.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    rows = summed.withColumn("_place", place).filter(f"_place <= {max(k, CLASSES)} AND (kind <> 1 OR _place <= {k})").collect()
    found_in: dict[str | None, dict[int, list]] = {}
    for r in rows:
        found_in.setdefault(r["lang"], {0: [], 1: [], 2: []})[r["kind"]].append((r["key"], r["n"]))
    out = {}
    for lang, mine in found_in.items():
        classes = np.zeros(CLASSES)
        for key, n in mine[0]:
            classes[key] = n
        common = sorted((np.uint64(key & (2**64 - 1)), n) for key, n in mine[1])
        total = mine[2][0][1] if mine[2] else 0
        shares = np.array([n for _, n in common] + [total - sum(n for _, n in common)], float)
        out[lang] = (classes / max(classes.sum(), 1), np.array([c for c, _ in common], np.uint64), shares / max(total, 1))
    return out


def judge(df: DataFrame, references: dict | None = None, limits: Limits = Limits()) -> DataFrame:
    """The rules over ``doc_id, text, lang``, one row per input row.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, class_distance, word_distance. Null texts count as empty
    and fail the base rules. A null language is a language of its own; one
    without a reference, and a text with fewer than ``judged_words`` words, have
    null distances and are kept if they pass the base rules. Rows that repeat
    are judged alike; an empty table gives an empty result; other columns of the
    input are left out.
    """
    if references is None:
        references = language_references(df, limits)
    known = references

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                yield _judged(part, known, limits)

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, class_distance double, word_distance double"
    )
    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")]
    return df.select(*columns).mapInArrow(rows, schema)


def _judged(part: pa.RecordBatch, known: dict, limits: Limits) -> pa.RecordBatch:
    t = texts(part.column("text"))
    w = split_words(t)
    base = base_counts(t, w, span_hashes(t.data, w.start, w.end), limits.window)
    failed = _failed(base, limits)
    n = len(t)
    by_class, by_word = np.full(n, np.nan), np.full(n, np.nan)
    bare, histogram = bare_words(t, w), class_histogram(t)
    langs = part.column("lang").to_pylist()
    for lang in set(langs) & set(known):
        classes, keys, shares = known[lang]
        mine = np.flatnonzero((base["n_words"] >= limits.judged_words) & np.array([x == lang for x in langs]))
        if not len(mine):
            continue
        words = bare[ragged(w.first[mine], base["n_words"][mine])]
        owner = np.repeat(np.arange(len(mine)), base["n_words"][mine])
        at = np.minimum(np.searchsorted(keys, words), len(keys) - 1) if len(keys) else np.zeros(len(words), int)
        hit = keys[at] == words if len(keys) else np.zeros(len(words), bool)
        cell = np.where(hit, at, len(keys))
        counts = np.bincount(owner * (len(keys) + 1) + cell, minlength=len(mine) * (len(keys) + 1))
        by_word[mine] = distance(counts.reshape(len(mine), -1), shares)
        by_class[mine] = distance(histogram[mine], classes)
    allowed = np.sqrt(limits.word_distance**2 + limits.sampling / np.maximum(base["n_words"], 1))
    far = (np.nan_to_num(by_class) > limits.class_distance) | (np.nan_to_num(by_word) > allowed)
    made = {k: pa.array(v.astype(np.int64)) for k, v in base.items()}
    made |= {"base_failed": pa.array(failed), "kept": pa.array(~failed & ~far)}
    made |= {"class_distance": pa.array(by_class, mask=np.isnan(by_class)), "word_distance": pa.array(by_word, mask=np.isnan(by_word))}
    return pa.RecordBatch.from_arrays([part.column("doc_id"), *made.values()], ["doc_id", *made])
