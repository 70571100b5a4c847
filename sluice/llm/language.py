"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed n-grams per language are summed over all training rows; the
matrix of log-probabilities has ``2**bits`` rows, whatever the input, and is sent
to every task. Texts are scored in batches by summing matrix rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.counts import pack, unpack
from sluice.llm.vectors import slices, texts

UNKNOWN = "und"
#: languages a model tells apart: a matrix of as many columns goes to every task
LANGUAGES = 256


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: (2**bits, languages), log-probabilities
    weights: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...]
    bits: int


@cache
def _letters() -> np.ndarray:
    return np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])


@cache
def _lower() -> np.ndarray:
    """Lower case of each code point, where that is one code point; no letter: a space."""
    single = [chr(c).lower() for c in range(0x110000)]
    made = np.array([ord(x) if len(x) == 1 else c for c, x in enumerate(single)], np.uint32)
    return np.where(_letters(), made, np.uint32(32))


def characters(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, the bounds of each text, and which texts have letters.

    Runs of other characters are one space; every text begins and ends with one.
    """
    t = texts(column)
    starts = (t.data & 0xC0) != 0x80
    bounds = np.concatenate([[0], np.cumsum(starts)])[t.bounds]
    raw = np.frombuffer(t.data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    if len(raw) != bounds[-1]:  # bytes that are no UTF-8
        parts = [bytes(t.data[a:b]).decode("utf-8", "replace") for a, b in zip(t.bounds[:-1], t.bounds[1:], strict=True)]
        bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        raw = np.frombuffer("".join(parts).encode("utf-32-le", "replace"), np.uint32)
    low = _lower()[np.minimum(raw, 0x10FFFF)]
    # a space ends each text, so that no n-gram reaches into the next one
    low = np.insert(low, bounds[1:], 32)
    bounds = bounds + np.arange(len(bounds))
    space = low == 32
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    at = np.concatenate([[0], np.cumsum(keep)])
    letters = np.concatenate([[0], np.cumsum(~space)])
    return low[keep], at[bounds], np.diff(letters[bounds]) > 0


def buckets(chars: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Hash buckets of the n-grams that begin at each character, padded at the end."""
    with np.errstate(over="ignore"):
        made = np.full(len(chars), np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF))
        for k in range(order):
            shifted = np.full(len(chars), np.uint32(32))
            shifted[: len(chars) - k] = chars[k:]
            made = (made ^ shifted) * np.uint32(0x85EBCA6B)
            made ^= made >> np.uint32(15)
    return made & np.uint32((1 << bits) - 1)


def train(df: DataFrame, orders: tuple[int, ...] = (1, 2, 3), bits: int = 16, smoothing: float = 0.5, most: int = LANGUAGES) -> Model:
    """A model from all rows of ``text, lang`` with a language and a letter.

    Values of ``lang`` are counted over all rows first; of more than ``most``
    different ones the most frequent are learned (the first in order among
    equally frequent ones), and the others are never predicted.
    """
    lang = F.col("lang").cast("string").alias("lang")
    counted = df.filter(F.col("lang").isNotNull()).groupBy(lang).agg(F.count(F.lit(1)).alias("n"))
    known = frozenset(r["lang"] for r in counted.orderBy(F.desc("n"), "lang").limit(most).collect())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for whole in batches:
            for part in slices(whole):
                chars, bounds, lettered = characters(part.column("text"))
                langs = part.column("lang").to_pylist()
                grams = [buckets(chars, n, bits) for n in orders]
                for lang in known.intersection(langs):
                    mine = np.array([x == lang for x in langs]) & lettered
                    inside = np.repeat(mine, np.diff(bounds))
                    total = sum(np.bincount(g[inside], minlength=1 << bits) for g in grams)
                    sums[lang] = sums.get(lang, 0) + total
                    docs[lang] = docs.get(lang, 0) + int(mine.sum())
        rows = [(lang, docs[lang], pack(total)) for lang, total in sums.items()]
        out = list(zip(*rows, strict=True)) or [[], [], []]
        arrays = [pa.array(c, k) for c, k in zip(out, (pa.string(), pa.int64(), pa.binary()), strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "docs", "counts"])

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, list] = {}
        for pdf in batches:
            for lang, docs, blob in zip(pdf["lang"], pdf["docs"], pdf["counts"], strict=True):
                held = sums.setdefault(lang, [0, 0])
                held[0] += docs
                held[1] = held[1] + unpack(blob)
        made = [(lang, docs, pack(total)) for lang, (docs, total) in sums.items()]
        yield pd.DataFrame(made, columns=["lang", "docs", "counts"])

    schema = "lang string, docs long, counts binary"
    parts = df.select(F.col("text").cast("string"), F.col("lang").cast("string")).mapInArrow(gather, schema)
    # one matrix per task, added up in two steps
    fewer = parts.repartition(16, F.pmod(F.xxhash64("counts"), F.lit(16))).mapInPandas(merge, schema)
    totals: dict[str, list] = {}
    for row in fewer.toLocalIterator():
        held = totals.setdefault(row["lang"], [0, 0])
        held[0] += row["docs"]
        held[1] = held[1] + unpack(row["counts"])
    languages = sorted(k for k, (n, _) in totals.items() if n)
    counts = np.array([totals[k][1] for k in languages], float).reshape(len(languages), 1 << bits) + smoothing
    weights = np.log(counts / counts.sum(axis=1, keepdims=True)).T if languages else np.zeros((1 << bits, 0))
    docs = np.array([totals[k][0] for k in languages], float)
    return Model(languages, np.ascontiguousarray(weights, np.float32), np.log(docs / max(docs.sum(), 1)), orders, bits)


def score_batch(part: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """Best language and its posterior probability for each text."""
    chars, bounds, lettered = characters(part)
    n = len(part)
    k = len(model.languages)
    if k == 0 or n == 0:
        return [UNKNOWN] * n, np.zeros(n)
    total = np.zeros((n, k))
    grams = [buckets(chars, order, model.bits) for order in model.orders]
    for j in range(k):
        column = np.ascontiguousarray(model.weights[:, j])
        each = np.zeros(len(chars) + 1)
        np.cumsum(sum(column[g] for g in grams), out=each[1:], dtype=np.float64)
        total[:, j] = each[bounds[1:]] - each[bounds[:-1]]
    total += model.prior
    best = total.argmax(axis=1)
    top = total[np.arange(n), best]
    score = 1 / np.exp(total - top[:, None]).sum(axis=1)
    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
    return names, np.where(lettered, score, 0.0)


def identify(df: DataFrame, model: Model, key: str = "doc_id", held_out: Column | None = None) -> DataFrame:
    """Predict the language of every text: ``key, held_out, lang_pred, score``.

    A null text or one without letters is ``und`` with score 0; so is every text
    if nothing could be learned. Only the text is read. Equal texts get equal
    predictions; ties go to the first language in order. An empty table gives an
    empty result, and further columns are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                names, score = score_batch(part.column("text"), model)
                arrays = [part.column("_key"), part.column("held_out"), pa.array(names, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, ["_key", "held_out", "lang_pred", "score"])

    flag = F.lit(False) if held_out is None else held_out
    kind = df.select(key).schema[0].dataType.simpleString()
    chosen = df.select(F.col(key).alias("_key"), flag.alias("held_out"), F.col("text").cast("string"))
    made = chosen.mapInArrow(rows, f"_key {kind}, held_out boolean, lang_pred string, score double")
    return made.withColumnRenamed("_key", key)
