"""Quality by perplexity under an interpolated modified Kneser-Ney bigram model.

The model is trained on trusted text: documents whose surface passes strict
rules. Words are hashes of 48 bits, so the vocabulary grows with the corpus and
words do not share places. Bigrams live in shards by their last word, which holds what
the lower order needs as well: how many different words come before it. Words
before a bigram are told apart the same way; those that are frequent as contexts,
a table of fixed size, have their statistics on the spot, and those of all others
lie in shards of their own.

Training sends each task's distinct bigrams with counts to the shards. Scoring
sends a document's bigrams to the same shards, where they meet their counts; those
after a rarer word go on to the shard of that word with them. Only sums per
document come back. The most frequent bigrams, a table of fixed size, are scored
where they are read, so no shard gets a hot one.

No text is judged by a model that has seen it: texts fall into folds by their
hash, counts are kept by fold, and a row is scored with the counts of the other
folds. Equal texts share a fold and count once.

Documents are rejected when their perplexity lies above a bound that quantiles of
the trusted documents of their language give.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.counts import by_shard, counted, merged, pack, pack_sorted, shard_bits, unpack, unpack_sorted
from sluice.llm.divergence import CLASS_OF
from sluice.llm.vectors import Texts, mixed, slices, span_hashes, split_words, texts, tidy
from sluice.llm.warc import store
from sluice.session import forget_shuffles, intermediates, materialize, scratch_path

#: parts of the trusted text, each scored with the counts of the others
FOLDS = 4
#: words with their statistics as contexts on the spot, and bigrams scored where they are read
CONTEXTS, FREQUENT = 1 << 17, 1 << 18
#: words of a task's block of bigrams, for the model and to be scored
BLOCK, ASKED = 1_000_000, 2_000_000
#: bits of the map of hashes that may belong to several rows
_REPEATED = 24
#: the bits of a word's hash that are kept; of a thousand million words some four in a million share theirs
_WORD = np.uint64(0xFFFFFFFFFFFF0000)
#: bits of a fold's number
_FOLD_BITS = 4
#: codes of words that are no frequent contexts: this bit and the 48 of their hash
_OTHER = np.uint64(1 << 63)
#: the documents are scored in so many passes, which bounds what is shuffled at a time
PASSES = 3
#: bytes of text at a time: the arrays of sums and powers, eight times as large, stay in the cache
_SLICE = 1 << 18
_CLASS_OF = CLASS_OF.astype(np.uint8).tobytes()
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: a place among the codes of a block
_PLACE = np.uint64((1 << 30) - 1)


@dataclass(frozen=True)
class Trust:
    """Surface rules of trusted text; shares of all characters."""

    words: int = 20
    symbols: float = 0.01
    marks: float = 0.02
    upper: float = 0.15
    digits: float = 0.10


@dataclass(frozen=True)
class Bound:
    """A document may lie ``width`` times the distance of two quantiles above the upper one."""

    words: int = 20
    middle: float = 0.5
    upper: float = 0.99
    width: float = 1.0
    #: short texts vary more: this many bits, divided by the root of their words
    sampling: float = 8.0


@dataclass(frozen=True)
class Index:
    """An ascending table of hashes, found by their top bits, which few of them share as they are spread evenly."""

    table: np.ndarray

    @cached_property
    def bits(self) -> int:
        return (4 * len(self.table) - 1).bit_length()

    @cached_property
    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """For each value of the top bits the last hash that has them, and whether others have them too."""
        slot = (self.table >> np.uint64(64 - self.bits)).astype(np.int64)
        last = np.zeros(1 << self.bits, np.int32)
        last[slot] = np.arange(len(slot), dtype=np.int32)
        shared = np.zeros(1 << self.bits, bool)
        shared[slot[1:][slot[1:] == slot[:-1]]] = True
        return last, shared

    def places(self, values: np.ndarray) -> np.ndarray:
        """The place of each value in the table, or -1."""
        if len(self.table) == 0:
            return np.full(len(values), -1, np.int32)
        last, shared = self.slots
        slot = (values >> np.uint64(64 - self.bits)).astype(np.int64)
        places = last[slot]
        other = np.flatnonzero(self.table[places] != values)
        places[other] = -1
        other = other[shared[slot[other]]]
        places[other] = _places(self.table, values[other])
        return places


@dataclass(frozen=True)
class Contexts:
    """Frequent words in order of their hash, with codes from 1, the most frequent first."""

    hashes: np.ndarray
    codes: np.ndarray

    @cached_property
    def index(self) -> Index:
        return Index(self.hashes)

    def before(self, words: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A code for the word before each word; 0 before the first of a text."""
        prior = np.concatenate([np.zeros(1, np.uint64), words[:-1]]) if len(words) else words
        made = _OTHER | prior >> np.uint64(16)
        at = self.index.places(prior)
        there = at >= 0
        made[there] = self.codes[at[there]]
        made[first[:-1][first[:-1] < first[1:]]] = 0
        return made


@dataclass(frozen=True)
class Model:
    """All of the model but its bigrams; one row of each array per fold of the judged texts."""

    contexts: Contexts
    #: by code of a frequent context: its occurrences, and the mass left to the lower order after it
    seen: np.ndarray
    backoff: np.ndarray
    discounts: np.ndarray
    #: of the lower order: discounts, bigrams of different words, mass left to unseen words, and words
    lower_discounts: np.ndarray
    kinds: np.ndarray
    left: np.ndarray
    words: np.ndarray
    #: whether the fold is left out of its own counts
    held_out: np.ndarray
    #: the most frequent bigrams in order of their key, with counts by fold and words before the last one
    hot_keys: np.ndarray
    hot_counts: np.ndarray
    hot_kinds: np.ndarray
    #: whether the other words have statistics as contexts too
    every: bool

    @cached_property
    def hot_index(self) -> Index:
        return Index(self.hot_keys)

    def slim(self, contexts: bool = True) -> Model:
        """The model without the frequent bigrams and words, and unless asked without statistics of contexts, to go to tasks that need no more."""
        none = np.zeros((len(self.held_out), 0))
        words = Contexts(np.zeros(0, np.uint64), np.zeros(0, np.uint32))
        left = {} if contexts else {"seen": none, "backoff": none}
        return replace(self, contexts=words, hot_keys=np.zeros(0, np.uint64), hot_counts=none, hot_kinds=none, **left)

    def known(self, counts: np.ndarray, at: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Counts of the bigrams at the given places as texts of the fold may know them."""
        return counts.sum(axis=0, dtype=np.int64)[at] - np.where(self.held_out[fold], counts[fold, at], 0)

    def lower(self, kinds: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Probability of words in the lower order, given how many different words come before them."""
        kept = np.maximum(kinds - self.lower_discounts[fold, np.minimum(kinds, 3)], 0) / np.maximum(self.kinds[fold], 1)
        return kept + self.left[fold] / (self.words[fold] + 1)

    def bits(self, before: np.ndarray, count: np.ndarray, kinds: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """Bits of each bigram's last word, given counts of the bigram and of words before the last one; the lower order after words without statistics here."""
        code = np.where(before < _OTHER, before, 0).astype(np.int64)
        seen = np.where(before < _OTHER, self.seen[fold, code], 0)
        return self.mixed_bits(seen, self.backoff[fold, code], count, kinds, fold)

    def mixed_bits(self, seen: np.ndarray, backoff: np.ndarray, count: np.ndarray, kinds: np.ndarray, fold: np.ndarray) -> np.ndarray:
        """The same, given the statistics of the contexts."""
        lower = self.lower(kinds, fold)
        kept = np.maximum(count - self.discounts[fold, np.minimum(count, 3)], 0) / np.maximum(seen, 1)
        return -np.log2(np.where(seen > 0, kept + backoff * lower, lower))


def word_hashes(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and each text's first word."""
    w = split_words(t)
    return span_hashes(t.data, w.start, w.end) & _WORD, w.first


def pair_keys(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(words ^ (before + np.uint64(1)) * _SPREAD)


def trusted(t: Texts, first: np.ndarray, rules: Trust) -> np.ndarray:
    classes = np.frombuffer(t.data.tobytes().translate(_CLASS_OF), np.uint8)

    def number(kind: int) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(classes == kind), t.bounds))

    # of all characters: later bytes of a character are no others
    whole = np.maximum(np.diff(t.bounds) - number(11), 1)
    ok = np.diff(first) >= rules.words
    for kind, most in ((9, rules.symbols), (7, rules.marks), (1, rules.upper), (2, rules.digits)):
        ok &= number(kind) / whole <= most
    return ok


def discounts(ones: float, twos: float, threes: float, fours: float) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts 0, 1, 2 and 3 or more."""
    if min(ones, twos, threes) <= 0:
        return np.array([0, 0.5, 0.75, 0.9])
    y = ones / (ones + 2 * twos)
    made = [0, 1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes]
    return np.clip(made, [0, 0.05, 0.05, 0.05], [0, 0.95, 1.95, 2.95])


def repeated_hashes(df: DataFrame) -> np.ndarray:
    """A map of fixed size that marks the hashes of all texts that occur more than once, and some others at worst."""
    hashed = df.select(F.xxhash64(F.col("text").cast("string")).alias("h")).filter(F.col("text").isNotNull())
    often = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    place = F.shiftrightunsigned("h", 64 - _REPEATED)

    def mark(pdf: pd.DataFrame) -> pd.DataFrame:
        marks = np.zeros(1 << 16, bool)
        marks[pdf["place"].to_numpy() & 0xFFFF] = True
        return pd.DataFrame({"part": [int(pdf["place"].iloc[0]) >> 16], "marks": [np.packbits(marks).tobytes()]})

    parts = often.select(place.alias("place")).groupBy(F.shiftright("place", 16)).applyInPandas(mark, "part int, marks binary")
    repeated = np.zeros(1 << _REPEATED, bool)
    for row in parts.collect():
        repeated[row["part"] << 16 : (row["part"] + 1) << 16] = np.unpackbits(np.frombuffer(row["marks"], np.uint8)).astype(bool)
    return np.packbits(repeated)


def _marked(marks: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    at = (batch.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - _REPEATED)).astype(np.int64)
    return marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1


def _word_order(words: np.ndarray) -> np.ndarray:
    """A stable order of the words by their hashes. Sorting values is many times faster than sorting places."""
    bits = np.uint64(max(1, (len(words) - 1).bit_length()))
    keys = words >> bits << bits | np.arange(len(words), dtype=np.uint64)
    keys.sort()
    order = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    found = words[order]
    # hashes that differ in their last bits only may be out of order: these few are sorted again, unless they are many
    wrong = np.flatnonzero(found[1:] < found[:-1])
    alike = np.unique(keys[wrong] >> bits) << bits
    if len(alike) > 1000:
        return np.argsort(words, kind="stable")
    starts = np.searchsorted(keys, alike)
    ends = np.searchsorted(keys, alike | ((np.uint64(1) << bits) - np.uint64(1)), "right")
    for a, b in zip(starts, ends, strict=True):
        order[a:b] = order[a:b][np.argsort(found[a:b], kind="stable")]
    return order


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and the place of each value among them, in half the room that NumPy takes."""
    order = np.argsort(values)
    values = values[order]
    first = np.concatenate([[True], values[1:] != values[:-1]])[: len(values)]
    places = np.empty(len(values), np.uint32)
    places[order] = np.cumsum(first, dtype=np.uint32) - np.uint32(1)
    return values[first], places


def _places(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The place of each value in an ascending table, or -1. Values that are searched in order find the table in the cache."""
    if len(table) == 0:
        return np.full(len(values), -1, np.int32)
    order = _word_order(values)
    found = values[order]
    at = np.minimum(np.searchsorted(table, found), len(table) - 1)
    places = np.empty(len(values), np.int32)
    places[order] = np.where(table[at] == found, at, -1)
    return places


def _largest(numbers: np.ndarray, keys: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest numbers; of equal ones, those with the smallest keys."""
    if len(numbers) <= most:
        return np.arange(len(numbers))
    if most <= 0:
        return np.arange(0)
    least = np.partition(numbers, len(numbers) - most)[len(numbers) - most]
    above, equal = np.flatnonzero(numbers > least), np.flatnonzero(numbers == least)
    return np.concatenate([above, equal[np.argsort(keys[equal], kind="stable")[: most - len(above)]]])


def _fold(folds: int) -> Column:
    return F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(folds)).cast("int").alias("fold")


def _packed(words: np.ndarray, before: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Bigrams in order of their words: the distinct words, how many bigrams each has, and the codes before."""
    distinct, length = counted(words)
    return pack_sorted(distinct), pack(length.astype(np.uint32)), pack(before)


def _most_frequent(rows: DataFrame, number: str, most: int) -> DataFrame:
    """The rows with the largest numbers, by classes of numbers, as many classes as fit into ``most`` rows."""
    classed = rows.withColumn("class", F.floor(F.log2(number) * 8))
    left, least = most, None
    for row in classed.groupBy("class").agg(F.count(F.lit(1)).alias("k")).orderBy(F.desc("class")).collect():
        left -= row["k"]
        if left < 0:
            break
        least = row["class"]
    return classed.filter(F.col("class") >= least if least is not None else F.lit(False)).drop("class")


def frequent_contexts(df: DataFrame, rules: Trust, most: int = CONTEXTS, block: int = BLOCK) -> Contexts:
    """The most frequent words of trusted text, or nearly so, as a task sends ``most`` words at most.

    Which words these are decides where statistics lie, not what they are.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, number = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []

        def add() -> tuple[np.ndarray, np.ndarray]:
            words, n = counted(np.concatenate(held) if held else best[:0])
            words, n = merged(np.concatenate([best, words]), np.concatenate([number, n]))
            if len(words) > 4 * most:
                top = np.sort(np.argpartition(-n, 4 * most)[: 4 * most])
                words, n = words[top], n[top]
            return words, n

        for whole in batches:
            for part in slices(whole, limit=_SLICE):
                t = texts(part.column("text"))
                words, first = word_hashes(t)
                held.append(words[np.repeat(trusted(t, first, rules), np.diff(first))])
                if sum(map(len, held)) > block:
                    best, number = add()
                    held = []
        best, number = add()
        top = np.argsort(-number, kind="stable")[:most]
        yield pa.RecordBatch.from_arrays([pa.array(best[top].view(np.int64)), pa.array(number[top])], ["word", "n"])

    found = df.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(count), "word long, n long")
    # written, as it is read twice
    counts = materialize(found.groupBy("word").agg(F.sum("n").alias("n")), "contexts")
    top = _most_frequent(counts, "n", most).toPandas()
    word, n = top["word"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    codes = np.empty(len(word), np.uint32)
    codes[np.lexsort((word, -n))] = np.arange(1, len(word) + 1, dtype=np.uint32)
    order = np.argsort(word)
    return Contexts(word[order], codes[order])


def count_bigrams(
    df: DataFrame, rules: Trust, contexts: Contexts, bits: int, block: int = BLOCK, folds: int = 1, marks: np.ndarray | None = None
) -> DataFrame:
    """Shards of all bigrams of trusted text: ``shard, words, lengths, known, before, counts``, written once; counts fold by fold.

    ``known`` are the codes of a shard in order, ``before`` places among them.

    With ``marks`` (see :func:`repeated_hashes`) every text counts once, and only
    texts that are marked are shuffled for that.
    """
    names = ["shard", "words", "lengths", "before", "folds", "counts"]
    kinds = (pa.int32(), *[pa.binary()] * 5)

    def gather(batches: Iterator[pa.RecordBatch], marks: np.ndarray | None = marks) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def rows() -> pa.RecordBatch:
            words, before, fold = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = _word_order(words)
            words, before, fold = words[order], before[order], fold[order]
            # a number for each word, in their order, one for the code before it and the fold as one
            first = np.concatenate([[True], words[1:] != words[:-1]])[: len(words)]
            number = np.cumsum(first).astype(np.uint64) - np.uint64(1)
            codes, before = _coded(before)
            entries, n = counted((number << np.uint64(30) | before.astype(np.uint64)) << np.uint64(_FOLD_BITS) | fold)
            pairs, fold = entries >> np.uint64(_FOLD_BITS), (entries & np.uint64((1 << _FOLD_BITS) - 1)).astype(np.uint8)
            words, before, n = words[first][(pairs >> np.uint64(30)).astype(np.int64)], codes[(pairs & _PLACE).astype(np.int64)], n.astype(np.uint32)
            found = [(s, *_packed(words[p], before[p]), pack(fold[p]), pack(n[p])) for s, p in by_shard(words, bits)]
            columns = list(zip(*found, strict=True)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for whole in batches:
            if marks is not None:
                whole = whole.filter(pa.array(~_marked(marks, whole)))
            for part in slices(whole, limit=_SLICE):
                t = texts(part.column("text"))
                words, first = word_hashes(t)
                good = np.repeat(trusted(t, first, rules), np.diff(first))
                fold = np.repeat(part.column("fold").to_numpy().astype(np.uint8), np.diff(first))
                held.append((words[good], contexts.before(words, first)[good], fold[good]))
                size += len(held[-1][0])
                if size > block:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        each, lengths = [unpack_sorted(w) for w in pdf["words"]], [unpack(k) for k in pdf["lengths"]]
        distinct = np.unique(np.concatenate(each))
        codes, pairs = _coded(np.concatenate([unpack(v) for v in pdf["before"]]))
        pairs = pairs.astype(np.uint64)
        at = 0
        for w, k in zip(each, lengths, strict=True):
            to = at + int(k.sum(dtype=np.int64))
            pairs[at:to] |= np.repeat(np.searchsorted(distinct, w).astype(np.uint64) << np.uint64(32), k)
            at = to
        del each, lengths
        n, fold = np.concatenate([unpack(c) for c in pdf["counts"]]), np.concatenate([unpack(f) for f in pdf["folds"]])
        order = np.argsort(pairs)
        pairs, n, fold = pairs[order], n[order], fold[order]
        del order
        at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
        words, place = distinct[(pairs >> np.uint64(32)).astype(np.int64)], (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        counts = np.stack([_small(np.add.reduceat(np.where(fold == f, n, np.uint32(0)), at, dtype=np.int64)) for f in range(folds)])
        w, k, v = _packed(words[at], _small(place[at]))
        made = {"words": w, "lengths": k, "known": pack_sorted(codes), "before": v, "counts": pack(counts.reshape(-1))}
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], **{name: [blob] for name, blob in made.items()}})

    schema = "shard int, words binary, lengths binary, before binary, folds binary, counts binary"
    chosen = df.select(F.col("text").cast("string").alias("text"), _fold(folds))
    chosen = chosen.filter("text IS NOT NULL").withColumn("h", F.xxhash64("text"))
    parts = chosen.mapInArrow(tidy(gather), schema)
    if marks is not None:

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(_marked(marks, batch)))

        repeated = chosen.mapInArrow(again, chosen.schema).dropDuplicates(["h"])
        parts = parts.unionAll(repeated.mapInArrow(tidy(lambda batches: gather(batches, None)), schema))
    made = parts.groupBy("shard").applyInPandas(tidy(merge), "shard int, words binary, lengths binary, known binary, before binary, counts binary")
    # a folder for each shard, so that its bigrams can be read where they are asked for
    folder = scratch_path(df.sparkSession, "bigrams")
    # what is packed is not compressed again
    made.write.partitionBy("shard").option("compression", "none").parquet(folder)
    return df.sparkSession.read.schema(made.schema).parquet(folder)


def _read_row(folder: str | None, number: int) -> object | None:
    """The row of a shard from its folder, if it is there."""
    if folder is not None:
        system, root = store(folder)
        for file in system.get_file_info(fs.FileSelector(f"{root}/shard={number}", allow_not_found=True)):
            if file.path.endswith(".parquet"):
                (row,) = pq.read_table(file.path, filesystem=system, partitioning=None).to_pandas().itertuples()
                return row
    return None


@dataclass(frozen=True)
class _Shard:
    """The bigrams of a shard in order of word and code; codes are places among the known ones."""

    words: np.ndarray
    lengths: np.ndarray
    known: np.ndarray
    inside: np.ndarray
    counts: np.ndarray

    @property
    def before(self) -> np.ndarray:
        return self.known[self.inside]

    @classmethod
    def of(cls, row: object, folds: int) -> _Shard:
        counts = unpack(row.counts).reshape(folds, -1)
        return cls(unpack_sorted(row.words), unpack(row.lengths).astype(np.int64), unpack_sorted(row.known), unpack(row.before), counts)

    @classmethod
    def read(cls, folder: str | None, number: int, folds: int) -> _Shard:
        """A shard from its folder; one that is not there has no bigrams."""
        row = _read_row(folder, number)
        if row is not None:
            return cls.of(row, folds)
        return cls(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint8), np.zeros((folds, 0), np.int64))

    def kinds(self, counts: np.ndarray) -> np.ndarray:
        """How many different words come before each word, by the given counts."""
        first = np.cumsum(self.lengths) - self.lengths
        return np.add.reduceat((counts > 0).astype(np.int64), first) if len(first) else first


def without(counts: np.ndarray, m: int) -> np.ndarray:
    """Counts of all folds but one, or of all."""
    whole = counts.sum(axis=0, dtype=np.int64)
    return whole if m == len(counts) else whole - counts[m]


def fit(shards: DataFrame, contexts: Contexts, hot: int = FREQUENT, folds: int = 1, every: bool = True) -> Model:
    """The model of the counted bigrams; what comes to the driver is bounded by the contexts and ``hot``.

    For each fold the model of the other folds' text. Where these have none,
    nothing can be held out, and the model is that of all text. Unless ``every``
    word is a context, only the given ones are.
    """
    # one model per fold, and that of all text
    models = [*range(folds if folds > 1 else 0), folds]
    codes = len(contexts.hashes) + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # per context: occurrences, followers seen once, twice, more often; then how many bigrams have each count,
        # and how many words have each number of words before them, their sum, and the words
        total = np.zeros((folds + 1, 4, codes), np.int64)
        few = np.zeros((folds + 1, 2, 7), np.int64)
        for pdf in batches:
            for row in pdf.itertuples():
                shard = _Shard.of(row, folds)
                before = shard.before
                frequent = before < _OTHER
                code = before[frequent].astype(np.int64)
                whole = without(shard.counts, folds)
                for m in models:
                    all_counts = whole if m == folds else whole - shard.counts[m]
                    counts = all_counts[frequent]
                    total[m, 0] += np.bincount(code, counts, codes).astype(np.int64)
                    classes = np.bincount(code * 4 + np.minimum(counts, 3), minlength=4 * codes).reshape(codes, 4)
                    total[m, 1:] += classes[:, 1:].T
                    counts = all_counts if every else counts
                    few[m, 0, :5] += np.bincount(np.minimum(counts, 5), minlength=6)[1:]
                    kinds = shard.kinds(all_counts)
                    kinds = kinds[kinds > 0]
                    few[m, 1, :5] += np.bincount(np.minimum(kinds, 5) - 1, minlength=5)
                    few[m, 1, 5:] += (kinds.sum(), len(kinds))
        made = [(m, n, pack(total[m, n])) for m in models for n in range(4)]
        yield pd.DataFrame(made + [(m, 4 + n, pack(few[m, n])) for m in models for n in range(2)], columns=["model", "kind", "total"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = 0
        for blob in pdf["total"]:
            total = total + unpack(blob)
        return pd.DataFrame({"model": [pdf["model"].iloc[0]], "kind": [pdf["kind"].iloc[0]], "total": [pack(total)]})

    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.zeros(0, np.uint64), np.zeros((2 * folds + 1, 0), np.int64)
        least = 0
        for pdf in batches:
            for row in pdf.itertuples():
                shard = _Shard.of(row, folds)
                whole = without(shard.counts, folds)
                # only contexts whose statistics are at hand are of use, and counts that can be among the largest
                before = shard.before
                top = np.flatnonzero((whole >= least) & (before < _OTHER) if every else whole >= least)
                word = np.repeat(np.arange(len(shard.words)), shard.lengths)[top]
                keys = pair_keys(shard.words[word], before[top])
                some = _largest(whole[top], keys, hot)
                top, word, keys = top[some], word[some], keys[some]
                kinds = [shard.kinds(whole if m == folds else whole - shard.counts[m])[word] for m in range(folds + 1)]
                facts = np.concatenate([shard.counts[:, top].astype(np.int64), kinds])
                best = np.concatenate([best[0], keys]), np.concatenate([best[1], facts], axis=1)
                number = best[1][:folds].sum(axis=0)
                top = _largest(number, best[0], hot)
                best = best[0][top], best[1][:, top]
                least = number[top].min() if 0 < hot <= len(top) else 0
        parts = [p.tobytes() for p in np.ascontiguousarray(best[1].T)]
        yield pd.DataFrame({"at": best[0].view(np.int64), "n": best[1][:folds].sum(axis=0), "parts": parts})

    schema = "model int, kind int, total binary"
    table = {(r["model"], r["kind"]): unpack(r["total"]) for r in shards.mapInPandas(tidy(sums), schema).groupBy("model", "kind").applyInPandas(add, schema).collect()}
    top = _most_frequent(shards.mapInPandas(tidy(frequent), "at long, n long, parts binary"), "n", hot).select("at", "parts").toPandas()

    def array(model: int, kind: int) -> np.ndarray:
        return table.get((model, kind), np.zeros(codes if kind < 4 else 7)).astype(float)

    def one(model: int) -> tuple[np.ndarray | float, ...]:
        seen, n1, n2, n3 = (array(model, k) for k in range(4))
        d = discounts(*array(model, 4)[:4])
        backoff = (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(seen, 1)
        kinds = array(model, 5)
        e = discounts(*kinds[:4])
        left = (e[1] * kinds[0] + e[2] * kinds[1] + e[3] * kinds[2:5].sum()) / kinds[5] if kinds[5] else 1.0
        return seen, backoff, d, e, kinds[5], left, kinds[6]

    held_out = np.array([folds > 1 and bool(array(m, 0).any()) for m in range(folds)])
    stats = [np.stack(x) for x in zip(*(one(m if held_out[m] else folds) for m in range(folds)), strict=True)]
    keys = top["at"].to_numpy(np.int64).view(np.uint64)
    facts = np.frombuffer(b"".join(top["parts"]), np.int64).reshape(-1, 2 * folds + 1).T
    order = np.argsort(keys)
    kinds = np.stack([facts[folds + (m if held_out[m] else folds), order] for m in range(folds)])
    return Model(contexts, *stats, held_out, keys[order], _small(facts[:folds, order]), _small(kinds), every)


def _small(numbers: np.ndarray) -> np.ndarray:
    """The same numbers from 0 up, in as few bytes as the largest needs."""
    return np.ascontiguousarray(numbers, np.min_scalar_type(int(numbers.max(initial=0))))


def rare_contexts(shards: DataFrame, model: Model, bits: int) -> DataFrame:
    """Shards of all words that are no frequent contexts: ``shard, words, facts``, written once.

    Facts are, for each fold of the judged texts, the occurrences of each word and
    how many of its followers come once, twice and more often.
    """
    held_out = model.held_out
    folds = len(held_out)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                shard = _Shard.of(row, folds)
                first = np.searchsorted(shard.known, _OTHER)
                rare = np.flatnonzero(shard.inside >= first)
                if len(rare) == 0:
                    continue
                place = shard.inside[rare].astype(np.uint32)
                order = np.argsort(place, kind="stable")
                rare, words = rare[order], shard.known[place[order]] << np.uint64(16)
                at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
                facts = np.zeros((4 * folds, len(at)), np.uint32)
                known = shard.counts[:, rare]
                whole = without(known, folds)
                for m in range(folds):
                    counts = whole - known[m] if held_out[m] else whole
                    for n, some in enumerate((counts, counts == 1, counts == 2, counts >= 3)):
                        facts[4 * m + n] = np.add.reduceat(some.astype(np.int64), at)
                words = words[at]
                found = [(s, pack_sorted(words[p]), pack(_small(facts[:, p].reshape(-1)))) for s, p in by_shard(words, bits)]
                yield pd.DataFrame(found, columns=["shard", "words", "facts"])

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        words = np.concatenate([unpack_sorted(w) for w in pdf["words"]])
        parts = [unpack(f).reshape(4 * folds, -1) for f in pdf["facts"]]
        order = _word_order(words)
        words = words[order]
        at = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
        # one fact at a time, as all of them in order are many times larger
        facts = np.stack([_small(np.add.reduceat(np.concatenate([f[k] for f in parts])[order], at, dtype=np.int64)) for k in range(4 * folds)])
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "words": [pack_sorted(words[at])], "facts": [pack(facts.reshape(-1))]})

    schema = "shard int, words binary, facts binary"
    made = shards.mapInPandas(tidy(send), schema).groupBy("shard").applyInPandas(tidy(merge), schema)
    folder = scratch_path(shards.sparkSession, "rare-contexts")
    # what is packed is not compressed again
    made.write.partitionBy("shard").option("compression", "none").parquet(folder)
    return shards.sparkSession.read.schema(made.schema).parquet(folder)


def _folder(shards: DataFrame) -> str | None:
    files = shards.inputFiles()
    return files[0].rsplit("/shard=", 1)[0] if files else None


DOCS = "doc_id long, lang string, h long, n_words long, bits double, trusted boolean"


def document_bits(
    df: DataFrame, shards: DataFrame, model: Model, rules: Trust, bits: int, block: int = ASKED, rare: DataFrame | None = None, rare_bits: int = 0, scored: tuple[int, int] | None = None
) -> DataFrame:
    """Bits of all words of each document: ``doc_id, lang, h, n_words, bits, trusted``, ``h`` a hash of its text.

    ``rare`` is what :func:`rare_contexts` returns, if every word is a context; only one part of so many is ``scored``: ``(part, parts)``.
    """
    folds = len(model.held_out)
    if model.every and rare is None:
        raise ValueError("every word is a context: the rare ones are needed")
    columns = ["block", "shard", "words", "lengths", "before", "docs", "table"]
    kinds = (pa.string(), pa.int32(), *[pa.binary()] * 5)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = docs = number = 0

        def rows() -> pa.RecordBatch:
            # the same for a task that runs again
            name = f"{TaskContext.get().partitionId()}-{number}"
            heads, counts, goods, heres, words, before, doc = map(list, zip(*held, strict=True))
            held.clear()
            table = pa.Table.from_batches(heads)
            count, good, here = (np.concatenate(c) for c in (counts, goods, heres))
            table = table.append_column("n_words", pa.array(count)).append_column("trusted", pa.array(good))
            table = table.append_column("bits", pa.array(here))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            # the table goes along with the bigrams of one shard
            out = [(name, crc32(name.encode()) & ((1 << bits) - 1), None, None, None, None, sink.getvalue().to_pybytes())]
            base = np.concatenate([[0], np.cumsum([len(c) for c in counts])])
            small = np.uint16 if len(count) * folds < 1 << 16 else np.uint32
            words = np.concatenate(words)
            order = _word_order(words)
            words = words[order]
            # one column after the other, so that few are there twice
            before = np.concatenate(before)[order]
            # a document's number and fold as one
            doc = np.concatenate([(d + np.uint32(b * folds)).astype(small) for d, b in zip(doc, base, strict=False)])[order]
            del order
            out += [(name, s, *_packed(words[p], before[p]), pack_sorted(doc[p]), None) for s, p in by_shard(words, bits)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], columns)

        for whole in batches:
            for part in slices(whole, limit=_SLICE):
                t = texts(part.column("text"))
                words, first = word_hashes(t)
                before, count, fold = model.contexts.before(words, first), np.diff(first), part.column("fold").to_numpy()
                doc = np.repeat(np.arange(len(t)), count)
                keys = pair_keys(words, before)
                at = model.hot_index.places(keys)
                hot = at >= 0
                own, at = fold[doc[hot]], at[hot]
                found = model.bits(before[hot], model.known(model.hot_counts, at, own), model.hot_kinds[own, at], own)
                here = np.bincount(doc[hot], np.round(found * 1024), len(t)) / 1024
                asked = (doc[~hot] * folds + fold[doc[~hot]]).astype(np.uint32)
                # after all words without statistics the model is the same
                codes = before[~hot] if model.every else np.minimum(before[~hot], _OTHER)
                held.append((part.select(["doc_id", "lang", "h"]), count, trusted(t, first, rules), here, words[~hot], codes, asked))
                size, docs = size + len(asked), docs + len(t)
                if size > block or docs >= 50_000:
                    yield rows()
                    size, docs, number = 0, 0, number + 1
        if held:
            yield rows()

    folder, rare_folder = _folder(shards), None if rare is None else _folder(rare)
    columns_on = ["target", "block", "sums", "table", "words", "places", "docs", "counts", "kinds"]

    # what goes to the tasks of a step is what these need
    counted_model, plain_model = model.slim(), model.slim(contexts=False)

    def score(parts: pd.DataFrame) -> pd.DataFrame:
        shard = _Shard.read(folder, int(parts["shard"].iloc[0]), folds)
        whole = shard.counts.sum(axis=0, dtype=np.int64)
        kinds = np.stack([shard.kinds(whole - np.where(counted_model.held_out[m], shard.counts[m], 0)) for m in range(folds)])
        known = shard.known
        pairs = np.repeat(np.arange(len(shard.words), dtype=np.uint64), shard.lengths) << np.uint64(32) | shard.inside.astype(np.uint64)
        out: list[tuple] = []
        names: list[str] = []
        onward: list[tuple[np.ndarray, ...]] = []
        for part in parts.itertuples():
            # what is done goes along, spread over the shards of rare contexts
            target = crc32(part.block.encode()) & ((1 << rare_bits) - 1)
            if part.table is not None:
                out.append((target, part.block, None, part.table, *[None] * 5))
                continue
            words, length, before = unpack_sorted(part.words), unpack(part.lengths).astype(np.int64), unpack(part.before)
            asked = unpack_sorted(part.docs).astype(np.int64)
            doc, fold = np.divmod(asked, folds)
            n, k = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
            if len(shard.words):
                place = np.minimum(np.searchsorted(shard.words, words), len(shard.words) - 1)
                there, place = np.repeat(shard.words[place] == words, length), np.repeat(place, length)
                k = np.where(there, kinds[fold, place], 0)
                code = _places(known, before)
                there &= code >= 0
                pair = place.astype(np.uint64) << np.uint64(32) | code.astype(np.uint64)
                at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1)
                n = np.where(there & (pairs[at] == pair), whole[at] - np.where(counted_model.held_out[fold], shard.counts[fold, at], 0), 0)
            if counted_model.every:
                later = before >= _OTHER
                place = np.full(np.count_nonzero(later), len(names), np.uint32)
                onward.append((before[later] << np.uint64(16), place, asked[later].astype(np.uint32), n[later].astype(np.uint32), k[later].astype(np.uint32)))
                names.append(part.block)
                before, n, k, doc, fold = (x[~later] for x in (before, n, k, doc, fold))
            # whole thousandths of a bit, so that sums do not depend on their order
            each = np.round(counted_model.bits(before, n, k, fold) * 1024)
            out.append((target, part.block, pack(np.bincount(doc, each).astype(np.int64)), None, *[None] * 5))
        if onward:
            words, *facts = (np.concatenate(x) for x in zip(*onward, strict=True))
            order = _word_order(words)
            words, facts = words[order], [x[order] for x in facts]
            blocks = "\n".join(names)
            for s, p in by_shard(words, rare_bits):
                out.append((s, blocks, None, None, pack_sorted(words[p]), *[pack(x[p]) for x in facts]))
        return pd.DataFrame(out, columns=columns_on)

    def score_rare(parts: pd.DataFrame) -> pd.DataFrame:
        done = parts[parts["words"].isna()]
        out = [(r.block, r.sums, r.table) for r in done.itertuples()]
        asked = parts[parts["words"].notna()]
        row = _read_row(rare_folder, int(parts["target"].iloc[0])) if len(asked) else None
        known = np.zeros(0, np.uint64) if row is None else unpack_sorted(row.words)
        facts = np.zeros((folds, 4, 0)) if row is None else unpack(row.facts).reshape(folds, 4, -1)
        for part in asked.itertuples():
            words = unpack_sorted(part.words)
            doc, fold = np.divmod(unpack(part.docs).astype(np.int64), folds)
            n, k = unpack(part.counts).astype(np.int64), unpack(part.kinds).astype(np.int64)
            seen, mass = np.zeros(len(words)), np.zeros(len(words))
            if len(known):
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                there = known[at] == words
                seen = np.where(there, facts[fold, 0, at], 0).astype(float)
                d = plain_model.discounts[fold]
                mass = sum(d[:, j] * facts[fold, j, at] for j in (1, 2, 3)) / np.maximum(seen, 1)
            each = np.round(plain_model.mixed_bits(seen, mass, n, k, fold) * 1024)
            names, place = part.block.split("\n"), unpack(part.places).astype(np.int64)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(len(names) + 1))
            for b, name in enumerate(names):
                some = order[cuts[b] : cuts[b + 1]]
                if len(some):
                    out.append((name, pack(np.bincount(doc[some], each[some]).astype(np.int64)), None))
        return pd.DataFrame(out, columns=["block", "sums", "table"])

    def total(parts: pd.DataFrame) -> pd.DataFrame:
        table = pa.ipc.open_stream(parts["table"].dropna().iloc[0]).read_all()
        sums = np.zeros(table.num_rows, np.int64)
        for blob in parts["sums"].dropna():
            each = unpack(blob)
            sums[: len(each)] += each
        out = table.select(["doc_id", "lang", "h", "n_words"]).to_pandas(integer_object_nulls=True)
        out["doc_id"] = pd.array(table.column("doc_id").to_pylist(), "Int64")
        out["bits"] = table.column("bits").to_numpy() + sums / 1024
        out["trusted"] = table.column("trusted").to_numpy(zero_copy_only=False)
        return out

    chosen = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.xxhash64(F.col("text").cast("string")).alias("h"),
        _fold(folds),
    )
    if scored is not None:
        # folds are the remainders of the hash itself
        chosen = chosen.filter(F.pmod(F.shiftrightunsigned("h", 16), F.lit(scored[1])) == scored[0])
    schema = "block string, shard int, words binary, lengths binary, before binary, docs binary, table binary"
    asked = chosen.mapInArrow(tidy(gather), schema)
    done = "block string, sums binary, table binary"
    sums = asked.groupBy("shard").applyInPandas(tidy(score), f"target int, {done}, words binary, places binary, docs binary, counts binary, kinds binary")
    sums = sums.groupBy("target").applyInPandas(tidy(score_rare), done) if model.every else sums.select("block", "sums", "table")
    return sums.groupBy("block").applyInPandas(total, DOCS)


def judge(df: DataFrame, rules: Trust = Trust(), bound: Bound = Bound(), contexts: int = CONTEXTS, frequent: int = FREQUENT) -> DataFrame:
    """Perplexity and verdict for every row of ``doc_id, text, lang``.

    Returns doc_id, lang, n_words, trusted, bits_per_word (the logarithm of the
    perplexity to base 2), bound and kept. Texts that are null, empty or shorter
    than ``bound.words`` words are kept, as are those of a language without
    trusted documents (bound null); a null language is one of its own. No row is
    scored with its own text or copies of it, and equal texts count once in the
    model and the quantiles (unless all trusted text is in one fold, as when it
    is a single text). Equal texts of a language get equal verdicts, repeated
    rows are judged each, other columns are left out, and an empty table gives an
    empty result. Every word has statistics as a context, those of ``contexts``
    words are on the spot; with 0 no word has any, and the model is the lower
    order. ``frequent`` bigrams are scored where they are read.
    """
    return verdicts(df, rules, bound, contexts, frequent).drop("h")


def verdicts(df: DataFrame, rules: Trust = Trust(), bound: Bound = Bound(), contexts: int = CONTEXTS, frequent: int = FREQUENT) -> DataFrame:
    """What :func:`judge` returns, with ``h``, the hash of the text."""
    size = df.select(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(shard_bits(size / 6, 2_000_000), 31)
    # about one word in eight is no frequent context
    rare_bits = max(0, bits - 3)
    spark = df.sparkSession
    passes = PASSES if bits else 1
    parts = [scratch_path(spark, "bits") for _ in range(passes)]
    # counts and contexts go when all is scored
    with intermediates(spark):
        known = frequent_contexts(df, rules, contexts)
        marks = repeated_hashes(df)
        forget_shuffles(spark)
        shards = count_bigrams(df, rules, known, bits, folds=FOLDS, marks=marks)
        model = fit(shards, known, frequent, folds=FOLDS, every=contexts > 0)
        forget_shuffles(spark)
        rare = rare_contexts(shards, model, rare_bits) if model.every else None
        for k, path in enumerate(parts):
            forget_shuffles(spark)
            document_bits(df, shards, model, rules, bits, rare=rare, rare_bits=rare_bits, scored=(k, passes)).write.parquet(path)
    forget_shuffles(spark)
    found = spark.read.schema(DOCS).parquet(*parts)
    found = found.withColumn("bits_per_word", F.when(F.col("n_words") > 0, F.round(F.col("bits") / F.col("n_words"), 6)))
    judged = F.col("trusted") & (F.col("n_words") >= bound.words)
    # the bound's own share for short texts, so that lengths can be compared
    slack = F.lit(bound.sampling) / F.sqrt(F.greatest("n_words", F.lit(1)))
    level = F.percentile_approx("bits_per_word", F.array(F.lit(bound.middle), F.lit(bound.upper)), 10_000).alias("q")
    quantiles = found.filter(judged).dropDuplicates(["lang", "h"]).groupBy(F.col("lang").alias("_lang")).agg(level)
    joined = found.join(quantiles, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    limit = F.col("q")[1] + bound.width * (F.col("q")[1] - F.col("q")[0]) + slack
    over = (F.col("n_words") >= bound.words) & (F.col("bits_per_word") > limit)
    return joined.select(
        "doc_id", "lang", "h", "n_words", "trusted", "bits_per_word", F.round(limit, 6).alias("bound"), F.coalesce(~over, F.lit(True)).alias("kept")
    )
