"""N-gram Jaccard join on parity sketches.

Every shingle of a document toggles one place of a long parity sketch, so two
sketches differ in at most as many places as their sets differ in elements. A
sketch is cut into more pieces than two similar sets may have differences, hence
similar sets agree on some pieces; a piece of the sketch is stored as the XOR of
the hashes of the shingles that toggled it. Sizes are banded, since the number of
pieces follows the size of the sets, and a set joins the next band too where it
may have partners there.

With spare pieces more than one must agree. So, as in prefix filtering, every
set leaves out its most frequent pieces, as many as it can spare: pieces that
hold nothing but a widely shared passage never form candidates. What is left is
compared with one set per piece, and again with another one where a piece's sets
are not all connected; what is apart even then is compared across components.
There the Hamming distance of short folded sketches bounds the difference from
below, so that no link is lost and hardly a pair is formed for nothing. Equal sets are one set throughout. Every candidate is
verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.counts import by_shard, pack, pack_sorted, shard_bits, unpack, unpack_sorted
from sluice.llm.vectors import U64, Texts, mixed, ragged, run_hashes, slices, span_hashes, split_words, texts, tidy
from sluice.session import finished, materialize, scratch_path

#: bits of the folded sketch of a whole set
FOLD = 1024
#: rows a task of a small step should have at least
TASK_ROWS = 100_000
#: members of one piece that a task sends to its shard; the others skip the shard
LOCAL_MEMBERS = 64


@dataclass(frozen=True)
class Similar:
    """What counts as similar: shingles of ``words`` words, ``100 * both >= percent * either``."""

    words: int = 5
    percent: int = 80
    #: pieces per possible difference
    spare: float = 1.5

    def differences(self, total: int | np.ndarray) -> int | np.ndarray:
        """Most differences of two similar sets with ``total`` elements together."""
        return total * (100 - self.percent) // (100 + self.percent)

    def bands(self) -> np.ndarray:
        """Smallest size of each band; partners are at most one band apart."""
        step = max(1.5, 100 / self.percent)
        sizes = [1]
        while sizes[-1] < 1 << 40:
            sizes.append(int(np.ceil(sizes[-1] * step)) + (sizes[-1] == 1))
        return np.array(sizes, np.int64)


def shingle_sets(t: Texts, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and where each text's begin.

    Letters A-Z count as a-z. A text with fewer words is one shingle, a text
    without words has none.
    """
    w = split_words(t)
    low = t.lowered()
    h = span_hashes(low.data, w.start, w.end)
    runs, at = run_hashes(h, w.first, words)
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < words))
    parts, sizes = [], np.zeros(len(t), np.int64)
    whole = {}
    for k in short:
        with np.errstate(over="ignore"):
            made = U64(n[k])
            for x in h[w.first[k] : w.first[k + 1]]:
                made = mixed(np.array([made * U64(0x9E3779B97F4A7C55) + x], U64))[0]
        whole[k] = np.array([made], U64)
    for k in range(len(t)):
        part = whole[k] if k in whole else np.sort(runs[at[k] : at[k + 1]])
        if len(part) > 1:
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        parts.append(part)
        sizes[k] = len(part)
    return np.concatenate([np.zeros(0, U64), *parts]), np.concatenate([[0], np.cumsum(sizes)])


def class_of(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name for each distinct set."""
    size = np.diff(first)
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mixed(sets ^ U64(0x5BD1E9955BD1E995)), dtype=U64)])
        return mixed(total[first[1:]] - total[first[:-1]] + mixed(size.astype(U64)))


def folded(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The parity sketch of each set, folded to ``FOLD`` bits: rows of 64-bit words."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    place = (mixed(sets + U64(2)) >> U64(32)).astype(np.int64) % FOLD
    odd = (np.bincount(doc * FOLD + place, minlength=n * FOLD) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, FOLD), axis=1).view(np.int64)


def sketch_pieces(sets: np.ndarray, first: np.ndarray, rule: Similar) -> dict[str, np.ndarray]:
    """The pieces each set may meet others in: set, key, band, and how many it can spare."""
    size = np.diff(first)
    starts = rule.bands()
    band = np.searchsorted(starts, size, "right") - 1
    full = size > 0
    reach = size * 100 // rule.percent
    own = np.flatnonzero(full)
    up = np.flatnonzero(full & (reach >= starts[np.minimum(band + 1, len(starts) - 1)]))
    which = np.concatenate([own, up])
    band = np.concatenate([band[own], band[up] + 1])
    # pairs within a band are smaller than twice its end
    differ = rule.differences(2 * (starts[band + 1] - 1))
    pieces = np.maximum(1, np.ceil(rule.spare * (differ + 1))).astype(np.int64)
    base = np.concatenate([[0], np.cumsum(pieces)])
    count = size[which]
    at = ragged(first[which], count)
    entry = np.repeat(np.arange(len(which)), count)
    h = sets[at]
    cell = base[entry] + (mixed(h + U64(1)) >> U64(20)).astype(np.int64) % pieces[entry]
    value = np.zeros(base[-1], U64)
    np.bitwise_xor.at(value, cell, h)
    filled = np.bincount(cell, minlength=base[-1]) > 0
    owner = np.repeat(np.arange(len(which)), pieces)
    empty = np.bincount(owner, ~filled, minlength=len(which)).astype(np.int64)
    # pieces with something in them that two similar sets share at least
    shared = pieces - differ - empty
    keep = filled | (shared < 1)[owner]
    place = np.arange(base[-1]) - base[owner]
    with np.errstate(over="ignore"):
        key = mixed(value + mixed((band[owner] << 40 | place).astype(U64)))
    return {
        "set": which[owner[keep]],
        "key": key[keep],
        "band": band[owner[keep]],
        "spare": np.maximum(shared - 1, 0)[owner[keep]],
    }


BLOCKS = "shard int, a binary, b binary, c binary, d binary, e binary"
NAMES = ["shard", "a", "b", "c", "d", "e"]
MEMBERS = "key long, cls long, band int, spare int, size long, freq long"
DOCUMENTS = "doc_id long, cls long, size long, fold array<long>"
#: the most frequent of all, for pieces too frequent to count in one place
HOT = 1 << 40


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), *[pa.binary()] * 5)
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def sketch_blocks(df: DataFrame, rule: Similar, bits: int, block_keys: int = 500_000) -> DataFrame:
    """Packed rows of ``doc_id, text``: pieces by shard, members of hot pieces (-1), documents (-2)."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0
        for whole in batches:
            for part in slices(whole):
                sets, first = shingle_sets(texts(part.column("text")), rule.words)
                names, size = class_of(sets, first), np.diff(first)
                ids = part.column("doc_id")
                null = np.asarray(ids.is_null(), dtype=np.uint8)
                fold = folded(sets, first).tobytes()
                yield _rows([(-2, pack(np.asarray(ids.fill_null(0), np.int64)), pack(null), pack(names), pack(size), fold)])
                made = sketch_pieces(sets, first, rule)
                s = made["set"]
                held.append((made["key"], names[s], made["band"].astype(np.uint8), made["spare"].astype(np.uint32), size[s]))
                count += len(s)
                if count > block_keys:
                    yield _rows(list(_packed(held, bits)))
                    held, count = [], 0
        if held:
            yield _rows(list(_packed(held, bits)))

    chosen = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(tidy(gather), BLOCKS)


def _packed(held: list[tuple], bits: int) -> Iterator[tuple]:
    key, cls, band, spare, size = (np.concatenate(c) for c in zip(*held, strict=True))
    # 48 bits: a chance meeting costs one verification more
    key = key >> U64(16) << U64(16)
    order = np.lexsort((cls, key))
    key, cls, band, spare, size = (x[order] for x in (key, cls, band, spare, size))
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]) if len(key) else np.zeros(0, bool)
    key, cls, band, spare, size = (x[once] for x in (key, cls, band, spare, size))
    if len(key) == 0:
        return
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    place = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    over = place >= LOCAL_MEMBERS
    if over.any():
        yield (-1, pack(key[over] >> U64(16)), pack(cls[over]), pack(band[over].astype(np.uint8)), pack(spare[over].astype(np.uint32)), pack(size[over]))
        key, cls, band, spare, size = (x[~over] for x in (key, cls, band, spare, size))
    # one entry of a table per set and band
    entries, where = np.unique(np.stack([cls, band.astype(U64)], axis=1), axis=0, return_index=True)[:2]
    pair = _find(entries, cls, band)
    small = np.uint16 if len(entries) < 1 << 16 else np.uint32
    for shard, part in by_shard(key, bits):
        used, inside = np.unique(pair[part], return_inverse=True)
        at = where[used]
        yield (
            shard,
            pack_sorted(key[part] >> U64(16)),
            pack(inside.astype(small)),
            pack(cls[at]),
            pack((size[at] << 8 | band[at]).astype(np.uint64)),
            pack(spare[at].astype(np.uint32)),
        )


def _find(entries: np.ndarray, cls: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Row of each (class, band) in the sorted table of both."""
    names = np.sort(np.unique(entries[:, 0]))
    table = np.searchsorted(names, entries[:, 0]).astype(np.int64) << 8 | entries[:, 1].astype(np.int64)
    return np.searchsorted(table, np.searchsorted(names, cls).astype(np.int64) << 8 | band)


def _members(pdf: pd.DataFrame) -> pd.DataFrame:
    """Pieces that several sets of one shard share, with all their sets."""
    keys, cls, band, spare, size = [], [], [], [], []
    for a, b, c, d, e in zip(pdf["a"], pdf["b"], pdf["c"], pdf["d"], pdf["e"], strict=True):
        inside, both = unpack(b), unpack(d).astype(np.int64)
        keys.append(unpack_sorted(a))
        cls.append(unpack(c)[inside])
        size.append((both >> 8)[inside])
        band.append((both & 255).astype(np.uint8)[inside])
        spare.append(unpack(e)[inside])
    key, cls, band, spare, size = (np.concatenate(x) for x in (keys, cls, band, spare, size))
    order = np.lexsort((cls, key))
    key, cls, band, spare, size = (x[order] for x in (key, cls, band, spare, size))
    once = np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])])
    key, cls, band, spare, size = (x[once] for x in (key, cls, band, spare, size))
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    freq = np.diff(np.append(begin, len(key)))
    # a piece some task found hot: as many members as a task sends
    each = np.repeat(freq, freq)
    keep = each > 1
    freq = np.where(each >= LOCAL_MEMBERS, HOT, each)[keep]
    return _frame(key[keep], cls[keep], band[keep], spare[keep], size[keep], freq)


def _frame(key, cls, band, spare, size, freq) -> pd.DataFrame:  # noqa: ANN001
    return pd.DataFrame(
        {
            "key": key.astype(np.int64),
            "cls": cls.view(np.int64),
            "band": band.astype(np.int32),
            "spare": spare.astype(np.int32),
            "size": size.astype(np.int64),
            "freq": freq,
        }
    )


def _unpacked_members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for a, b, c, d, e in zip(pdf["a"], pdf["b"], pdf["c"], pdf["d"], pdf["e"], strict=True):
            key = unpack(a)
            yield _frame(key, unpack(b), unpack(c), unpack(d), unpack(e), np.full(len(key), HOT))


def _unpacked_documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for a, b, c, d, e in zip(pdf["a"], pdf["b"], pdf["c"], pdf["d"], pdf["e"], strict=True):
            ids, null = unpack(a), unpack(b).astype(bool)
            doc = pd.array(ids, "Int64")
            doc[null] = pd.NA
            fold = np.frombuffer(e, np.int64).reshape(len(ids), -1)
            yield pd.DataFrame({"doc_id": doc, "cls": unpack(c).view(np.int64), "size": unpack(d), "fold": list(fold)})


def _class_sets(df: DataFrame, documents: DataFrame, pairs: DataFrame, rows: int, rule: Similar) -> DataFrame:
    """``cls, items`` of all sets that met another one, from one document of each."""

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole):
                sets, first = shingle_sets(texts(part.column("text")), rule.words)
                items = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(sets.view(np.int64)))
                names = class_of(sets, first).view(np.int64)
                same = pa.array(names == np.asarray(part.column("cls")))
                yield pa.RecordBatch.from_arrays([pa.array(names), items], ["cls", "items"]).filter(same)

    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    needed = documents.filter("size > 0").join(wanted, "cls").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    needed = materialize(_sized(needed, 2 * rows), "needed")
    chosen = df.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("text"))
    # the same plan at every size
    joined = chosen.join(needed.hint("merge"), F.col("_id").eqNullSafe(F.col("doc_id"))).select("cls", "text")
    return joined.mapInArrow(tidy(shingled), "cls long, items array<long>").dropDuplicates(["cls"])


def _sized(df: DataFrame, rows: int) -> DataFrame:
    """In tasks of at least ``TASK_ROWS`` rows, when there are about so many rows."""
    return df.coalesce(max(1, -(-rows // TASK_ROWS)))


def _kept(df: DataFrame, label: str, rows: int) -> tuple[DataFrame, int]:
    """``df`` written once, and its number of rows; ``rows`` is about how many are expected."""
    made = materialize(_sized(df, rows), label)
    return made, made.count()


def _verified(pairs: DataFrame, sets: DataFrame, rule: Similar) -> DataFrame:
    """Those of the pairs ``a, b`` that are similar."""
    left = sets.select(F.col("cls").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    joined = pairs.join(right, "b").join(left, "a").withColumn("both", both)
    either = F.size("x") + F.size("y") - F.col("both")
    return joined.filter(F.col("both") * 100 >= either * rule.percent).select("a", "b")


def components(links: DataFrame, rows: int) -> DataFrame:
    """``cls, label``: the smallest class each linked class is connected to.

    Every class points at its smallest neighbour, pointers are followed to their
    ends, and links between different ends make a smaller graph of the same kind,
    until no link is left. Each step is written to the shared folder, in as many
    tasks as its rows need.
    """
    labels = None
    while rows:
        ways = links.select("a", "b").union(links.select("b", "a")).toDF("cls", "near")
        low = F.least("cls", F.min("near")).alias("label")
        point, nodes = _kept(ways.groupBy("cls").agg(low), "labels", 2 * rows)
        while True:
            ahead = point.select(F.col("cls").alias("label"), F.col("label").alias("far"))
            moved = point.join(ahead, "label").select("cls", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved"))
            moved, _ = _kept(moved, "labels", nodes)
            point = moved.drop("moved")
            if moved.filter("moved").isEmpty():
                break
        if labels is None:
            labels, total = point, nodes
        else:
            far = point.select(F.col("cls").alias("label"), F.col("label").alias("far"))
            labels = labels.join(far, "label", "left").select("cls", F.coalesce("far", "label").alias("label"))
            labels, total = _kept(labels, "labels", total)
        ends = [point.select(F.col("cls").alias(x), F.col("label").alias(f"{x}_end")) for x in ("a", "b")]
        moved = links.join(ends[0], "a").join(ends[1], "b").filter("a_end <> b_end")
        links, rows = _kept(moved.select(F.col("a_end").alias("a"), F.col("b_end").alias("b")).distinct(), "links", rows)
    return labels if labels is not None else links.sparkSession.createDataFrame([], "cls long, label long")


def jaccard_classes(df: DataFrame, rule: Similar = Similar()) -> DataFrame:
    """Documents of ``doc_id, text`` with the group they are linked into.

    Returns doc_id, n_shingles and component_id, the smallest doc_id reachable by
    links, one row per input row. Texts that are null or without words are linked
    with nothing and are their own component. Equal texts have equal sets; rows
    without a doc_id take part, and a component of such rows only has none.
    Repeated rows are kept, other columns left out, and an empty table gives an
    empty result.
    """
    return finished(df.sparkSession, "classes", lambda: _classes(df, rule))


def _classes(df: DataFrame, rule: Similar) -> DataFrame:
    size = df.select(F.sum(F.octet_length("text"))).first()[0] or 0
    # about one shingle in six bytes, and a piece per possible difference, some in two bands
    pieces = size / 6 * 2 * (100 - rule.percent) / (100 + rule.percent) * rule.spare * 1.6
    bits = shard_bits(pieces, 1_000_000)
    # what a step read goes as soon as the next one is written
    spark, place = df.sparkSession, scratch_path(df.sparkSession, "documents")

    def members() -> DataFrame:
        blocks = materialize(sketch_blocks(df, rule, bits), "sketches")
        blocks.filter("shard = -2").mapInPandas(tidy(_unpacked_documents), DOCUMENTS).write.parquet(place)
        shared = blocks.filter("shard >= 0").groupBy("shard").applyInPandas(tidy(_members), MEMBERS)
        hot = blocks.filter("shard = -1").mapInPandas(tidy(_unpacked_members), MEMBERS)
        return shared.unionByName(hot)

    def met_pieces() -> DataFrame:
        found = finished(spark, "members", members)
        rank = F.row_number().over(Window.partitionBy("cls", "band").orderBy(F.desc("freq"), "key"))
        ranked = found.withColumn("_rank", rank).filter("_rank > spare").select("key", "cls", "size")
        return _sized(ranked, found.count())

    kept = finished(spark, "kept", met_pieces)
    documents, n = spark.read.schema(DOCUMENTS).parquet(place), kept.count()

    fits = F.least("size", "size_b") * 100 >= F.greatest("size", "size_b") * rule.percent
    leads = kept.groupBy("key").agg(F.min(F.struct("cls", "size")).alias("lead"))
    star = kept.join(leads, "key").select(F.col("lead.cls").alias("a"), F.col("lead.size").alias("size_b"), F.col("cls").alias("b"), "size")
    met, n_met = _kept(star.filter(F.col("a") != F.col("b")).select("a", "b", fits.alias("fits")).distinct(), "pairs", n)
    pairs = met.filter("fits").select("a", "b")
    sets = finished(spark, "sets", lambda: _class_sets(df, documents, met, n_met, rule))
    links, linked = _linked(pairs, n_met, sets, rule)
    groups = components(links, linked)

    # pieces whose sets are still apart: first with one set per piece, another one for
    # each piece, then, in those that remain, across components
    folds = documents.select("cls", "fold").dropDuplicates(["cls"])
    for find in (_leading, _across):
        rest, n = _apart(kept, groups, folds, n)
        if not n:
            break
        more, asked = _kept(find(rest, rule).distinct().join(pairs, ["a", "b"], "left_anti"), "pairs", n)
        if asked:
            pairs = pairs.unionByName(more)
            found, extra = _linked(more, asked, sets, rule)
            if extra:
                links, linked = links.unionByName(found), linked + extra
                groups = components(links, linked)
    return _labelled(documents.drop("fold"), groups)


def _apart(kept: DataFrame, groups: DataFrame, folds: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The sets of pieces that are not all connected, with their component and folded sketch."""
    label = F.coalesce("label", "cls").alias("label")
    placed = kept.join(groups, "cls", "left").select("key", "cls", "size", label)
    apart = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
    return _kept(placed.join(apart.filter("lo <> hi AND n > 2").select("key"), "key").join(folds, "cls"), "apart", rows)


def _near(rule: Similar) -> Column:
    """Whether two sets side by side may be similar, by sizes and folded sketches."""
    fits = F.least("size", "size_b") * 100 >= F.greatest("size", "size_b") * rule.percent
    differ = F.aggregate(
        F.zip_with("fold", "fold_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )
    near = differ * (100 + rule.percent) <= (F.col("size") + F.col("size_b")) * (100 - rule.percent)
    return (F.col("label") != F.col("label_b")) & fits & near


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("cls", "cls_b").alias("a"), F.greatest("cls", "cls_b").alias("b"))


def _leading(rest: DataFrame, rule: Similar) -> DataFrame:
    """Every set with one set of its piece, which differs from piece to piece."""
    one = F.min_by(F.struct("cls", "size", "label", "fold"), F.xxhash64("key", "cls")).alias("lead")
    leads = rest.groupBy("key").agg(one).select("key", *(F.col(f"lead.{c}").alias(f"{c}_b") for c in ("cls", "size", "label", "fold")))
    return _pairs(rest.join(leads, "key").filter(_near(rule)))


def _across(rest: DataFrame, rule: Similar) -> DataFrame:
    """Sets of a piece that belong to different components."""
    other = rest.select("key", *(F.col(c).alias(f"{c}_b") for c in ("cls", "size", "label", "fold")))
    return _pairs(rest.join(other, "key").filter((F.col("cls") < F.col("cls_b")) & _near(rule)))


def _linked(pairs: DataFrame, rows: int, sets: DataFrame, rule: Similar) -> tuple[DataFrame, int]:
    """The pairs that are similar, and how many they are."""
    found = finished(pairs.sparkSession, "links", lambda: _sized(_verified(pairs, sets, rule), 8 * rows))
    return found, found.count()


def _labelled(documents: DataFrame, groups: DataFrame) -> DataFrame:
    full = F.col("size") > 0
    placed = documents.join(groups, "cls", "left").select("doc_id", "size", F.when(full, F.coalesce("label", "cls")).alias("label"))
    smallest = placed.filter("label IS NOT NULL").groupBy(F.col("label").alias("_of")).agg(F.min("doc_id").alias("lowest"))
    joined = placed.join(smallest, F.col("label") == F.col("_of"), "left")
    component = F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return joined.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
