"""How far sources of a language diverge, by exact term frequencies.

A first reading of the texts finds the kept terms of each language, those that
enough of its documents have. Sorted, they are cut into blocks, and each block
becomes a minimal acyclic transducer, so that a term's ordinal is its rank among
the kept terms of its language. A second reading counts: each task reduces the
words it has read to distinct words with counts per source and sends them, by
ranges of words, to the blocks, where they run through the transducer. A block
that many tasks send to is dealt to several tasks, each with the transducer, and
their counts are added up. From there on terms are ordinals, which also settle
ties, and only the terms of the result are turned back.

All arithmetic is on integers.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.transducer import Transducer, build
from sluice.llm.vectors import slices, texts
from sluice.session import materialize

#: fixed value: probabilities are whole parts of this many
UNIT = 1_000_000_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def letter_runs(column: pa.Array) -> pa.Table:
    r"""``doc`` and ``term`` of all matches of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``, with A-Z lower-cased."""
    t = texts(column)
    inside = np.zeros(len(t.data) + 2, bool)
    inside[1:-1] = _LETTER[t.data]
    edge = np.zeros(len(t.data) + 1, bool)
    edge[t.bounds] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    # the bytes of all terms, one after the other
    raw = t.lowered().data[inside[1:-1]]
    at = np.concatenate([[0], np.cumsum(end - start)])
    term = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw.tobytes())])
    doc = np.searchsorted(t.bounds, start, "right") - 1
    return pa.table({"doc": pa.array(doc.astype(np.int32)), "term": term})


def _added(tables: list[pa.Table], name: str, number: str) -> pa.Table:
    """The rows of all tables with equal text ``name`` and integer ``number`` as one, ``n`` added up."""
    whole = pa.concat_tables(tables)
    coded = whole.column(name).combine_chunks().dictionary_encode()
    other = whole.column(number).to_numpy()
    order = np.lexsort((coded.indices.to_numpy(), other))
    code, other = coded.indices.to_numpy()[order], other[order]
    first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (other[1:] != other[:-1])])) if len(order) else order
    n = np.add.reduceat(whole.column("n").to_numpy()[order], first) if len(order) else np.zeros(0, np.int64)
    made = pa.table({number: pa.array(other[first]), name: coded.dictionary.take(pa.array(code[first])), "n": pa.array(n)})
    return made.select(whole.column_names)


def _gathered(
    batches: Iterator[pa.RecordBatch], once: bool, names: list[str], most: int, bytes_most: int = 48 << 20
) -> Iterator[tuple[list[tuple], pa.Table]]:
    """Counts by group and term over as many texts as give ``most`` different ones.

    Groups are the distinct values of the named columns; yields their list and a
    table ``group, term, n``. With ``once`` a term counts once per text.
    """
    codes: dict[tuple, int] = {}
    held: list[pa.Table] = []
    rows = 0
    for whole in batches:
        for part in slices(whole):
            keys = zip(*(part.column(n).to_pylist() for n in names), strict=True)
            group = np.array([codes.setdefault(k, len(codes)) for k in keys], np.int64)
            held.append(_counted(letter_runs(part.column("text")), group, once))
            rows += held[-1].num_rows
            if rows > 2 * most or sum(h.nbytes for h in held) > bytes_most:
                held = [_added(held, "term", "group")]
                rows = held[0].num_rows
                if rows > most or 2 * held[0].nbytes > bytes_most:
                    yield list(codes), held[0]
                    held, rows = [], 0
    if held:
        yield list(codes), _added(held, "term", "group")


def _counted(found: pa.Table, group: np.ndarray, once: bool) -> pa.Table:
    """``group, term, n`` of the terms of some texts, whose groups are given."""
    coded = found.column("term").combine_chunks().dictionary_encode()
    doc, code = found.column("doc").to_numpy().astype(np.int64), coded.indices.to_numpy()
    if once:
        doc, code = np.divmod(np.unique(doc << 32 | code), 1 << 32)
    cell, n = np.unique(group[doc] << 32 | code, return_counts=True)
    group, code = np.divmod(cell, 1 << 32)
    return pa.table({"group": pa.array(group), "term": coded.dictionary.take(pa.array(code)), "n": pa.array(n)})


def document_frequencies(docs: DataFrame, most: int) -> DataFrame:
    """``lang, term, docs, parts``: documents that have the term, and tasks' blocks that found it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, table in _gathered(batches, True, ["lang"], most):
            names = pa.array([g[0] for g in groups], pa.string())
            out = pa.table([names.take(table.column("group")), table.column("term").cast(pa.binary()).cast(pa.string()), table.column("n")], ["lang", "term", "n"])
            yield from out.to_batches(max_chunksize=50_000)

    found = docs.select("lang", "text").mapInArrow(count, "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("docs"), F.count(F.lit(1)).alias("parts"))


BLOCK = "lang string, first string, terms long, parts long, machine array<binary>"


def vocabulary(kept: DataFrame, block_terms: int) -> DataFrame:
    """Blocks of the kept terms ``lang, term, parts``, each a transducer of about ``block_terms`` terms.

    ``lang, first, terms, parts, machine``, with ``block``, the block's number,
    ``base``, the ordinal of its first term, and ``vocabulary``, the terms of the
    language. Written once.
    """
    kept = materialize(kept.select("lang", "term", "parts"), "terms")
    blocks = max(1, -(-kept.count() // block_terms))

    def compile_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms, parts = None, [], 0

        def row() -> pa.RecordBatch:
            machine = build(terms).packed()
            arrays = [pa.array([lang]), pa.array([terms[0].decode()]), pa.array([len(terms)], pa.int64()), pa.array([parts], pa.int64())]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([machine], pa.list_(pa.binary()))], ["lang", "first", "terms", "parts", "machine"])

        for batch in batches:
            for of, term, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if terms and (of != lang or len(terms) >= 2 * block_terms):
                    yield row()
                    terms, parts = [], 0
                lang = of
                terms.append(term.encode())
                parts += n
        if terms:
            yield row()

    made = kept.repartitionByRange(blocks, "lang", "term").sortWithinPartitions("lang", "term").mapInArrow(compile_blocks, BLOCK)
    made = materialize(made, "transducers")
    # one row per block from here on
    order = Window.partitionBy("lang").orderBy("first")
    facts = made.select("lang", "first", "terms").withColumns(
        {
            "block": F.concat_ws("/", F.col("lang"), F.lpad(F.row_number().over(order).cast("string"), 9, "0")),
            "base": F.coalesce(F.sum("terms").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "vocabulary": F.sum("terms").over(Window.partitionBy("lang")),
        }
    )
    return materialize(made.join(facts.drop("terms"), ["lang", "first"]), "vocabulary")


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _table(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def source_words(docs: DataFrame, most: int) -> DataFrame:
    """Words of the texts as sorted tables ``term, source, n``: ``lang, seed, entries, words``, written once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for groups, table in _gathered(batches, False, ["lang", "source"], most):
            langs: dict[str, list[int]] = {}
            for code, (lang, _) in enumerate(groups):
                langs.setdefault(lang, []).append(code)
            names = pa.array([s for _, s in groups], pa.string())
            for lang, codes in langs.items():
                one = table.filter(pc.is_in(table.column("group"), pa.array(codes, pa.int64()))) if len(langs) > 1 else table
                if one.num_rows == 0:
                    continue
                one = one.take(pc.sort_indices(one, sort_keys=[("term", "ascending")])).combine_chunks()
                source = names.take(one.column("group").combine_chunks()).dictionary_encode()
                out = pa.table([one.column("term"), source, one.column("n")], ["term", "source", "n"])
                # the same for a task that runs again
                seed = TaskContext.get().partitionId() + 7919 * number
                arrays = [pa.array([lang]), pa.array([seed], pa.int64()), pa.array([one.num_rows], pa.int64()), pa.array([_ipc(out)], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["lang", "seed", "entries", "words"])
                number += 1

    return materialize(docs.select("lang", "source", "text").mapInArrow(count, "lang string, seed long, entries long, words binary"), "words")


def recount(words: DataFrame, blocks: DataFrame, task_entries: int, most: int) -> DataFrame:
    """Occurrences of kept terms: ``lang, source, block, ord, n``, written once, without zeros.

    A task gets one block and about ``task_entries`` entries of words for it.
    """
    entries = words.groupBy("lang").agg(F.sum("entries").alias("entries"))
    share = F.col("parts") + F.coalesce("entries", F.lit(0)) * F.col("terms") / F.col("vocabulary")
    sized = blocks.join(entries, "lang", "left").withColumn("copies", F.greatest(F.lit(1), F.ceil(share / task_entries)).cast("long"))
    # one row per block
    order = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    slots = sized.select("block", "lang", "first", "copies").withColumn("slot", F.coalesce(F.sum("copies").over(order), F.lit(0)))
    slots = materialize(slots, "slots")
    total = slots.agg(F.sum("copies")).first()[0] or 1
    cuts = slots.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("first", "slot", "copies"))).alias("cuts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                table = _table(batch.column("words")[k].as_py())
                terms, seed, cuts = table.column("term"), batch.column("seed")[k].as_py(), batch.column("cuts")[k].as_py()
                place = [bisect_left(range(len(terms)), c["first"].encode(), key=lambda i, t=terms: t[i].as_py()) for c in cuts]
                out = [(c["slot"] + seed % c["copies"], _ipc(table.slice(a, b - a))) for c, a, b in zip(cuts, place, [*place[1:], len(terms)], strict=True) if a < b]
                if out:
                    slot, blobs = zip(*out, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int64()), pa.array(blobs, pa.binary())], ["slot", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, lang, block, base = None, "", "", 0
        held: list[pa.Table] = []

        def rows() -> Iterator[pa.RecordBatch]:
            table = _added(held, "source", "ord")
            n = table.num_rows
            out = [pa.array([lang] * n), table.column("source"), pa.array([block] * n), table.column("ord"), table.column("n")]
            yield from pa.table(out, ["lang", "source", "block", "ord", "n"]).to_batches(max_chunksize=50_000)

        for batch in batches:
            for k in range(batch.num_rows):
                # one row at a time: a row holds many words
                (row,) = batch.slice(k, 1).to_pylist()
                if row["machine"] is not None:
                    if held:
                        yield from rows()
                        held = []
                    machine, lang, block, base = Transducer.unpacked(row["machine"], row["terms"]), row["lang"], row["block"], row["base"]
                    continue
                table = _table(row["words"])
                column = table.column("term").combine_chunks()
                at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
                raw = column.buffers()[2]
                found = machine.ordinals(np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8), at[:-1], at[1:])
                hit = np.flatnonzero(found >= 0)
                source = table.column("source").combine_chunks().cast(pa.string())
                held.append(pa.table({"source": source.take(pa.array(hit)), "ord": pa.array(found[hit] + base), "n": table.column("n").take(pa.array(hit))}))
                if sum(h.num_rows for h in held) > 4 * most:
                    held = [_added(held, "source", "ord")]
                    if held[0].num_rows > 2 * most:
                        yield from rows()
                        held = []
        if held:
            yield from rows()

    none = F.lit(None)
    sent = words.join(cuts, "lang").select("seed", "words", "cuts").mapInArrow(cut, "slot long, words binary")
    sent = sent.select("slot", none.cast("array<binary>").alias("machine"), none.cast("long").alias("terms"), none.cast("string").alias("lang"),
                       none.cast("string").alias("block"), none.cast("long").alias("base"), "words")
    each = slots.select("block", F.explode(F.sequence(F.col("slot"), F.col("slot") + F.col("copies") - 1)).alias("slot"))
    machines = blocks.join(each, "block").select("slot", "machine", "terms", "lang", "block", "base", none.cast("binary").alias("words"))
    dealt = machines.unionByName(sent).repartitionById(int(total), F.col("slot").cast("int")).sortWithinPartitions("slot", F.col("machine").isNull())
    counted = dealt.mapInArrow(run, "lang string, source string, block string, ord long, n long")
    return materialize(counted.groupBy("lang", "source", "block", "ord").agg(F.sum("n").alias("n")), "counts")


def _probability(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + 1) / total), three digits to the base of 1000: nothing overflows."""
    first = (n + 1) * 1000
    second = first % total * 1000
    third = second % total * 1000
    div = lambda a: F.call_function("div", a, total)
    return 1 + div(first) * 1_000_000 + div(second) * 1000 + div(third)


def _probabilities(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    first = (n + 1) * 1000
    second = first % total * 1000
    third = second % total * 1000
    return 1 + first // total * 1_000_000 + second // total * 1000 + third // total


def _pairs(counts: DataFrame, groups: DataFrame, cells: int = 1_000_000, widest: int = 8192) -> DataFrame:
    """``lang, source, item, value``: divergence of each source from each other of its language.

    Terms are dealt in chunks; a chunk's table of sources by terms has ``cells``
    cells at most, or one term, and what leaves it is one sum per pair.
    """
    width = F.greatest(F.lit(1), F.least(F.lit(widest), F.call_function("div", F.lit(cells), F.count(F.lit(1)))))
    langs = groups.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources"), F.first("vocabulary").alias("vocabulary"), width.alias("width")
    )
    last = F.greatest(F.lit(0), F.call_function("div", F.col("vocabulary") - 1, F.col("width")))
    chunks = langs.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    placed = counts.join(langs.select("lang", "width"), "lang").select("lang", F.expr("ord div width").alias("chunk"), "source", "ord", "n")

    def compare(rows: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
        lang, chunk, width, size = about["lang"].iloc[0], int(about["chunk"].iloc[0]), int(about["width"].iloc[0]), int(about["vocabulary"].iloc[0])
        sources = about["sources"].iloc[0]
        names = [s["source"] for s in sources]
        total = np.array([s["total"] for s in sources], np.int64)[:, None] + size
        terms = min(width, size - chunk * width)
        n = np.zeros((len(names), max(terms, 0)), np.int64)
        place = {s: k for k, s in enumerate(names)}
        n[rows["source"].map(place).to_numpy(np.int64), rows["ord"].to_numpy(np.int64) - chunk * width] = rows["n"].to_numpy(np.int64)
        p = _probabilities(n, total) if terms > 0 else n
        values = np.stack([((p - q) ** 2 // q).sum(axis=1) for q in p], axis=1)
        a, b = np.nonzero(~np.eye(len(names), dtype=bool))
        named = np.array(names, object)
        return pd.DataFrame({"lang": np.full(len(a), lang, object), "source": named[a], "item": named[b], "value": values[a, b]})

    # both sides have every chunk's key once at least on the right
    found = placed.groupBy("lang", "chunk").cogroup(chunks.groupBy("lang", "chunk")).applyInPandas(compare, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _decoded(wanted: DataFrame, blocks: DataFrame) -> DataFrame:
    """``block, ord, item``: the terms of the given ordinals."""

    def decode(rows: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"block": [], "ord": [], "item": []}, dtype=object)
        machine, base = Transducer.unpacked(list(block["machine"].iloc[0]), int(block["terms"].iloc[0])), int(block["base"].iloc[0])
        ords = rows["ord"].tolist()
        return pd.DataFrame({"block": [block["block"].iloc[0]] * len(ords), "ord": ords, "item": [machine.term(k - base).decode() for k in ords]})

    machines = blocks.select("block", "base", "terms", "machine")
    return wanted.distinct().groupBy("block").cogroup(machines.groupBy("block")).applyInPandas(decode, "block string, ord long, item string")


def divergence_audit(
    df: DataFrame, least_docs: int = 3, top: int = 200, block_terms: int = 100_000, task_entries: int = 3_000_000, held: int = 400_000
) -> DataFrame:
    """Divergence of the sources of each language, from ``text, lang, source``.

    Returns lang, source, part, item, value, rank. Part ``pair``: every other
    source of the language as item, with the sum of the terms' divergences over
    all kept terms. Part ``term``: the ``top`` terms more probable in the source
    than in the language. Probabilities are ``1 + floor(10^9 (n + 1) / (N + V))``,
    V kept terms of the language, N their occurrences in the source or language.
    Ranks count from 1 by value, descending, then item in the order of its bytes.

    A task holds about ``held`` different words at once, a block has about
    ``block_terms`` terms, and a task of the second reading gets about
    ``task_entries`` words of a block; the result depends on none of these.

    Nulls are empty texts, languages or sources, which are values like others. A
    language without kept terms has pairs of value 0, a language with one source
    has no pairs, repeated rows count each, other columns are left out and an
    empty table gives an empty result.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = df.select(text("lang"), text("source"), text("text"))
    kept = document_frequencies(docs, held).filter(F.col("docs") >= least_docs)
    blocks = vocabulary(kept, block_terms)
    counts = recount(source_words(docs, held), blocks, task_entries, held)

    sizes = blocks.groupBy("lang").agg(F.sum("terms").alias("vocabulary"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    groups = materialize(groups.fillna(0, ["total", "vocabulary"]), "groups")
    whole = groups.groupBy("lang").agg(F.sum("total").alias("all"))

    pairs = _pairs(counts, groups)
    by_source = Window.partitionBy("lang", "source")
    ranked = pairs.withColumn("rank", F.row_number().over(by_source.orderBy(F.desc("value"), "item")))

    together = counts.withColumn("n_all", F.sum("n").over(Window.partitionBy("lang", "ord")))
    known = together.join(groups.join(whole, "lang"), ["lang", "source"])
    p = _probability(F.col("n"), F.col("total") + F.col("vocabulary"))
    q = _probability(F.col("n_all"), F.col("all") + F.col("vocabulary"))
    valued = known.select("lang", "source", "block", "ord", p.alias("p"), q.alias("q")).filter("p > q")
    valued = valued.withColumn("value", F.expr("(p - q) * (p - q) div q"))
    best = valued.withColumn("rank", F.row_number().over(by_source.orderBy(F.desc("value"), "ord"))).filter(F.col("rank") <= top)
    best = materialize(best.select("lang", "source", "block", "ord", "value", "rank"), "top-terms")
    terms = best.join(_decoded(best.select("block", "ord"), blocks), ["block", "ord"])

    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    return ranked.withColumn("part", F.lit("pair")).select(columns).unionAll(terms.withColumn("part", F.lit("term")).select(columns))
