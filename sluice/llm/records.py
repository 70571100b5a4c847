"""Token sequences as length-delimited binary records, with an offset index.

A file is a row of frames: the length of the payload, a checksum of that length,
the payload, and a checksum of the payload. Checksums are CRC-32C, masked so that
checksums of data that holds checksums stay useful. A payload is a document's
identifier, the number of its token ids, and the ids in two bytes each, or in four
where the vocabulary needs them, filled up to whole words of four bytes. The index
names file, place and length of every record, so that any selection of records can
be read in any order.

Documents are dealt to files by ranges of their order, each file is one task that
sorts its documents by identifier, and a file is written under a name of its own
attempt that then replaces the final one: a task that runs again writes the same
bytes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import suppress
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.packing import encoder
from sluice.llm.vectors import ragged, slices, texts
from sluice.llm.warc import read_plan, store
from sluice.operators.ordering import order_keys, with_buckets

#: fixed values of the format: the reflected polynomial and the mask
POLYNOMIAL = 0x82F63B78
MASK = 0xA282EAD8

#: bytes of the pieces whose checksums are found side by side
_PIECE = 256
#: 32-bit words of a frame around the ids: length (2), its checksum, identifier (2), flags, number of ids, checksum
_AROUND, _BEFORE = 8, 7
#: flags
_KNOWN, _WIDE = 1, 2

INDEX = "doc_id long, file string, offset long, length long, n_tokens long, start long"


@cache
def _steps() -> np.ndarray:
    """What two bytes do to a checksum whose low half they were added to."""
    state = np.arange(1 << 16, dtype=np.uint32)
    for _ in range(16):
        state = (state >> np.uint32(1)) ^ np.where(state & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    return state


@cache
def _shift(level: int) -> np.ndarray:
    """Tables, one per byte of a checksum, of what ``_PIECE << level`` zero bytes do to it."""
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if level:
        basis = _shifted(_shifted(basis, level - 1), level - 1)
    else:
        for _ in range(_PIECE // 2):
            basis = _steps()[basis & np.uint32(0xFFFF)] ^ (basis >> np.uint32(16))
    tables = np.zeros((4, 256), np.uint32)
    for bit in range(32):
        part, place = divmod(bit, 8)
        tables[part, (np.arange(256) >> place) & 1 == 1] ^= basis[bit]
    return tables


def _shifted(state: np.ndarray, level: int) -> np.ndarray:
    a, b, c, d = _shift(level)
    low = np.uint32(255)
    return a[state & low] ^ b[state >> np.uint32(8) & low] ^ c[state >> np.uint32(16) & low] ^ d[state >> np.uint32(24)]


def checksums(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32C of byte ranges of ``data``, each of four bytes at least.

    Ranges are cut into pieces whose checksums are found side by side, then
    joined in pairs, in as many rounds as the longest range needs.
    """
    if len(start) == 0:
        return np.zeros(0, np.uint32)
    count = -(-length // _PIECE)
    bounds = np.concatenate([[0], np.cumsum(count)])
    cells = np.zeros(bounds[-1] * _PIECE, np.uint8)
    # zeros before a range change nothing
    begin = bounds[1:] * _PIECE - length
    cells[ragged(begin, length)] = data[ragged(start, length)]
    for k in range(4):
        cells[begin + k] ^= np.uint8(255)
    columns = np.ascontiguousarray(cells.view("<u2").reshape(-1, _PIECE // 2).T)
    state = np.zeros(bounds[-1], np.uint32)
    steps = _steps()
    for column in columns:
        state = steps[(state ^ column) & np.uint32(0xFFFF)] ^ (state >> np.uint32(16))
    level = 0
    while len(state) > len(start):
        # an odd number of pieces gets a piece of zeros in front
        pairs = (count + 1) // 2
        at = np.concatenate([[0], np.cumsum(pairs)])
        wide = np.zeros(2 * at[-1], np.uint32)
        wide[ragged(2 * at[1:] - count, count)] = state
        state = _shifted(wide[::2], level) ^ wide[1::2]
        count, level = pairs, level + 1
    return ~state


def masked(sums: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (sums >> np.uint32(15) | sums << np.uint32(17)) + np.uint32(MASK)


def frames(doc_id: np.ndarray, known: np.ndarray, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The frames of some documents as 32-bit words, and the words of each; ids have 16 or 32 bits."""
    per_word = 4 // ids.itemsize
    filled = -(-size // per_word)
    words = filled + _AROUND
    at = np.cumsum(words) - words
    out = np.zeros(int(words.sum()), "<u4")
    out.view("<u2" if per_word == 2 else "<u4")[ragged(per_word * (at + _BEFORE), size)] = ids
    payload = 4 * (filled + 4)
    length = payload.astype("<u8").view("<u4").reshape(-1, 2)
    name = doc_id.astype("<i8").view("<u4").reshape(-1, 2)
    out[at], out[at + 1] = length[:, 0], length[:, 1]
    out[at + 3], out[at + 4], out[at + 6] = name[:, 0], name[:, 1], size
    out[at + 5] = known * _KNOWN + (per_word == 1) * _WIDE
    raw = out.view(np.uint8)
    out[at + 2] = masked(checksums(raw, 4 * at, np.full(len(at), 8)))
    out[at + words - 1] = masked(checksums(raw, 4 * at + 12, payload))
    return out, words


def unframed(raw: np.ndarray, at: np.ndarray, length: np.ndarray, where: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Identifiers, whether they are known, ids and their counts of the frames at the given bytes.

    Raises where a length or a checksum does not agree.
    """
    if len(at) == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.uint32), np.zeros(0, np.int64)
    words = np.frombuffer(raw, "<u4")
    at = at // 4
    payload = words[at].astype(np.int64) | words[at + 1].astype(np.int64) << 32
    good = payload == length - 16
    good &= words[at + 2] == masked(checksums(raw, 4 * at, np.full(len(at), 8)))
    if good.all():
        good = words[at + length // 4 - 1] == masked(checksums(raw, 4 * at + 12, length - 16))
    if not good.all():
        raise ValueError(f"damaged record in {where}, byte {int(4 * at[~good][0])} of the range read")
    name = np.stack([words[at + 3], words[at + 4]], axis=1).reshape(-1).view("<i8")
    flags, size = words[at + 5], words[at + 6].astype(np.int64)
    if (flags & _WIDE).any():
        ids = words[ragged(at + _BEFORE, size)]
    else:
        ids = np.frombuffer(raw, "<u2")[ragged(2 * (at + _BEFORE), size)].astype(np.uint32)
    return name, flags & _KNOWN == _KNOWN, ids, size


def sequential(raw: np.ndarray, where: str = "file") -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of the frames of a whole file, found without the index."""
    at, found = 0, []
    while at < len(raw):
        if at + 16 > len(raw):
            raise ValueError(f"{where} ends inside a record")
        length = int(raw[at : at + 8].view("<u8")[0]) + 16
        if at + length > len(raw):
            raise ValueError(f"{where} ends inside a record")
        found.append((at, length))
        at += length
    places = np.array(found, np.int64).reshape(-1, 2)
    return places[:, 0], places[:, 1]


def _file(number: int) -> str:
    return f"tokens-{number:07d}.records"


def write_records(df: DataFrame, folder: str, tokenizer: str, end_id: int = 1, file_bytes: int = 64 << 20) -> DataFrame:
    """Write the tokens of ``doc_id, text`` as files below ``folder`` and return the index.

    Documents lie in ascending order of doc_id, over all files in the order of
    their names; ``start`` counts the ids of all documents before. A file holds
    about ``file_bytes`` of text. A null text is empty and gives the end id
    alone; documents without an id come last; rows that share an id are ordered
    by a hash of their text, and entirely equal rows are records each. Other
    columns are left out, and an empty table gives an empty index and no files.
    """
    spark = df.sparkSession
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = rows.select(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    count = max(1, -(-total // file_bytes))
    # a number of its own per row cuts a run of equal rows
    keyed = rows.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ranges = with_buckets(keyed, order_keys(keyed, ["doc_id", "h", "row"]), "range", count) if count > 1 else keyed.withColumn("range", F.lit(0))
    # one number per file_bytes of text
    numbers = np.array(sorted(r["range"] for r in ranges.select("range").distinct().collect()), np.int64)
    model = encoder(tokenizer)
    kind = "<u2" if model.tokenizer.get_vocab_size() <= 1 << 16 and end_id < 1 << 16 else "<u4"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer)
        for whole in batches:
            for part in slices(whole):
                ids, bounds = model.encode(part.column("text"))
                raw = np.insert(ids, bounds[1:], end_id).astype(kind).tobytes()
                at = (bounds + np.arange(len(bounds))) * np.dtype(kind).itemsize
                blobs = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(raw)])
                file = np.searchsorted(numbers, part.column("range").to_numpy()).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), pa.array(file), blobs], ["doc_id", "h", "file", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        system.create_dir(root, recursive=True)
        name, sink, part, offset, start = None, None, "", 0, 0

        def finish() -> None:
            sink.close()
            system.move(part, f"{root}/{name}")

        try:
            for batch in batches:
                seen = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("file"), batch.column("ids").view(pa.string())], ["doc_id", "file", "ids"]
                )
                for some in slices(seen, "ids"):
                    numbers = some.column("file").to_numpy()
                    cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        if _file(int(numbers[a])) != name:
                            if sink is not None:
                                finish()
                            name, offset, start = _file(int(numbers[a])), 0, 0
                            part = f"{root}/{name}.{uuid.uuid4().hex}"
                            sink = system.open_output_stream(part, compression=None)
                        one = some.slice(a, b - a)
                        t = texts(one.column("ids"))
                        size = np.diff(t.bounds) // np.dtype(kind).itemsize
                        ids = np.frombuffer(t.data, kind)
                        doc = one.column("doc_id")
                        known = np.asarray(doc.is_valid(), dtype=bool)
                        out, words = frames(doc.fill_null(0).to_numpy(zero_copy_only=False), known, ids, size)
                        sink.write(out.tobytes())
                        length = 4 * words
                        place = offset + np.cumsum(length) - length
                        arrays = [doc, pa.array([name] * len(size)), pa.array(place), pa.array(length), pa.array(size)]
                        yield pa.RecordBatch.from_arrays([*arrays, pa.array(start + np.cumsum(size) - size)], INDEX_NAMES)
                        offset, start = offset + int(length.sum()), start + int(size.sum())
            if sink is not None:
                finish()
                part = ""
        except BaseException:
            if part:
                with suppress(OSError):
                    system.delete_file(part)
            raise

    encoded = ranges.select("doc_id", "text", "h", "range").mapInArrow(encode, "doc_id long, h long, file int, ids binary")
    dealt = encoded.repartitionById(max(1, len(numbers)), F.col("file"))
    laid = dealt.sortWithinPartitions("file", F.col("doc_id").asc_nulls_last(), "h")
    laid.mapInArrow(write, INDEX).write.parquet(f"{folder}/index-by-file")
    by_file = spark.read.schema(INDEX).parquet(f"{folder}/index-by-file")
    # one row per file
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = by_file.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = sizes.select(F.col("file").alias("named"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    placed = by_file.join(before, F.col("file") == F.col("named")).withColumn("start", F.col("start") + F.col("before"))
    placed.select(INDEX_NAMES).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


INDEX_NAMES = [part.split()[0] for part in INDEX.split(", ")]
RECORDS = "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long"


def read_records(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 4 << 20, ids: bool = True) -> DataFrame:
    """The records of the given index rows, read from the files below ``folder``.

    Returns doc_id, start (as the index says), n_tokens, ids (unsigned, 32 bits,
    little-endian; null if not asked for) and ids_crc32. Rows are dealt by file
    and range of ``most`` bytes; in a task, records at most ``gap`` bytes apart
    are one read of up to ``most`` bytes or one record. Lengths and checksums
    must agree, and so must the index. Repeated index rows are read each.
    """
    cell = F.floor(F.col("offset") / (4 * most))
    laid = index.select("file", "offset", "length", "n_tokens", "start", "doc_id").repartition("file", cell)
    laid = laid.sortWithinPartitions("file", "offset")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        for batch in batches:
            names = np.array(batch.column("file").to_pylist(), object)
            offset, length = batch.column("offset").to_numpy(), batch.column("length").to_numpy()
            told = batch.column("n_tokens").to_numpy()
            cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                with system.open_input_file(f"{root}/{names[a]}") as source:
                    for lo, hi in read_plan(offset[a:b], length[a:b], gap, most):
                        lo, hi = lo + a, hi + a
                        span = source.read_at(int(offset[hi - 1] + length[hi - 1] - offset[lo]), int(offset[lo]))
                        raw = np.frombuffer(span, np.uint8)
                        name, known, found, size = unframed(raw, offset[lo:hi] - offset[lo], length[lo:hi], names[a])
                        doc = pa.array(name, mask=~known)
                        if (size != told[lo:hi]).any() or not doc.equals(batch.column("doc_id").slice(lo, hi - lo)):
                            raise ValueError(f"the index does not belong to {names[a]}")
                        at = 4 * np.concatenate([[0], np.cumsum(size)])
                        packed = memoryview(found.astype("<u4").tobytes())
                        sums = [crc32(packed[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                        blobs = pa.nulls(len(size), pa.binary())
                        if ids:
                            blobs = pa.array([bytes(packed[x:y]) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
                        arrays = [doc, batch.column("start").slice(lo, hi - lo), pa.array(size), blobs, pa.array(sums, pa.int64())]
                        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids", "ids_crc32"])

    return laid.mapInArrow(read, RECORDS)
