"""Records of token ids: framing, files, index and what comes back."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from sluice.llm.queries import QUERIES, tokenizer_path
from sluice.llm.records import checksums, frames, masked, read_records, sequential, unframed, write_records
from sluice.session import scratch_path

FOLDER = "/root/testdata/sf0.001"


def bitwise(data):
    """CRC-32C, one bit after the other."""
    c = 0xFFFFFFFF
    for byte in data:
        c ^= byte
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def one(data):
    return int(checksums(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])


def test_checksums():
    # values that the definition of CRC-32C gives
    assert one(b"123456789") == 0xE3069283
    assert one(bytes(32)) == 0x8A9136AA
    rng = random.Random(3)
    data = rng.randbytes(6000)
    start = np.array([rng.randrange(0, 2000) for _ in range(60)])
    length = np.array([rng.choice([4, 5, 255, 256, 257, 511, 512, 513, 769, 4000]) for _ in range(60)])
    got = checksums(np.frombuffer(data, np.uint8), start, length)
    assert got.tolist() == [bitwise(data[a : a + n]) for a, n in zip(start, length, strict=True)]
    assert int(masked(np.array([0], np.uint32))[0]) == 0xA282EAD8


@pytest.mark.parametrize("kind", [np.uint16, np.uint32])
def test_frames_and_damage(kind):
    doc, known = np.array([5, 0, -7]), np.array([True, False, True])
    ids, size = np.arange(10, dtype=kind), np.array([3, 0, 7])
    words, count = frames(doc, known, ids, size)
    raw = np.frombuffer(words.tobytes(), np.uint8)
    at, length = sequential(raw)
    assert length.tolist() == (4 * count).tolist()
    name, there, back, n = unframed(raw, at, length, "f")
    assert (name.tolist(), there.tolist(), back.tolist(), n.tolist()) == ([5, 0, -7], [True, False, True], list(range(10)), [3, 0, 7])
    for place in range(0, len(raw), 3):
        broken = raw.copy()
        broken[place] ^= 16
        with pytest.raises(ValueError, match="damaged"):
            unframed(broken, at, length, "f")
    with pytest.raises(ValueError, match="ends inside"):
        sequential(raw[:-1])


def plain(rows, tokenizer):
    """All documents one after the other."""
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_query_against_plain(spark, tokenizer):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op11_length_delimited"](spark, FOLDER)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain(docs, tokenizer))


def test_many_files_odd_rows_and_shuffled_reads(spark, tokenizer):
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma.", "δέλτα", "épsilon", "<|endoftext|>", "zeta!?", "\x00"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for k in range(300)]
    rows += [(7, "the same row")] * 400 + [(k % 3 + 900, f"shared {k}") for k in range(60)]
    rows += [(None, f"nameless {k}") for k in range(50)] + [(None, None)] * 3 + [(-5, ""), (2000, None), (2**62, "far")]
    rows.append((2001, "long " * 60_000))
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, `row` int, h string").repartition(5)
    folder = scratch_path(spark, "records")
    index = write_records(df, folder, tokenizer_path(), file_bytes=4096)
    assert index.select("file").distinct().count() > 5
    back = [tuple(r) for r in read_records(index, folder, gap=64, most=4096).collect()]
    want = plain(rows, tokenizer)
    # rows that share an id may come in any order among themselves
    total = sum(n for _, _, n, _ in want)
    ordered = sorted(back, key=lambda r: r[1])
    assert [r[0] for r in ordered] == [r[0] for r in want]
    assert [r[1] for r in ordered] == np.concatenate([[0], np.cumsum([r[2] for r in ordered])[:-1]]).tolist()
    assert ordered[-1][1] + ordered[-1][2] == total
    assert sorted((str(d), n, c) for d, _, n, _, c in back) == sorted((str(d), n, c) for d, _, n, c in want)
    for _, _, n, ids, c in back[:50]:
        assert len(ids) == 4 * n and zlib.crc32(ids) == c
    # a selection in another order
    few = index.filter("doc_id % 7 = 3").orderBy("n_tokens")
    assert sorted(r["start"] for r in read_records(few, folder, ids=False).collect()) == sorted(r[1] for r in back if r[0] is not None and r[0] % 7 == 3)
    # every file can be read on its own
    from pyarrow import fs

    from sluice.llm.warc import store

    system, root = store(folder)
    seen = 0
    for file in system.get_file_info(fs.FileSelector(root)):
        if file.path.endswith(".records"):
            raw = np.frombuffer(system.open_input_file(file.path).read(), np.uint8)
            seen += len(unframed(raw, *sequential(raw), file.path)[0])
    assert seen == len(rows)


def test_a_hot_id_is_cut(spark):
    rows = [(1, f"text {k}") for k in range(2000)] + [(k, "other") for k in range(2, 2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    index = write_records(df, scratch_path(spark, "records"), tokenizer_path(), file_bytes=4096)
    sizes = [r["count"] for r in index.groupBy("file").count().collect()]
    assert max(sizes) < 6 * sum(sizes) / len(sizes)


def test_empty(spark):
    folder = scratch_path(spark, "records")
    index = write_records(spark.createDataFrame([], "doc_id long, text string"), folder, tokenizer_path())
    assert index.count() == 0 and read_records(index, folder).count() == 0


def test_wrong_index(spark):
    folder = scratch_path(spark, "records")
    index = write_records(spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string"), folder, tokenizer_path())
    wrong = index.selectExpr("doc_id + 1 AS doc_id", "file", "offset", "length", "n_tokens", "start")
    with pytest.raises(Exception, match="does not belong"):
        read_records(wrong, folder).collect()
