"""Token pieces, their packing and the search behind it."""

import itertools
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from sluice.llm.packing import all_fillings, best_fit, complete, lower_bound, pack_documents
from sluice.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def checked(packing, counts, capacity):
    got = {}
    for times, filling in packing:
        assert times > 0 and sum(n * k for n, k in filling) <= capacity
        for n, k in filling:
            got[n] = got.get(n, 0) + times * k
    assert got == {n: k for n, k in counts.items() if k}
    return sum(times for times, _ in packing)


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = [len(lengths)]

    def put(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(rooms)
            return
        for r in {x for x in rooms if x >= lengths[k]}:
            rest = list(rooms)
            rest[rest.index(r)] -= lengths[k]
            put(k + 1, rest)
        put(k + 1, [*rooms, capacity - lengths[k]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best[0]


def test_search_finds_the_least():
    rng = random.Random(3)
    for _ in range(60):
        lengths = [rng.randrange(3, 16) for _ in range(rng.randrange(1, 11))]
        counts = {n: lengths.count(n) for n in lengths}
        least = fewest(lengths, 20)
        assert lower_bound(counts, 20) <= least
        assert checked(complete(counts, 20), counts, 20) == least


def test_search_beats_best_fit():
    rng = random.Random(1)
    gained = 0
    for _ in range(6):
        lengths = [rng.randrange(800, 3000) for _ in range(400)]
        counts = {n: lengths.count(n) for n in lengths}
        fit, found = checked(best_fit(counts, 4096), counts, 4096), checked(complete(counts, 4096), counts, 4096)
        assert lower_bound(counts, 4096) <= found <= fit
        gained += fit - found
    assert gained > 0


def test_search_goes_on_through_all_fillings():
    # sequences that are full to the last place, of many lengths: sets of three, and the first 200, are not enough
    rng = random.Random(5)
    for _ in range(120):
        capacity, sequences, parts = rng.choice([100, 150, 200, 400]), rng.randrange(2, 6), rng.randrange(5, 9)
        lengths = []
        for _ in range(sequences):
            cuts = [0, *sorted(rng.sample(range(1, capacity), parts - 1)), capacity]
            lengths += [b - a for a, b in itertools.pairwise(cuts)]
        counts = {n: lengths.count(n) for n in lengths}
        assert checked(complete(counts, capacity), counts, capacity) == sequences


def test_search_without_limit_proves_the_least():
    rng = random.Random(9)
    for _ in range(40):
        lengths = [rng.randrange(5, 22) for _ in range(rng.randrange(1, 10))]
        counts = {n: lengths.count(n) for n in lengths}
        assert checked(complete(counts, 30, nodes=None), counts, 30) == fewest(lengths, 30)


def test_no_filling_is_left_out():
    rng = random.Random(2)
    for _ in range(60):
        pool = sorted(rng.randrange(1, 30) for _ in range(rng.randrange(0, 9)))
        counts, room = {n: pool.count(n) for n in pool}, rng.randrange(0, 60)
        lengths = sorted(counts)
        found = list(all_fillings(lengths, counts, room))
        assert len(found) == len(set(found)) and all(sum(f) <= room and all(f.count(n) <= counts[n] for n in f) for f in found)
        for k in range(len(pool) + 1):
            for some in set(itertools.combinations(sorted(pool, reverse=True), k)):
                # length for length, one of those found holds it
                assert sum(some) > room or any(len(f) >= k and all(a >= b for a, b in zip(f, some, strict=False)) for f in found)


def test_work_does_not_grow_with_the_counts():
    counts = {4096: 10**9, 3000: 10**10, 1000: 10**10, 96: 10**10, 7: 3}
    assert checked(complete(counts, 4096), counts, 4096) >= lower_bound(counts, 4096)


def test_memory_does_not_grow_with_the_depth_of_the_search():
    # without short lengths best fit misses the bound, and the search goes down a level for nearly every length
    rng = random.Random(4)
    counts = {n: rng.randrange(1, 9) for n in range(701, 4097, 3)}
    assert sum(t for t, _ in best_fit(counts, 4096)) > lower_bound(counts, 4096)
    tracemalloc.start()
    try:
        packing = complete(counts, 4096, nodes=1500)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert checked(packing, counts, 4096) >= lower_bound(counts, 4096)
    assert peak < 16 << 20


def test_choices_made_again_are_the_same(monkeypatch):
    rng = random.Random(7)
    for _ in range(20):
        lengths = [rng.randrange(60, 300) for _ in range(60)]
        counts = {n: lengths.count(n) for n in lengths}
        found = []
        for live in (1, 2, 16, 10**6):
            monkeypatch.setattr("sluice.llm.packing.LIVE", live)
            found.append(complete(counts, 400, nodes=300))
        assert all(packing == found[-1] for packing in found)


def verify(rows, docs, tokenizer, capacity):
    """Pieces hold the tokenizer's ids, and sequences are gapless."""
    expected = []
    for k, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for p, start in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[start : start + capacity], "<u4")
            expected.append((k, p, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(spark, tokenizer):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    rows = pack_documents(df, tokenizer_path()).collect()
    used = verify(rows, docs, tokenizer, 4096)
    total = sum(r["length"] for r in rows)
    assert used <= 1.02 * total / 4096 + 1


def test_odd_rows(table, tokenizer):
    words = ["It's ÉCOLE, 'S don't 1234 á ́b ﬁ İstanbul ΣΑΣ.", None, "", " \n\t", "<|endoftext|> a<|endoftext|>b", "日本語。a", "x" * 9000, "to be " * 40]
    docs = list(itertools.chain(enumerate(words), [(3, "same"), (3, "same")]))
    rows = pack_documents(table([(k, t, 1) for k, t in docs], "doc_id long, text string, length int"), tokenizer_path(), 64).collect()
    verify(rows, docs, tokenizer, 64)


def test_null_id_and_empty_table(table):
    rows = pack_documents(table([(None, "a b")], "doc_id long, text string"), tokenizer_path()).collect()
    assert [(r["doc_id"], r["length"], r["offset"]) for r in rows] == [(None, 3, 0)]
    assert pack_documents(table([], "doc_id long, text string"), tokenizer_path()).collect() == []
