"""Near copies against all pairs."""

import pathlib
import random
import re

import pyarrow as pa
import pytest

from sluice.llm import jaccard
from sluice.llm.jaccard import Similar, jaccard_classes, shingle_sets, sketch_pieces
from sluice.llm.vectors import texts
from sluice.session import scratch_root

FOLDER = "/root/testdata/sf0.001"


def plain_set(text, n):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(zip(*[w[k:] for k in range(n)])) if len(w) >= n else frozenset([tuple(w)])


def plain(docs, rule):
    """(set size, smallest reachable doc_id) of each document, by comparing all pairs."""
    sets = [(k, plain_set(t, rule.words)) for k, t in docs]
    group = list(range(len(docs)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= rule.percent * len(a | b):
                x, y = root(i), root(j)
                group[max(x, y)] = min(x, y)
    lowest = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            lowest[root(i)] = min(lowest.get(root(i), k), k)
    return sorted((str(k), len(s), lowest.get(root(i))) for i, (k, s) in enumerate(sets))


def result(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in df.collect())


def family(seed=2, words=60):
    """Documents at all distances around the bound, chains, and a passage that most share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    passage = [word() for _ in range(40)]
    docs = []
    for _ in range(12):
        base = [word() for _ in range(rng.randrange(3, words))]
        if rng.random() < 0.7:
            base = passage + base
        for _ in range(rng.randrange(1, 9)):
            docs.append((len(docs), " ".join(base)))
            base = list(base)
            for _ in range(rng.randrange(0, 3)):
                base[rng.randrange(len(base))] = word()
    for k in range(30):
        docs.append((len(docs), " ".join(passage + [word() for _ in range(k)])))
    return docs


@pytest.mark.parametrize("rule", [Similar(3, 90), Similar(5, 80), Similar(2, 60)])
def test_against_all_pairs(table, rule):
    docs = family()
    expected = plain(docs, rule)
    assert result(jaccard_classes(table(docs, "doc_id long, text string"), rule)) == expected
    assert len({c for _, _, c in expected}) < len(docs)


def test_hot_pieces_skip_the_shard(table, monkeypatch):
    monkeypatch.setattr(jaccard, "LOCAL_MEMBERS", 2)
    docs = family(3, 20)
    rule = Similar(3, 80)
    df = table(docs, "doc_id long, text string").coalesce(1)
    assert result(jaccard_classes(df, rule)) == plain(docs, rule)


def test_documents(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = sorted((r["doc_id"], r["text"]) for r in df.collect())
    rule = Similar()
    assert result(jaccard_classes(df, rule)) == plain(docs, rule)


def test_similar_sets_share_more_pieces_than_they_leave_out():
    """The guarantee the candidates rest on, for pairs at the bound."""
    rng = random.Random(7)
    for percent in (60, 80, 90):
        rule = Similar(1, percent)
        for _ in range(60):
            n = rng.randrange(1, 300)
            a = [f"w{rng.random()}" for _ in range(n)]
            b = a[: max(1, -(-n * percent // 100))] if rng.random() < 0.5 else a + ["x%d" % k for k in range(n * (100 - percent) // percent)]
            sets, first = shingle_sets(texts(pa.array([" ".join(a), " ".join(b)])), 1)
            x, y = set(a), set(b)
            assert 100 * len(x & y) >= percent * len(x | y)
            made = sketch_pieces(sets, first, rule)
            mine = {0: {}, 1: {}}
            for s, key, spare in zip(made["set"], made["key"], made["spare"]):
                mine[int(s)][int(key)] = int(spare)
            common = set(mine[0]) & set(mine[1])
            assert len(common) > max(min(mine[0][k] for k in common), min(mine[1][k] for k in common))


def test_odd_rows(table):
    rows = [(5, "a b c"), (3, "A  b\tC"), (3, "A  b\tC"), (1, None), (2, ""), (0, " \n"), (7, "x"), (6, "X"), (8, "x x"), (None, "a b c"), (9, "w " * 20000)]
    df = table([(*r, 1, 2) for r in rows], "doc_id long, text string, cls int, size int")
    got = result(jaccard_classes(df, Similar(3, 90)))
    assert got == sorted(
        [("5", 1, 3), ("3", 1, 3), ("3", 1, 3), ("1", 0, 1), ("2", 0, 2), ("0", 0, 0), ("7", 1, 6), ("6", 1, 6), ("8", 1, 8), ("None", 1, 3), ("9", 1, 9)]
    )


def test_rows_without_an_id(table):
    got = jaccard_classes(table([(None, "only here"), (None, "")], "doc_id long, text string")).collect()
    assert sorted((r["n_shingles"], r["component_id"]) for r in got) == [(0, None), (1, None)]


def test_empty_table(table):
    assert jaccard_classes(table([], "doc_id long, text string")).collect() == []


def test_what_a_step_read_goes_before_the_next(spark, table, monkeypatch):
    """Sketches and members, with their shuffles, are gone when the sets are made; so is what made the sets at their verification."""
    root = pathlib.Path(scratch_root(spark).removeprefix("file://"))
    earlier, seen = set(root.iterdir()), {}

    def spied(name):
        real = getattr(jaccard, name)

        def spy(*args):
            seen[name] = {re.sub(r"-[0-9a-f]{32}$", "", p.name) for p in set(root.iterdir()) - earlier}
            return real(*args)

        monkeypatch.setattr(jaccard, name, spy)

    spied("_class_sets")
    spied("_verified")
    docs = family()
    assert jaccard_classes(table(docs, "doc_id long, text string")).count() == len(docs)
    assert seen["_class_sets"] == {"documents", "kept", "pairs"}
    assert seen["_verified"] == {"documents", "kept", "pairs", "sets"}
