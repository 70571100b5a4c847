"""Transducers, and the divergence of sources against plain integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from sluice.llm.audit import divergence_audit, letter_runs
from sluice.llm.transducer import Transducer, build

COLUMNS = "lang source part item value rank".split()


def look_up(machine, words):
    data = np.frombuffer(b"".join(words), np.uint8)
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return machine.ordinals(data, at[:-1], at[1:]).tolist()


def test_transducer_of_random_terms():
    rng = random.Random(2)
    for alphabet, size in ((b"ab", 60), (b"abcdefgh", 900), (bytes(range(256)), 900)):
        terms = sorted({bytes(rng.choices(alphabet, k=rng.randrange(1, 9))) for _ in range(size)})
        machine = build(terms)
        machine = Transducer.unpacked(machine.packed(), machine.terms)
        assert look_up(machine, terms) == list(range(len(terms)))
        assert [machine.term(k) for k in range(len(terms))] == terms
        others = [bytes(rng.choices(alphabet, k=rng.randrange(0, 10))) for _ in range(500)]
        want = {t: k for k, t in enumerate(terms)}
        assert look_up(machine, others) == [want.get(o, -1) for o in others]


def test_transducer_is_minimal():
    terms = sorted(a + b for a in (b"un", b"re", b"over") for b in (b"do", b"doing", b"done", b"load", b"loaded"))
    machine = build(terms)
    # states are told apart by what can follow
    follow = {}
    for prefix in {t[:k] for t in terms for k in range(len(t) + 1)}:
        follow.setdefault(frozenset(t[len(prefix) :] for t in terms if t.startswith(prefix)), prefix)
    states = set((machine.arcs >> 8).tolist()) | set(machine.target.tolist())
    assert len(states) == len(follow)


def test_odd_terms():
    assert look_up(build([]), [b"", b"a"]) == [-1, -1]
    assert look_up(build([b""]), [b"", b"a"]) == [0, -1]
    long = b"x" * 30_000
    machine = build([long, long + b"y"])
    assert look_up(machine, [long + b"y", long, long[:-1]]) == [1, 0, -1] and machine.term(1) == long + b"y"
    with pytest.raises(ValueError, match="order"):
        build([b"b", b"a"])
    with pytest.raises(ValueError, match="order"):
        build([b"a", b"a"])


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)


def test_letter_runs():
    import pyarrow as pa

    given = ["Ab-c9É", None, "", "ÀÀ x", "z", "Z`a{b"]
    found = letter_runs(pa.array(given)).to_pydict()
    want = [(k, w.encode()) for k, t in enumerate(given) for w in words(t)]
    assert list(zip(found["doc"], found["term"], strict=True)) == want


def plain(rows, least=3, top=200):
    """The audit as the definition says, one cell after the other."""
    docs = [(la or "", so or "", words(te)) for te, la, so in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        kept = sorted((t for t, n in Counter(t for _, _, ws in own for t in set(ws)).items() if n >= least), key=lambda t: t.encode())
        sources = sorted({s for _, s, _ in own}, key=lambda s: s.encode())
        count = {s: Counter(t for _, x, ws in own if x == s for t in ws) for s in sources}
        whole = Counter(t for _, _, ws in own for t in ws)

        def p(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        chances, q = {s: p(count[s]) for s in sources}, p(whole)
        for s in sources:
            pairs = [(r, sum((chances[s][t] - chances[r][t]) ** 2 // chances[r][t] for t in kept)) for r in sources if r != s]
            terms = [(t, (chances[s][t] - q[t]) ** 2 // q[t]) for t in kept if count[s][t] and chances[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items, 1) if part == "pair" or k <= top]
    return sorted(out)


def collected(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


def odd_rows():
    rng = random.Random(4)
    vocabulary = ["the", "The", "of", "straße", "été", "x", "naïve", "zoo", "日本", "a b", *[f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)]]
    rows = []
    for k in range(240):
        lang, source = rng.choice(["en", "en", "en", None, "", "fr"]), rng.choice(["s1", "s1", "s2", "S3", None])
        pool = vocabulary if lang != "fr" else vocabulary[:12]
        rows.append((" ".join(rng.choices(pool, k=rng.randrange(0, 30))) + rng.choice(["", "7", "-x", "\n"]), lang, source))
    rows += [("same row again", "en", "s2")] * 5 + [(None, "en", "only null"), ("", None, None), ("12 34", "digits", "d1"), ("rare", "digits", "d2")]
    rows += [("lone " * 3, "one", "single")] * 4 + [("k" * 50_000 + " tail", "en", "s1")] * 3
    return rows


@pytest.mark.parametrize(("block_terms", "held"), [(7, 20), (100_000, 400_000)])
def test_against_plain(spark, block_terms, held):
    rows = odd_rows()
    given = [(*r, 1, "x", 2) for r in rows]
    df = spark.createDataFrame(given, "text string, lang string, source string, n long, term string, ord int").repartition(4)
    got = collected(divergence_audit(df, top=9, block_terms=block_terms, task_entries=50, held=held))
    assert got == plain(rows, top=9)


def test_hot_source_and_equal_values(spark):
    rows = [("common words here", "en", "hot")] * 300 + [(f"alpha beta{'ab'[k % 2]} gamma", "en", f"s{k % 4}") for k in range(40)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    assert collected(divergence_audit(df)) == plain(rows)


def test_large_counts_do_not_overflow():
    from sluice.llm.audit import UNIT, _probabilities

    rng = random.Random(6)
    total = [rng.randrange(1, 9 * 10**15) for _ in range(500)]
    n = [rng.choice([0, t - 1, rng.randrange(t)]) for t in total]
    got = _probabilities(np.array(n), np.array(total)).tolist()
    assert got == [1 + UNIT * (a + 1) // t for a, t in zip(n, total, strict=True)]


def test_empty(spark):
    assert collected(divergence_audit(spark.createDataFrame([], "text string, lang string, source string"))) == []
