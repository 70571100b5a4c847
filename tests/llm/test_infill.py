"""The rank index, and documents turned and turned back."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm.infill import Marks, RankIndex, fill_in_middle, fit, restored


def test_index_is_exact_and_bounded():
    rng = random.Random(1)
    shapes = [
        [0],
        [0, 5],
        list(range(0, 5000, 10)),
        sorted(rng.sample(range(200_000), 3000)),
        np.cumsum([rng.choice([1, 1, 1, 2, 80, 3000]) for _ in range(4000)]).tolist(),
        [0, *range(10**9, 10**9 + 500)],
        np.cumsum(np.concatenate([np.full(700, 1), np.full(700, 500), np.full(700, 3)])).tolist(),
    ]
    for places in shapes:
        for error in (0, 3, 127, 1000):
            index = fit(np.array(places), error)
            every = np.arange(len(places))
            assert index.places(every).tolist() == places
            assert np.abs(np.array(places) - index.predicted(every)).max() <= error
            assert index.rank[0] == 0 and (np.diff(index.rank) > 0).all()


def test_segments_are_as_long_as_the_bound_allows():
    rng = random.Random(2)
    places = np.cumsum([rng.randrange(1, 40) for _ in range(600)])
    index = fit(places, 20)
    ends = [*index.rank[1:].tolist(), len(places)]
    for first, stop in zip(index.rank.tolist(), ends, strict=True):
        if stop == len(places):
            continue
        # no slope in whole parts of a byte reaches one place more
        steps = np.arange(1, stop - first + 1)
        rise = (places[first + 1 : stop + 1] - places[first]) * 2**20
        low, high = max(-(-(rise - 20 * 2**20) // steps)), min((rise + 20 * 2**20) // steps)
        assert max(low, 0) > high
    assert len(fit(np.arange(0, 10**6, 7)).rank) == 1


def plain(doc, text, seed=7, plain_below=100, spm_below=50):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= plain_below:
        return doc, n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_below:
        return doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_rows():
    rng = random.Random(3)
    pieces = ["a", "é", "日本", "\U0001f600", "\n", "\n\n", " ", "word", "\r", "<", "S>", "<P", ">", " ", "\x00"]
    rows = [(k, "".join(rng.choices(pieces, k=rng.randrange(0, 40)))) for k in range(400)]
    rows += [(500, "has <M> inside\nmore\n"), (501, ""), (502, None), (None, "no id\nat all\n"), (None, "no id\nat all\n"), (503, "\n" * 5000)]
    rows += [(504, "one line"), (505, "x" * 3_000_000), (506, "\n".join("y" * (k % 900) for k in range(20_000))), (7, "a\nb"), (7, "a\nb"), (-3, "u\nv\nw")]
    return rows


def same(left, right):
    return sorted(left, key=repr) == sorted(right, key=repr)


@pytest.mark.parametrize(("plain_below", "spm_below"), [(100, 50), (60, 0), (100, 100)])
def test_against_plain(spark, plain_below, spm_below):
    rows = odd_rows()
    given = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], "doc_id long, text string, n int, form string, h1 string").repartition(3)
    made = fill_in_middle(given, plain_below=plain_below, spm_below=spm_below)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = [tuple(r) for r in made.collect()]
    assert same(got, [plain(*r, plain_below=plain_below, spm_below=spm_below) for r in rows])
    back = made.select("doc_id", restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert same([tuple(r) for r in back], [(d, t or "") for d, t in rows])


def test_index_column_finds_every_line(spark):
    rows = [(k, t) for k, t in odd_rows() if k is not None and k >= 500]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in fill_in_middle(df, index=True).collect():
        text = (dict(rows)[r["doc_id"]] or "").encode()
        parts = [np.array([s[k] for s in r["segments"]], np.int64) for k in range(3)]
        index = RankIndex(*parts, np.frombuffer(r["residuals"], np.int8))
        want = np.cumsum([0, *(len(u) for u in re.findall(rb"[^\n]*\n|[^\n]+", text))]).tolist()
        assert index.places(np.arange(r["n"] + 1)).tolist() == want


def test_marks():
    with pytest.raises(ValueError, match="holds another"):
        Marks("<P>", "<P>", "<M>")
    with pytest.raises(ValueError, match="begins"):
        Marks("ab", "bc", "d")


def test_other_marks(spark):
    marks = Marks("[pre.]", "[suf.]", "[mid.]")
    rows = [(k, f"l{k}\nm\nn [pre?] [prex]\n" * 3) for k in range(20)] + [(30, "x [suf.]\n")]
    made = fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string"), marks=marks)
    back = made.select("doc_id", "form", restored(F.col("output"), F.col("form"), marks).alias("t")).collect()
    assert {r["doc_id"]: r["t"] for r in back} == dict(rows)
    assert [r["doc_id"] for r in back if r["form"] == "plain"] == [30]


def test_empty(spark):
    assert fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
