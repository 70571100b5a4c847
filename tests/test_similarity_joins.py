"""Similarity joins against all pairs."""

import math
import random
import re
from collections import Counter

import pytest
from conftest import values
from pyspark.sql import functions as F

from sluice.operators.similar import cosine_pairs, dedupe_fuzzy, edit_pairs, suggest_replacements


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(before + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def changed(rng, text, n, letters="abc é"):
    out = list(text)
    for _ in range(n):
        at, what = rng.randrange(len(out) + 1), rng.random()
        if what < 0.35:
            out.insert(at, rng.choice(letters))
        elif out and what < 0.7:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = rng.choice(letters)
    return "".join(out)


@pytest.mark.parametrize("bound", [0.3, 0.6, 0.75, 0.9, 1.0])
def test_edit_pairs_are_all_pairs(table, bound):
    rng = random.Random(int(bound * 100))
    words = {"", "a", "b", "ab"}
    for _ in range(25):
        base = "".join(rng.choices("abc é", k=rng.randrange(1, 30)))
        words |= {base, *(changed(rng, base, rng.randrange(1, 6)) for _ in range(3))}
    words = sorted(words)
    got = values(edit_pairs(table([(w,) for w in words], "text string"), bound))
    want = []
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            n = edits(a, b)
            if 1 - n / max(len(a), len(b)) >= bound - 1e-9:
                want.append((min(a, b, key=lambda t: t.encode()), max(a, b, key=lambda t: t.encode()), n))
    assert got == sorted(want, key=repr)


def test_long_texts(table):
    rng = random.Random(7)
    base = "".join(rng.choices("abcdefghij ", k=10_000))
    texts = [base, changed(rng, base, 30), changed(rng, base, 90), "".join(rng.choices("abcdefghij ", k=10_000)), base[:9_950]]
    got = edit_pairs(table([(t,) for t in texts], "text string"), 0.99).collect()
    found = {frozenset((texts.index(r["text"]), texts.index(r["other"]))) for r in got}
    assert found >= {frozenset((0, 1)), frozenset((0, 2)), frozenset((0, 4)), frozenset((1, 4))} and not any(3 in f for f in found)


def vector(text, total, spread):
    counted = Counter(w for w in re.sub(r"[\W_]+", " ", text.lower()).split())
    weights = {w: n * math.log1p(total / spread[w]) for w, n in counted.items()}
    norm = math.sqrt(sum(x * x for x in weights.values()))
    return {w: x / norm for w, x in weights.items()}


@pytest.mark.parametrize("bound", [0.2, 0.5, 0.8, 1.0])
def test_cosine_pairs_are_all_pairs(table, bound):
    rng = random.Random(int(bound * 10))
    pool = ["the", "of", *[f"w{k}" for k in range(25)]]
    texts = sorted({" ".join(rng.choices(pool, weights=[30, 20, *[2] * 25], k=rng.randrange(0, 8))) for _ in range(90)} | {"The OF", "the, of", ""})
    spread = Counter(w for t in texts for w in set(re.sub(r"[\W_]+", " ", t.lower()).split()))
    vectors = [vector(t, len(texts), spread) for t in texts]
    want = set()
    for i, a in enumerate(vectors):
        for j in range(i + 1, len(vectors)):
            if round(sum(x * vectors[j].get(w, 0) for w, x in a.items()), 9) >= bound and a:
                want.add(frozenset((texts[i], texts[j])))
    got = cosine_pairs(table([(t,) for t in texts], "text string"), bound).collect()
    assert {frozenset((r["text"], r["other"])) for r in got} == want and len(got) == len(want)


def test_a_word_that_half_of_the_texts_have_brings_no_candidates(spark):
    # all names share a word; two of each pair share the rest
    names = spark.range(4000).select(F.concat(F.when(F.col("id") % 2 == 0, F.lit("company ")).otherwise(F.lit("")), F.lit("n"), (F.col("id") / 2).cast("int")).alias("text"))
    got = cosine_pairs(names, 0.8)
    assert got.count() == 2000
    met = [n for n in got._jdf.queryExecution().toString().split("\n") if "NestedLoop" in n or "Cartesian" in n]
    assert not met


def test_candidates_are_verified_where_they_meet(spark, monkeypatch):
    # many texts share their rarest word; none of the pairs it brings is grouped before it is known to be similar
    names = spark.range(600).select(F.concat(F.lit("lot "), (F.col("id") % 3).cast("string"), F.lit(" kind "), F.chr(F.col("id") % 20 + 97), F.lit(" name "), F.col("id").cast("string")).alias("text"))
    want = {(r["text"], r["other"]): r["similarity"] for r in cosine_pairs(names, 0.3).collect()}
    monkeypatch.setattr("sluice.operators.similar.MET_TEXTS", 5)
    got = cosine_pairs(names, 0.3)
    assert want and {(r["text"], r["other"]): r["similarity"] for r in got.collect()} == want
    text = got._jdf.queryExecution().optimizedPlan().toString()
    (join,) = [line for line in text.split("\n") if "Join" in line]
    assert "lambda" in join and text.index("Aggregate [text") < text.index("Join")


def test_suggestions_and_duplicates(table):
    rows = [("Acme Trading Corporation", 3), ("Acme Tradng Corporatoin", 1), ("Beta Works", 2), ("Bta Wrks", 1), ("Gamma", 1)]
    df = table([(n,) for n, k in rows for _ in range(k)], "v string")
    assert values(suggest_replacements(df, "v", "spelling", min_similarity=0.8)) == [
        ("Acme Tradng Corporatoin", "Acme Trading Corporation", 1), ("Bta Wrks", "Beta Works", 1)
    ]
    with pytest.raises(ValueError, match="no similarity"):
        suggest_replacements(df, "v", "phonetic", min_similarity=0.5)
    people = table([(1, "Jonathan Q Smithson", 5), (2, "Jonathon Q Smithsen", 6), (3, "Jo", 1), (4, None, 0)], "_text int, name string, _group int")
    kept = dedupe_fuzzy(people, ["name"], ["_text"], max_edits=None, min_similarity=0.85)
    assert values(kept, "_text", "_group") == [(1, 5), (3, 1), (4, 0)]
    for wrong in (0, 1.5):
        with pytest.raises(ValueError, match="min_similarity"):
            edit_pairs(table([("a",)], "text string"), wrong)
