import itertools
import random

import pandas as pd
import pytest
from conftest import values

from sluice import Condition
from sluice.operators import quality, similar
from sluice.operators.ai import ai_transform
from sluice.operators.aggregate import Aggregation
from sluice.operators.quality import Check, Widget


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words(seed, n=60):
    rng = random.Random(seed)
    return sorted({"".join(rng.choices("abc", k=rng.randint(1, 6))) for _ in range(n)})


@pytest.mark.parametrize("edits", [1, 2])
def test_near_pairs_are_all_pairs_within_the_distance(table, edits):
    texts = words(1)
    df = table([(t,) for t in texts], "text string")
    expected = sorted(
        (a, b, distance(a, b))
        for a, b in itertools.combinations(texts, 2)
        if distance(a, b) <= edits
    )
    assert sorted(tuple(r) for r in similar.near_pairs(df, edits).collect()) == expected


def components(texts, near):
    label = {t: t for t in texts}
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return label


def test_connected_texts(table):
    rng = random.Random(2)
    texts = [f"t{i:03}" for i in range(120)]
    near = [tuple(rng.sample(texts, 2)) for _ in range(90)]
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(60)]
    df = table(near + chain, "a string, b string")
    got = {r["_text"]: r["_label"] for r in similar.smallest_connected(df).collect()}
    names = {x for pair in near + chain for x in pair}
    want = components(names, near + chain)
    assert {t: got.get(t, t) for t in names} == want


def test_fuzzy_duplicates(table):
    texts = words(3, 40)
    data = [(i, t.upper() if i % 2 else f" {t}!") for i, t in enumerate(texts * 3)]
    df = table([*data, (900, None), (901, "?!"), (902, None)], "id int, name string")
    kept = similar.dedupe_fuzzy(df, ["name"], ["id"], 1, 0.6)
    near = [
        (a, b)
        for a, b in itertools.combinations(texts, 2)
        if distance(a, b) <= 1 and 1 - distance(a, b) / max(len(a), len(b)) >= 0.6
    ]
    label = components(texts, near)
    first = {}
    for i, _ in data:
        first.setdefault(label[texts[i % len(texts)]], i)
    assert sorted(r.id for r in kept.collect()) == [*sorted(first.values()), 900, 901, 902]


def test_suggestions(table):
    counts = {"Acme Inc.": 5, "ACME": 2, "acme, corp": 1, "Apex": 3, "Zenith": 1}
    df = table([(n,) for n, c in counts.items() for _ in range(c)] + [(None,)], "firm string")
    got = values(similar.suggest_replacements(df, "firm", "patterns"))
    assert got == [("ACME", "Acme Inc.", 2), ("acme, corp", "Acme Inc.", 1)]
    typos = table([("Boston",)] * 3 + [("Bostn",), ("Bosten",), ("Austin",)], "city string")
    assert values(similar.suggest_replacements(typos, "city", "spelling")) == [
        ("Bosten", "Boston", 1),
        ("Bostn", "Boston", 1),
    ]
    sounds = table([("Robert",)] * 2 + [("Rupert",), ("Ann",)], "n string")
    assert values(similar.suggest_replacements(sounds, "n", "phonetic")) == [("Rupert", "Robert", 1)]
    with pytest.raises(ValueError):
        similar.suggest_replacements(df, "firm", "magic")


def test_profile(table):
    df = table([(1.0, "a"), (3.0, "a"), (None, "b")], "n double, s string")
    for exact in (True, False):
        rows = {r["column"]: r for r in quality.profile(df, exact=exact).collect()}
        assert (rows["n"]["nulls"], rows["n"]["null_pct"], rows["n"]["mean"]) == (1, 33.33, 2.0)
        assert rows["s"]["distinct_values"] == 2
        assert rows["s"]["top_values"] == "a (2), b (1)"


def test_checks(table):
    df = table([(1, "a", 5.0), (2, "b", None), (2, "", -1.0)], "id int, s string, n double")
    checks = [
        Check("id once", "unique", "id"),
        Check("s filled", "not_null", "s"),
        Check("n positive", "range", "n", low=0),
        Check("s known", "in_set", "s", values=["a", "b"]),
        Check("s word", "regex", "s", pattern="^[a-z]+$"),
        Check("known id", "reference", "id", reference=table([(1,)], "id int")),
        Check("rule", "condition", condition=Condition("id", "LT", 3)),
        Check("size", "row_count", low=4),
    ]
    flagged = {r["failed_checks"] for r in quality.flag_rows(df, checks).collect()}
    assert flagged == {
        "id once, known id",
        "id once, s filled, n positive, s known, s word, known id",
    }
    summary = {r["check"]: r["failed"] for r in quality.check_summary(df, checks).collect()}
    assert summary == {
        "id once": 2,
        "s filled": 1,
        "n positive": 1,
        "s known": 1,
        "s word": 1,
        "known id": 2,
        "rule": 0,
        "size": 1,
    }
    with pytest.raises(ValueError):
        Check("x", "vibes")


def test_row_level_security(table):
    df = table([(1, "e"), (2, "w"), (3, None)], "id int, region string")
    rules = table(
        [("ann", "e", False), ("bob", None, True), ("ann", "e", False)],
        "viewer string, value string, all_access boolean",
    )
    seen = {v: quality.row_level_security(df, "region", v, rules).count() for v in ("ann", "bob", "eve")}
    assert seen == {"ann": 1, "bob": 3, "eve": 0}


def test_join_key_quality(table):
    left = table([(1,), (1,), (2,), (None,)], "k int")
    right = table([(1,), (3,), (None,), (None,)], "k int")
    got = quality.join_key_quality(left, right, "k", "k").first().asDict()
    assert got == {
        "left_rows": 4,
        "right_rows": 4,
        "left_nulls": 1,
        "right_nulls": 2,
        "left_keys": 2,
        "right_keys": 2,
        "matched_keys": 1,
        "left_most_per_key": 2,
        "right_most_per_key": 1,
        "inner_join_rows": 2,
    }


def test_widgets_share_filters(table):
    df = table([("a", 1.0), ("a", 2.0), ("b", 9.0)], "k string, v double")
    total = Widget(["k"], [Aggregation("v", "SUM", "t")])
    first = Widget(["k"], [Aggregation("v", "MAX", "t")], order_by=[["t", "DESC"]], limit=1)
    data = quality.widget_data(df, {"all": total, "top": first}, [Condition("v", "GT", 1)])
    assert values(data["all"]) == [("a", 2.0), ("b", 9.0)]
    assert values(data["top"]) == [("b", 9.0)]
    with pytest.raises(ValueError):
        quality.widget_data(df, {str(i): total for i in range(101)})


def test_ai_asks_once_per_distinct_input(table, tmp_path):
    log = str(tmp_path / "asked")

    def model(prompt: str, context: pd.DataFrame):
        with open(log, "a") as f:
            f.writelines(f"{x}\n" for x in context["s"])
        return [f"{prompt}:{s}:{n}" for s, n in zip(context["s"], context["n"], strict=True)]

    rows = [("a", 1)] * 20 + [("b", 2)] * 5 + [(None, None)]
    df = table(rows, "s string, n int")
    out = ai_transform(df, "p", ["s", "n"], model, "answer")
    assert set(values(out)) == {("a", 1, "p:a:1"), ("b", 2, "p:b:2"), (None, None, None)}
    assert out.count() == 26
    with open(log) as f:
        assert set(f.read().split()) == {"a", "b"}
    with pytest.raises(ValueError, match="more than 5 rows"):
        ai_transform(df, "p", ["s"], model, "x", row_limit=5)
    with pytest.raises(ValueError, match="exists"):
        ai_transform(df, "p", ["s"], model, "n")


def test_checks_need_names_of_their_own(table):
    from sluice.operators.quality import Check, check_summary, flag_rows

    df = table([(1,), (None,)], "a int")
    twice = [Check("same", "not_null", "a"), Check("same", "unique", "a")]
    for run in (check_summary, flag_rows):
        with pytest.raises(ValueError, match="more than once"):
            run(df, twice)


def test_exact_profile_reads_twice_and_shows_samples(table):
    from sluice.operators.quality import profile

    df = table([(k, f"t{k % 7}", None if k % 2 else 1.5) for k in range(40)], "a int, b string, c double")
    made = profile(df, exact=True, samples=3)
    got = {r["column"]: r for r in made.collect()}
    assert {k: r["distinct_values"] for k, r in got.items()} == {"a": 40, "b": 7, "c": 1}
    assert got["b"]["sample_values"] == sorted(got["b"]["sample_values"]) and len(got["b"]["sample_values"]) == 3
    assert got["c"]["sample_values"] == ["1.5"] and got["c"]["top_values"] == "1.5 (20)"
    again = {r["column"]: r["sample_values"] for r in profile(df.repartition(7), exact=True, samples=3).collect()}
    assert again == {k: r["sample_values"] for k, r in got.items()}


def test_frequent_values_state_a_bound(spark):
    """Two frequent values among ten thousand that occur once or twice."""
    df = spark.range(40_000).selectExpr(
        "CASE WHEN id % 4 = 0 THEN 'often' WHEN id % 10 = 1 THEN 'less' ELSE concat('v', id div 2) END AS t", "id % 3 AS k", "CAST(NULL AS STRING) AS none"
    )
    got = {r["column"]: r for r in quality.frequent_values(df, ["t", "k", "none"], 3).collect()}
    exact = {r["column"]: r["top_values"] for r in quality.top_values(df, ["t", "k"], 3).collect()}
    assert got["k"]["top_values"] == exact["k"] and got["none"]["top_values"] is None
    listed = got["t"]["top_values"].split(", ")
    assert listed[:2] == exact["t"].split(", ")[:2]
    # nothing that is left out occurs more often than the bound says
    assert 2 <= got["t"]["top_bound"] < 4000
    row = {r["column"]: r for r in quality.profile(df, ["t"]).collect()}["t"]
    assert abs(row["distinct_values"] / df.select("t").distinct().count() - 1) < 5 * row["distinct_error"]
