"""Edit matching against plain dynamic programming."""

import random

from sluice.llm.leaks import drop_leaks, find_leaks


def least(pattern, text):
    """Fewest edits between a pattern and any part of a text, in bytes."""
    p, t = pattern, text
    row = list(range(len(p) + 1))
    best = row[-1]
    for c in t:
        new = [0]
        for i, x in enumerate(p, 1):
            new.append(min(row[i - 1] + (x != c), row[i] + 1, new[i - 1] + 1))
        row = new
        best = min(best, row[-1])
    return best


def normal(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return " ".join(low.split()).encode()


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        k = rng.randrange(len(out))
        rng.choice([lambda: out.insert(k, "q"), lambda: out.pop(k), lambda: out.__setitem__(k, "z")])()
    return "".join(out)


def fixture():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(rng.randrange(4, 60))) for k in range(12)]
    docs = []
    for k in range(60):
        parts = [prose(rng.randrange(0, 30))]
        if k % 3:
            text = edited(rng, rng.choice(items)[1], rng.randrange(0, 14))
            parts += [text.upper() if k % 2 else text.replace(" ", " \n", 2), prose(5)]
        docs.append((k, " ".join(parts)))
    return items, docs


def test_against_dynamic_programming(table):
    items, docs = fixture()
    got = find_leaks(table(docs, "doc_id long, text string"), table(items, "item_id long, text string"), rate=0.1).collect()
    expected = {}
    for d, text in docs:
        for i, item in items:
            n = least(normal(item), normal(text))
            if n <= len(normal(item)) // 10:
                expected[d, i] = n
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in got} == expected
    assert len(set(expected.values())) > 3
    texts = dict(docs)
    for r in got:  # the reported place holds the match
        place = texts[r["doc_id"]].encode()[r["begin"] : r["end"]].decode("utf-8", "replace")
        assert least(normal(place), normal(dict(items)[r["item_id"]])) <= r["distance"] + abs(len(normal(place)) - len(normal(dict(items)[r["item_id"]])))


def test_blocks_of_items_give_the_same(table):
    items, docs = fixture()
    d, i = table(docs, "doc_id long, text string"), table(items, "item_id long, text string")
    assert sorted(map(tuple, find_leaks(d, i).collect())) == sorted(map(tuple, find_leaks(d, i, block_bytes=50).collect()))


def test_dropping_keeps_columns_and_clean_rows(table):
    items = [(1, "the quick brown fox jumps over the lazy dog again and again"), (2, None), (3, "  "), (None, "xy")]
    rows = [
        (1, "So: The quick  brown fox jumps over the lazy dog again\nand again!", "a"),
        (2, "nothing here", None),
        (3, None, "b"),
        (4, "", "c"),
        (None, "a null id", "d"),
        (5, "word " * 30000 + "the quick brown fox jumped over the lazy dog again and again", "e"),
        (2, "nothing here", None),
    ]
    docs = table(rows, "doc_id long, text string, item_id string")
    kept = drop_leaks(docs, table(items, "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in kept.collect()) == [("2", None), ("2", None), ("3", "b"), ("4", "c"), ("None", "d")]


def test_empty_tables(table):
    none = table([], "doc_id long, text string")
    items = table([(1, "something to find")], "item_id long, text string")
    assert find_leaks(none, items).collect() == []
    assert find_leaks(table([(1, "x")], "doc_id long, text string"), items.limit(0)).collect() == []
