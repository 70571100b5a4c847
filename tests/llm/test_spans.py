"""Repeated sentence runs against a plain version."""

import re

from sluice.llm.spans import Run, remove_repeats

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_sentences(text):
    """(normal form, words, first character, end) of each sentence."""
    out, now = [], []
    found = list(WORD.finditer(text))
    for i, m in enumerate(found):
        now.append(m)
        gap = text[m.end() : found[i + 1].start()] if i + 1 < len(found) else "\n"
        if re.search(r"[.!?][\"')\]]{0,2}$", m.group()) or "\n" in gap or "\r" in gap:
            normal = tuple(re.sub("[A-Z]", lambda x: x.group().lower(), x.group()) for x in now)
            out.append((normal, len(now), now[0].start(), now[-1].end()))
            now = []
    return out


def plain(docs, run):
    seen, split = {}, {k: plain_sentences(t or "") for k, t in docs}
    spans = []
    for k, _ in docs:
        s, found = split[k], set()
        for i in range(len(s)):
            for j in range(i + run.sentences, len(s) + 1):
                if sum(x[1] for x in s[i:j]) >= run.words:
                    found.add((i, j))
                    break
            if s[i][1] >= run.alone:
                found.add((i, i + 1))
            for h in range(i + 1 - run.sentences, -1, -1):
                if sum(x[1] for x in s[h : i + 1]) >= run.words:
                    found.add((h, i + 1))
                    break
        for i, j in sorted(found):
            spans.append((tuple(x[0] for x in s[i:j]), k, i, j))
    for key, k, i, _ in spans:
        seen[key] = min(seen.get(key, (k, i)), (k, i))
    out = {}
    for k, t in docs:
        covered = set()
        for key, d, i, j in spans:
            if d == k and seen[key] != (k, i):
                covered |= set(range(i, j))
        s, text = split[k], t
        if t is not None and covered:
            stops = [x[2] for x in s[1:]] + [len(t)]
            text = t[: s[0][2]] + "".join(t[x[2] : e] for n, (x, e) in enumerate(zip(s, stops)) if n not in covered)
            text = "" if len(covered) == len(s) else text
        out[k] = (text, len(s), len(covered))
    return out


def result(df):
    return {r["doc_id"]: (r["text"], r["n_sentences"], r["n_removed"]) for r in df.collect()}


def test_against_plain_version(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    docs = sorted((r["doc_id"], r["text"]) for r in df.collect())
    run = Run()
    expected = plain(docs, run)
    got = result(remove_repeats(df, run))
    assert got == expected
    assert any(n for _, _, n in expected.values())


def test_small_blocks_give_the_same(spark):
    from sluice.llm import spans

    df = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").repartition(7)
    whole = {(r["doc_id"]) for r in spans.repeated_ranges(df).collect()}
    parts = {(r["doc_id"]) for r in spans.repeated_ranges(df, block_runs=50).collect()}
    assert whole == parts


def test_odd_rows(table):
    run = Run(sentences=2, words=4)
    rows = [
        (1, "One two. Three four. Tail.", "x"),
        (2, "Head here now.\nONE   two. three FOUR. Rest of it.", "x"),
        (3, None, None),
        (4, "", "y"),
        (5, "   \n ", "y"),
        (6, "one two. three four.", None),
        (None, "Ünder öl. Three four. one two. three four.", "z"),
        (7, "a " * 5000, "long"),
    ]
    df = table(rows, "doc_id long, text string, shard string")
    got = {r["doc_id"]: (r["text"], r["n_removed"], r["shard"]) for r in remove_repeats(df, run).collect()}
    assert got[1] == (rows[0][1], 0, "x")
    assert got[2] == ("Head here now.\nRest of it.", 2, "x")
    assert got[3] == (None, 0, None) and got[4] == ("", 0, "y") and got[5] == ("   \n ", 0, "y")
    assert got[6] == ("", 2, None)
    assert got[None] == ("Ünder öl. Three four. ", 2, "z")
    assert got[7][1] == 0


def test_a_long_sentence_is_a_run(table):
    long = " ".join(f"w{k}" for k in range(45)) + "."
    rows = [(1, f"Start here. {long} End."), (2, f"Other start. {long.upper()} Other end.")]
    got = {r["doc_id"]: r["text"] for r in remove_repeats(table(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "Other start. Other end."}


def test_empty_table(table):
    df = table([], "doc_id long, text string")
    assert remove_repeats(df).collect() == []


def test_equal_rows_share_their_fate(table):
    df = table([(1, "A b c. D e f.")] * 2 + [(0, "A b c. D e f.")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"]) for r in remove_repeats(df, Run(2, 4)).collect())
    assert got == [(0, "A b c. D e f."), (1, ""), (1, "")]


def test_rows_without_ids_are_documents_of_their_own(table):
    passage, other = "A b c. D e f.", "U v w. X y z. Unlike it."
    rows = [(1, passage), (None, passage), (None, other), (2, other), (2, "Not this. Nor that one.")]
    got = sorted((str(r["doc_id"]), r["text"]) for r in remove_repeats(table(rows, "doc_id long, text string"), Run(2, 4)).collect())
    assert got == [("1", passage), ("2", "Not this. Nor that one."), ("2", other), ("None", ""), ("None", "")]
    rows = [(1, passage), (None, passage), (None, other)]
    got = sorted((str(r["doc_id"]), r["text"]) for r in remove_repeats(table(rows, "doc_id long, text string"), Run(2, 4)).collect())
    assert got == [("1", passage), ("None", ""), ("None", other)]


def test_of_equal_rows_one_stays(table):
    passage = "A b c. D e f."
    for key in (7, None):
        df = table([(key, passage)] * 3, "doc_id long, text string").repartition(2)
        assert sorted(r["text"] for r in remove_repeats(df, Run(2, 4)).collect()) == ["", "", passage]
