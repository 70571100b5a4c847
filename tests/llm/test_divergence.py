"""Counting rules and distances against plain versions."""

import math
import re
from collections import Counter

import duckdb

from sluice.llm.divergence import CLASS_OF, CLASSES, Limits, judge, language_references

FOLDER = "/root/testdata/sf0.001"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def bare(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return [w.strip(".,;:!?\"'()") for w in re.findall(r"[^\x20\x09-\x0D]+", low)]


def classes(text):
    out = [0] * 12
    for b in text.encode():
        out[CLASS_OF[b]] += 1
    return out[:CLASSES]


def distance(p, q):
    p, q = [x / max(sum(p), 1) for x in p], [x / max(sum(q), 1) for x in q]
    part = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    return math.sqrt(max(0, (part(p, q) + part(q, p)) / 2))


def test_against_plain_version(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = {r["doc_id"]: (r["text"], r["lang"]) for r in df.collect()}
    got = {r["doc_id"]: r for r in judge(df.repartition(3)).collect()}
    base = {k: plain(t) for k, (t, _) in docs.items()}
    limits = Limits()
    passed = [k for k, b in base.items() if b[0] >= 20 and 100 * b[4] <= 30 * b[0]]
    for lang in {v for _, v in docs.values()}:
        mine = [k for k in passed if docs[k][1] == lang]
        words = Counter(w for k in mine for w in bare(docs[k][0]))
        chars = [sum(c) for c in zip(*(classes(docs[k][0]) for k in mine))]
        ranked = words.most_common()
        cut = ranked[limits.common_words - 1][1]
        tied = sum(1 for _, n in ranked if n == cut) > 1 and ranked[limits.common_words][1] == cut
        common = [w for w, _ in ranked[: limits.common_words]]
        reference = [words[w] for w in common] + [sum(words.values()) - sum(words[w] for w in common)]
        for k, (text, of) in docs.items():
            if of != lang:
                continue
            r = got[k]
            assert tuple(r[n] for n in NAMES) == base[k]
            assert r["base_failed"] == (k not in passed)
            if base[k][0] < limits.judged_words:
                assert r["word_distance"] is None and r["kept"] == (k in passed)
                continue
            own = Counter(bare(text))
            mine_words = [own[w] for w in common] + [sum(own.values()) - sum(own[w] for w in common)]
            assert abs(r["class_distance"] - distance(classes(text), chars)) < 1e-9
            # words that tie for the last place may differ
            assert abs(r["word_distance"] - distance(mine_words, reference)) < (0.05 if tied else 1e-9)


def test_verdicts_agree_with_labels(spark):
    got = judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    labels = duckdb.sql("SELECT * FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    good = both[(both.quality == 1) & ~both.base_failed]
    assert good.kept.mean() > 0.99
    assert both[both.quality == 0].kept.mean() < 0.1


def test_odd_rows(table):
    line = "a b c d e f g h"
    rows = [
        (1, None, "en"),
        (2, "", "en"),
        (3, "\n \n\t", None),
        (4, "\n".join([line, line, "x", "x ", line]), "en"),
        (None, "é# " * 25, None),
        (5, "word " * 60000, "zz"),
        (5, "word " * 60000, "zz"),
        (6, " ".join(f"w{k}" for k in range(40)), "qq"),
    ]
    df = table([(*r, False) for r in rows], "doc_id long, text string, lang string, kept boolean")
    got = {r["doc_id"]: r for r in judge(df, references={}).collect()}
    for k, text, _ in rows:
        assert tuple(got[k][n] for n in NAMES) == plain(text or "")
    assert got[1]["base_failed"] and got[4]["n_dup_lines"] == 2 and got[4]["n_repeat_words"] == 24
    assert got[6]["kept"] and got[6]["class_distance"] is None


def test_empty_table(table):
    none = table([], "doc_id long, text string, lang string")
    assert language_references(none) == {} and judge(none).collect() == []


def test_thousands_of_languages(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 40), x -> concat('w', x * (id + 1))), ' ') AS text", "concat('l', id) AS lang").repartition(4)
    assert len(language_references(df)) == 4000
