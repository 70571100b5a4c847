"""Licences from texts and from the directories above."""

import math
import re

from sluice.llm.licences import TEMPLATES, scan

FOLDER = "/root/testdata/sf0.001"
APACHE = next(t for n, t in TEMPLATES if n == "Apache-2.0" and len(t) > 100)


def terms(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text)
    return [w.strip(".,;:!?\"'()") for w in re.findall(r"[^\x20\x09-\x0D]+", low)]


def plain(texts, least):
    """Best licence and cosine of each text, one unit after the other."""
    vocab = {w for _, t in TEMPLATES for w in terms(t)}
    n = len(texts)
    df = {w: sum(w in set(terms(t or "")) for t in texts) for w in vocab}
    weight = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in vocab else math.log(1 + n) + 1

    def vector(words):
        out = {}
        for w in words:
            out[w] = out.get(w, 0) + weight(w)
        return out, math.sqrt(sum(x * x for x in out.values()))

    shapes = [(name, *vector(terms(t))) for name, t in TEMPLATES]
    found = []
    for text in texts:
        best = (0.0, None)
        text = text or ""
        for unit in [*text.split("\n"), *re.split(r"\n[\x20\x09-\x0D]*\n", text), text]:
            v, norm = vector(terms(unit))
            for name, shape, size in shapes:
                c = sum(x * shape.get(w, 0) for w, x in v.items()) / (norm * size) if norm else 0
                if c > best[0] + 1e-9:
                    best = (c, name)
        found.append((best[1] if best[0] >= least else None, best[0]))
    return found


def test_against_plain_version(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("doc_id", "text", "cast(null as string) path")
    rows = sorted(df.collect())
    expected = plain([r["text"] for r in rows], 0.6)
    got = {r["doc_id"]: r for r in scan(df).collect()}
    for r, (licence, score) in zip(rows, expected):
        assert got[r["doc_id"]]["licence"] == licence
        if licence:
            assert abs(got[r["doc_id"]]["score"] - score) < 1e-5
    assert sum(x is not None for x, _ in expected) > 0


def test_nearest_directory_gives_its_licence(table):
    code = "def f ( x ) return x plus one"
    rows = [
        (1, "a/LICENSE", APACHE),
        (2, "a/b/c/x.py", code),
        (3, "a/b/LICENSE.txt", "Released under the MIT License."),
        (4, "a/b/y.py", code),
        (5, "a/z.py", code + "\n\nThis work is licensed under the GNU General Public License, version 3.\n" + code),
        (6, "ab/x.py", code),
        (7, None, code),
        (8, "a/b/c/n.py", None),
        (9, "a/q/x.py", ""),
        (10, "x.py", code * 3000),
        (None, "a/b/c/x.py", code),
        (11, "a/bb/x.py", code),
    ]
    df = table([(*r, "z") for r in rows], "doc_id long, path string, text string, licence string")
    got = {r["doc_id"]: (r["licence"], r["basis"], r["licence_path"]) for r in scan(df).collect()}
    mit, apache = ("MIT", "inherited", "a/b/LICENSE.txt"), ("Apache-2.0", "inherited", "a/LICENSE")
    nothing = (None, None, None)
    assert got == {
        1: ("Apache-2.0", "file", "a/LICENSE"),
        2: mit,
        3: ("MIT", "file", "a/b/LICENSE.txt"),
        4: mit,
        5: ("GPL-3.0", "header", None),
        6: nothing,
        7: nothing,
        8: mit,
        9: apache,
        10: nothing,
        None: mit,
        11: apache,
    }


def test_root_licence_and_repeats(table):
    rows = [(1, "LICENSE", "Released under the MIT License."), (2, "/abs/x", "some code here"), (3, "d/x", "some code"), (3, "d/x", "some code")]
    got = sorted((r["doc_id"], r["licence"]) for r in scan(table(rows, "doc_id long, path string, text string")).collect())
    assert got == [(1, "MIT"), (2, "MIT"), (3, "MIT"), (3, "MIT")]


def test_empty_table(table):
    assert scan(table([], "doc_id long, path string, text string")).collect() == []
