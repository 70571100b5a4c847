"""The Kneser-Ney model against plain dictionaries, and its verdicts against labels."""

import math
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm.divergence import class_histogram
from sluice.llm.perplexity import Bound, Contexts, Trust, count_bigrams, discounts, fit, judge, word_hashes
from sluice.llm.vectors import texts

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def surface_ok(text):
    share = lambda kind: sum(c in kind for c in text) / max(len(text), 1)
    upper, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    ok = share("#*$%&|<>") <= 0.01 and share(";:!?") <= 0.02 and share(upper) <= 0.15 and share(digits) <= 0.10
    return len(words(text)) >= 20 and ok


def chen_goodman(n):
    """Discounts for counts of one, two, and three or more."""
    if not (n[1] and n[2] and n[3]):
        return [0, 0.5, 0.75, 0.9]
    y = n[1] / (n[1] + 2 * n[2])
    raw = [k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3)]
    return [0, *(min(max(r, 0.05), k - 0.05) for k, r in enumerate(raw, 1))]


class Plain:
    """A model of some texts, from dictionaries; only the given contexts have statistics."""

    def __init__(self, given, is_context):
        self.pairs = Counter()
        for text in given:
            self.pairs.update(zip([None, *words(text)], words(text), strict=False))
        self.of, self.followers, self.kinds = Counter(), {}, Counter()
        for (v, w), c in self.pairs.items():
            self.kinds[w] += 1
            if is_context(v):
                self.of[v] += c
                self.followers.setdefault(v, Counter())[min(c, 3)] += 1
        self.d = chen_goodman(Counter(c for (v, _), c in self.pairs.items() if is_context(v)))
        self.e = chen_goodman(Counter(self.kinds.values()))
        self.total = sum(self.kinds.values())
        self.left = sum(self.e[min(c, 3)] for c in self.kinds.values()) / self.total if self.total else 1
        self.gamma = {v: sum(self.d[n] * k for n, k in f.items()) / self.of[v] for v, f in self.followers.items()}

    def bits(self, v, w):
        lower = self.left / (len(self.kinds) + 1)
        if self.kinds[w]:
            lower += max(self.kinds[w] - self.e[min(self.kinds[w], 3)], 0) / self.total
        if not self.of[v]:
            return -math.log2(lower)
        c = self.pairs.get((v, w), 0)
        return -math.log2(max(c - self.d[min(c, 3)], 0) / self.of[v] + self.gamma[v] * lower)


def plain_judge(rows, fold, folds, is_context):
    """``rows`` of doc_id, text, lang; ``fold`` of each text."""
    trusted = {t for _, t, _ in rows if t is not None and surface_ok(t)}
    models = []
    for m in range(folds):
        others = [t for t in trusted if fold[t] != m]
        models.append(Plain(others or trusted, is_context))
    bits, scored = {}, {}
    for _, t, lang in rows:
        ws = words(t)
        if t not in bits and ws:
            bits[t] = sum(models[fold[t]].bits(v, w) for v, w in zip([None, *ws], ws, strict=False)) / len(ws)
        if t in trusted:
            scored.setdefault(lang, {})[t] = bits[t]
    out = []
    for k, t, lang in rows:
        n, level = len(words(t)), sorted(scored.get(lang, {}).values())
        bound = None
        if level:
            low, high = (level[math.ceil(q * len(level)) - 1] for q in (0.5, 0.99))
            bound = high + (high - low) + 8 / math.sqrt(max(n, 1))
        out.append((k, lang, n, t in trusted, bits.get(t), bound, bound is None or n < 20 or bits[t] <= bound))
    return out


def compare(df, contexts, frequent, is_context):
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang").collect()]
    fold = {r["text"]: r["f"] for r in df.select("text", F.expr("pmod(xxhash64(text), 4) AS f")).collect()}
    want = sorted(plain_judge(rows, fold, 4, is_context), key=lambda r: (repr(r[:4]), r[4] or 0))
    got = sorted((tuple(r) for r in judge(df, contexts=contexts, frequent=frequent).collect()), key=lambda r: (repr(r[:4]), r[4] or 0))
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for g, w in zip(got, want, strict=True):
        assert (g[4] is None) == (w[4] is None) and (g[4] is None or abs(g[4] - w[4]) < 2e-3), (g, w)
        assert (g[5] is None) == (w[5] is None) and (g[5] is None or abs(g[5] - w[5]) < 6e-3), (g, w)
        assert g[6] == w[6] or abs(w[4] - w[5]) < 0.01, (g, w)
    return got


@pytest.mark.parametrize("frequent", [0, 40, 1 << 16])
def test_judge_against_dictionaries(spark, frequent):
    """What the query runs: folds, copies, null texts and languages, quantiles and the bound."""
    rng = random.Random(frequent)
    pool = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(260):
        text = " ".join(rng.choices(pool, weights=[60 - j for j in range(60)], k=rng.randrange(0, 60)))
        rows.append((k, text, rng.choice(["en", "en", "de", None])))
    rows += [(1000 + k, rows[k % 7][1], "en") for k in range(90)] + [(None, rows[3][1], "de"), (5, None, "en"), (5, "", None)]
    rows += [(2000, " ".join(f"Odd#{k}" for k in range(40)), "en"), (2001, " ".join(f"new{k}" for k in range(300)), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    compare(df, 1 << 17, frequent, lambda v: True)


@pytest.mark.parametrize("contexts", [1, 9])
def test_rare_contexts_have_their_statistics(spark, contexts):
    """How many contexts are on the spot changes nothing."""
    rng = random.Random(contexts)
    pool = [f"w{k}" for k in range(50)]
    texts = [" ".join(rng.choices(pool, weights=[50 - j for j in range(50)], k=rng.randrange(0, 50))) for _ in range(160)]
    rows = [(k, t, rng.choice(["en", "de"])) for k, t in enumerate(texts)] + [(300, texts[1], None), (301, None, "en"), (302, " ".join(f"new{k}" for k in range(60)), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    compare(df, contexts, 20, lambda v: True)


def test_judge_of_documents_against_dictionaries(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    kept = Counter(r[6] for r in compare(docs, 1 << 17, 1 << 16, lambda v: True))
    assert kept[True] and kept[False]


def test_without_contexts_it_is_the_lower_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    compare(docs, 0, 1 << 16, lambda v: v is None)


def test_one_fold_only(spark):
    # a single trusted text cannot be held out
    good = "one two three four five six seven eight nine ten " * 3
    compare(spark.createDataFrame([(1, good, "en"), (2, good + "x", "fr"), (3, good, None)], "doc_id long, text string, lang string").filter("doc_id <> 2"), 1 << 17, 9, lambda v: True)


def test_probabilities_add_up(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    none = Contexts(np.zeros(0, np.uint64), np.zeros(0, np.uint32))
    shards = count_bigrams(df, Trust(), none, 2, block=20_000)
    model = fit(shards, none)
    from sluice.llm.perplexity import _Shard

    kinds = np.concatenate([s.kinds(s.counts[0]) for s in (_Shard.of(r, 1) for r in shards.toPandas().itertuples())])
    assert len(kinds) == model.words[0]
    zero = np.zeros(1, np.int64)
    assert abs(model.lower(kinds, np.zeros(len(kinds), np.int64)).sum() + model.lower(zero, zero)[0] - 1) < 1e-9


def test_verdicts_agree_with_labels(spark):
    got = judge(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    labels = duckdb.sql("SELECT * FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    assert both[both.quality == 1].kept.mean() > 0.99
    assert both[both.quality == 0].kept.mean() < 0.4


def test_trust_is_a_matter_of_the_surface():
    good = "the words of this text are plain and there are more than twenty of them so that it may be trusted, and so it is."
    t = texts(pa.array([good, good.upper(), good.replace(" ", "## "), "too short", None]))
    from sluice.llm.perplexity import trusted

    first = word_hashes(t)[1]
    assert trusted(t, first, Trust()).tolist() == [True, False, False, False, False]
    assert class_histogram(t).shape == (5, 11)


def test_odd_rows(table):
    good = "one two three four five six seven eight nine ten " * 4
    rows = [(k, good, "en") for k in range(30)]
    rows += [(100, " ".join(f"Q{k}#" for k in range(50)), "en"), (101, None, "en"), (102, "", None), (103, good, None), (None, good, "en"), (104, "x", "fr"), (5, good, "en"), (105, "Q! " * 20000, "xx")]
    df = table([(*r, 1) for r in rows], "doc_id long, text string, lang string, bits int")
    got = {(r["doc_id"], r["lang"]): r for r in judge(df).collect()}
    assert len(got) == len(rows) - 1
    assert got[0, "en"]["kept"] and got[None, "en"]["kept"] and got[103, None]["kept"]
    assert got[101, "en"]["kept"] and got[101, "en"]["bits_per_word"] is None
    assert got[102, None]["n_words"] == 0 and got[104, "fr"]["kept"]
    assert not got[100, "en"]["kept"]
    assert got[105, "xx"]["bound"] is None and got[105, "xx"]["kept"]


def test_empty_table(table):
    assert judge(table([], "doc_id long, text string, lang string"), bound=Bound()).collect() == []
    assert np.isfinite(discounts(0, 0, 0, 0)).all()


def test_nonsense_does_not_vouch_for_itself(spark):
    """Random letters that pass the surface rules, each text three times."""
    rng = np.random.default_rng(5)
    words = lambda: " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(4, 9))) for _ in range(300))
    rows = [(10_000_000 + k, text, "en") for k, text in enumerate(words() for _ in range(2)) for _ in range(3)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    got = judge(docs.unionAll(spark.createDataFrame(rows, docs.schema))).filter("doc_id >= 10000000").collect()
    assert len(got) == 6 and all(r["trusted"] and not r["kept"] for r in got)


def test_every_text_once(table):
    from sluice.llm.perplexity import _Shard, _word_order, repeated_hashes

    good = "the words of this text are plain and there are more than twenty of them so that it may be trusted, and so it is "
    rows = [(good + "a",), (good + "a",), (good + "c",), (None,), ("",), ("",), (good + "d",)] + [(good + "e",)] * 5
    none, rules = Contexts(np.zeros(0, np.uint64), np.zeros(0, np.uint32)), Trust()

    def total(df, marks=None):
        shards = [_Shard.of(r, 1) for r in count_bigrams(df, rules, none, 1, marks=marks).toPandas().itertuples()]
        return sorted((w, v, n) for s in shards for w, v, n in zip(np.repeat(s.words, s.lengths).tolist(), s.before.tolist(), s.counts[0].tolist(), strict=True))

    df = table(rows, "text string").repartition(3)
    once = table(list(dict.fromkeys(rows)), "text string")
    assert total(df, repeated_hashes(df)) == total(once) != total(df)
    # a map that marks everything marks too many, which costs time alone
    assert total(df, np.full(1 << 21, 255, np.uint8)) == total(once)
    near = np.array([8, 7, 7, 6, 1 << 60, 5, 0], np.uint64)
    assert near[_word_order(near)].tolist() == sorted(near.tolist()) and len(_word_order(near[:0])) == 0


def shuffle_files(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in kept.split("\n") if "/shuffle_" in f}


def test_shuffles_of_the_last_step_go(spark, tmp_path):
    from sluice.session import forget_shuffles

    before = shuffle_files(spark)
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().write.parquet(str(tmp_path / "counts"))
    made = shuffle_files(spark) - before
    assert made
    forget_shuffles(spark)
    time.sleep(1)
    assert not shuffle_files(spark) & made


def test_passes_do_not_change_verdicts(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    monkeypatch.setattr("sluice.llm.perplexity.shard_bits", lambda *_: 3)
    found = []
    for passes in (1, 3):
        monkeypatch.setattr("sluice.llm.perplexity.PASSES", passes)
        found.append(sorted(map(tuple, judge(df).collect()), key=repr))
    assert found[0] == found[1]
    assert len(found[0]) == df.count()


def test_places_and_largest():
    from sluice.llm.perplexity import _largest, _places

    rng = np.random.default_rng(5)
    table = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    values = np.concatenate([table[rng.integers(0, len(table), 500)], rng.integers(0, 1 << 63, 500).astype(np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    where = {int(v): k for k, v in enumerate(table)}
    assert _places(table, values).tolist() == [where.get(int(v), -1) for v in values]
    assert _places(table[:0], values).tolist() == [-1] * len(values)
    numbers, keys = rng.integers(0, 6, 200), rng.permutation(200)
    for most in (0, 1, 37, 200, 300):
        ranked = sorted(range(200), key=lambda k: (-numbers[k], keys[k]))[:most]
        assert sorted(_largest(numbers, keys, most).tolist()) == sorted(ranked)


def test_free_memory_goes_back():
    from sluice.llm.vectors import let_go

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    held = [np.ones(100_000, np.uint8) for _ in range(3000)]
    # the last one keeps the others' room from being given back by itself
    held = held[-1:]
    before = resident()
    let_go()
    assert held[0].all() and before - resident() > 100_000_000


def test_tasks_leave_no_free_memory_behind():
    from sluice.llm.vectors import tidy

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def work(given):
        held = [np.ones(100_000, np.uint8) for _ in range(3000)]
        most.append(resident())
        # keeps the others' room from being given back by itself
        kept.append(held[-1])
        return len(given)

    most, kept = [], []
    assert tidy(work)([1, 2]) == 2 and most[-1] - resident() > 100_000_000
    assert list(tidy(lambda batches: map(work, batches))(iter([[1], [], [2, 3]]))) == [1, 0, 2]
    assert list(tidy(lambda batches: (work(b) for b in batches))(iter([[1]]))) == [1] and most[-1] - resident() > 100_000_000


def test_words_that_differ_in_their_last_bits_are_ordered_in_place(monkeypatch):
    from sluice.llm.perplexity import _coded, _word_order

    rng = np.random.default_rng(8)
    some = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) << np.uint64(16))
    words = np.concatenate([some[rng.integers(0, len(some), 100_000)], rng.permutation(np.repeat(some[:3] ^ np.uint64(1 << 16), 20)), some[:3]])
    words = words[rng.permutation(len(words))]
    right = np.argsort(words, kind="stable")
    codes, places = np.unique(words, return_inverse=True)
    sizes = []
    monkeypatch.setattr(np, "argsort", lambda a, *x, f=np.argsort, **y: sizes.append(len(a)) or f(a, *x, **y))
    assert (_word_order(words) == right).all() and max(sizes) < 1000
    assert len(_word_order(words[:0])) == 0 and _word_order(words[:1]).tolist() == [0]
    many = rng.integers(0, 1 << 20, 50_000).astype(np.uint64)
    assert (_word_order(many) == np.argsort(many, kind="stable")).all()
    assert all((a == b).all() for a, b in zip(_coded(words), (codes, places), strict=True))
    assert [len(x) for x in _coded(words[:0])] == [0, 0]


def test_index_finds_what_places_finds():
    from sluice.llm.perplexity import Index, _places

    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2), np.array([0, 1, 2, (1 << 64) - 1], np.uint64)])
    for table in (values[:0], values[:1], np.array([0, 1, (1 << 64) - 1], np.uint64), np.arange(300, dtype=np.uint64), np.unique(values[:1500])):
        assert (Index(table).places(values) == _places(table, values)).all()


def test_trust_counts_characters_as_the_histogram():
    from sluice.llm.perplexity import trusted
    from sluice.llm.vectors import split_words

    odd = ["", None, "é; A1#", "a,b" * 30, "Ab 1 " * 9 + "c" * 80, "ü" * 40 + "#", "x\n\ty: zz " * 12, "  "]
    t = texts(pa.array(odd))
    n = class_histogram(t).astype(float)
    share = n / np.maximum(n.sum(axis=1, keepdims=True), 1)
    for most in (0.0, 0.02, 0.1, 1.0):
        right = (share[:, [9, 7, 1, 2]] <= most).all(axis=1)
        assert (trusted(t, split_words(t).first, Trust(0, most, most, most, most)) == right).all()
