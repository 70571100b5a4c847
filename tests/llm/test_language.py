"""Language identification on held-out documents and odd texts."""

from pyspark.sql import functions as F

from sluice.llm.language import identify, train
from sluice.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op5_naive_bayes"](spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and 0.1 < len(held) / len(rows) < 0.3
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def sample(table):
    return table(
        [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "12 34", "xx"), (4, "le chat", None), (5, None, "fr")],
        "doc_id long, text string, lang string",
    )


def test_odd_texts(table):
    model = train(sample(table))
    assert model.languages == ["de", "en"]
    rows = [(1, "THE DOG", "z"), (2, None, "z"), (3, "123 !?", "z"), (4, "", "z"), (None, "die katze", None), (6, "und " * 50000, "z"), (7, "日本", "z"), (6, "und " * 50000, "z")]
    df = table([(*r, 0.5) for r in rows], "doc_id long, text string, lang string, score double")
    got = sorted((str(r["doc_id"]), r["lang_pred"], r["held_out"]) for r in identify(df, model, held_out=F.col("doc_id") == 1).collect())
    assert [(k, v) for k, v, _ in got] == [("1", "en"), ("2", "und"), ("3", "und"), ("4", "und"), ("6", "de"), ("6", "de"), ("7", got[6][1]), ("None", "de")]
    assert got[6][1] in model.languages and got[0][2] is True


def test_nothing_to_learn_from(table):
    model = train(sample(table).limit(0))
    assert [r["lang_pred"] for r in identify(table([(1, "some text")], "doc_id long, text string"), model).collect()] == ["und"]
    assert identify(table([], "doc_id long, text string"), model).collect() == []


def test_score_is_the_posterior(table):
    """Against the formula on the raw counts."""
    import math

    import numpy as np
    import pyarrow as pa

    from sluice.llm.language import buckets, characters, score_batch

    df = sample(table)
    model = train(df, orders=(1, 2), bits=10, smoothing=1.0)
    grams = lambda text: [int(b) for n in (1, 2) for b in buckets(characters(pa.array([text]))[0], n, 10)]
    counts = {"en": np.ones(1024), "de": np.ones(1024)}
    for text, lang in (("the cat and the dog", "en"), ("der hund und die katze", "de")):
        for g in grams(text):
            counts[lang][g] += 1
    logs = {k: sum(math.log(v[g] / v.sum()) for g in grams("katze dog")) for k, v in counts.items()}
    best = max(logs, key=logs.get)
    share = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
    names, score = score_batch(pa.array(["katze dog"]), model)
    assert names == [best] and abs(score[0] - share) < 1e-3


def test_ten_thousand_values_of_lang(spark):
    """The most frequent ones are learned, whatever task they lie in."""
    text = "CASE id % 3 WHEN 0 THEN 'the quick brown fox and the lazy dog' WHEN 1 THEN 'el perro y la casa de los niños' ELSE concat('zz', id) END"
    lang = "CASE id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'es' ELSE concat('x', id) END"
    df = spark.range(30_000).selectExpr("id AS doc_id", f"{text} AS text", f"{lang} AS lang").repartition(7)
    model = train(df, most=20)
    assert len(model.languages) == 20 and {"en", "es"} <= set(model.languages)
    got = identify(df.filter("doc_id < 300"), model, "doc_id", F.lit(False)).collect()
    assert all(r["lang_pred"] == ("en", "es")[r["doc_id"] % 3] for r in got if r["doc_id"] % 3 < 2)
