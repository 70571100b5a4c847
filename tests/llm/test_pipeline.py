"""The pipeline's stages against plain versions, and its registration."""

import pathlib

import corpus_pipeline
import pytest

import __spark_entry__
from sluice.llm import perplexity
from sluice.session import scratch_root, with_row_names
from tests_llm_plain import plain_leaks, plain_near, plain_spans

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after every stage."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, FOLDER), name.replace(" ", "-"))
        out.append(docs)
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_names_and_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[:-1])


def test_quality_stage(stages):
    verdict = {r["doc_id"]: r["kept"] for r in perplexity.judge(stages[0]).collect()}
    assert pairs(stages[1]) == [p for p in pairs(stages[0]) if verdict[p[0]]]
    assert 0 < stages[1].count() < stages[0].count()


def test_near_copies_stage(stages):
    assert pairs(stages[2]) == plain_near(pairs(stages[1]), 5, 80)
    assert stages[2].count() < stages[1].count()


def test_spans_stage(stages):
    assert pairs(stages[3]) == plain_spans(pairs(stages[2]))
    lengths = {r["doc_id"]: (r["n_chars"], len(r["text"])) for r in stages[3].collect()}
    assert all(n == m for n, m in lengths.values())


def test_leaks_stage(spark, stages):
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left, dropped = plain_leaks(pairs(stages[3]), items)
    got = pairs(stages[4])
    assert [p for p in got if p in left] == got and not [p for p in got if p in dropped]


def test_packing_stage(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == {k for k, _ in pairs(stages[4])}
    ends = {}
    for r in rows:
        ends.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in ends.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096


def test_run_is_the_stages_in_order(spark, stages):
    key = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert key(corpus_pipeline.run(spark, FOLDER)) == key(stages[5])


def test_rows_without_ids_and_odd_rows(spark, table):
    good = "some plain words in a sentence that is long enough to be judged by the model of trusted text here. And more."
    rows = [(None, good, "en", "s", 1), (1, good, "en", "s", 1), (1, good, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0)]
    docs = table(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    got = sorted(str(r["doc_id"]) for r in docs.collect())
    assert {"1", "2", "3"} <= set(got)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), FOLDER).collect() == []


def test_every_row_is_decided_by_itself(spark, table):
    good = "some plain words in a sentence that is long enough to be judged by the model of trusted text here. And more."
    bad = " ".join(f"Q{k}#" for k in range(60))
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(k, good + f" It is number {k}.", "en", "s", 1) for k in range(10, 30)] + [(1, good, "en", "s", 1), (1, bad, "en", "s", 1), (None, bad, "en", "s", 1)]
    got = corpus_pipeline.quality(spark, table(rows, kind), FOLDER).collect()
    assert len(got) == 21 and all(r["text"] != bad for r in got)
    other = "another text of many words that is not at all like the first one in any of its parts."
    rows = [(None, good), (1, good), (1, good), (1, other), (None, other), (None, "alone here without any partner to be found at all"), (2, None), (None, None), (3, "")]
    docs = table([(*r, "en", "s", 1) for r in rows], kind).repartition(3)
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in corpus_pipeline.near_copies(spark, docs, FOLDER).collect())
    assert got == sorted((str(k), str(t)) for k, t in [rows[1], rows[3], *rows[5:]])


def test_registration():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


def test_stages_let_go_of_what_they_wrote(spark):
    """Counts and sketches go with their stage, and row numbers need no copy of the texts."""
    root = pathlib.Path(scratch_root(spark).removeprefix("file://"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = set(root.iterdir())
    kept = corpus_pipeline.near_copies(spark, corpus_pipeline.quality(spark, docs, FOLDER).localCheckpoint(), FOLDER)
    assert kept.count() < docs.count()
    left = {p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before}
    assert {n for n in left if n != "rows"} == {"bits", "classes"}
    before = set(root.iterdir())
    assert corpus_pipeline.near_copies(spark, docs, FOLDER).count() < docs.count()
    assert {p.name.rsplit("-", 1)[0] for p in set(root.iterdir()) - before} == {"classes"}


def test_rows_are_named_alike_whenever_they_are_read(spark, tmp_path):
    docs = spark.range(3000, numPartitions=3).selectExpr("id % 7 AS doc_id", "IF(id % 5 = 0, NULL, concat('t', id % 11)) AS text", "id AS n")
    docs.write.parquet(f"{tmp_path}/docs")
    read = spark.read.parquet(f"{tmp_path}/docs")
    named = with_row_names(read)
    first = {r["n"]: r["__row"] for r in named.collect()}
    assert len(set(first.values())) == 3000
    assert {r["n"]: r["__row"] for r in named.filter("text = 't3'").select("n", "__row").collect()}.items() <= first.items()
    # not straight from files: a file's row may come twice
    twice = with_row_names(read.unionAll(read))
    assert twice.select("__row").distinct().count() == 6000
