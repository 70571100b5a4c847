"""The registered queries against their SQL, and what their results look like."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2] / "tools"))

from compare import compare, connect  # noqa: E402

from sluice.llm.queries import QUERIES, SQL  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(SQL))
def test_against_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name, SQL[name]).startswith("ok (")


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_kneser_ney", "doc_id lang n_words trusted bits_per_word bound kept"),
        ("op4_licence_scan", "doc_id path licence score basis licence_path"),
        ("op5_naive_bayes", "doc_id held_out lang_pred score"),
        ("op6_bin_completion", "doc_id piece start length ids_crc32 sequence_id offset"),
        ("op7_divergence_rules", "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept class_distance word_distance"),
        ("op8_edit_matches", "doc_id item_id distance begin end"),
        ("op9_sentence_spans", "doc_id text n_sentences n_removed"),
        ("op11_length_delimited", "doc_id start n_tokens ids_crc32"),
        ("op13_rank_index", "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256"),
    ],
)
def test_columns(spark, name, columns):
    df = QUERIES[name](spark, FOLDER)
    assert df.columns == columns.split()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if name not in ("op6_bin_completion", "op8_edit_matches"):
        assert df.count() == documents
