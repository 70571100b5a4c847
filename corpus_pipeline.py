"""The corpus pipeline: five stages from raw documents to packed sequences.

Every stage takes the documents its predecessor kept and returns documents with
the columns of the input, the last one the packed pieces. Every row is a document
of its own, also one that shares its doc_id with others or has none.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import jaccard, leaks, packing, perplexity, spans
from sluice.llm.queries import table, tokenizer_path
from sluice.session import finished, materialize, with_row_names  # noqa: F401


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the perplexity model rejects go: equal texts of a language have equal verdicts."""
    gone = perplexity.verdicts(docs).filter("NOT kept").select(F.col("h").alias("__h"), F.col("lang").alias("__lang")).distinct()
    same = (F.xxhash64(docs["text"].cast("string")) == F.col("__h")) & docs["lang"].cast("string").eqNullSafe(F.col("__lang"))
    return docs.join(gone, same, "left_anti")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by 5-word shingles at 0.8, one stays: smallest doc_id, then hash of the text, then row."""
    rows = with_row_names(docs)
    classes = jaccard.jaccard_classes(rows.select(F.col("__row").alias("doc_id"), "text"), jaccard.Similar(words=5, percent=80))
    named = classes.select(F.col("doc_id").alias("__row"), "component_id").join(rows.select("__row", "__hash", "doc_id"), "__row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__hash", "__row"))
    kept = named.groupBy("component_id").agg(first.alias("first")).select(F.col("first.__row").alias("__row"))
    return rows.join(kept, "__row", "left_semi").select(*docs.columns)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences that repeat an earlier run go, and documents nothing is left of."""
    cut = spans.remove_repeats(docs)
    left = cut.filter("NOT (n_removed > 0 AND trim(text) = '')")
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    return leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed into sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_spans),
    ("benchmark decontamination", decontaminated),
    ("best-fit packing", packed),
]

#: SQL cannot express the stages; each is tested against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next; what a stage wrote for itself goes."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = finished(spark, name.replace(" ", "-"), partial(stage, spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
