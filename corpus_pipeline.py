"""The corpus pipeline: documents pass language identification, near-duplicate removal, repeated passages,
benchmark decontamination and encoding. Every stage is one function (spark, docs, sf_dir) -> DataFrame; its
result is written and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from changefold.llm import bpe, decontaminate, languages, passages, registered, simhash
from changefold.llm.common import written

RESULTS = ("n_tokens", "token_ids", "ids_sha256", "decoded_sha256")
VOCABULARY = registered.vocabulary_path(registered.VOCABULARY)

#: Keys of dropped documents up to this number are held by every executor; more are joined by a shuffle.
SENT_KEYS = 1 << 20


def _packed(docs: DataFrame) -> DataFrame:
    """The texts, every other column put by in ``doc``, so that no result of an operator meets a caller's column."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text")).alias("doc"), "text")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, as they came."""
    return rows.select(*(F.col("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a text without a letter (or none at all) goes.

    The models learn from the documents that ``op3`` learns from; labels of others are not read.
    """
    train = docs.where(~languages.held_out("doc_id"))
    found = languages.identify(_packed(docs), languages.training_sample(train))
    return _unpacked(found.where(F.col("lang_pred") != languages.UNDETERMINED), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest key of each component of near-equal fingerprints.

    Rows that share a key are one document, and stay or go together.
    """
    found = simhash.near_duplicates(docs).groupBy("doc_id").agg(
        F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept"))
    gone = written(found.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id")), "pipeline-gone")
    # few keys are sent to the documents, so that no text is shuffled for them
    gone = F.broadcast(gone) if gone.count() <= SENT_KEYS else gone.hint("merge")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]), "left_anti")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more are left only where they stand first; documents with no word left go."""
    cut = passages.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a window of a benchmark item."""
    benchmark = registered.table(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(_packed(docs), benchmark)
    return _unpacked(found.where(~decontaminate.is_contaminated()), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids instead of text, with the digests of ids and decoded text; a column of the
    input with the name of one of these is replaced."""
    encoded = bpe.encode_documents(_packed(docs), VOCABULARY)
    others = [c for c in docs.columns if c != "text" and c.lower() not in RESULTS]
    return encoded.select(*(F.col("doc")[c].alias(c) for c in others), *RESULTS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("decontamination", remove_contaminated),
    ("encoding", encode),
]

#: SQL cannot say the byte context models, fuzzy chains or the encoding; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole table of documents."""
    docs = registered.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
