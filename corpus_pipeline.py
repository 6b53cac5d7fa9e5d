"""From raw documents to token ids: the training-data pipeline, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm import bpe, lines, minhash, mixing, quality
from tallyloom.llm.common import read_table, with_text_ids, written

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _unpacked(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps.

    A row is judged by its own text: repeated rows alike, a second text under an id, or a text
    without an id, for itself (the label of an id goes with one of its texts). Null and empty
    texts are scored as such. Without labels of both kinds, and on an empty table, all rows stay.
    """
    rows = with_text_ids(docs, for_nulls=True)
    judged = rows.select(F.col("key").alias("doc_id"), *[F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != "doc_id"])
    rejected = quality.classify(judged, read_table(spark, sf_dir, "labels")).filter("NOT kept").select(F.col("doc_id").alias("key")).distinct()
    return _unpacked(rows.join(rejected, "key", "left_anti"), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that repeat, see ``lines.without_repeated_lines``; every row stays, null texts and ids as they are."""
    return lines.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 or more, the one of the smallest id.

    A document is an id with a text: of repeated rows one stays, different texts of an id are
    compared like any others. Rows without an id stay, and texts without a word stay once per id.
    """
    rows = with_text_ids(docs, for_nulls=False)
    compared = rows.select(F.col("key").alias("doc_id"), F.col("doc.text").alias("text"))
    gone = minhash.near_duplicates(compared, percent=80).filter("NOT kept").select(F.col("doc_id").alias("key")).distinct()
    left = rows.join(gone, "key", "left_anti")
    turn = F.row_number().over(W.partitionBy(F.coalesce("key", F.xxhash64("doc"))).orderBy(F.xxhash64("doc")))
    return _unpacked(left.withColumn("turn", turn).filter("key IS NULL OR turn = 1"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The blocks that the mix takes: whole copies, and texts cut to the words taken.

    Rows without words have nothing to take and go; a null source is a source of its own, the last.
    """
    return mixing.mixed_documents(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and the text that they decode to; a null text is an empty one, every row stays."""
    return bpe.encode(docs, TOKENIZER).select(
        "doc_id", F.size("tokens").alias("n_tokens"), "tokens", F.col("decoded").cast("string").alias("text"),
    )


STAGES = [
    ("quality", classify_quality),
    ("lines", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("tokens", encode_tokens),
]

#: A fitted classifier has no SQL twin; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
