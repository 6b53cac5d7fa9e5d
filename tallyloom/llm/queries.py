"""Registered queries of the subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, lines, lm, minhash, mixing, neighbours, packing, pii, quality, spelling, tools, topk, whitening
from tallyloom.llm.common import read_table, word_count

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, folder, "documents"))


def op2_nn_descent_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(read_table(spark, folder, "embeddings"))


def op3_threshold_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


#: The tools that the derived calls use.
TOOLS = {
    "search": {
        "type": "object", "required": ["query"], "additionalProperties": False,
        "properties": {"query": {"type": "string", "minLength": 1}, "limit": {"type": "integer", "minimum": 1, "maximum": 60}, "source": {"type": "string"}},
    },
    "lookup": {"type": "object", "required": ["key"], "properties": {"key": {"type": "string", "maxLength": 40}, "strict": {"type": "boolean"}}},
    "count": {"type": "object", "required": ["text", "unit"], "properties": {"unit": {"enum": ["word", "char"]}, "text": {"type": "string"}}},
}


def tool_calls(conversations: DataFrame) -> DataFrame:
    """A call for each assistant turn: tool, arguments and their faults follow from the turn's text.

    Every second call uses the result of the call two turns earlier.
    """
    told = conversations.filter("role = 'assistant'").withColumn("n", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    words = F.split(F.coalesce("text", F.lit("")), " ")
    told = told.withColumn("name", F.element_at(F.array(*map(F.lit, TOOLS)), (F.col("n") % 3 + 1).cast("int")))
    earlier = F.when((F.col("turn") >= 3) & (F.col("n") % 2 == 0), F.concat(F.lit("$call_"), "conv_id", F.lit("_"), F.col("turn") - 2))
    search = F.to_json(F.struct(
        earlier.alias("source"), F.when(F.col("n") % 11 != 1, F.array_join(F.slice(words, 1, 6), " ")).alias("query"), F.size(words).alias("limit"),
    ))
    lookup = F.to_json(F.struct(F.element_at(words, 1).alias("key"), (F.col("n") % 5 == 0).alias("strict"), earlier.alias("after")))
    count = F.to_json(F.struct(F.element_at(F.array(F.lit("word"), F.lit("char"), F.lit("line")), (F.col("n") % 7 % 3 + 1).cast("int")).alias("unit"), F.coalesce(earlier, F.element_at(words, -1)).alias("text")))
    arguments = F.when(F.col("name") == "search", search).when(F.col("name") == "lookup", lookup).otherwise(count)
    cut = F.when(F.col("n") % 13 == 0, F.expr("substring(arguments, 1, length(arguments) - 1)")).otherwise(F.col("arguments"))
    return told.withColumn("arguments", arguments).select(
        "conv_id", "turn", F.concat(F.lit("call_"), "conv_id", F.lit("_"), "turn").alias("call_id"), "name", cut.alias("arguments"),
    )


def tool_results(conversations: DataFrame) -> DataFrame:
    """A result for each user turn after the first one, for the call of the turn before it."""
    return conversations.filter("role = 'user' AND turn >= 1").select(
        "conv_id", "turn", F.concat(F.lit("call_"), "conv_id", F.lit("_"), F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"),
    )


def op4_tool_call_links(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read_table(spark, folder, "conversations")
    return tools.link(tool_calls(conversations), tool_results(conversations), TOOLS)


def op5_segment_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.near_duplicate_lines(read_table(spark, folder, "documents")).drop("size")


def op6_elias_fano_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(read_table(spark, folder, "documents"))


def op7_packed_token_rows(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_cotraining_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op9_duckdb_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = bpe.encode(read_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return coded.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("tokens").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_sainte_lague_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("content"),
    )
    mix = mixing.mix(docs, "source", "size", ["doc_id", "content"])
    return mix.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "size", "source_size", "target", "taken",
    )


def op11_trie_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read_table(spark, folder, "documents"))


def op12_multiplicity_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """A deviation that no long holds is null; at any scale ``whiten`` itself returns it as a decimal."""
    white = whitening.whiten(read_table(spark, folder, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_semi_markov_pii(spark: SparkSession, folder: str) -> DataFrame:
    """The counts and the digest are of the rules' spans; ``spans`` has the added ones too."""
    found = pii.find(read_table(spark, folder, "documents"))

    def of(kind: str, *spans: str):
        return F.filter(F.concat(*spans), lambda s: s["kind"] == kind)

    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    by_kind = F.flatten(F.array(*[F.array_sort(of(kind, "base", "added")) for kind in pii.KINDS]))
    return found.select(
        "doc_id", *[F.size(of(kind, "base")).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(told(F.col("base")), 256).alias("base_sha256"), told(by_kind).alias("spans"), F.size("added").cast("bigint").alias("n_added"),
    )


def all_queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
