"""Helpers that several operators share: words, hashes, scratch tables, connected components."""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from tallyloom.sources.staging import written

U64 = np.uint64
FEW_EDGES = 50_000  # so many edges' ends are broadcast: some 10 MB


def words_of(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text, A-Z lowered; none of a null text.

    ``bytes.lower`` and ``bytes.split`` touch ASCII letters and exactly these six spaces.
    """
    return raw.lower().split() if raw else []


def hashes_of(words: list[bytes]) -> np.ndarray:
    """One 64-bit hash per word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit hash."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def shingles_of(raw: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word runs of the given width; a shorter text is one run."""
    words = words_of(raw)
    if not words:
        return np.empty(0, U64)
    h = hashes_of(words)
    run = np.zeros(max(1, len(h) - width + 1), U64)
    for k in range(min(width, len(h))):
        run = mixed(run * U64(0x9E3779B97F4A7C15) + h[k : k + len(run)] + U64(k + 1))
    return distinct(run)


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values; np.unique hashes them first, which is far slower here."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


@pandas_udf(LongType())
def _count_words(raw: pd.Series) -> pd.Series:
    return pd.Series([0 if r is None else len(r.split()) for r in raw], dtype="int64")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+``; 0 for a null text."""
    return _count_words(text.cast("binary"))


def tidy(run):
    """run over a partition's batches, then give freed memory back: the worker lives on for other stages."""

    def over(parts):
        yield from run(parts)
        give_back()

    return over


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small(df: DataFrame, most_rows: int = 500_000) -> DataFrame:
    """A written table of narrow rows, with a broadcast hint if it has at most so many."""
    return F.broadcast(df) if df.count() <= most_rows else df


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``written`` made and that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_text_ids(docs: DataFrame, for_nulls: bool) -> DataFrame:
    """(doc, key): each row as one struct, and a number that rows of one id and text share, and no others.

    It is the id itself, but for further texts of an id, which get a hash from 2^62 on; with
    ``for_nulls`` rows without an id get one by their text, otherwise their key is null.
    """
    content = F.xxhash64("text")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("id"), content.alias("content")).groupBy("id").agg(F.min("content").alias("first"), F.max("content").alias("last"))
    several = small(written(texts.filter("first < last AND id IS NOT NULL").select("id", "first"), "ids-of-several-texts"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("own"), content.alias("content"))
    other = F.xxhash64("own", "content").bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    key = F.when(F.col("own").isNull(), other if for_nulls else F.lit(None).cast("bigint")).when(F.col("first") != F.col("content"), other).otherwise(F.col("own"))
    return rows.join(several, F.col("own") == F.col("id"), "left").select("doc", key.alias("key"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that an edge (a, b) names; component is the smallest node reachable.

    Alternating star contraction: each round hangs every larger neighbour under the
    smallest one it can see. The frame stays in the cluster, is written after each
    round (which cuts its lineage), and the driver sees two numbers per round. While the
    edges are few, their ends are broadcast, so that a round has half the shuffles.
    """
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi > lo").distinct()
    now, before = written(pairs, "edges"), None
    state = _fingerprint(now)
    while state != before:
        few = state[0] <= FEW_EDGES
        near = F.broadcast if few else lambda ends: ends
        both = now.unionAll(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m"))
        large = (  # every larger neighbour hangs under the smallest neighbour, or the node itself
            both.join(near(least), "hi").filter("lo > hi")
            .select(F.col("lo").alias("hi"), F.least("hi", "m").alias("lo"))
        )
        large = large if few else large.distinct()
        seen = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(near(seen), "hi")
        step = (
            small.filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
            .unionAll(seen.select("hi", F.col("m").alias("lo"))).filter("hi > lo").distinct()
        )
        after = written(step, "edges")
        discard(now)
        now, before, state = after, state, _fingerprint(after)
    tops = now.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(tops)


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(row)
