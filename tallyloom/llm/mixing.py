"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sources get word targets by weight, cut off at a multiple of what they hold. The
targets are turned into whole blocks: block after block goes to the source with the
highest quotient target / (2 * seats + 1), and inside a source to its shards in the
same way. Which blocks of a shard are taken follows from a seeded permutation, so a
rerun takes the same words.

Rows: a null or empty text has size 0 and is never taken. A null source is a source
of its own, last in order. Repeated rows are separate documents that follow each
other in the stream; ties in the order are broken by the row's own columns. An empty
table gives an empty result. Columns of the input travel inside the struct ``row``,
so their names can't clash with the added ones.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StringType

WEIGHTS = (5, 2, 1)
#: One row per source passes through the driver; a table with more sources is refused, not cut.
MOST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], budget: float, repeat: float) -> list[float]:
    """Shares of budget * sum(sizes) by weight, none above repeat * its size; what is cut off is shared anew."""
    left, open_, out = budget * sum(sizes), set(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in sorted(open_))
        share = {i: left * weights[i] / total for i in open_}
        full = sorted(i for i in open_ if share[i] > repeat * sizes[i])
        if not full:
            for i, x in share.items():
                out[i] = x
            break
        for i in full:
            out[i] = float(repeat * sizes[i])
            left -= out[i]
            open_.discard(i)
    return out


def sainte_lague(weights: list[float], caps: list[int], seats: int) -> list[int]:
    """Seats by highest quotient weight / (2 * seats + 1), at most cap each; equal quotients go to the first.

    A common divisor found by bisection gives all but a few seats at once; the last
    ones, at most one per party, are dealt out by a heap.
    """
    w, cap = np.asarray(weights, float), np.asarray(caps, np.int64)
    seats = min(seats, int(cap[w > 0].sum()))

    def dealt(divisor: float) -> np.ndarray:
        return np.minimum(cap, np.maximum(0, np.ceil(w / divisor - 0.5)).astype(np.int64))

    if seats <= 0:
        return [0] * len(w)
    low, high = float(w[w > 0].min()) / (2.0 * max(1, int(cap.max()))) / 4, float(w.max()) * 4
    for _ in range(200):  # dealt(high) <= seats always holds
        mid = (low + high) / 2
        low, high = (low, mid) if dealt(mid).sum() <= seats else (mid, high)
    got = dealt(high)
    heap = [(-w[i] / (2 * got[i] + 1), i) for i in range(len(w)) if got[i] < cap[i] and w[i] > 0]
    heapq.heapify(heap)
    for _ in range(seats - int(got.sum())):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < cap[i]:
            heapq.heappush(heap, (-w[i] / (2 * got[i] + 1), i))
    return [int(x) for x in got]


def _shard_quotas(block: int, seed: int):
    def quotas(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("shard")
        blocks = np.maximum(1, (part.words.to_numpy() + block // 2) // block)
        got = sainte_lague(part.words.tolist(), (part.most.iloc[0] * blocks).astype(int).tolist(), int(part.seats.iloc[0]))
        mine = [(seed * 1_000_003 + int(s) * 7919) % 1_000_000_007 for s in part.shard]
        return pd.DataFrame({
            "key": part.key, "shard": part.shard, "words": part.words, "blocks": blocks, "quota": got,
            "first": [m % int(n) for n, m in zip(blocks, mine)],
        })

    return quotas


def mix(
    rows: DataFrame, source: str, size: str, order: list[str], weights: tuple = WEIGHTS, budget: float = 1.5,
    repeat: int = 2, block: int = 16, rows_per_shard: int = 20_000, seed: int = 17,
) -> DataFrame:
    """Each row of rows with what the mix takes of it.

    Adds source_size, target (its source's words), full (whole copies), spans (the
    further word ranges [lo, hi) taken once, ascending) and taken. ``order`` names
    columns that tell rows apart; with the seed they fix the stream of a shard.
    The row itself is in the struct ``row``.
    """
    spark = rows.sparkSession
    base = rows.select(
        F.struct("*").alias("row"), F.col(size).alias("size"),
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")).alias("key"),
        F.xxhash64(F.lit(seed), *[F.col(c) for c in order]).alias("at"), F.struct(*order).alias("tie"),
    )
    held = base.groupBy("key").agg(F.sum("size").alias("words"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(held) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    held.sort(key=lambda r: (r.key == "n", r.key))
    sizes = [r.words for r in held]
    goal = targets(sizes, [float(weights[i % len(weights)]) for i in range(len(held))], budget, repeat)
    caps = [repeat * max(1, (s + block // 2) // block) + repeat * math.ceil(r.n / rows_per_shard) for s, r in zip(sizes, held)]
    seats = sainte_lague(goal, caps, round(sum(goal) / block)) if held else []
    sources = F.broadcast(spark.createDataFrame(
        [(r.key, s, g, q, math.ceil(r.n / rows_per_shard), repeat) for r, s, g, q in zip(held, sizes, goal, seats)],
        "key string, source_size bigint, target double, seats bigint, shards bigint, most bigint",
    ))
    dealt = base.join(sources, "key").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "at"), "shards"))
    quotas = (
        dealt.groupBy("key", "shard").agg(F.sum("size").alias("words"), F.first("seats").alias("seats"), F.first("most").alias("most"))
        .groupBy("key").applyInPandas(
            _shard_quotas(block, seed),
            "key string, shard bigint, words bigint, blocks bigint, quota bigint, first bigint",
        )
    )
    stream = W.partitionBy("key", "shard").orderBy("at", "tie").rowsBetween(W.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("start", F.coalesce(F.sum("size").over(stream), F.lit(0)))
        .join(quotas.select("key", "shard", "words", "blocks", "quota", "first"), ["key", "shard"])
        .withColumn("end", F.expr("start + size"))
        .withColumn("full", F.expr("quota div blocks")).withColumn("rest", F.expr("quota % blocks"))
        .withColumn("spans", F.when((F.col("size") > 0) & (F.col("rest") > 0), _spans()).otherwise(F.expr("array()").cast("array<struct<lo:bigint,hi:bigint>>")))
    )
    extra = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["hi"] - s["lo"])
    return placed.select(
        "row", "size", "source_size", "target", "full", "spans", (F.col("full") * F.col("size") + extra).alias("taken"),
    )


def _spans() -> Column:
    """Word ranges of the row that lie in chosen blocks; block j of a shard is [j * words div blocks, (j + 1) * words div blocks).

    The chosen blocks follow one another from a seeded place in the shard's stream, round its end:
    documents are taken whole but for the two at the ends of the run.
    """
    return F.expr("""
        transform(
            filter(
                sequence(((start + 1) * blocks - 1) div words, (end * blocks - 1) div words),
                j -> (j + first) % blocks < rest
            ),
            j -> named_struct(
                'lo', greatest(start, j * words div blocks) - start,
                'hi', least(end, (j + 1) * words div blocks) - start
            )
        )
    """)


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, with the columns of docs: whole copies, then one row with the words of the spans.

    A text cut to its spans keeps the characters between the words of a run; separate
    runs are joined by a line break. ``n_chars`` is counted anew where it exists.
    """
    from tallyloom.llm.common import word_count

    names = docs.columns
    order = ["doc_id"] if "doc_id" in names else []
    # the document stays in one column, so that none of its names meets one of these
    rows = docs.select(F.struct("*").alias("doc"), "source", *order, word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("hash"))
    out = mix(rows, "source", "size", [*order, "hash"], **settings).withColumn("row", F.col("row.doc"))
    copies = F.when(F.col("size") > 0, F.concat(
        F.array_repeat(F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>"), F.col("full").cast("int")),
        F.when(F.size("spans") > 0, F.array("spans")).otherwise(F.array().cast("array<array<struct<lo:bigint,hi:bigint>>>")),
    ))
    each = out.select("row", F.explode(copies).alias("cut"))
    text = F.when(F.col("cut").isNull(), F.col("row.text")).otherwise(
        _cut_text(F.when(F.col("cut").isNotNull(), F.col("row.text").cast("binary")), F.col("cut"))  # whole copies stay in the JVM
    )
    each = each.withColumn("new_text", text)
    return each.select(*[
        F.col("new_text").alias(c) if c == "text"
        else F.length("new_text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"row.`{c}`").alias(c)
        for c in names
    ])


@F.pandas_udf(StringType())
def _cut_text(raw: pd.Series, cut: pd.Series) -> pd.Series:
    import re

    word = re.compile(rb"[^\x20\x09-\x0D]+")
    out = []
    for text, spans in zip(raw, cut):
        if spans is None:
            out.append(None)
            continue
        at = [m.span() for m in word.finditer(text)]
        runs: list[list[int]] = []
        for s in spans:
            if runs and runs[-1][1] == s["lo"]:
                runs[-1][1] = s["hi"]
            elif s["hi"] > s["lo"]:
                runs.append([s["lo"], s["hi"]])
        out.append(b"\n".join(text[at[a][0] : at[b - 1][1]] for a, b in runs).decode("utf-8", "replace"))
    return pd.Series(out, dtype=object)
