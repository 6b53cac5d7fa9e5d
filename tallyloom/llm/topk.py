"""Exact top-k by integer inner product with Fagin's threshold algorithm.

Vectors are dealt into blocks and queries into groups; a task holds one block and
one group. Inside it every dimension has its list of rows sorted by value. A query
walks the lists of its non-zero dimensions from the end that helps its score, scores
each row when it first meets it, and stops when the bound, the inner product with
the values at the current depth, is below its k-th score. The few winners of each
block are then ranked together.

Rows: a vector that is null, empty, or holds a null or non-finite component takes no
part, nor does a row without id. Vectors meet queries of their own length only. Rows
with the id of the query are its own. Equal queries (id and vector) count once.
Repeated candidates stay repeated. Ties go to the smaller id. Components beyond 2**62
in sum leave 64-bit arithmetic for exact integers. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.llm.common import distinct

RESULT = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def usable(vector: Column) -> Column:
    """True for a vector without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


class SortedLists:
    """A block of integer vectors with one list of rows per dimension, sorted by value."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[by_id], vectors[by_id]
        self.order = np.argsort(self.vectors, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(self.vectors.T, self.order, axis=1)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """(ids, scores) of the k best rows, ties to the smaller id, and the depth the walk reached."""
        rows = len(self.ids)
        dims = np.flatnonzero(query)
        if not len(dims):
            at = np.flatnonzero(self.ids != own)[:k]
            return self.ids[at], np.zeros(len(at), np.int64), 0
        down = query[dims] > 0
        seen = self.ids == own
        best_at, best = np.empty(0, np.int64), np.empty(0, self.vectors.dtype)
        depth, step = 0, max(8, 2 * k)
        while depth < rows:
            stop = min(rows, depth + step)
            met = np.concatenate([
                self.order[dims[down], rows - stop : rows - depth].ravel(), self.order[dims[~down], depth:stop].ravel(),
            ])
            met = distinct(met[~seen[met]])
            seen[met] = True
            best_at = np.concatenate([best_at, met])
            best = np.concatenate([best, self.vectors[met] @ query])
            if len(best_at) > k:
                first = np.lexsort((best_at, -best))[:k]
                best_at, best = best_at[first], best[first]
            edge = np.where(down, self.values[dims, rows - stop], self.values[dims, stop - 1])
            if len(best_at) == k and int(edge @ query[dims]) < int(best.min()):
                break
            depth, step = stop, step * 2
        first = np.lexsort((best_at, -best))
        return self.ids[best_at[first]], best[first], min(rows, depth + step)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in vectors])


def _search_cell(k: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        asked, held = part[part.is_query], part[~part.is_query]
        out = []
        if len(asked) and len(held):
            x, q = _matrix(held.vec), _matrix(asked.vec)
            if float(np.abs(x.astype(float)).max()) * float(np.abs(q.astype(float)).max()) * x.shape[1] >= 2.0**62:
                x, q = x.astype(object), q.astype(object)
            lists = SortedLists(held.vec_id.to_numpy(), x)
            for own, key, vector in zip(asked.vec_id, asked.query_key, q):
                ids, scores, _ = lists.search(vector, own, k)
                out += [(own, key, int(i), int(s)) for i, s in zip(ids, scores)]
        return pd.DataFrame(out, columns=["query_id", "query_key", "vec_id", "score"])

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 1024, block_rows: int = 4096, query_rows: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows of each query, over floor(scale * component)."""
    base = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("raw"), is_query.alias("asks"))
    base = base.filter(usable(F.col("raw")) & F.col("vec_id").isNotNull()).select(
        "vec_id", "asks", F.transform("raw", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint")).alias("vec"),
    )
    asked = base.filter("asks").select("vec_id", "vec").distinct().withColumn("query_key", F.xxhash64("vec"))
    counts = base.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks, groups = -(-counts.n // block_rows) or 1, -(-counts.q // query_rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    held = base.select(
        F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int").alias("block"), every(groups).alias("group"),
        F.lit(False).alias("is_query"), "vec_id", F.lit(0).cast("bigint").alias("query_key"), "vec",
    )
    ask = asked.select(
        every(blocks).alias("block"), F.pmod(F.xxhash64("vec_id", F.lit(5)), F.lit(groups)).cast("int").alias("group"),
        F.lit(True).alias("is_query"), "vec_id", "query_key", "vec",
    )
    found = (
        held.unionAll(ask).withColumn("dims", F.size("vec"))
        .groupBy("block", "group", "dims").applyInPandas(_search_cell(k), RESULT)
    )
    order = W.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score",
    )
