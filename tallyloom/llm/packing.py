"""Token ids packed into fixed rows by best-fit-decreasing.

A task tokenizes its documents, cuts token lists longer than a row into pieces without
loss, and packs a few million tokens at a time: pieces go by falling length into the
fullest row that still has room, found with a segment tree over free capacities. Each
packed row has its ids as little-endian integers, the cumulative segment lengths, the
places where positions start anew, and for each segment its document and the place of
its first token there. Nothing is shuffled; what lies together follows the partitions.

Rows: a null or empty text has the end token only, so that every document lands in
some row. Documents without id keep a null id. Repeated rows are packed like others.
Equal lengths keep the order of the input. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import tidy

PACKED = "shard string, row int, ids binary, n_tokens int, cu_seqlens array<int>, resets array<int>, doc_ids array<bigint>, starts array<bigint>"


class Capacities:
    """Rows by free capacity: a segment tree whose leaf c counts the rows with c places free."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, row: int, free: int) -> None:
        self.rows[free].append(row)
        at = self.leaves + free
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, its free places) with the least capacity of at least need, taken out."""
        at = self.leaves + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.leaves
        while at:
            self.count[at] -= 1
            at >>= 1
        return self.rows[free].pop(), free


def best_fit_decreasing(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Pieces of each row; every length is at most size."""
    tree, rows = Capacities(size), []
    for piece in np.argsort(-lengths, kind="stable"):
        need = int(lengths[piece])
        found = tree.take(need)
        if found is None:
            rows.append([])
            found = (len(rows) - 1, size)
        rows[found[0]].append(int(piece))
        tree.put(found[0], found[1] - need)
    return rows


def _pack(name: str, held: list[tuple[int | None, np.ndarray]], size: int, pad: int, kind: np.dtype) -> pa.RecordBatch:
    pieces = [(i, start, ids[start : start + size]) for i, ids in held for start in range(0, len(ids), size)]
    out = []
    for k, row in enumerate(best_fit_decreasing(np.array([len(p[2]) for p in pieces], np.int64), size)):
        parts = [pieces[p] for p in row]
        ends = np.cumsum([len(p[2]) for p in parts])
        ids = np.full(size, pad, kind)
        ids[: ends[-1]] = np.concatenate([p[2] for p in parts])
        out.append({
            "shard": name, "row": k, "ids": ids.tobytes(), "n_tokens": int(ends[-1]), "cu_seqlens": [0, *ends.tolist()],
            "resets": [0, *ends[:-1].tolist()], "doc_ids": [p[0] for p in parts], "starts": [p[1] for p in parts],
        })
    return pa.RecordBatch.from_pylist(out, pa.schema([
        ("shard", pa.string()), ("row", pa.int32()), ("ids", pa.binary()), ("n_tokens", pa.int32()), ("cu_seqlens", pa.list_(pa.int32())),
        ("resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
    ]))


def pack(docs: DataFrame, rank_file: str, pattern: str, size: int = 2048, end_id: int = 50_256, group_tokens: int = 4_000_000) -> DataFrame:
    """Packed rows of the token ids of docs; each document ends with end_id, which also fills a row's rest."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    kind = np.dtype("<u2" if max(end_id, *ranks.values()) < 2**16 else "<u4")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        part_id, made, held, total = TaskContext.get().partitionId(), 0, [], 0
        for part in parts:
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids = np.array([*encoding.encode_ordinary(text or ""), end_id], kind)
                held.append((doc_id, ids))
                total += len(ids)
                if total >= group_tokens:
                    yield _pack(f"{part_id}-{made}", held, size, end_id, kind)
                    held, total, made = [], 0, made + 1
        if held:
            yield _pack(f"{part_id}-{made}", held, size, end_id, kind)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), PACKED)


def write_packed(packed: DataFrame, folder: str) -> None:
    """The packed rows as files in a folder that the cluster shares."""
    packed.write.mode("overwrite").parquet(folder)


def unpack_row(ids: bytes, cu_seqlens: list[int], wide: bool = False) -> list[np.ndarray]:
    """The segments of a packed row."""
    flat = np.frombuffer(ids, "<u4" if wide else "<u2")
    return [flat[a:b] for a, b in zip(cu_seqlens, cu_seqlens[1:])]


def positions(cu_seqlens: list[int], size: int) -> np.ndarray:
    """Position of each token of a row in its segment; the filled rest counts from 0 as well."""
    ends = [*cu_seqlens, size] if cu_seqlens[-1] < size else list(cu_seqlens)
    return np.concatenate([np.arange(b - a) for a, b in zip(ends, ends[1:])])
