"""Byte-level BPE with DuckDB inside each partition.

A partition's texts are cut into pieces by the tokenizer's pattern. Pieces not yet
seen in the partition start as one token per byte and go through a recursive query:
token positions join the merge table, and each piece contracts its leftmost pair of
minimum rank until none is left. Decoding joins tokens with the vocabulary and strings
their bytes together by ordered aggregation. Texts are put together from their pieces.

The rank file is read on the driver (one line per token, a size fixed by the
tokenizer) and travels with the task. Texts pass in batches; what a partition
remembers of earlier pieces is bounded, and forgetting only costs time.

Rows: a null text counts as empty; an empty text has no tokens. Very long pieces go
through the same recursion on their own. Repeated rows are encoded alike, an empty
table gives no rows, and the other columns are not touched.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import tidy

# White space, and the letters and numbers of newer Unicode versions that
# DuckDB's regular expressions don't count among \p{L} and \p{N} yet.
_SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_LETTERS = (
    r"\p{L}\x{1c89}\x{1c8a}\x{a7cb}-\x{a7cd}\x{a7da}-\x{a7dc}\x{105c0}-\x{105f3}\x{10d4a}-\x{10d65}\x{10d6f}-\x{10d85}"
    r"\x{10ec2}-\x{10ec4}\x{11380}-\x{11389}\x{1138b}\x{1138e}\x{11390}-\x{113b5}\x{113b7}\x{113d1}\x{113d3}"
    r"\x{11bc0}-\x{11be0}\x{13460}-\x{143fa}\x{16100}-\x{1611d}\x{16d40}-\x{16d6c}\x{18cff}\x{1e5d0}-\x{1e5ed}\x{1e5f0}"
    r"\x{2ebf0}-\x{2ee5d}"
)
_NUMBERS = (
    r"\p{N}\x{10d40}-\x{10d49}\x{116d0}-\x{116e3}\x{11bf0}-\x{11bf9}\x{16130}-\x{16139}\x{16d70}-\x{16d79}"
    r"\x{1ccf0}-\x{1ccf9}\x{1e5f1}-\x{1e5fa}"
)

#: Code points that mean nothing by themselves: noncharacters and private use.
_UNUSED = (range(0xFDD0, 0xFDF0), range(0xE000, 0xF900), range(0xF0000, 0xFFFFE))

MERGE = """
WITH RECURSIVE state(w, t, done) USING KEY (w) AS (
    SELECT w, t, false FROM fresh
    UNION
    SELECT state.w,
           CASE WHEN best IS NULL THEN t
                ELSE list_concat(list_concat(t[:(best & 4294967295) - 1], [(best >> 32)::INTEGER]), t[(best & 4294967295) + 2:]) END,
           best IS NULL
    FROM state LEFT JOIN (
        SELECT w, min((merges.made::BIGINT << 32) | place) AS best
        FROM (SELECT w, unnest(t) AS x, unnest(t[2:]) AS y, generate_subscripts(t, 1) AS place FROM state WHERE NOT done) AS token
        JOIN merges ON token.x = merges.x AND token.y = merges.y
        GROUP BY w
    ) AS pair ON state.w = pair.w
    WHERE NOT state.done
)
SELECT w, t FROM state ORDER BY w
"""
DECODE = """
SELECT w, unhex(coalesce(string_agg(vocabulary.hex, '' ORDER BY place), '')) AS bytes
FROM (SELECT w, unnest(t) AS id, generate_subscripts(t, 1) AS place FROM coded) AS token JOIN vocabulary USING (id)
GROUP BY w ORDER BY w
"""


class Ranks:
    """The tokens of a rank file and every pair of tokens whose join is a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        made = [
            (self.ids[token[:k]], self.ids[token[k:]], rank)
            for token, rank in self.ids.items() for k in range(1, len(token)) if token[:k] in self.ids and token[k:] in self.ids
        ]
        self.merges = np.array(made, np.int32).reshape(-1, 3)
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)


class Session:
    """One partition's DuckDB with the merge table, and the pieces encoded so far."""

    def __init__(self, ranks: Ranks, most_pieces: int = 400_000, batch: int = 40_000):
        self.ranks, self.most, self.batch = ranks, most_pieces, batch
        self.con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        x, y, made = (pa.array(c) for c in ranks.merges.T.copy())
        self.con.register("given", pa.table({"x": x, "y": y, "made": made}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.con.register("given", pa.table({"id": pa.array(list(ranks.ids.values()), pa.int32()), "hex": [t.hex() for t in ranks.ids]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM given")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.coded = pa.array([], pa.list_(pa.int32()))
        self.plain = pa.array([], pa.binary())

    def cut(self, texts: pa.Array) -> pa.ListArray:
        """The pieces of each text.

        White space before a word gives its last character to the word. DuckDB's expressions can't
        look ahead, so a mark that no text holds is set before that character and taken out again.
        """
        joined = "".join(t for t in texts.to_pylist() if t)
        mark = self.mark = next(chr(c) for r in _UNUSED for c in r if chr(c) not in joined)
        pattern = (
            rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACE}{_LETTERS}{_NUMBERS}{mark}]+|[{_SPACE}]+"
        )
        self.con.register("given", pa.table({"i": pa.array(range(len(texts))), "text": texts}))
        pieces = self.con.sql(
            rf"SELECT regexp_extract_all(regexp_replace(coalesce(text, ''), '([{_SPACE}])([{_SPACE}][^{_SPACE}])', '\1{mark}\2', 'g'), ?)"
            " AS p FROM given ORDER BY i", params=[pattern],
        ).to_arrow_table()["p"]
        return pa.concat_arrays(pieces.chunks) if pieces.num_chunks else pa.array([], pa.list_(pa.string()))

    def learn(self, pieces: list[str]) -> None:
        """Encode and decode pieces not met before."""
        new = sorted((p for p in pieces if p not in self.known), key=len)
        whole, parted, long = [], [], []
        for p in new:
            raw = p.encode()
            (whole if raw in self.ranks.ids else parted if len(raw) <= 64 else long).append((p, raw))
        for group in [whole[at : at + 200_000] for at in range(0, len(whole), 200_000)]:
            ids = pa.array([self.ranks.ids[raw] for _, raw in group], pa.int32())
            self._keep(group, pa.ListArray.from_arrays(pa.array(range(len(group) + 1), pa.int32()), ids))
        parts = [parted[at : at + self.batch] for at in range(0, len(parted), self.batch)]
        for group in [*parts, *([x] for x in long)]:
            flat = self.ranks.byte_ids[np.frombuffer(b"".join(raw for _, raw in group), np.uint8)]
            ends = np.cumsum([0] + [len(raw) for _, raw in group]).astype(np.int32)
            start = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            self.con.register("fresh", pa.table({"w": pa.array(range(len(group)), pa.int32()), "t": start}))
            self._keep(group, self._one(self.con.sql(MERGE).to_arrow_table()["t"], pa.list_(pa.int32())))

    def _keep(self, group: list[tuple[str, bytes]], ids: pa.ListArray) -> None:
        at = len(self.coded)
        self.known.update((p, at + i) for i, (p, _) in enumerate(group))
        self.coded = pa.concat_arrays([self.coded, ids])
        self.plain = pa.concat_arrays([self.plain, self.decode(ids)])

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each list of tokens; an empty list has none."""
        rows = pa.array(range(len(ids)), pa.int32())
        full = pc.greater(pc.list_value_length(ids), 0)
        self.con.register("coded", pa.table({"w": rows, "t": ids}))
        got = self._one(self.con.sql(DECODE).to_arrow_table()["bytes"], pa.binary())
        if len(got) == len(ids):
            return got
        out = np.full(len(ids), b"", object)
        out[full.to_numpy(zero_copy_only=False)] = got.to_pylist()
        return pa.array(out, pa.binary())

    @staticmethod
    def _one(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([c.cast(kind) for c in column.chunks]) if column.num_chunks else pa.array([], kind)

    def encode(self, texts: pa.Array) -> tuple[pa.ListArray, pa.Array]:
        """(tokens, decoded bytes) of each text."""
        if len(self.known) > self.most:
            self._forget()
        lists = self.cut(texts)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        keep = pc.not_equal(flat, self.mark)
        before = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])
        ends, flat = before[ends], flat.filter(keep)
        named = flat.dictionary_encode()
        words = named.dictionary.to_pylist()
        self.learn(words)
        at = np.fromiter((self.known[w] for w in words), np.int64, len(words))[named.indices.to_numpy()]
        coded = self.coded.take(pa.array(at))
        token_ends = coded.offsets.to_numpy()[ends] - coded.offsets[0].as_py()
        ids = pa.ListArray.from_arrays(pa.array(token_ends, pa.int32()), coded.flatten())
        plain = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.plain.take(pa.array(at)))
        return ids, pc.binary_join(plain, b"")


def _encode(ranks: Ranks, most_bytes: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = None
        for part in parts:
            session = session or Session(ranks)
            sizes = np.cumsum([0] + [len(t or "") for t in part.column("text").to_pylist()])
            at = 0
            while at < part.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, sizes[at] + most_bytes)))
                rows = part.slice(at, end - at)
                ids, plain = session.encode(rows.column("text"))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), ids, plain], names=["doc_id", "tokens", "decoded"])
                at = end

    return run


def encode(docs: DataFrame, rank_file: str, most_bytes: int = 6_000_000) -> DataFrame:
    """doc_id, tokens, and the bytes they decode to, of every document."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(_encode(Ranks(rank_file), most_bytes)), "doc_id bigint, tokens array<int>, decoded binary",
    )


def decode(tokens: DataFrame, rank_file: str) -> DataFrame:
    """doc_id and the bytes of each row's tokens; null or empty tokens give no bytes."""
    ranks = Ranks(rank_file)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = Session(ranks)
        for part in parts:
            for at in range(0, part.num_rows, 500):
                rows = part.slice(at, 500)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), session.decode(rows.column("tokens"))], names=["doc_id", "decoded"])

    empty = F.array().cast("array<int>")
    return tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("tokens", empty).alias("tokens")).mapInArrow(tidy(run), "doc_id bigint, decoded binary",
    )
