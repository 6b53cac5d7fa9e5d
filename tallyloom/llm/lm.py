"""Scoring texts with a word-pair model held in Elias-Fano tries.

The corpus is cut into chunks of documents; each chunk is turned into numbers once and
written. Its distinct words, and its distinct (context, word) pairs with their counts
in the training documents, go to shards: words by their hash, pairs by the context's
hash, so that a shard has all there is to know of a context. A shard adds the counts
up, builds a trie of its contexts, and answers the pairs of every chunk with quantised
log probabilities; the chunk adds these up per document. No model passes through the
driver or has to fit a machine.

A context with many occurrences is spread over shards by its words; such contexts
(at most as many as there are shards) and their counts are sent along.

A trie has two levels. The contexts are a sorted sequence of hashes, the successors a
sequence of (context rank, word) that grows along the contexts, both Elias-Fano coded;
the unary upper bits give the pointers, a search is relative to its context. A level
is written to a file and read through a memory map; the file goes with the trie.

Probability: p(w | h) = (c(hw) + m * p(w)) / (c(h) + m) with p(w) = (c(w) + 1) / (N + V + 1),
where c(hw) / (c(h) + m) is the stored, quantised part. A context never seen leaves p(w).
A word's hash has 64 bits, as a successor the upper 40; a clash is taken for the same word.

Rows: a null or empty text has the end token only. A document without id belongs to the
training part. Repeated rows are scored alike and count each time. An empty table gives
no rows; without any training document N and V are 0. Other columns are not read.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import U64, distinct, hashes_of, mixed, tidy, words_of, written

#: Hash of the end token (no word is empty) and of the context at a text's start.
END, START = hashes_of([b""])[0], mixed(hashes_of([b"", b" "]))[1]
CODES, STEP = 65_535, 10 / 65_534


def pack(x: np.ndarray) -> bytes:
    """An array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(raw: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


class EliasFano:
    """A sorted sequence: lower bytes side by side, upper bits in unary."""

    def __init__(self, low_bytes: int, size: int, upper: np.ndarray, lower: np.ndarray):
        self.low_bytes, self.size, self.lower = low_bytes, size, lower
        ends = np.flatnonzero(np.unpackbits(np.asarray(upper), bitorder="little") == 0)
        self.starts = np.concatenate([[0], np.minimum(ends - np.arange(len(ends)), size)])

    @staticmethod
    def write(values: np.ndarray, universe: int, file: Path) -> None:
        n = max(1, len(values))
        low_bytes = min(7, max(1, -(-max(0, (universe // n).bit_length() - 1) // 8)))
        high = (values >> U64(8 * low_bytes)).astype(np.int64)
        bits = np.zeros(len(values) + (int(high[-1]) if len(high) else 0) + 1, np.uint8)
        bits[high + np.arange(len(values))] = 1
        upper = np.packbits(bits, bitorder="little")
        lower = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :low_bytes]
        head = np.array([low_bytes, len(values), len(upper)], np.int64)
        with file.open("wb") as out:
            for part in (head, upper, np.ascontiguousarray(lower)):
                out.write(part.tobytes())

    @staticmethod
    def open(file: Path) -> EliasFano:
        raw = np.memmap(file, np.uint8, "r")
        low_bytes, size, upper = (int(x) for x in raw[:24].view(np.int64))
        return EliasFano(low_bytes, size, raw[24 : 24 + upper], raw[24 + upper :].reshape(size, low_bytes) if size else np.zeros((0, low_bytes), np.uint8))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key in the sequence, -1 where it isn't: a binary search in the key's bucket."""
        high = (keys >> U64(8 * self.low_bytes)).astype(np.int64)
        low = keys & U64((1 << 8 * self.low_bytes) - 1)
        inside = high < len(self.starts) - 1
        high = np.where(inside, high, 0)
        a = np.where(inside, self.starts[high], 0)
        end = np.where(inside, self.starts[np.minimum(high + 1, len(self.starts) - 1)], 0)
        b = end.copy()
        for _ in range(int((end - a).max(initial=0)).bit_length()):
            open_ = a < b
            mid = (a + b) // 2
            less = np.zeros(len(keys), bool)
            less[open_] = self._lower(mid[open_]) < low[open_]
            a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)
        hit = a < end
        hit[hit] = self._lower(a[hit]) == low[hit]
        return np.where(hit, a, -1)

    def _lower(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.low_bytes] = self.lower[at]
        return out.view(U64).ravel()


class Trie:
    """Contexts, their successors, and a quantised probability per successor, in memory-mapped files."""

    def __init__(self, folder: str, contexts: np.ndarray, successors: np.ndarray, logs: np.ndarray):
        """contexts and successors (40 bits): the pairs, sorted; logs: log10 of their probabilities."""
        place = Path(folder)
        own, rank = np.unique(contexts, return_inverse=True)
        codes = np.clip(np.rint(-logs / STEP) + 1, 1, CODES).astype(np.uint16)
        EliasFano.write(own, 1 << 64, place / "contexts")
        EliasFano.write((rank.astype(U64) << U64(40)) | successors, max(1, len(own)) << 40, place / "successors")
        codes.tofile(place / "codes")
        self.contexts, self.successors = EliasFano.open(place / "contexts"), EliasFano.open(place / "successors")
        self.codes = np.memmap(place / "codes", np.uint16, "r") if len(codes) else codes

    def find(self, contexts: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Quantised log probability of each pair, 0 for a pair the trie doesn't hold."""
        own, back = np.unique(contexts, return_inverse=True)
        rank = self.contexts.find(own)[back]
        at = np.full(len(contexts), -1, np.int64)
        known = rank >= 0
        at[known] = self.successors.find((rank[known].astype(U64) << U64(40)) | successors[known])
        out = np.zeros(len(contexts), np.uint16)
        out[at >= 0] = self.codes[at[at >= 0]]
        return out


def probability(codes: np.ndarray) -> np.ndarray:
    return np.where(codes > 0, 10.0 ** (-(codes.astype(np.float64) - 1) * STEP), 0.0)


# --- chunks -------------------------------------------------------------------------------------

CHUNK = "chunk string, train_tokens bigint, train_docs bigint, docs binary, words binary, tokens binary"


def _chunks(most_bytes: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, made = TaskContext.get().partitionId(), 0
        held, size = [], 0
        for part in parts:
            for doc in zip(*(part.column(c).to_pylist() for c in ("doc_id", "train", "raw"))):
                held.append((doc[0], doc[1], hashes_of(words_of(doc[2]))))
                size += len(doc[2] or b"") + 64
                if size >= most_bytes:
                    yield _chunk(f"{name}-{made}", held)
                    held, size, made = [], 0, made + 1
        if held:
            yield _chunk(f"{name}-{made}", held)

    return run


def _chunk(name: str, held: list) -> pa.RecordBatch:
    docs = np.array([(i or 0, i is None, t, len(h) + 1) for i, t, h in held], DOC)
    every = np.concatenate([x for _, _, h in held for x in (h, [END])]).astype(U64)
    words, tokens = np.unique(every, return_inverse=True)
    train = docs["train"] > 0
    return pa.RecordBatch.from_pylist([{
        "chunk": name, "train_tokens": int(docs["tokens"][train].sum()), "train_docs": int(train.sum()),
        "docs": pack(docs), "words": words.tobytes(), "tokens": pack(tokens.astype(np.uint32)),
    }], pa.schema([("chunk", pa.string()), ("train_tokens", pa.int64()), ("train_docs", pa.int64()), ("docs", pa.binary()), ("words", pa.binary()), ("tokens", pa.binary())]))


DOC = np.dtype([("id", np.int64), ("null", np.uint8), ("train", np.uint8), ("tokens", np.int64)])


class Chunk:
    """One chunk: documents, distinct words in order of their hash, and the tokens as places among them."""

    def __init__(self, docs: bytes, words: bytes, tokens: bytes):
        self.docs, self.words, self.tokens = unpack(docs, DOC), np.frombuffer(words, U64), unpack(tokens, np.uint32)
        self.train = np.repeat(self.docs["train"] > 0, self.docs["tokens"])

    @cached_property
    def keys(self) -> np.ndarray:
        """Each token with its context, the word before; place len(words) stands for the start of a text."""
        n = len(self.words)
        keys = np.empty(len(self.tokens), np.int64)
        keys[1:] = self.tokens[:-1]
        keys[np.concatenate([[0], np.cumsum(self.docs["tokens"])[:-1]])] = n
        keys *= n + 1
        keys += self.tokens
        return keys

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) keys in order, and the hashes of both."""
        keys = distinct(self.keys)
        contexts = np.append(self.words, START)[keys // (len(self.words) + 1)]
        return keys, contexts, self.words[keys % (len(self.words) + 1)]

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        own, n = np.unique(self.keys[self.train], return_counts=True)
        out = np.zeros(len(keys), np.uint32)
        out[np.searchsorted(keys, own)] = n
        return out


class Hot:
    """Contexts that occur so often that their pairs are spread over shards."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, share: float):
        order = np.argsort(hashes)
        self.hashes, self.counts = hashes[order].astype(U64), counts[order].astype(np.int64)
        self.spread = np.ceil(self.counts / max(1.0, share)).astype(np.int64)

    def at(self, contexts: np.ndarray) -> np.ndarray:
        """Place of each context among the hot ones, -1 for others."""
        if not len(self.hashes):
            return np.full(len(contexts), -1)
        place = np.minimum(np.searchsorted(self.hashes, contexts), len(self.hashes) - 1)
        return np.where(self.hashes[place] == contexts, place, -1)


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """Even ranges of the hashes, in their order."""
    return ((h >> U64(32)) * U64(shards) >> U64(32)).astype(np.int64)


def pair_shards(contexts: np.ndarray, words: np.ndarray, shards: int, hot: Hot) -> np.ndarray:
    out, place = shard_of(contexts, shards), hot.at(contexts)
    mine = place >= 0
    part = shard_of(words[mine], 1 << 30) * hot.spread[place[mine]] >> 30
    out[mine] = (out[mine] + part) % shards
    return out


def _ask_words(shards: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                chunk = Chunk(row.docs, row.words, row.tokens)
                counts, ends = chunk.word_counts().astype(np.uint32), np.searchsorted(shard_of(chunk.words, shards), np.arange(shards + 1))
                rows = [(row.chunk, s, chunk.words[a:b].tobytes(), pack(counts[a:b])) for s, (a, b) in enumerate(zip(ends, ends[1:])) if b > a]
                yield pd.DataFrame(rows, columns=["chunk", "shard", "asked", "counts"])

    return run


def _answer_words(floor: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        asked = [np.frombuffer(x, U64) for x in part.asked]
        own, back = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(back, np.concatenate([unpack(x, np.uint32) for x in part.counts])).astype(np.int64)
        ends = np.cumsum([0] + [len(x) for x in asked])
        hot = (total >= floor) & (own != END)
        out = pd.DataFrame({"chunk": part.chunk, "shard": part.shard, "reply": [pack(total[back[a:b]]) for a, b in zip(ends, ends[1:])]})
        out["known"], out["hot"], out["hot_counts"] = 0, None, None
        out.loc[out.index[0], ["known", "hot", "hot_counts"]] = [int((total > 0).sum()), own[hot].tobytes(), total[hot].tobytes()]
        return out

    return run


def _ask_pairs(shards: int, hot: Hot):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                chunk = Chunk(row.docs, row.words, row.tokens)
                keys, contexts, words = chunk.pairs()
                counts, to = chunk.pair_counts(keys), pair_shards(contexts, words, shards, hot)
                order = np.argsort(to, kind="stable")
                ends, rows = np.searchsorted(to[order], np.arange(shards + 1)), []
                for s, (a, b) in enumerate(zip(ends, ends[1:])):
                    if b > a:
                        at = order[a:b]
                        new = np.flatnonzero(np.concatenate([[True], contexts[at][1:] != contexts[at][:-1]]))
                        tail = np.ascontiguousarray(words[at]).view(np.uint8).reshape(-1, 8)[:, 3:]  # the upper 40 bits
                        rows.append((
                            row.chunk, s, contexts[at][new].tobytes(), pack(np.diff(np.append(new, len(at))).astype(np.uint32)),
                            np.ascontiguousarray(tail).tobytes(), pack(counts[at]),
                        ))
                yield pd.DataFrame(rows, columns=["chunk", "shard", "contexts", "runs", "words", "counts"])

    return run


def _answer_pairs(hot: Hot, weight: float):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        def tails(raw: bytes) -> np.ndarray:
            out = np.zeros((len(raw) // 5, 8), np.uint8)
            out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
            return out.view(U64).ravel()

        contexts = [np.repeat(np.frombuffer(c, U64), unpack(r, np.uint32)) for c, r in zip(part.contexts, part.runs)]
        words = [tails(x) for x in part.words]
        all_contexts, all_words = np.concatenate(contexts), np.concatenate(words)
        counts = np.concatenate([unpack(x, np.uint32) for x in part.counts]).astype(np.int64)
        seen = np.flatnonzero(counts)
        seen = seen[np.lexsort((all_words[seen], all_contexts[seen]))]
        c, w = all_contexts[seen], all_words[seen]
        new = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (w[1:] != w[:-1])])) if len(seen) else seen
        c, w, n = c[new], w[new], np.add.reduceat(counts[seen], new) if len(new) else counts[:0]
        own, rank = np.unique(c, return_inverse=True)
        total, place = np.bincount(rank, n, minlength=len(own)), hot.at(own)
        total = np.where(place >= 0, hot.counts[place] if len(hot.counts) else 0, total)
        with tempfile.TemporaryDirectory() as folder:
            trie = Trie(folder, c, w, np.log10(n / (total[rank] + weight)))
            replies = [pack(trie.find(x, y)) for x, y in zip(contexts, words)]
            del trie
        return pd.DataFrame({"chunk": part.chunk, "shard": part.shard, "reply": replies})

    return run


def _score(shards: int, hot: Hot, weight: float, tokens: int, vocabulary: int, train_docs: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        row = part[part.kind == "chunk"].iloc[0]
        chunk = Chunk(row.docs, row.words, row.tokens)
        replies = lambda kind, t: np.concatenate([unpack(x, t) for x in part[part.kind == kind].sort_values("shard").reply])
        counts = replies("word", np.int64)
        keys, contexts, words = chunk.pairs()
        owner = np.repeat(np.arange(len(chunk.docs), dtype=np.int32), chunk.docs["tokens"])
        codes = np.zeros(len(keys), np.uint16)
        codes[np.argsort(pair_shards(contexts, words, shards, hot), kind="stable")] = replies("pair", np.uint16)
        unigram = (counts + 1) / (tokens + vocabulary + 1)
        context = np.append(counts, train_docs)
        n = len(chunk.words) + 1
        pair = np.log10(probability(codes) + weight / (context[keys // n] + weight) * unigram[keys % n])
        docs, add = chunk.docs, lambda x: np.bincount(owner, x, minlength=len(chunk.docs))
        ids = pd.array(docs["id"].astype(np.int64), "Int64")
        ids[docs["null"] > 0] = pd.NA
        return pd.DataFrame({
            "doc_id": ids,
            "held_out": docs["train"] == 0, "n_tokens": docs["tokens"], "n_known": add((counts > 0)[chunk.tokens]).astype(np.int64),
            "train_tokens": tokens, "base_score": add(np.log10(unigram)[chunk.tokens]), "score": add(pair[np.unique(chunk.keys, return_inverse=True)[1]]),
        })

    return run


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score(docs: DataFrame, folds: int = 7, held_fold: int = 2, weight: float = 50.0, chunk_bytes: int = 8_000_000, shard_tokens: int = 1_000_000) -> DataFrame:
    """Every document scored by a model of those whose crc32(id as text) mod folds isn't held_fold."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(fold != held_fold, F.lit(True)).alias("train"), F.col("text").cast("binary").alias("raw"),
    )
    chunks = written(narrow.mapInArrow(tidy(_chunks(chunk_bytes)), CHUNK), "chunks")
    seen = chunks.agg(F.sum("train_tokens").alias("tokens"), F.sum("train_docs").alias("docs")).first()
    tokens, train_docs = int(seen.tokens or 0), int(seen.docs or 0)
    shards = max(8, -(-tokens // shard_tokens))
    share = max(1.0, tokens / shards / 4)  # a context above this is spread
    cut = chunks.select("chunk", "docs", "words", "tokens")
    asked = cut.mapInPandas(tidy(_ask_words(shards)), "chunk string, shard int, asked binary, counts binary")
    words = written(
        asked.groupBy("shard").applyInPandas(_answer_words(share), "chunk string, shard int, reply binary, known bigint, hot binary, hot_counts binary"), "words",
    )
    vocabulary = int(words.agg(F.sum("known")).first()[0] or 0)
    # at most 4 * shards contexts can have more than a fourth of a shard's tokens
    frequent = words.filter("hot IS NOT NULL").select("hot", "hot_counts").collect()
    hot = Hot(
        np.concatenate([np.frombuffer(r.hot, U64) for r in frequent] + [np.array([START], U64)]),
        np.concatenate([np.frombuffer(r.hot_counts, np.int64) for r in frequent] + [np.array([train_docs])]), share,
    )
    pairs = cut.mapInPandas(tidy(_ask_pairs(shards, hot)), "chunk string, shard int, contexts binary, runs binary, words binary, counts binary")
    pairs = pairs.groupBy("shard").applyInPandas(_answer_pairs(hot, weight), "chunk string, shard int, reply binary")
    none = F.lit(None).cast("binary")
    every = (
        cut.select("chunk", F.lit("chunk").alias("kind"), F.lit(0).alias("shard"), none.alias("reply"), "docs", "words", "tokens")
        .unionByName(words.select("chunk", F.lit("word").alias("kind"), "shard", "reply"), allowMissingColumns=True)
        .unionByName(pairs.select("chunk", F.lit("pair").alias("kind"), "shard", "reply"), allowMissingColumns=True)
    )
    return every.groupBy("chunk").applyInPandas(_score(shards, hot, weight, tokens, vocabulary, train_docs), RESULT)
