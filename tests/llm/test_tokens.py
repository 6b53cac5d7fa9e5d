"""Tokens, packing, language model and mixing against the library, formulas and naive versions."""

from __future__ import annotations

import base64
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import bpe, lm, mixing, packing
from tallyloom.llm.common import word_count

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id bigint, text string, source string, tokens int, size int"
ODD = [
    None, "", " ", "  \n x", "a" * 1500, "I'll  we've\t\tx  ﷐ y  ", " \U000113a7a 1\U00010d40 　　z", "\x00a\x85 b",
    "don’t 12345 \U0001f600\U0001f600  ", "\n\n\n", "x \n", "日本語 中文" * 50, "THE cat THE cat", "word " * 30_000,
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, library):
    rows = [(i, t, "s", 1, 2) for i, t in enumerate(ODD)] + [(None, "no id", "s", 1, 2), (3, ODD[3], "s", 1, 2)]
    coded = bpe.encode(spark.createDataFrame(rows, DOCS), RANKS, most_bytes=2000)
    out = {(r.doc_id, bytes(r.decoded)): r.tokens for r in coded.collect()}
    assert out == {(i, (t or "").encode()): library.encode_ordinary(t or "") for i, t, *_ in rows}
    back = {(r.doc_id, bytes(r.decoded)) for r in bpe.decode(coded.unionByName(spark.createDataFrame([(99, None, None)], coded.schema)), RANKS).collect()}
    assert back == set(out) | {(99, b"")}
    assert bpe.encode(spark.createDataFrame([], DOCS), RANKS).count() == 0


def test_every_code_point_is_cut_as_by_the_library(library):
    cut = bpe.Session(bpe.Ranks(RANKS))
    import pyarrow as pa

    texts = ["".join(f"a{chr(c)}a{chr(c)}{chr(c)} {chr(c)}1" for c in range(at, at + 64) if not 0xD800 <= c < 0xE000) for at in range(0, 0x30000, 64)]
    ids, plain = cut.encode(pa.array(texts))
    assert ids.to_pylist() == [library.encode_ordinary(t) for t in texts] and plain.to_pylist() == [t.encode() for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_decreasing_is_best_fit(lengths):
    rows = packing.best_fit_decreasing(np.array(lengths, np.int64), 40)
    assert sorted(p for r in rows for p in r) == list(range(len(lengths)))
    free: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((f for f in free if f >= n), default=None)
        free.remove(fit) if fit is not None else None
        free.append((40 if fit is None else fit) - n)
    assert sorted(free) == sorted(40 - sum(lengths[p] for p in r) for r in rows)


def test_packing_loses_nothing(spark, library):
    rows = [(i, t, "s", 1, 2) for i, t in enumerate(ODD)]
    packed = packing.pack(spark.createDataFrame(rows, DOCS), RANKS, public_tokenizers.PATTERN, size=64, group_tokens=3000).collect()
    got = defaultdict(list)
    for r in packed:
        assert len(r.ids) == 128 and r.cu_seqlens[-1] == r.n_tokens <= 64 and r.resets == r.cu_seqlens[:-1]
        assert list(packing.positions(r.cu_seqlens, 64)[r.resets]) == [0] * len(r.resets)
        for i, start, part in zip(r.doc_ids, r.starts, packing.unpack_row(bytes(r.ids), r.cu_seqlens)):
            got[i].append((start, part.tolist()))
    for i, t, *_ in rows:
        assert [x for _, p in sorted(got[i]) for x in p] == [*library.encode_ordinary(t or ""), 50_256]
    assert packing.pack(spark.createDataFrame([], DOCS), RANKS, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=80), st.integers(1, 64))
def test_elias_fano_finds_places(tmp_path_factory, values, bits):
    x = np.array(sorted({v % 2**bits for v in values}), np.uint64)
    file = tmp_path_factory.mktemp("ef") / "x"
    lm.EliasFano.write(x, 2**bits, file)
    ef = lm.EliasFano.open(file)
    assert ef.find(x).tolist() == list(range(len(x)))
    others = np.array([v for v in (0, 1, 5, 2**bits - 1, 2**63) if v not in set(x.tolist())], np.uint64)
    assert (ef.find(others) == -1).all()


def test_language_model_equals_the_formula(spark):
    rng = random.Random(8)
    words = ["the", "THE", *(f"w{k}" for k in range(60))]
    rows = [(i, " ".join(rng.choices(words, [30, 5, *[1] * 60], k=rng.randrange(0, 80)))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "the " * 5000), (1003, "never seen before"), (None, "the w1 w2"), (1002, "w1 w2")]
    texts = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    train = [w for i, w in texts if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    one = Counter(x for w in train for x in w)
    two = Counter(p for w in train for p in zip([None, *w[:-1]], w))
    n, v, m = sum(one.values()), len(one), 50.0
    uni = lambda x: (one[x] + 1) / (n + v + 1)
    seen = lambda h: len(train) if h is None else one[h]
    want = sorted(
        (str(i), len(w), sum(one[x] > 0 for x in w), sum(math.log10(uni(x)) for x in w),
         sum(math.log10((two[h, x] + m * uni(x)) / (seen(h) + m)) for h, x in zip([None, *w[:-1]], w))) for i, w in texts
    )
    docs = spark.createDataFrame([(*r, "s", 1, 2) for r in rows], DOCS)
    for chunk_bytes, shard_tokens in ((2000, 500), (10**8, 10**8)):
        out = lm.score(docs, chunk_bytes=chunk_bytes, shard_tokens=shard_tokens).collect()
        assert {r.train_tokens for r in out} == {n}
        got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in out)
        for a, b in zip(got, want, strict=True):
            assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-6) and a[4] == pytest.approx(b[4], abs=1e-4 * b[1] + 1e-6)
    assert lm.score(docs.filter(F.lit(False))).count() == 0


def naive_seats(weights, caps, seats):
    got = [0] * len(weights)
    for _ in range(min(seats, sum(c for c, w in zip(caps, weights) if w > 0))):
        i = max((i for i in range(len(weights)) if got[i] < caps[i] and weights[i] > 0), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[i] += 1
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 30)), min_size=1, max_size=12), st.integers(0, 120))
def test_sainte_lague_equals_highest_quotients(parties, seats):
    weights, caps = [float(w) for w, _ in parties], [c for _, c in parties]
    got = mixing.sainte_lague(weights, caps, seats)
    assert sum(got) == sum(naive_seats(weights, caps, seats))
    if len({w for w in weights if w > 0}) == sum(w > 0 for w in weights):
        assert got == naive_seats(weights, caps, seats)


def test_mix_meets_targets(spark):
    rng = random.Random(2)
    sizes = {"a": 4000, "b": 300, "": 900, None: 2500, "zé": 60, "c": 0}
    rows, at = [], 0
    for source, words in sizes.items():
        while words > 0:
            n = min(words, rng.randrange(1, 90))
            rows.append((at, " ".join(["w"] * n), source, 0, 7))
            words, at = words - n, at + 1
    rows += [(at, None, "c", 0, 7), (at + 1, " ", "a", 0, 7), (5, rows[5][1], rows[5][2], 0, 7), (None, "x y z", "b", 0, 7)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("n", word_count(F.col("text")))
    mix = lambda: mixing.mix(docs, "source", "n", ["doc_id", "text"], rows_per_shard=40).collect()
    out = mix()
    assert len(out) == len(rows) and sorted(map(str, out)) == sorted(map(str, mix()))
    order = sorted((s for s in sizes if s is not None)) + [None]
    held, goal, got = Counter(), {}, Counter()
    for r in out:
        held[r.row.source] += r.size
        got[r.row.source] += r.taken
        goal[r.row.source] = r.target
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.full * r.size + sum(s.hi - s.lo for s in r.spans)
    want = mixing.targets([held[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5, 2)
    assert [goal[s] for s in order] == want and sum(want) == pytest.approx(1.5 * sum(held.values()))
    shards = {s: 1 + sum(r.row.source == s for r in out) // 40 for s in order}
    assert all(abs(got[s] - goal[s]) <= 17 * (1 + shards[s]) for s in order)
    assert mixing.mix(docs.filter(F.lit(False)), "source", "n", ["doc_id"]).count() == 0


def test_mixed_texts_hold_the_words_taken(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(5 + i)), "ab"[i % 2], 1, 2) for i in range(60)] + [(100, None, "a", 1, 2), (101, "", None, 1, 2)]
    docs = spark.createDataFrame(rows, DOCS)
    taken = Counter()
    for r in mixing.mix(docs.withColumn("n", word_count(F.col("text"))).withColumn("h", F.xxhash64("text")), "source", "n", ["doc_id", "h"]).collect():
        taken[r.row.doc_id] += r.taken
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert set(r.text.split()) <= set(rows[r.doc_id][1].split())
    assert words == +taken
