"""Vector operators against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import neighbours, topk

VECTORS = "vec_id bigint, label int, embedding array<float>, node int"


def brute_links(rows, threshold=0.98):
    good = {}
    for i, label, v, *_ in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, np.float32).astype(float))
    links = {i: set() for i in good}
    for i, (a, x) in good.items():
        for j, (b, y) in good.items():
            if i != j and a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[i].add(j)
    top = {i: i for i in good}
    while True:
        new = {i: min([top[i], *(top[j] for j in links[i])]) for i in good}
        if new == top:
            return {i: (len(links[i]), top[i]) for i in good}
        top = new


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out, at = [], 0
    for label in (0, 1):
        for size in (300, 40, 7, 2, *[1] * 120):
            centre = rng.standard_normal(24)
            for _ in range(size):
                v = centre + rng.standard_normal(24) * rng.choice([0.0, 0.05, 0.12])
                out.append((at, label, [float(x) for x in v], 1))
                at += 1
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None, *[1.0] * 23], [float("inf")] * 24, [1.0, 2.0], [2.0, 4.0]]
    out += [(at + i, 0, v, 1) for i, v in enumerate(odd)]
    out.append((at + 50, None, out[0][2], 1))
    return out


def test_links_equal_brute_force(spark, rows):
    want = brute_links(rows)
    got = neighbours.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == want.get(r.vec_id, (0, r.vec_id)) and r.kept == (r.component_id == r.vec_id)


def test_links_of_odd_tables(spark):
    assert neighbours.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    big = 2**60 + 1
    rows = [(big, 1, [1.0, 0.0], 0), (big, 1, [1.0, 0.0], 0), (big + 1, 1, [2.0, 0.0], 0), (None, 1, [1.0, 0.0], 0), (5, 2, [1.0, 0.0], 0)]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in neighbours.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()), key=str)
    assert got == sorted([(big, 1, big), (big, 1, big), (big + 1, 1, big), (None, 0, None), (5, 0, 5)], key=str)


def test_links_of_one_large_label(spark):
    """Planted pairs next to hot groups, one tight and one wide, that take many blocks."""
    rng = np.random.default_rng(11)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    alone = unit(rng.standard_normal((4000, 32)))
    side = rng.standard_normal((400, 32))
    side = unit(side - (side * alone[:400]).sum(1, keepdims=True) * alone[:400])
    pairs = 0.981 * alone[:400] + math.sqrt(1 - 0.981**2) * side
    tight = unit(rng.standard_normal(32)) + 0.006 * rng.standard_normal((1500, 32))
    wide = unit(rng.standard_normal(32)) + 0.026 * rng.standard_normal((1500, 32))
    x = np.concatenate([alone, pairs, tight, wide, tight[:200]]).astype(np.float32)
    x = x[rng.permutation(len(x))]
    d = x.astype(float)
    d /= np.linalg.norm(d, axis=1, keepdims=True)
    near = d @ d.T >= 0.98
    n_links = near.sum(1) - 1
    top = np.arange(len(x))
    while True:
        new = np.where(near, top[None, :], len(x)).min(1)
        if (new == top).all():
            break
        top = new
    df = spark.createDataFrame([(i, 0, v.tolist(), 1) for i, v in enumerate(x)], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(df).collect()}
    lost = [i for i in got if got[i] != (n_links[i], top[i])]
    assert len(got) == len(x) and len(lost) <= 0.01 * (n_links > 0).sum() and all(got[i][0] <= n_links[i] for i in lost)


def test_tables_grow_with_the_code():
    counts = [neighbours.tables_for(bits, 0.98, 0.002) for bits in (1, 8, 16, 30)]
    assert counts == sorted(counts) and counts[0] < counts[-1]
    for bits, n in zip((1, 8, 16, 30), counts):
        assert (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** n <= 0.002


def test_a_search_that_loses_links_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(neighbours.Graph, "recall", lambda self, counts: 0.5)
    df = spark.createDataFrame([(1, 0, [1.0, 0.0], 0), (2, 0, [1.0, 0.01], 0)], VECTORS)
    with pytest.raises(RuntimeError):
        neighbours.near_duplicates(df, attempts=1)


def brute_top(rows, asks, k=10):
    ints = {i: [math.floor(1024 * float(np.float32(x))) for x in v] for i, _, v, *_ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in (i for i in ints if asks(i)):
        scores = sorted((-sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i != q and len(v) == len(ints[q]))
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize("block", [37, 4096])
def test_top_k_equals_brute_force(spark, rows, block):
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, block_rows=block, query_rows=11).collect()
    assert {tuple(r) for r in got} == brute_top(rows, lambda i: i % 20 == 0) and len(got) == len({tuple(r) for r in got})


def test_top_k_ties_zeros_and_large_values(spark):
    rows = [(i, 0, [float(i % 3), 0.0], 0) for i in range(40)] + [(100, 0, [0.0, 0.0], 0), (200, 0, [float(2**40), 1.0], 0), (300, 0, [1.0], 0)]
    got = topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0, block_rows=7).collect()
    assert {tuple(r) for r in got} == brute_top(rows, lambda i: i % 10 == 0)
    assert topk.top_k(spark.createDataFrame([], VECTORS), F.col("vec_id") % 10 == 0).count() == 0


def test_threshold_walk_stops_early():
    rng = np.random.default_rng(1)
    x = np.floor(1024 * np.abs(rng.standard_normal((4000, 3)))).astype(np.int64)
    _, scores, depth = topk.SortedLists(np.arange(4000), x).search(x[0], 0, 10)
    assert depth < 2000 and list(scores) == sorted((x[1:] @ x[0]).tolist(), reverse=True)[:10]
