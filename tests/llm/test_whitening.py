"""Whitening against brute force over every row."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from tallyloom.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, key int, x string, n int"


def brute(rows, once=False):
    """vec_id -> (n, deviation, [(value up to sign, explained)]) from exact sums over the fit list."""
    good = [(i, [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = [x for _, x in good] if not once else [list(x) for x in {tuple(x) for _, x in good}]
    n, d = len(fit), len(fit[0])
    s = [sum(x[k] for x in fit) for k in range(d)]
    v = np.array([[float(sum((x[i] - Fraction(s[i], n)) * (x[j] - Fraction(s[j], n)) for x in fit) / n) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    mean = np.array([float(Fraction(a, n)) for a in s])
    return [(i, n, sum((n * a - b) ** 2 for a, b in zip(x, s)), (np.array(x) - mean) @ u / np.sqrt(e), e / e.sum()) for i, x in good]


def table(seed=3, size=60, dims=12):
    rng = np.random.default_rng(seed)
    base = [[float(c) for c in rng.standard_normal(dims) * np.linspace(1, 0.1, dims)] for _ in range(size)]
    rows = [(i, base[i % size if i < size else i % 3], 1, "a", 2) for i in range(2 * size)]  # a third of all rows are copies of three
    odd = [None, [], [None, *[1.0] * (dims - 1)], [float("nan")] * dims, [float("-inf"), *[0.0] * (dims - 1)]]
    return rows + [(1000 + i, v, 1, None, 2) for i, v in enumerate(odd)] + [(None, base[0], None, None, None), (0, base[1], 0, "", 0)]


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_equals_brute_force(spark, weights):
    rows = table()
    want = sorted(brute(rows, weights == "one"), key=lambda r: (r[0] is None, r[0], r[2]))
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA), weights=weights).collect()
    assert len(got) == 8 * len(want)
    signs = {}
    by = {}
    for r in got:
        by.setdefault((r.vec_id is None, r.vec_id, int(r.deviation)), []).append(r)
        assert r.n == want[0][1] and r.identity_error < 1e-9
    for i, n, far, z, explained in want:
        found = by[(i is None, i, far)]
        for r in found:
            k = r.component - 1
            signs.setdefault(k, 1 if abs(r.whitened - z[k]) < abs(r.whitened + z[k]) else -1)
            assert r.whitened == pytest.approx(signs[k] * z[k], rel=1e-6, abs=1e-7) and r.explained == pytest.approx(explained[k], rel=1e-9)


def test_tables_without_variance(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1, "", 1), (2, [1e38, 1.0], 1, "", 1)], SCHEMA)).count() == 0
    same = whitening.whiten(spark.createDataFrame([(i, [0.5, 1.0], 0, "", 0) for i in range(3)], SCHEMA)).collect()
    assert {(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 3, 0, None, None, None), (2, 3, 0, None, None, None)}
    line = whitening.whiten(spark.createDataFrame([(i, [i / 4, i / 2], 0, "", 0) for i in range(5)], SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-9 for r in line)


def test_lengths_must_agree(spark):
    with pytest.raises(ValueError, match="2 to 3 entries"):
        whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0), (2, [1.0, 2.0, 3.0], 0, "", 0)], SCHEMA))


def test_products_stay_exact():
    for size in (3, 2**28, 2**45):
        a = np.array([[size, -1], [size - 1, 7]], np.int64)
        w = np.array([3, 2**20], np.int64)
        want = [[sum(int(w[r]) * int(a[r, i]) * int(a[r, j]) for r in range(2)) for j in range(2)] for i in range(2)]
        assert whitening._product(a, a, w).tolist() == want
