"""Pilot readout against brute force on a small fixture."""

from __future__ import annotations

import hashlib
import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import pilot


@pytest.fixture(scope="module")
def customers(spark):
    rng = random.Random(4)
    rows = []
    for i in range(240):
        segment, group, rate, _ = pilot.PILOT_GROUPS[i % 5]
        value = rng.choice([0, 0, 1]) * rng.expovariate(1 / 80)
        rows.append((f"c{i}", segment, group, rate, value * (0.5 - rate) + rate * 6, rate * value))
    return spark.createDataFrame(rows, "customer_id string, segment string, group string, rate double, x double, d double")


def effect(rows, weight, segment, group):
    pick = lambda g: [(weight(r), r) for r in rows if r.segment == segment and r.group == g]
    offer, hold = pick(group), pick("holdout")
    n, nh = sum(w for w, _ in offer), sum(w for w, _ in hold)
    gap = sum(w * r.x for w, r in offer) / n - sum(w * r.x for w, r in hold) / nh
    return gap * n / sum(w * r.d for w, r in offer)


OFFERS = [(s, g) for s, g, _, _ in pilot.PILOT_GROUPS if g != "holdout"]


def test_readout_equals_brute_force(customers):
    rows = customers.collect()
    got = {(r.segment, r["group"]): r.per_euro for r in pilot.readout(customers).collect()}
    assert got == {k: pytest.approx(effect(rows, lambda r: 1, *k), abs=1e-7) for k in OFFERS}


def test_replicates_equal_brute_force(spark, customers):
    weights = {}
    for r in customers.collect():
        share, term, k = int(hashlib.md5(f"42|3|{r.customer_id}".encode()).hexdigest()[:13], 16) / 2**52, math.exp(-1), 0
        reached = term
        while share >= reached:
            k += 1
            term /= k
            reached += term
        weights[r.customer_id] = k
    assert 0.8 < sum(weights.values()) / len(weights) < 1.2 and max(weights.values()) > 1
    got = {(r.segment, r["group"]): r.per_euro for r in pilot.replicates(customers, 3).filter("draw = 3").collect()}
    rows = customers.collect()
    assert got == {k: pytest.approx(effect(rows, lambda r: weights[r.customer_id], *k)) for k in OFFERS}


def test_acceleration_equals_the_jackknife(customers):
    rows = customers.collect()
    got = {(r.segment, r["group"]): r.a for r in pilot.acceleration(customers).collect()}
    for key in OFFERS:
        used = [r for r in rows if r.segment == key[0] and r.group in (key[1], "holdout")]
        left = [effect([r for r in rows if r is not out], lambda r: 1, *key) for out in used]
        mean = sum(left) / len(left)
        cube, square = sum((mean - t) ** 3 for t in left), sum((mean - t) ** 2 for t in left)
        assert got[key] == pytest.approx(cube / (6 * square ** 1.5), rel=1e-6)


def interval(estimate, draws, a):
    """BCa interval from replicate values, in plain Python."""
    normal, ordered, size = NormalDist(), sorted(draws), len(draws)
    below = sum(d < estimate for d in ordered) + sum(d == estimate for d in ordered) / 2
    z0 = normal.inv_cdf(min(max(below / size, 0.5 / size), 1 - 0.5 / size))

    def end(p):
        z = z0 + normal.inv_cdf(p)
        at = normal.cdf(z0 + z / (1 - a * z)) * (size - 1)
        low = min(int(at), size - 1)
        return ordered[low] + (ordered[min(low + 1, size - 1)] - ordered[low]) * (at - low)

    return end(0.025), end(0.975)


def test_intervals_equal_plain_python(spark):
    rng = random.Random(9)
    spread = [rng.gauss(0.3, 1) for _ in range(400)]
    groups = {"even": (0.5, [i / 1000 for i in range(1001)], 0.0), "biased": (0.9, spread, 0.04), "skewed": (-2.0, spread, -0.08),
              "beyond": (99.0, spread, None), "ties": (1.0, [1.0, 1.0, 2.0], float("nan")), "one": (3.0, [4.0], 0.1)}
    points = spark.createDataFrame([(k, e) for k, (e, _, _) in groups.items()] + [("none", None), ("undrawn", 1.0)], "k string, estimate double")
    draws = spark.createDataFrame([(k, v) for k, (_, vs, _) in groups.items() for v in [*vs, None]], "k string, value double")
    skews = spark.createDataFrame([(k, a) for k, (_, _, a) in groups.items()], "k string, a double")
    got = {r.k: (r.lower, r.upper) for r in pilot.intervals(points, draws, skews, ["k"]).collect()}
    assert set(got) == set(groups)
    for k, (e, vs, a) in groups.items():
        assert got[k] == pytest.approx(interval(e, vs, a if a and a == a else 0.0), abs=1e-9)
    assert got["even"] == pytest.approx((0.025, 0.975), abs=1e-6)


def test_normal_functions(spark):
    normal = NormalDist()
    rows = spark.range(-70, 71).select((F.col("id") / 10).alias("x")).select("x", pilot.normal_cdf(F.col("x")).alias("p")).collect()
    assert all(r.p == pytest.approx(normal.cdf(r.x), abs=1e-14) for r in rows)
    rows = spark.range(1, 2000).select((F.col("id") / 2000).alias("p")).select("p", pilot.normal_quantile(F.col("p")).alias("z")).collect()
    assert all(r.z == pytest.approx(normal.inv_cdf(r.p), abs=1e-9) for r in rows)


def test_intervals_hold_the_estimate(customers):
    rows = pilot.pilot_intervals(customers, draws=100).collect()
    assert len(rows) == 3 and all(r.lower <= r.per_euro <= r.upper for r in rows)


def test_contrasts_equal_brute_force(customers):
    rows = customers.collect()
    one = lambda rs, s, g: effect(rs, lambda r: 1, s, g)
    mean = lambda rs, s, g: (lambda v: sum(v) / len(v))([r.x for r in rs if (r.segment, r.group) == (s, g)])
    stat = {
        "rate_per_euro": lambda rs: one(rs, "Hibernating", "offer_15") - one(rs, "Hibernating", "offer_20"),
        "rate_per_customer": lambda rs: mean(rs, "Hibernating", "offer_15") - mean(rs, "Hibernating", "offer_20"),
        "priority_at_15": lambda rs: one(rs, "At Risk", "offer_15") - one(rs, "Hibernating", "offer_15"),
        "priority_at_20": lambda rs: one(rs, "At Risk", "offer_15") - one(rs, "Hibernating", "offer_20"),
    }
    got = {r.contrast: r for r in pilot.pilot_decisions(customers, draws=100).collect()}
    skews = pilot.contrast_accelerations(customers).first().asDict()
    for name, f in stat.items():
        assert got[name].value == pytest.approx(f(rows), abs=1e-5) and got[name].lower <= got[name].value <= got[name].upper
        assert got[name].decided == (got[name].lower > 0)
        (s1, g1), (s2, g2), _ = pilot.CONTRASTS[name]
        used = [r for r in rows if (r.segment == s1 and r.group in (g1, "holdout")) or (r.segment == s2 and r.group in (g2, "holdout"))]
        left = [f([r for r in rows if r is not out]) for out in used]
        middle = sum(left) / len(left)
        cube, square = sum((middle - t) ** 3 for t in left), sum((middle - t) ** 2 for t in left)
        assert skews[name] == pytest.approx(cube / (6 * square**1.5), rel=1e-5, abs=1e-9)


def test_groups_split_every_eligible_customer(spark):
    segments = spark.createDataFrame([(f"c{i}", s) for i in range(600) for s in ("At Risk", "Hibernating", "Champions")], "customer_id string, rfm_segment string")
    counts = {(r.segment, r["group"]): r["count"] for r in pilot.assigned(segments).groupBy("segment", "group").count().collect()}
    assert sum(counts.values()) == 1200 and len(counts) == 5
    assert 250 < counts[("At Risk", "holdout")] < 350 and 150 < counts[("Hibernating", "offer_15")] < 250
