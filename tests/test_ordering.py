"""Distributed positions against plain one-task windows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.operators.ordering import group_percentiles, ntiles, percentiles, rank_bands, ranks


def frame(spark, values):
    return spark.createDataFrame([(f"c{i}", v, f"g{i % 3}") for i, v in enumerate(values)], "id string, v decimal(18,2), g string")


def numbers(n, kind, seed=1):
    rng = random.Random(seed)
    if kind == "hot":  # a third and more share one value
        return [5 if rng.random() < 0.4 else rng.randrange(1000) for _ in range(n)]
    if kind == "equal":
        return [7] * n
    return [rng.randrange(10**6) / 100 for _ in range(n)]


def dec(values):
    from decimal import Decimal
    return [None if v is None else Decimal(str(v)) for v in values]


@pytest.mark.parametrize("n,tiles,kind", [(7, 5, "spread"), (3, 5, "spread"), (1, 10, "spread"), (500, 5, "hot"), (503, 10, "equal"), (401, 10, "spread")])
def test_ntiles_equal_the_plain_window(spark, n, tiles, kind):
    df = frame(spark, dec(numbers(n, kind)))
    got = ntiles(df, "id", {"up": "v", "down": "-v"}, tiles)
    want = got.withColumn("up2", F.ntile(tiles).over(Window.orderBy("v", "id"))).withColumn(
        "down2", F.ntile(tiles).over(Window.orderBy(F.desc("v"), "id")))
    rows = want.collect()
    assert all(r.up == r.up2 and r.down == r.down2 for r in rows)
    sizes = [sum(r.up == t for r in rows) for t in range(1, tiles + 1)]
    assert max(sizes) - min(sizes) <= 1


def test_seven_rows_in_five_tiles(spark):
    rows = ntiles(frame(spark, dec(range(7))), "id", {"t": "v"}, 5).collect()
    assert [sum(r.t == t for r in rows) for t in range(1, 6)] == [2, 2, 1, 1, 1]


@pytest.mark.parametrize("n,kind", [(1, "spread"), (2, "spread"), (250, "hot"), (333, "spread")])
def test_percentiles_equal_the_exact_aggregate(spark, n, kind):
    df = frame(spark, dec(numbers(n, kind, 3)))
    at = ["0.10", "0.25", "0.50", "0.90", "0.99"]
    got = percentiles(df, F.col("v"), at)
    want = df.agg(F.percentile("v", F.array(*[F.lit(float(p)) for p in at])).alias("p")).first().p
    assert [round(float(got[p]), 6) for p in at] == [round(w, 6) for w in want]


def test_percentiles_of_nothing(spark):
    assert percentiles(frame(spark, [None, None]), F.col("v"), ["0.5"]) == {}


def test_bands_share_ranks_and_blanks_come_last(spark):
    df = frame(spark, dec([100, 50, 50, None]))
    value = F.coalesce("v", F.lit(0).cast("decimal(18,2)"))
    got = df.withColumn("d", rank_bands(df, value, 10)).orderBy("id").collect()
    assert [r.d for r in got] == [1, 3, 3, 8]


@pytest.mark.parametrize("kind", ["hot", "spread", "equal"])
def test_bands_equal_the_plain_rank(spark, kind):
    df = frame(spark, dec(numbers(317, kind, 5)))
    plain = F.rank().over(Window.orderBy(F.desc("v")))
    rows = df.withColumn("d", rank_bands(df, F.col("v"), 10)).withColumn("r", plain).collect()
    assert all(r.d == (r.r - 1) * 10 // 317 + 1 for r in rows)


@pytest.mark.parametrize("kind", ["hot", "spread", "equal"])
def test_ranks_equal_the_plain_window(spark, kind):
    df = frame(spark, dec(numbers(200, kind, 9) + [None, None]))
    got = ranks(df, {"r": ("v", None), "rg": ("v", "g")})
    rows = got.withColumn("r2", F.rank().over(Window.orderBy(F.desc("v")))).withColumn(
        "rg2", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))).collect()
    assert len(rows) == 202 and all(r.r == r.r2 and r.rg == r.rg2 for r in rows)


@pytest.mark.parametrize("kind", ["hot", "equal", "spread"])
def test_group_percentiles_equal_interpolation(spark, kind):
    import numpy as np

    values = numbers(700, kind)
    rows = [(f"g{i % 3}" if i % 11 else None, "h" if i % 2 else "k", v, None if i % 3 == 1 else v * 2) for i, v in enumerate(values)]
    df = spark.createDataFrame([(g, h, *dec([v, w])) for g, h, v, w in rows], "g string, h string, v decimal(18,2), w decimal(18,2)")
    sets = [["g", "h"], ["g"], ["h"], []]
    got = group_percentiles(df, ["g", "h"], sets, {"v_mid": ("v", "0.5"), "v_high": ("v", "0.9"), "w_low": ("w", "0.125")}).collect()
    want = {}
    for g, h, v, w in rows:
        for key in ((g, h, 0), (g, None, 1), (None, h, 2), (None, None, 3)):
            want.setdefault(key, ([], []))[0].append(v)
            if w is not None:
                want[key][1].append(w)
    assert len(got) == len(want)
    for r in got:
        v, w = want[r.g, r.h, r.grouping]
        assert float(r.v_mid) == pytest.approx(np.percentile(v, 50)) and float(r.v_high) == pytest.approx(np.percentile(v, 90))
        assert (r.w_low is None) if not w else float(r.w_low) == pytest.approx(np.percentile(w, 12.5))


def test_group_percentiles_of_few_rows(spark):
    wanted = {"low": ("v", "0"), "mid": ("v", "0.5"), "high": ("v", "1")}
    df = spark.createDataFrame([(g, *dec([v])) for g, v in [("a", None), ("b", 3), ("c", 1), ("c", 2)]], "g string, v decimal(18,2)")
    got = {r.g: tuple(r[2:]) for r in group_percentiles(df, ["g"], [["g"]], wanted).collect()}
    assert {g: tuple(None if x is None else float(x) for x in r) for g, r in got.items()} == {"a": (None, None, None), "b": (3, 3, 3), "c": (1, 1.5, 2)}
    assert group_percentiles(df.limit(0), ["g"], [["g"], []], wanted).count() == 0
