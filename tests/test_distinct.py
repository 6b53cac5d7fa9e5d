"""Merged bitmaps against plain distinct counts."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.distinct import bitmaps, distinct_counts, numbered

SCHEMA = "month string, place string, who string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    out = [(f"2001-{rng.randrange(1, 13):02d}", rng.choice(["n", "s", None]), rng.choice([f"c{rng.randrange(900)}", "hot", None])) for _ in range(4000)]
    return [*out, ("2002-01", "x", None)]


def test_numbers_are_dense(spark, rows):
    got = sorted((r.value, r.number) for r in numbered(spark.createDataFrame(rows, SCHEMA), "who").collect())
    assert got == [(v, i) for i, v in enumerate(sorted({r[2] for r in rows if r[2]}), 1)]


def test_counts_of_every_level(spark, rows):
    maps = bitmaps(spark.createDataFrame(rows, SCHEMA), ["month", "place"], "who")
    by = {"year": F.substring("month", 1, 4), "place": F.col("place")}
    got = {(r.year, r.place, r.grouping): r["values"] for r in distinct_counts(maps, by, [["year", "place"], ["year"], ["place"], []]).collect()}
    want = {}
    for month, place, who in rows:
        for key in ((month[:4], place, 0), (month[:4], None, 1), (None, place, 2), (None, None, 3)):
            want.setdefault(key, set()).update({who} - {None})
    assert got == {k: len(v) for k, v in want.items()} and got["2002", "x", 0] == 0


def test_more_values_than_one_range(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("who"))
    got = {r.g: r.n for r in distinct_counts(bitmaps(df, ["g"], "who"), {"g": F.col("g")}, [["g"], []], "n").collect()}
    assert got == {0: 33334, 1: 33333, 2: 33333, None: 100_000}


def test_two_tables_share_numbers(spark):
    one = spark.createDataFrame([("a", "x"), ("b", "x")], "who string, g string")
    two = spark.createDataFrame([("b", "x"), ("z", "x")], "who string, g string")
    numbers = numbered(one.union(two), "who")
    both = bitmaps(one, ["g"], "who", numbers).unionAll(bitmaps(two, ["g"], "who", numbers))
    assert distinct_counts(both, {"g": F.col("g")}).first()["values"] == 3


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert distinct_counts(bitmaps(df, ["month"], "who"), {"month": F.col("month")}).count() == 0
