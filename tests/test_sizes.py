"""What a shop writes and shuffles: each row once, in parts that don't grow with the input's files."""

from __future__ import annotations

import os
from collections import Counter

from pyspark.sql import functions as F

from tallyloom.functions.rows import settled
from tallyloom.operators import audit, cleaning, measures
from tallyloom.plans import build
from tallyloom.plans.build import Shop, feed_tables
from tallyloom.sources import feed

SF = "/root/testdata/sf0.001"


def shop(spark):
    return Shop(spark, SF, feed_tables(spark, SF))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_raw_and_cleaned_rows_are_not_written(spark):
    s = shop(spark)
    assert s.items.count() > 0 and s.orders.count() > 0
    assert set(os.listdir(s.folder)) == {"items_validated", "orders_validated"}
    s.close()


def test_parts_follow_the_size_of_the_facts(spark, monkeypatch):
    size = feed.fact_bytes(spark, SF)
    assert size == sum(os.path.getsize(f"{SF}/{t}.parquet") for t in ("orders", "lineitem"))
    monkeypatch.setattr(build, "PART_BYTES", size // 9)
    s = shop(spark)
    assert s.parts == 9
    # a file per bucket: no task holds rows of several
    assert s.costed.count() > 0
    for stage in ("items_validated", "costed_items"):
        buckets = Counter(f.split("_")[-1].split(".")[0] for f in os.listdir(f"{s.folder}/{stage}") if f.endswith(".parquet"))
        assert set(buckets.values()) == {1} and len(buckets) == 9
    s.close()


def test_lines_are_not_sorted_before_they_are_dealt(spark):
    s = shop(spark)
    text = plan(cleaning.items_validated(s.items_cleaned, 7))
    dealt = text.index("hashpartitioning(order_id")
    assert "Window" not in text[dealt:] and "Sort " not in text[dealt:] and text.count("Exchange") == 1
    plain = cleaning.items_validated(s.items_cleaned)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cleaning.items_validated(s.items_cleaned, 7).collect()))
    s.close()


def test_measures_of_customers_build_no_lines(spark):
    s = shop(spark)
    assert measures.evaluate(s.star, ["avg_r_score"], ["customer.city"]).count() > 0
    assert "lines" not in s.__dict__ and "retention" not in s.__dict__
    s.close()


def test_audit_shuffles_lines_once(spark):
    s = shop(spark)
    customers = spark.createDataFrame([("1",)], "CustomerID string")
    products = spark.createDataFrame([("1",)], "ProductID string")
    found = [audit._raw_item_checks(audit.RawSource(s.raw_orders, s.raw_items, customers, products, None, parts), s.cfg, True) for parts in (None, 5)]
    assert all(plan(df).count("FileScan") == 2 for df in found)  # one scan counts, one has the keys
    assert sorted(map(str, found[0].collect())) == sorted(map(str, found[1].collect()))
    s.close()


def test_settled_columns_keep_names_types_and_values(spark):
    df = spark.createDataFrame([(1, "a"), (None, None)], "n int, `b c` string").withColumn("x", F.col("n") + 1)
    out = settled(df)
    assert out.dtypes == df.dtypes and sorted(map(str, out.collect())) == sorted(map(str, df.collect()))
    assert "Generate inline" in plan(out.filter("x > 0"))
