"""Committed stages: reuse by a later session, months rewritten alone, runs that break off."""

from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from tallyloom.config import FEED_CONFIG
from tallyloom.plans.build import PROPERTIES, READS, RawTables, Shop, feed_tables
from tallyloom.sources.staging import inputs
from tallyloom.sources.store import StageStore, content_marks

SF = "/root/testdata/sf0.001"


def shop(spark, root, raw=None, cfg=FEED_CONFIG):
    """As a session of its own: nothing is known but the folder."""
    return Shop(spark, SF, raw or feed_tables(spark, SF), cfg, store=StageStore(spark, str(root)))


def build_all(s):
    return {label: getattr(s, PROPERTIES.get(label, label)) for label in READS}


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def changed_orders(spark, month="199605"):
    raw = feed_tables(spark, SF)
    return RawTables(raw.orders.withColumn("CustomerID", F.when(F.col("source_month") == month, F.lit("7")).otherwise(F.col("CustomerID"))), raw.items, raw.customers, raw.products)


def test_a_second_session_reuses_every_stage(spark, tmp_path):
    first = shop(spark, tmp_path)
    rows = {label: sorted(map(str, df.collect())) for label, df in build_all(first).items()}
    plain = Shop(spark, SF, feed_tables(spark, SF))
    assert rows == {label: sorted(map(str, getattr(plain, PROPERTIES.get(label, label)).collect())) for label in READS}
    there = files(tmp_path)
    for name in first.names:
        spark.sql(f"DROP TABLE {name}")  # another session has no such table
    second = shop(spark, tmp_path)
    for label, df in build_all(second).items():
        assert sorted(map(str, df.collect())) == rows[label]
    assert files(tmp_path) == there and second.versions == first.versions
    joined = second.orders.join(second.order_totals, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in joined  # still bucketed
    for a, df in build_all(second).items():  # what a stage is said to read is what its files come from
        assert all(f"/{a}/" in f for f in df.inputFiles())


def test_a_changed_month_rewrites_what_depends_on_it(spark, tmp_path):
    first = shop(spark, tmp_path)
    build_all(first)
    other = shop(spark, tmp_path, changed_orders(spark))
    tables = build_all(other)
    for label in ("raw_orders", "orders_cleaned"):
        assert {m for m, v in other.versions[label].items() if v != first.versions[label][m]} == {"199605"}
    same = {label for label in READS if other.versions[label] == first.versions[label]}
    assert same == {"raw_items", "raw_customers", "raw_products", "items_cleaned", "items_validated", "customers", "products", "catalogue", "priced_items", "order_totals"}
    plain = Shop(spark, SF, changed_orders(spark))
    for label in ("orders_cleaned", "sales_curated", "rfm_customer_segments"):
        assert sorted(map(str, tables[label].collect())) == sorted(map(str, getattr(plain, PROPERTIES.get(label, label)).collect()))
    before = files(tmp_path)
    other.store.purge()
    assert len(files(tmp_path)) < len(before) and set(tables["sales_curated"].inputFiles()) <= {f"file://{f}" for f in files(tmp_path)}
    assert tables["orders_cleaned"].count() == 1500


def test_settings_make_other_versions(spark, tmp_path):
    first = shop(spark, tmp_path)
    first.orders_cleaned
    late = shop(spark, tmp_path, cfg=dataclasses.replace(FEED_CONFIG, min_order_date=FEED_CONFIG.as_of_date))
    late.orders_cleaned
    assert late.versions["raw_orders"] == first.versions["raw_orders"]
    assert not set(late.versions["orders_cleaned"].values()) & set(first.versions["orders_cleaned"].values())


def test_a_run_that_breaks_off_leaves_the_last_state(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    df = spark.createDataFrame([("a", "202301"), ("b", "202302"), ("c", None)], "x string, source_month string")
    store.raw_months("t", df)
    more = df.unionAll(spark.createDataFrame([("d", "202302"), ("e", "202303")], df.schema))

    class Broken(StageStore):
        def commit(self, label, entry):
            raise OSError("lost")

    with pytest.raises(OSError):
        Broken(spark, str(tmp_path)).raw_months("t", more)
    known = store.entry("t")["months"]
    table, _ = store.months("t", {m: key for m, (key, _) in known.items()}, lambda: df, files=store.entry("t")["files"])
    assert sorted(map(tuple, table.collect()), key=str) == sorted([("a", "202301"), ("b", "202302"), ("c", None)], key=str)
    again, versions = store.raw_months("t", more)
    assert again.count() == 5 and versions["202301"] == known["202301"][1]
    store.purge()
    assert again.count() == 5
    fewer, versions = store.raw_months("t", more.filter("source_month <> '202301'"))
    assert fewer.count() == 3 and "202301" not in versions


def test_marks_follow_rows(spark):
    a = spark.createDataFrame([("a", None), (None, "a")], "x string, source_month string")
    assert content_marks(a) != content_marks(a.select(F.lit(None).cast("string").alias("x"), F.lit("a").alias("source_month")).limit(1))
    assert content_marks(a, "source_month") == content_marks(a.orderBy("x"), "source_month")
    assert inputs(a) == ((), ())
