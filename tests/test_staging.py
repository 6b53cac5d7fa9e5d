"""Stages follow settings and inputs; scratch tables are reused and deleted."""

from __future__ import annotations

import dataclasses
import os
import shutil
from datetime import date

from pyspark.sql import functions as F

from tallyloom.config import FEED_CONFIG
from tallyloom.operators import cleaning
from tallyloom.operators.ordering import percentiles
from tallyloom.plans.build import forget, shop_of
from tallyloom.plans.queries import all_queries
from tallyloom.sources.staging import inputs, kept, shared_folder

SF = "/root/testdata/sf0.001"


def folders(spark):
    return set(os.listdir(shared_folder(spark)))


def test_settings_have_stages_of_their_own(spark):
    early = shop_of(spark, SF, dataclasses.replace(FEED_CONFIG, as_of_date=date(1998, 1, 31)))
    late = shop_of(spark, SF)
    assert (early.orders_cleaned.count(), late.orders_cleaned.count()) == (679, 1500)
    assert shop_of(spark, SF) is late


def test_changed_input_is_read_anew(spark, tmp_path):
    copy = str(tmp_path / "sf")
    os.mkdir(copy)
    for name in os.listdir(SF):  # contents only: the inputs may be read-only
        shutil.copyfile(f"{SF}/{name}", f"{copy}/{name}")
    before = shop_of(spark, copy)
    assert before.raw_orders.count() == 1500 and shop_of(spark, copy) is before
    os.remove(f"{copy}/orders.parquet")
    spark.read.parquet(f"{SF}/orders.parquet").limit(100).write.parquet(f"{copy}/orders.parquet")
    after = shop_of(spark, copy)
    assert after is not before and after.raw_orders.count() == 100 and not os.path.exists(before.folder)


def test_second_call_writes_nothing_new(spark):
    for name in ("e7_pareto_concentration", "m3_product_performance", "b14_customer_decile", "s1_shard_load", "s1_shard_load_items"):
        query = all_queries()[name]
        first = query(spark, SF)
        rows, there = sorted(map(str, first.collect())), folders(spark)
        assert sorted(map(str, query(spark, SF).collect())) == rows and folders(spark) == there
        assert sorted(map(str, first.collect())) == rows  # still readable


def test_scratch_tables_go(spark):
    df = spark.range(7).selectExpr("id * 2 AS x")
    again = kept(df, "scratch-test")
    assert kept(spark.range(7).selectExpr("id * 2 AS x"), "scratch-test").inputFiles() == again.inputFiles()
    assert kept(spark.range(7).selectExpr("id * 3 AS x"), "scratch-test").inputFiles() != again.inputFiles()
    forget(spark)
    assert not any(f.startswith("scratch-test") for f in folders(spark))


def test_overwritten_input_is_another_input(spark, tmp_path):
    path = str(tmp_path / "numbers")
    for first in (0, 1000):
        spark.range(first, first + 100).withColumn("v", F.col("id").cast("double")).write.mode("overwrite").parquet(path)
        spark.catalog.refreshByPath(path)
        got = percentiles(spark.read.parquet(path), F.col("v"), ["1/2"])
        assert float(got["1/2"]) == first + 49.5
    single = f"{path}/{next(f for f in os.listdir(path) if f.endswith('.parquet'))}"
    state = inputs(spark.read.parquet(single))
    os.utime(single, (1, 1))
    assert inputs(spark.read.parquet(single)) != state


def test_months_get_a_folder_and_filters_prune_them(spark):
    shop = shop_of(spark, SF)
    for df in (cleaning.orders_intake(shop.raw_orders, shop.cfg), shop.items_cleaned.filter("source_month = '199605'")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(source_month" in plan
    assert len(shop.raw_items.filter("source_month = '199605'").inputFiles()) > 50  # listed, not read
    assert shop.raw_items.columns[-1] == "source_month" and shop.orders_cleaned.columns[1] == "source_month"


def test_lines_of_every_month_are_kept(spark):
    shop = shop_of(spark, SF)
    assert shop.items_intake.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    window = shop_of(spark, SF, dataclasses.replace(FEED_CONFIG, as_of_date=date(2001, 9, 30)))
    assert window.items_intake.count() < shop.items_intake.count()
