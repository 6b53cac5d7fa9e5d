"""Rules of facts, scores, marts and lifecycle on small tables."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyloom.config import RetailConfig
from tallyloom.functions.dates import last_complete_month
from tallyloom.functions.text import clean_text, parse_date
from tallyloom.operators import dimensions, explore, facts, lifecycle, measures, rfm

D = Decimal


def small_shop(spark):
    orders = spark.createDataFrame(
        [("O1", "C1", date(2024, 1, 31), D("0.1"), 2, "202401"), ("O2", "C1", date(2024, 3, 1), D("0"), 1, "202403"),
         ("O3", "C2", date(2024, 3, 15), None, 1, "202403"), ("O4", "C9", date(2024, 2, 1), D("0.5"), 3, "202402"),
         ("O5", "C2", date(2024, 3, 16), None, 1, "202403")],
        "order_id string, customer_id string, order_date date, order_discount_pct decimal(10,9), basket_item_count bigint, source_month string")
    items = spark.createDataFrame(
        [("O1", "P2", 1, D("5"), D("5")), ("O1", "P1", 2, D("2.5"), D("5")), ("O2", "P1", 1, D("10"), D("10.50")),
         ("O3", "PX", 1, D("9"), D("9")), ("O4", "P2", 4, D("25"), D("100")), ("O7", "P1", 1, D("1"), D("1"))],
        "order_id string, product_id string, quantity bigint, unit_price decimal(18,2), line_net_amount decimal(18,2)")
    products = spark.createDataFrame(
        [("P1", "one", "A", "x", D("5"), D("1.5"), D("0.7")), ("P2", "two", "B", "y", D("30"), D("20"), D("0.3"))],
        "product_id string, product_name string, product_category string, brand string, retail_price decimal(18,4), unit_cost decimal(18,4), margin_pct decimal(18,4)")
    customers = spark.createDataFrame(
        [("C1", "DE", "BY", "M"), ("C2", "AT", "W", "W"), ("C3", None, None, None)],
        "customer_id string, country string, state string, city string")
    return orders, items, products, customers


def curated_of(spark):
    orders, items, products, customers = small_shop(spark)
    totals = facts.order_totals(facts.priced_items(items, facts.catalogue(products)))
    return facts.sales_curated(orders, totals, customers), facts.order_baskets(orders, totals)


def test_curated_orders(spark):
    curated, baskets = curated_of(spark)
    rows = {r.order_id: r for r in curated.collect()}
    assert set(rows) == {"O1", "O2", "O4"}  # no lines, or unknown products only
    o1 = rows["O1"]
    assert (o1.order_value, o1.order_cost, o1.order_profit) == (D("10.00"), D("23.00"), D("-13.00"))
    assert (o1.total_units, o1.distinct_products, o1.order_margin_pct) == (3, 2, D("-1.3000"))
    assert (o1.dominant_category, o1.dominant_brand) == ("A", "x")  # tie on 5.00: smaller product id
    assert rows["O4"].country is None and rows["O1"].country == "DE"
    by_order = {r.order_id: r for r in baskets.collect()}
    assert (by_order["O3"].line_count, by_order["O3"].line_value) == (1, D("9.00"))
    assert (by_order["O5"].line_count, by_order["O5"].line_value) == (0, None)


def test_repeated_product_key_counts_one_product(spark):
    orders, items, products, customers = small_shop(spark)
    doubled = products.unionByName(products.filter("product_id = 'P1'"))
    totals = facts.order_totals(facts.priced_items(items, facts.catalogue(doubled)))
    o1 = facts.sales_curated(orders, totals, customers).filter("order_id = 'O1'").first()
    assert (o1.distinct_products, o1.order_value) == (2, D("15.00"))  # the sum fans out, the count does not
    assert facts.order_baskets(orders, totals).filter("order_id = 'O1'").first().line_count == 2


def test_both_grains_agree(spark):
    orders, items, products, customers = small_shop(spark)
    curated, _ = curated_of(spark)
    lines = facts.items_for_bi(facts.priced_items(items, facts.catalogue(products)), curated)
    assert {r.order_id for r in lines.collect()} == {"O1", "O2", "O4"}
    assert facts.line_fact_totals(lines).first().total_revenue == curated.agg(F.sum("order_value")).first()[0]


def test_scores_segments_and_labels(spark):
    rows = [(f"C{i}", date(2024, 1, 1), date(2024, 1, 1), 100 - i, i, D(i), D(1), D("0.1"), D(1), 1, D(1), None, None, None) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "customer_id string, data_as_of_date date, last_order_date date, recency_days bigint, frequency_orders bigint, monetary_value decimal(18,2), total_profit decimal(18,2), avg_margin_pct decimal(28,4), avg_order_value decimal(28,2), total_units bigint, avg_products_per_order decimal(28,1), primary_country string, primary_state string, primary_city string")
    out = {r.customer_id: r for r in rfm.rfm_customer_segments(df, RetailConfig()).collect()}
    assert (out["C1"].rfm_cell, out["C1"].rfm_segment) == ("R01F01M01", "Hibernating")
    assert (out["C10"].rfm_cell, out["C10"].rfm_segment, out["C10"].rfm_total_score) == ("R05F05M05", "Champions", 15)
    assert out["C5"].snapshot_date == date(2026, 9, 30)


def test_segment_bands(spark):
    df = spark.createDataFrame([(t,) for t in range(3, 16)], "t int").select("t", rfm._banded(F.col("t"), 1).alias("s"))
    got = {r.t: r.s for r in df.collect()}
    assert [got[t] for t in (13, 12, 11, 10, 9, 8, 7, 6, 5, 4, 3)] == [
        "Champions", "Loyal Customers", "Loyal Customers", "Potential Loyalists", "Potential Loyalists",
        "Recent Customers", "Recent Customers", "At Risk", "At Risk", "Hibernating", "Hibernating"]


def test_buckets_and_bins(spark):
    df = spark.createDataFrame([(d,) for d in (29, 30, 89, 90, 364, 365, 730)], "d int")
    got = [r[0][:2] for r in df.select(explore.recency_bucket(F.col("d"))).collect()]
    assert got == ["01", "02", "02", "03", "04", "05", "06"]
    bins = spark.createDataFrame([(29,), (30,), (91,), (None,)], "d int").select(measures.recency_bin(F.col("d"))).collect()
    assert [r[0] for r in bins] == [0, 30, 90, None]


@pytest.mark.parametrize("last,want", [("2026-03-15", date(2026, 2, 1)), ("2024-02-29", date(2024, 2, 1)), ("2024-01-05", date(2023, 12, 1))])
def test_last_complete_month(spark, last, want):
    assert spark.range(1).select(last_complete_month(F.lit(last).cast("date"))).first()[0] == want


def test_cohorts_start_whole_and_revenue_adds_up(spark):
    curated, _ = curated_of(spark)
    months = lifecycle.customer_months(curated)
    retention = lifecycle.cohort_retention(months).collect()
    assert all(r.retention_rate == 1.0 for r in retention if r.months_since_acquisition == 0)
    assert {(r.cohort_month, r.months_since_acquisition) for r in retention} == {
        (date(2024, 1, 1), 0), (date(2024, 1, 1), 2), (date(2024, 2, 1), 0)}
    split = lifecycle.revenue_new_returning(months)
    assert split.agg(F.sum("revenue")).first()[0] == curated.agg(F.sum("order_value")).first()[0]
    assert {(r.customer_type, r.revenue) for r in split.collect()} == {("New", D("10.00")), ("New", D("100.00")), ("Returning", D("10.50"))}


def test_standardised_customers(spark):
    raw = spark.createDataFrame(
        [(" C1 ", "2024-1-5", "a", " Ann ", "", "", None, "DE", "", "X", " "), ("", "2024", "a", None, None, "e", "p", "", None, "", "")],
        ", ".join(f"{c} string" for c in dimensions.CUSTOMER_COLUMNS))
    one, two = dimensions.standardize_customers(raw).collect()
    assert (one.customer_id, one.signup_date, one.full_name, one.email) == ("C1", date(2024, 1, 5), "Ann", None)
    assert (two.customer_id, two.signup_date, two.full_name) == (None, None, "")


def test_customers_without_orders_keep_their_row(spark):
    _, _, _, customers = small_shop(spark)
    scored = spark.createDataFrame([("C1", "XX", "YY", "ZZ", "Champions", 3)], "customer_id string, country string, state string, city string, segment string, order_count bigint")
    rows = {r.customer_id: r for r in dimensions.dim_customers_for_bi(customers, scored).collect()}
    assert rows["C1"].country == "DE" and rows["C1"].segment == "Champions"
    assert len(rows) == 3 and rows["C3"].segment is None


def test_text_helpers(spark):
    df = spark.createDataFrame([(" a b ",), ("\t",), (None,), ("2024-03",), ("2024-3-9",)], "x string")
    assert [r[0] for r in df.select(clean_text(F.col("x"))).collect()] == ["a b", None, None, "2024-03", "2024-3-9"]
    assert [r[0] for r in df.select(parse_date(F.col("x"))).collect()] == [None, None, None, None, date(2024, 3, 9)]
