"""Every registered query against its SQL twin, invariants, and the measure layer."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tallyloom.operators import measures as m
from tallyloom.plans.build import shop_of
from tallyloom.plans.queries import all_queries
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    found = difference(QUERIES[name](spark, SF), con, SQL[name])
    assert found is None, found


def test_every_query_has_sql(spark):
    assert set(all_queries()) <= set(SQL) <= set(QUERIES)
    rows = QUERIES["x4_pilot_intervals"](spark, SF).collect()
    assert all(r.lower <= r.per_euro <= r.upper for r in rows)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 6


def test_invariants(spark):
    shop = shop_of(spark, SF)
    assert m.evaluate(shop.star, ["grain_reconciliation"]).first()[0] == 0
    assert shop.retention.filter("months_since_acquisition = 0 AND retention_rate <> 1.0").count() == 0
    total = m.evaluate(shop.star, ["total_revenue", "lifecycle_revenue"]).first()
    assert total.total_revenue == total.lifecycle_revenue
    assert shop.dim_customers.count() == shop.customers.count()


def test_filters_follow_the_paths(spark):
    star = shop_of(spark, SF).star
    every = m.evaluate(star, ["total_revenue", "line_revenue"]).first()
    brand = m.evaluate(star, ["total_revenue", "line_revenue"], (), {"product.brand": ["Brand#1"]}).first()
    assert brand.total_revenue == every.total_revenue  # orders have no path from products
    assert brand.line_revenue < every.line_revenue
    by_brand = m.evaluate(star, ["total_revenue", "line_revenue"], ["product.brand"])
    assert {r.total_revenue for r in by_brand.collect()} == {every.total_revenue}


def test_kpi_selector_falls_back_to_revenue(spark):
    star = shop_of(spark, SF).star
    assert m.kpi_selector(star, "no such KPI").first().value == m.kpi_selector(star).first().value
    assert m.kpi_selector(star, "Total Customers").first().value == m.evaluate(star, ["total_customers"]).first()[0]


def test_rolling_window_guards(spark):
    rows = m.rolling_12m(shop_of(spark, SF).star, "start_of_month").collect()
    values = [r.revenue_rolling_12m for r in rows]
    assert values[:11] == [None] * 11 and values[-1] is None and values[11] is not None


def test_no_filter_flags_without_filters(spark):
    row = m.filter_flags(shop_of(spark, SF).star).first()
    assert (row.region_filter_active, row.country_filter_active) == (0, 0)


def scans_of(df, column):
    """Table scans in the plan that read the column."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return sum(1 for line in plan.splitlines() if "Scan" in line and column in line)


def test_contexts_share_one_scan(spark):
    star = shop_of(spark, SF).star
    where = {"customer.country": ["EUROPE"], "customer.state": ["NATION_3"]}
    assert scans_of(m.map_shares(star, ("EUROPE", "ASIA"), where), "order_value") == 1
    levels = [["customer.segment", "customer.country"], ["customer.segment"], []]
    assert scans_of(m.evaluate_levels(star, ["total_revenue", "avg_order_value"], levels[0], levels), "order_value") == 1


def test_contexts_equal_one_evaluation_each(spark):
    star = shop_of(spark, SF).star
    some = spark.createDataFrame([("EUROPE",), ("EUROPE",), (None,)], "country string")
    contexts = {"every": {}, "framed": {"customer.country": some}, "none": {"customer.country": ["no such"]}, "brand": {"product.brand": ["Brand#1"]}}
    row = m.evaluate_contexts(star, ["total_revenue", "distinct_orders"], contexts).first()
    for name, where in contexts.items():
        one = m.evaluate(star, ["total_revenue", "distinct_orders"], (), where).first()
        assert row[f"{name}_total_revenue"] == one.total_revenue and (row[f"{name}_distinct_orders"] or 0) == (one.distinct_orders or 0)
    assert not row.none_seen and row.every_seen
    with pytest.raises(ValueError):
        m.evaluate_contexts(star, ["total_revenue", "line_revenue"], contexts)
    with pytest.raises(ValueError):
        m.evaluate_levels(star, ["total_revenue"], ["product.brand"], [[]])


def test_subtotals_add_up(spark):
    star = shop_of(spark, SF).star
    by = ["customer.segment", "customer.country"]
    rows = m.evaluate_levels(star, ["total_revenue"], by, [by, by[:1], []]).collect()
    sums = [sum(r.total_revenue or 0 for r in rows if r.grouping == g) for g in (0, 1, 3)]
    assert len(set(sums)) == 1 and sum(r.grouping == 3 for r in rows) == 1
