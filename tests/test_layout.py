"""The line-grain stages are laid out by order id."""

from __future__ import annotations

from tallyloom.operators import facts
from tallyloom.plans.build import shop_of

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_on_order_id(spark):
    shop = shop_of(spark, SF)
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(facts.order_totals(shop.priced))
        assert "Exchange" not in plan(facts.items_for_bi(shop.priced, shop.curated))
        assert "Exchange" not in plan(facts.product_analytics(shop.priced, shop.curated))
        assert "Exchange" not in plan(facts.order_baskets(shop.orders, shop.order_totals))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
