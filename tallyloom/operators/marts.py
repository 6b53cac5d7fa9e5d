"""Pre-aggregated marts. Monthly ones drop the partial last month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.dates import last_complete_month as last_complete
from tallyloom.functions.dates import month_label, month_start
from tallyloom.functions.numeric import money, rounded_ratio
from tallyloom.operators.facts import known_lines, line_cost
from tallyloom.operators.ordering import ranks
from tallyloom.sources.staging import kept


def last_complete_month(curated: DataFrame) -> DataFrame:
    return curated.agg(F.max("order_date").alias("d")).select(
        last_complete(F.col("d")).alias("cutoff_month")
    )


def _closed(curated: DataFrame) -> DataFrame:
    cutoff = last_complete_month(curated)  # one row
    return curated.crossJoin(F.broadcast(cutoff)).filter(
        F.col("order_date") <= F.last_day("cutoff_month")
    )


def monthly_revenue(curated: DataFrame) -> DataFrame:
    per_customer = (
        _closed(curated)
        .groupBy(month_start(F.col("order_date")).alias("order_month"), "customer_id")
        .agg(
            F.count("*").alias("orders"), F.sum("order_value").alias("value"),
            F.sum("order_profit").alias("profit"), F.sum("total_units").alias("units"),
        )
    )
    return per_customer.groupBy("order_month").agg(
        month_label(F.col("order_month")).alias("month_label"),
        F.year("order_month").alias("order_year"),
        F.month("order_month").alias("order_month_num"),
        F.sum("orders").alias("total_orders"),
        F.count("*").alias("active_customers"),
        money(F.sum("value")).alias("total_revenue"),
        money(F.sum("profit")).alias("total_profit"),
        rounded_ratio(F.sum("profit"), F.sum("value"), 4).alias("margin_pct"),
        rounded_ratio(F.sum("value"), F.sum("orders"), 2).alias("avg_order_value"),
        F.sum("units").alias("total_units"),
    )


def product_performance(items: DataFrame, products: DataFrame) -> DataFrame:
    """Every validated line counts, also lines whose order was not validated.

    Lines are unique per order and product, so orders per product is a count,
    and the sums run before the product attributes are joined.
    """
    sold = items.groupBy("product_id").agg(
        F.count("*").alias("orders_containing"),
        F.sum("quantity").alias("units_sold"),
        F.sum("line_net_amount").cast("decimal(28,2)").alias("total_revenue"),
    )
    revenue = F.col("total_revenue")
    cost = F.col("units_sold").cast("decimal(20,0)") * F.col("unit_cost")
    base = sold.join(products, "product_id").select(
        "product_id", "product_name", "product_category", "brand", "retail_price", "unit_cost",
        F.col("margin_pct").alias("product_margin_pct"),
        "orders_containing", "units_sold", "total_revenue",
        money(cost).alias("total_cost"),
        money(revenue - cost).alias("total_profit"),
        rounded_ratio(revenue - cost, revenue, 4).alias("realized_margin_pct"),
        rounded_ratio(revenue, F.col("orders_containing"), 2).alias("avg_line_revenue"),
        rounded_ratio(revenue, F.col("units_sold"), 2).alias("revenue_per_unit"),
    )
    # Read once per rank and once for the rows, so written first: one row per product.
    return ranks(kept(base, "product_totals"), {
        "revenue_rank": ("total_revenue", None),
        "units_rank": ("units_sold", None),
        "rank_within_category": ("total_revenue", "product_category"),
    })


def top_products(performance: DataFrame, rows: int = 15) -> DataFrame:
    """Best products by revenue; products tied with the last place are kept."""
    last = performance.orderBy(F.desc("total_revenue")).limit(rows).agg(F.min("total_revenue").alias("_cut"))
    return performance.crossJoin(F.broadcast(last)).filter("total_revenue >= _cut").drop("_cut")


def brand_profitability(priced: DataFrame) -> DataFrame:
    """Every validated line of a known product counts, with or without its order."""
    lines = known_lines(priced)
    revenue, cost = F.sum("value"), F.sum("cost")
    # Per brand and order first: the orders of a brand are then a plain count.
    per_order = lines.groupBy("brand", "order_id").agg(
        F.sum("quantity").alias("units"),
        F.sum("line_net_amount").alias("value"),
        F.sum(line_cost()).alias("cost"),
    )
    by_brand = per_order.groupBy("brand").agg(
        F.count("order_id").alias("orders_containing"),
        F.sum("units").alias("units_sold"),
        money(revenue).alias("total_revenue"),
        money(cost).alias("total_cost"),
        money(revenue - cost).alias("total_profit"),
        rounded_ratio(revenue - cost, revenue, 4).alias("brand_margin_pct"),
        rounded_ratio(revenue, F.sum("units"), 2).alias("revenue_per_unit"),
    )
    variety = lines.groupBy("brand", "product_id").agg(F.lit(1).alias("_sold")).groupBy(
        F.col("brand").alias("_brand")
    ).agg(F.count("*").alias("product_count"))
    whole = lines.agg(F.sum("line_net_amount").alias("_all"))
    return (
        by_brand.join(variety, F.col("brand").eqNullSafe(F.col("_brand")))
        .crossJoin(F.broadcast(whole))
        .withColumn("revenue_share", rounded_ratio(F.col("total_revenue"), F.col("_all"), 4))
        .drop("_all", "_brand")
    )


def _by_place(curated: DataFrame, place: list[str], names: dict[str, str]) -> DataFrame:
    placed = curated.filter("country IS NOT NULL")
    per_customer = placed.groupBy(*place, "customer_id").agg(
        F.count("*").alias("orders"), F.sum("order_value").alias("value"),
        F.sum("order_profit").alias("profit"),
    )
    value, profit = F.sum("value"), F.sum("profit")
    by_place = per_customer.groupBy(*place).agg(
        F.count("*").alias(names["customers"]),
        F.sum("orders").alias(names["orders"]),
        money(value).alias(names["revenue"]),
        money(profit).alias(names["profit"]),
        rounded_ratio(profit, value, 4).alias("margin_pct"),
        rounded_ratio(value, F.count("*"), 2).alias("arpu"),
        rounded_ratio(value, F.sum("orders"), 2).alias("avg_order_value"),
    )
    whole = placed.agg(F.sum("order_value").alias("_all"))
    return (
        by_place.crossJoin(F.broadcast(whole))
        .withColumn("revenue_share", rounded_ratio(F.col(names["revenue"]), F.col("_all"), 4))
        .drop("_all")
    )


def regional_performance(curated: DataFrame) -> DataFrame:
    return _by_place(
        curated, ["country", "state", "city"],
        {"customers": "customer_count", "orders": "order_count", "revenue": "total_revenue", "profit": "total_profit"},
    )


def country_summary(curated: DataFrame) -> DataFrame:
    return _by_place(
        curated, ["country"],
        {"customers": "customers", "orders": "orders", "revenue": "revenue", "profit": "profit"},
    )


def category_monthly_trend(priced: DataFrame, curated: DataFrame) -> DataFrame:
    # One row per order, category and brand before the join to the order dates.
    per_order = known_lines(priced).groupBy("order_id", "product_category", "brand").agg(
        F.sum("quantity").alias("units"), F.sum("line_net_amount").alias("value"),
        F.sum(line_cost()).alias("cost"),
    )
    value, cost = F.sum("value"), F.sum("cost")
    dated = per_order.join(_closed(curated.select("order_id", "order_date")), "order_id")
    return dated.groupBy(
        "product_category", "brand", month_start(F.col("order_date")).alias("order_month")
    ).agg(
        month_label(F.col("order_month")).alias("month_label"),
        F.count("*").alias("order_count"),
        F.sum("units").alias("units_sold"),
        money(value).alias("category_revenue"),
        money(value - cost).alias("category_profit"),
        rounded_ratio(value - cost, value, 4).alias("category_margin_pct"),
    )


def mart_row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count("*").alias("rows_count")).select(F.lit(name).alias("view_name"), "rows_count")
        for name, df in marts.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def last_month_check(monthly: DataFrame, trend: DataFrame) -> DataFrame:
    parts = [
        df.agg(F.max("order_month").alias("last_complete_month"))
        .select(F.lit(name).alias("view_name"), "last_complete_month")
        for name, df in (("v_monthly_revenue", monthly), ("v_category_monthly_trend", trend))
    ]
    return parts[0].unionByName(parts[1])
