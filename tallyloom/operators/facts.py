"""Order-grain and line-grain facts.

Lines are aggregated to orders before they meet the orders table: the partial
sums shrink a very large order before the shuffle, and the join that follows is
one row per order on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numeric import MONEY, money, rounded_ratio


def line_cost() -> Column:
    return F.col("quantity").cast("decimal(20,0)") * F.col("unit_cost")


def priced_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Validated lines with their product's attributes, NULL when it is unknown.

    ``copy`` numbers the rows of a repeated product key. The one join of lines
    to products; pass ``products`` as catalogue(products) in a stage table, so
    that the join reads it by a plain shuffle and a product holding very many
    lines can be split.
    """
    return items.drop("source_month", "cleaning_flags").join(
        products, F.col("product_id") == F.col("_product"), "left"
    ).withColumnRenamed("_product", "known_product")


def catalogue(products: DataFrame) -> DataFrame:
    """Product attributes, with the copies of a repeated product key numbered."""
    order = Window.partitionBy("product_id").orderBy("product_name", "brand", "unit_cost")
    return products.filter("product_id IS NOT NULL").select(
        F.col("product_id").alias("_product"), "product_name", "product_category", "brand", "unit_cost",
        F.col("margin_pct").alias("product_margin_pct"),
        F.row_number().over(order).alias("copy"),
    )


def order_totals(priced: DataFrame) -> DataFrame:
    """Per order: all validated lines, and the lines with a known product.

    One shuffle on order_id serves the exploration tables (all lines) and the
    curated fact (known products only).
    """
    known = F.col("known_product").isNotNull()
    once = ~known | (F.col("copy") == 1)
    net = F.col("line_net_amount")
    # The largest line decides; on a tie, the smallest product id.
    leading = F.struct((-net).alias("a"), F.col("product_id").alias("b"))
    return priced.groupBy("order_id").agg(
        F.count_if(once).alias("line_count"),
        F.sum(F.when(once, net)).cast(MONEY).alias("line_value"),
        F.count_if(known).alias("known_lines"),
        F.sum(F.when(known, net)).cast(MONEY).alias("order_value"),
        F.sum(F.when(known, line_cost())).alias("cost"),
        F.sum(F.when(known, F.col("quantity"))).alias("total_units"),
        F.count_if(F.col("copy") == 1).alias("distinct_products"),
        F.min_by(F.struct("product_category", "brand"), F.when(known, leading)).alias("lead"),
    )


def known_lines(priced: DataFrame) -> DataFrame:
    return priced.filter("known_product IS NOT NULL")


def sales_curated(orders: DataFrame, totals: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order that has at least one line with a known product."""
    places = customers.select(F.col("customer_id").alias("_customer"), "country", "state", "city")
    value, profit = F.col("order_value"), F.col("order_value") - F.col("cost")
    return (
        orders.join(totals.filter("known_lines > 0"), "order_id")
        .join(places, F.col("customer_id") == F.col("_customer"), "left")
        .select(
            "order_id", "customer_id", "order_date", "country", "state", "city",
            "order_discount_pct", "basket_item_count", "order_value",
            money(F.col("cost")).alias("order_cost"),
            money(profit).alias("order_profit"),
            rounded_ratio(profit, value, 4).alias("order_margin_pct"),
            "total_units", "distinct_products",
            F.col("lead.product_category").alias("dominant_category"),
            F.col("lead.brand").alias("dominant_brand"),
            "source_month",
        )
    )


def order_baskets(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Every validated order with its line count and value; 0 and NULL without lines."""
    return orders.join(totals.select("order_id", "line_count", "line_value"), "order_id", "left").select(
        "order_id", "customer_id", "order_date", "order_discount_pct", "basket_item_count",
        F.coalesce("line_count", F.lit(0)).alias("line_count"), "line_value",
    )


def items_for_bi(priced: DataFrame, curated: DataFrame) -> DataFrame:
    net = F.col("line_net_amount")
    profit = net - line_cost()
    return (
        known_lines(priced).join(curated.select("order_id", "customer_id", "order_date"), "order_id")
        .select(
            "order_id", "product_id", "customer_id", "order_date", "quantity", "line_net_amount",
            money(profit).alias("line_profit"),
            rounded_ratio(profit, net, 4).alias("line_margin_pct"),
        )
    )


def product_analytics(priced: DataFrame, curated: DataFrame) -> DataFrame:
    orders = curated.select(
        "order_id", "customer_id", "order_date", "country", "state", "city", "order_discount_pct",
        "order_value", "order_cost", "order_profit", "order_margin_pct",
    )
    return known_lines(priced).join(orders, "order_id").select(
        *orders.columns, "product_id", "product_name", "product_category", "brand",
        "product_margin_pct", "quantity", "unit_price",
        F.col("line_net_amount").alias("line_revenue"),
        money(line_cost()).alias("line_cost"),
        money(F.col("line_net_amount") - line_cost()).alias("line_profit"),
    )


def line_fact_totals(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.count("*").alias("line_rows"),
        money(F.sum("line_net_amount")).alias("total_revenue"),
        money(F.sum("line_profit")).alias("total_profit"),
    )
