"""Exploration tables. All read order_baskets: one row per validated order.

Orders without lines have no order value; they count as orders and customers in
the frequency, recency and basket tables only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.config import RECENCY_BUCKETS, REVENUE_TILES
from tallyloom.functions.dates import month_label, month_start
from tallyloom.functions.numeric import MONEY, money, rounded_mean, rounded_ratio, share_pct
from tallyloom.operators.ordering import ntiles, percentiles
from tallyloom.sources.staging import kept

PERCENTILES = {"p10": "0.10", "p25": "0.25", "median": "0.50", "p75": "0.75", "p90": "0.90", "p99": "0.99"}


def with_lines(baskets: DataFrame) -> DataFrame:
    return baskets.filter("line_count > 0").withColumnRenamed("line_value", "order_value")


def _country(customers: DataFrame) -> DataFrame:
    return customers.select(F.col("customer_id").alias("_customer"), "country")


def order_value_distribution(baskets: DataFrame) -> DataFrame:
    orders = with_lines(baskets)
    cuts = percentiles(orders, F.col("order_value"), list(PERCENTILES.values()))
    summary = orders.agg(
        F.min("order_value").alias("min_value"),
        F.max("order_value").alias("max_value"),
        rounded_mean(F.col("order_value"), 2).alias("mean_value"),
        F.count("*").alias("order_count"),
    )
    points = [
        F.round(F.lit(cuts.get(p)).cast("decimal(38,8)"), 2).cast(MONEY).alias(name)
        for name, p in PERCENTILES.items()
    ]
    return summary.select(*points, "min_value", "max_value", "mean_value", "order_count")


def p99_of(baskets: DataFrame) -> Column:
    cut = percentiles(with_lines(baskets), F.col("order_value"), ["0.99"]).get("0.99")
    return F.round(F.lit(cut).cast("decimal(38,8)"), 2).cast(MONEY)


def order_value_outliers(baskets: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders above the 99th percentile: about one in a hundred, sorted by value."""
    p99 = p99_of(baskets)
    return (
        with_lines(baskets).filter(F.col("order_value") > p99)
        .join(_country(customers), F.col("customer_id") == F.col("_customer"), "left")
        .select(
            "order_id", "customer_id", "order_date", "country", "order_value",
            p99.alias("p99_threshold"),
            rounded_ratio(F.col("order_value"), p99, 2).alias("multiple_of_p99"),
        )
        .orderBy(F.desc("order_value"), "order_id")
    )


def largest_outliers(outliers: DataFrame, rows: int = 5) -> DataFrame:
    return outliers.orderBy(F.desc("order_value"), "order_id").limit(rows)


def country_breakdown(baskets: DataFrame, customers: DataFrame) -> DataFrame:
    # Customers first: a country's orders meet the country as one row per customer.
    per_customer = with_lines(baskets).groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum("order_value").alias("value")
    )
    by_country = (
        per_customer.join(_country(customers), F.col("customer_id") == F.col("_customer"), "left")
        .groupBy("country")
        .agg(
            F.sum("orders").alias("order_count"),
            F.count("*").alias("customer_count"),
            rounded_ratio(F.sum("value"), F.sum("orders"), 2).alias("avg_order_value"),
            money(F.sum("value")).alias("total_revenue"),
        )
    )
    whole = with_lines(baskets).agg(F.sum("order_value").alias("_all"))
    return (
        by_country.crossJoin(F.broadcast(whole))
        .withColumn("revenue_share_pct", share_pct(F.col("total_revenue"), F.col("_all")))
        .drop("_all").orderBy(F.desc("total_revenue"))
    )


def monthly_temporal_pattern(baskets: DataFrame) -> DataFrame:
    """Every month, the partial last one included."""
    per_customer = (
        with_lines(baskets)
        .groupBy(month_label(F.col("order_date")).alias("year_month"), "customer_id")
        .agg(F.count("*").alias("orders"), F.sum("order_value").alias("value"))
    )
    return (
        per_customer.groupBy("year_month")
        .agg(
            F.sum("orders").alias("order_count"),
            F.count("*").alias("active_customers"),
            money(F.sum("value")).alias("monthly_revenue"),
            rounded_ratio(F.sum("value"), F.sum("orders"), 2).alias("avg_order_value"),
        )
        .orderBy("year_month")
    )


def customer_frequency_distribution(baskets: DataFrame) -> DataFrame:
    per_customer = baskets.groupBy("customer_id").agg(F.count("*").alias("order_count"))
    # Written, so that the total does not count the orders again.
    by_count = kept(
        per_customer.groupBy("order_count").agg(F.count("*").alias("customers_with_this_count")), "frequency"
    )
    whole = by_count.agg(F.sum("customers_with_this_count").alias("_all"))
    return (
        by_count.crossJoin(F.broadcast(whole))
        .withColumn("pct_of_customers", share_pct(F.col("customers_with_this_count"), F.col("_all")))
        .drop("_all").orderBy("order_count")
    )


def recency_bucket(days: Column) -> Column:
    out = None
    for edge, name in RECENCY_BUCKETS[:-1]:
        out = F.when(days < edge, name) if out is None else out.when(days < edge, name)
    return out.otherwise(RECENCY_BUCKETS[-1][1])


def recency_distribution(baskets: DataFrame) -> DataFrame:
    last = baskets.groupBy("customer_id").agg(F.max("order_date").alias("last_order_date"))
    anchor = baskets.agg(F.max("order_date").alias("anchor"))
    days = F.datediff("anchor", "last_order_date")
    return (
        last.crossJoin(F.broadcast(anchor)).withColumn("days", days)
        .groupBy(recency_bucket(F.col("days")).alias("recency_bucket"))
        .agg(
            F.count("*").alias("customer_count"),
            F.min("days").alias("min_days"),
            F.max("days").alias("max_days"),
        )
        .orderBy("recency_bucket")
    )


def pareto_concentration(baskets: DataFrame) -> DataFrame:
    """Revenue by customer revenue decile; equal spend is ordered by customer id."""
    spend = kept(
        with_lines(baskets).groupBy("customer_id").agg(F.sum("order_value").cast("decimal(28,2)").alias("total_spend")),
        "customer_spend",
    )
    tiled = ntiles(spend, "customer_id", {"revenue_decile": "-total_spend"}, REVENUE_TILES)
    by_decile = tiled.groupBy("revenue_decile").agg(
        F.count("*").alias("customers_in_decile"), money(F.sum("total_spend")).alias("decile_revenue")
    )
    whole = spend.agg(F.sum("total_spend").alias("_all"))
    return (
        by_decile.crossJoin(F.broadcast(whole))
        .withColumn("pct_of_total_revenue", share_pct(F.col("decile_revenue"), F.col("_all")))
        .drop("_all").orderBy("revenue_decile")
    )


def cumulative_concentration(pareto: DataFrame) -> DataFrame:
    """Running share over the ten deciles."""
    running = Window.orderBy("revenue_decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return pareto.select(
        "revenue_decile",
        F.sum("pct_of_total_revenue").over(running).cast("decimal(28,2)").alias("cumulative_pct"),
    )


def basket_composition(baskets: DataFrame, customers: DataFrame) -> DataFrame:
    declared, actual = F.col("basket_item_count"), F.col("line_count")
    per_customer = baskets.groupBy("customer_id").agg(
        F.count("*").alias("orders"),
        F.sum(actual).alias("lines"),
        F.sum(declared).alias("declared_sum"),
        F.count(declared).alias("declared_n"),
        F.count_if(actual != declared).alias("mismatches"),
    )
    return (
        per_customer.join(_country(customers), F.col("customer_id") == F.col("_customer"), "left")
        .groupBy("country")
        .agg(
            F.sum("orders").alias("order_count"),
            F.sum("lines").alias("line_count"),
            rounded_ratio(F.sum("lines"), F.sum("orders"), 2).alias("avg_items_per_order"),
            rounded_ratio(F.sum("declared_sum"), F.sum("declared_n"), 2).alias("avg_declared_items_per_order"),
            F.sum("mismatches").alias("declared_actual_mismatch_count"),
            share_pct(F.sum("mismatches"), F.sum("orders")).alias("declared_actual_mismatch_pct"),
        )
        .orderBy(F.desc("avg_items_per_order"), "country")
    )


def population_split(baskets: DataFrame) -> DataFrame:
    """Orders with lines, all orders, and the difference."""
    counts = baskets.agg(
        F.count_if(F.col("line_count") > 0).alias("with_lines"), F.count("*").alias("all_orders")
    )
    return counts.select(
        F.expr(
            "stack(3, 'Item-bearing orders', with_lines, 'All validated orders', all_orders, "
            "'Delta: itemless orders', all_orders - with_lines) as (population, orders)"
        )
    )


def month_coverage(baskets: DataFrame) -> DataFrame:
    """Days of each month inside the data's span, partial edges and missing months."""
    orders = with_lines(baskets)
    span = orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    months = span.select(
        "first_day", "last_day",
        F.explode(F.expr("sequence(trunc(first_day, 'MM'), trunc(last_day, 'MM'), interval 1 month)")).alias("month"),
    )
    seen = orders.groupBy(month_start(F.col("order_date")).alias("month")).agg(F.count("*").alias("orders"))
    covered = F.datediff(
        F.least(F.last_day("month"), F.col("last_day")), F.greatest(F.col("month"), F.col("first_day"))
    ) + 1
    return months.join(seen, "month", "left").select(
        month_label(F.col("month")).alias("year_month"),
        F.day(F.last_day("month")).alias("days_in_month"),
        covered.alias("days_covered"),
        (covered < F.day(F.last_day("month"))).alias("is_partial"),
        F.col("orders").isNull().alias("is_gap"),
    ).orderBy("year_month")
