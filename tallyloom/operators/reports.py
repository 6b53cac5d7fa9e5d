"""The report's queries: axes and measures of each chart and table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tallyloom.config import DEFAULT_REACTIVATION_RATE, PARETO_THRESHOLD, WIN_BACK_SEGMENTS
from tallyloom.functions.dates import month_start
from tallyloom.functions.numeric import ratio
from tallyloom.operators import measures as m
from tallyloom.operators.measures import Star, evaluate

SCORE_AXES = {"R Score": "r_score", "F Score": "f_score", "M Score": "m_score"}


def weekly_revenue(star: Star) -> DataFrame:
    return m.rolling_12m(star, "start_of_week")


def revenue_and_customers_by_segment(star: Star) -> DataFrame:
    return evaluate(star, ["total_revenue", "total_customers"], ["customer.segment"])


def segment_profile(star: Star) -> DataFrame:
    """Per segment and in total; the total row has no segment and is marked."""
    names = ["total_customers", "avg_r_score", "avg_f_score", "avg_m_score", "total_revenue"]
    rows = m.evaluate_levels(star, names, ["customer.segment"], [["customer.segment"], []])
    return rows.select("segment", *names, F.col("grouping").cast("int").alias("is_total"))


def matrix_with_totals(star: Star) -> DataFrame:
    """The profitability matrix with its subtotals: products within brands within categories, and all."""
    axes = ["product.product_category", "product.brand", "product.product_id"]
    return m.evaluate_levels(
        star, ["line_revenue", "line_profit", "line_margin_pct", "line_quantity"], axes, [axes[:n] for n in range(len(axes), -1, -1)]
    )


def top_products(star: Star, rows: int = 15) -> DataFrame:
    """Best product names by line revenue; names tied with the last place are kept."""
    by_name = evaluate(star, ["line_revenue"], ["product.product_name"])
    last = by_name.orderBy(F.desc("line_revenue")).limit(rows).agg(F.min("line_revenue").alias("_cut"))
    return by_name.crossJoin(F.broadcast(last)).filter("line_revenue >= _cut").drop("_cut")


def recency_histogram(star: Star) -> DataFrame:
    return evaluate(star, ["total_customers"], ["customer.recency_bin"]).filter("recency_bin IS NOT NULL")


def revenue_by_score(star: Star, axis: str = "R Score") -> DataFrame:
    column = SCORE_AXES[axis]
    return evaluate(star, ["total_revenue"], [f"customer.{column}"]).filter(f"{column} IS NOT NULL")


def revenue_by_every_score(star: Star) -> DataFrame:
    parts = [
        revenue_by_score(star, axis).select(
            F.lit(axis).alias("axis"), F.col(column).alias("score"), "total_revenue"
        )
        for axis, column in SCORE_AXES.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def revenue_by_brand(star: Star) -> DataFrame:
    brands = m.brand_margins(star)
    baseline = brands.agg(
        F.coalesce(ratio(F.sum("line_profit"), F.sum("line_revenue")), F.lit(0.0)).alias("margin_baseline")
    )
    return brands.crossJoin(F.broadcast(baseline))


def revenue_by_decile(star: Star) -> DataFrame:
    """Spend per decile with its running share; ten rows."""
    deciles = m.with_decile(star.customers).groupBy("customer_decile").agg(
        F.count("*").alias("customers"), F.sum("total_spend").alias("total_revenue")
    )
    whole = star.customers.agg(F.sum("total_spend").alias("_all"))
    running = Window.orderBy("customer_decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return deciles.crossJoin(F.broadcast(whole)).select(
        "customer_decile", "customers", "total_revenue",
        ratio(F.sum("total_revenue").over(running), F.col("_all")).alias("cumulative_revenue_pct"),
        F.lit(PARETO_THRESHOLD).alias("pareto_threshold"),
    )


def recency_stages(star: Star) -> DataFrame:
    row = evaluate(star, ["revenue_active", "revenue_cooling", "revenue_dormant"])
    whole = " + ".join(f"coalesce({c}, 0)" for c in row.columns)
    return row.selectExpr(
        f"stack(3, 1, 'Active', revenue_active, {whole}, 2, 'Cooling', revenue_cooling, {whole}, "
        f"3, 'Dormant', revenue_dormant, {whole}) as (stage_order, stage, revenue, _all)"
    ).select("stage_order", "stage", "revenue", ratio(F.col("revenue"), F.col("_all")).alias("share"))


# --- one customer --------------------------------------------------------------

def customer_kpis(star: Star, customer: DataFrame) -> DataFrame:
    return evaluate(
        star, ["total_revenue", "total_orders", "avg_order_value", "profit_margin_pct"],
        (), {"customer.customer_id": customer},
    ).crossJoin(F.broadcast(m.customer_readout(star, customer).select("recency_days", "health_score", "rfm_label")))


def customer_orders(star: Star, customer: DataFrame) -> DataFrame:
    return m.of_customer(star.orders, customer).select(
        "order_id", "order_date", "order_value", "order_profit", "order_margin_pct", "total_units", "dominant_category"
    ).orderBy(F.desc("order_date"), "order_id")


def customer_monthly_revenue(star: Star, customer: DataFrame) -> DataFrame:
    return (
        m.of_customer(star.orders, customer)
        .groupBy(month_start(F.col("order_date")).alias("order_month"))
        .agg(F.sum("order_value").alias("total_revenue"))
    )


def customer_top_categories(star: Star, customer: DataFrame, rows: int = 5) -> DataFrame:
    """The customer's best categories by line revenue, ties with the last kept."""
    by_category = evaluate(
        star, ["line_revenue"], ["product.product_category"], {"customer.customer_id": customer}
    )
    last = by_category.orderBy(F.desc("line_revenue")).limit(rows).agg(F.min("line_revenue").alias("_cut"))
    return by_category.crossJoin(F.broadcast(last)).filter("line_revenue >= _cut").drop("_cut")


def best_customer(star: Star) -> DataFrame:
    """One row: the id of the customer with the highest spend; used when none is named."""
    return star.customers.filter("total_spend IS NOT NULL").orderBy(F.desc("total_spend"), "customer_id").limit(1).select("customer_id")


# --- grids and trends -------------------------------------------------------------

def rf_heatmap(star: Star) -> DataFrame:
    return evaluate(star, ["total_customers"], ["customer.r_score", "customer.f_score"]).filter("r_score IS NOT NULL")


def category_trend(star: Star) -> DataFrame:
    """Line revenue per category and month, months inside the data only."""
    monthly = evaluate(star, ["line_revenue"], ["product.product_category", "date.start_of_month"])
    closed = m.closed_months(star.days, star.orders).filter("is_closed_month").select(
        F.col("start_of_month").alias("_m")
    ).distinct()
    return monthly.join(closed, F.col("start_of_month") == F.col("_m"), "left_semi")


def profitability_matrix(star: Star) -> DataFrame:
    return evaluate(
        star, ["line_revenue", "line_profit", "line_margin_pct", "line_quantity"],
        ["product.product_category", "product.brand", "product.product_id"],
    )


def frequency_monetary_by_segment(star: Star) -> DataFrame:
    return evaluate(
        star, ["avg_frequency", "avg_monetary", "total_customers"], ["customer.segment"]
    ).filter("segment IS NOT NULL")


def win_back_customers(star: Star) -> DataFrame:
    """At-risk customers by recency and spend, with the median of both."""
    lines = m.medians(star, {"customer.segment": list(WIN_BACK_SEGMENTS)})  # one row
    return star.customers.filter(F.col("segment").isin(*WIN_BACK_SEGMENTS)).select(
        "customer_id", "segment", "recency_days", "total_spend", "order_count"
    ).crossJoin(F.broadcast(lines))


def risk_table(star: Star, spark: SparkSession, rate: int = DEFAULT_REACTIVATION_RATE) -> DataFrame:
    offers = m.segment_table(spark).select(F.col("segment").alias("_s"), "discount_approach")
    return (
        # per segment: the risk measures themselves replace an axis on the segment
        evaluate(star, ["total_customers", "customer_spend", "avg_monetary"], ["customer.segment"])
        .withColumnsRenamed({"total_customers": "customers_at_risk", "customer_spend": "revenue_at_risk"})
        .join(F.broadcast(offers), F.col("segment") == F.col("_s")).drop("_s")
        .filter(F.col("segment").isin(*WIN_BACK_SEGMENTS))
        .withColumn("gross_recoverable", F.col("revenue_at_risk").cast("double") * rate / 100)
    )


def segment_mix(star: Star) -> DataFrame:
    return m.share_of_all(star, "customer.segment").filter("segment IS NOT NULL")


def market_ranking(star: Star) -> DataFrame:
    return evaluate(
        star, ["total_revenue", "total_customers", "avg_customer_ltv"], ["customer.country"]
    ).filter("country IS NOT NULL").orderBy(F.desc("total_revenue"))


def kpi_snapshot(star: Star) -> DataFrame:
    return evaluate(star, [
        "total_revenue", "total_profit", "total_customers", "total_orders", "avg_order_value", "profit_margin_pct",
        "line_revenue", "grain_reconciliation",
    ])


def segment_reconciliation(star: Star) -> DataFrame:
    return evaluate(
        star, ["total_revenue", "line_revenue", "total_customers", "grain_reconciliation"], ["customer.segment"]
    )


def segment_strategy(star: Star, spark: SparkSession) -> DataFrame:
    facts = revenue_and_customers_by_segment(star)
    table = m.segment_table(spark).withColumnRenamed("segment", "_s")
    return facts.join(F.broadcast(table), F.col("segment") == F.col("_s")).drop("_s").orderBy("sort_order")
