"""Acquisition cohorts, retention, and new against returning revenue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.dates import month_start, months_between_starts
from tallyloom.functions.numeric import ratio


def customer_months(curated: DataFrame) -> DataFrame:
    """One row per customer and month with orders, with orders, revenue and cohort month.

    Aggregated before the cohort month is added, so a customer with very many
    orders is at most one row per month in the window and later distinct counts
    are plain counts.
    """
    monthly = curated.groupBy("customer_id", month_start(F.col("order_date")).alias("month")).agg(
        F.count("*").alias("orders"), F.sum("order_value").cast("decimal(28,2)").alias("revenue")
    )
    first = F.min("month").over(Window.partitionBy("customer_id"))
    return monthly.withColumn("cohort_month", first)


def cohort_retention(months: DataFrame) -> DataFrame:
    """Share of a cohort that orders n months after its first month.

    Month 0 holds the whole cohort, so its count is the cohort size. ``months``
    is customer_months, here and below.
    """
    active = months.groupBy(
        "cohort_month",
        months_between_starts(F.col("month"), F.col("cohort_month")).alias("months_since_acquisition"),
    ).agg(F.count("*").alias("active_customers"))
    sizes = active.filter("months_since_acquisition = 0").select(
        "cohort_month", F.col("active_customers").alias("cohort_customers")
    )
    return active.join(sizes, "cohort_month").select(
        "cohort_month", "months_since_acquisition", "active_customers", "cohort_customers",
        ratio(F.col("active_customers"), F.col("cohort_customers")).alias("retention_rate"),
    )


def revenue_new_returning(months: DataFrame) -> DataFrame:
    is_first = F.col("month") == F.col("cohort_month")
    return (
        months.groupBy(
            F.col("month").alias("revenue_month"),
            F.when(is_first, "New").otherwise("Returning").alias("customer_type"),
        )
        .agg(
            F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
            F.count("*").alias("active_customers"),
        )
    )


def retention_matrix(retention: DataFrame) -> DataFrame:
    """The cells of the cohort matrix: every cohort with every month from 0 to the largest one found.

    A cell without active customers has no rate. Cohorts and months are calendar months, so the grid is small.
    """
    last = retention.agg(F.max("months_since_acquisition").alias("last"))
    grid = retention.select("cohort_month").distinct().crossJoin(F.broadcast(last)).select(
        "cohort_month", F.explode(F.sequence(F.lit(0), F.col("last").cast("int"))).alias("months_since_acquisition"),
    )
    cells = retention.select(
        F.col("cohort_month").alias("_c"), F.col("months_since_acquisition").alias("_m"), "retention_rate",
    )
    return grid.join(cells, (F.col("cohort_month") == F.col("_c")) & (F.col("months_since_acquisition") == F.col("_m")), "left").drop("_c", "_m")


def cohort_rebound(retention: DataFrame) -> DataFrame:
    """Month-1 retention of November against October cohorts, per year."""
    month_one = retention.filter("months_since_acquisition = 1")
    return (
        month_one.filter(F.month("cohort_month").isin(10, 11))
        .groupBy(F.year("cohort_month").alias("cohort_year"))
        .agg(
            F.max(F.when(F.month("cohort_month") == 10, F.col("retention_rate"))).alias("october_rate"),
            F.max(F.when(F.month("cohort_month") == 11, F.col("retention_rate"))).alias("november_rate"),
        )
        .withColumn("rebound_points", (F.col("november_rate") - F.col("october_rate")) * 100)
    )


def dilution_correlation(months: DataFrame, retention: DataFrame) -> DataFrame:
    """Correlation of month-1 retention with repeat orders per acquired customer.

    The ratio for a cohort is taken in its second month: repeat orders placed
    that month over customers acquired up to the month before.
    """
    number = lambda d: (F.year(d) * 12 + F.month(d)).cast("int")
    repeats = (
        months.filter("month > cohort_month").groupBy(number("month").alias("_m"))
        .agg(F.sum("orders").alias("repeat_orders"))
    )
    # From here on one row per calendar month, so the ordered window is small.
    sizes = retention.filter("months_since_acquisition = 0").select(
        number("cohort_month").alias("k"), F.col("cohort_customers").alias("acquired"),
        F.lit(None).cast("double").alias("rate"),
    )
    points = retention.filter("months_since_acquisition = 1").select(
        (number("cohort_month") + 1).alias("k"), F.lit(0).cast("bigint").alias("acquired"),
        F.col("retention_rate").alias("rate"),
    )
    before = Window.orderBy("k").rangeBetween(Window.unboundedPreceding, -1)
    base = sizes.unionByName(points).withColumn("base", F.sum("acquired").over(before)).filter("rate IS NOT NULL")
    pairs = base.join(repeats, F.col("k") == F.col("_m")).select(
        "rate", ratio(F.col("repeat_orders"), F.col("base")).alias("budget_to_base")
    )
    return pairs.agg(
        F.count("*").alias("cohorts"), F.round(F.corr("rate", "budget_to_base"), 6).alias("pearson_r")
    )
