"""KPI regression: primitives, derived ratios, and drift against a baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import money, rounded_ratio

# Kind of each KPI: counts and the grain check compare exactly, money to the cent.
KINDS = {
    "total_revenue": "currency",
    "total_profit": "currency",
    "distinct_customers": "count",
    "distinct_orders": "count",
    "grain_parity": "grain",
}


def kpi_primitives(curated: DataFrame, lines: DataFrame) -> DataFrame:
    """The five primitives as one row.

    Grain parity counts orders found on exactly one grain; it must be 0.
    """
    totals = curated.agg(
        money(F.sum("order_value")).alias("total_revenue"),
        money(F.sum("order_profit")).alias("total_profit"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        F.count("*").alias("distinct_orders"),
    )
    line_orders = lines.groupBy("order_id").agg(F.lit(1).alias("_line"))
    parity = (
        curated.select(F.col("order_id").alias("_order"))
        .join(line_orders, F.col("_order") == F.col("order_id"), "full")
        .agg(F.count_if(F.col("_order").isNull() | F.col("order_id").isNull()).alias("grain_parity"))
    )
    return totals.crossJoin(F.broadcast(parity))


def kpi_derived(primitives: DataFrame) -> DataFrame:
    """Average order value and margin, two digits; a zero denominator is an error."""
    def checked(c: str, message: str) -> Column:
        return F.when(F.col(c) == 0, F.raise_error(F.lit(message)).cast("double")).otherwise(F.col(c).cast("double"))

    orders = checked("distinct_orders", "distinct_orders is 0 - cannot compute AOV")
    revenue = checked("total_revenue", "total_revenue is 0 - cannot compute Margin %")
    return primitives.select(
        rounded_ratio(F.col("total_revenue"), orders, 2).alias("aov"),
        rounded_ratio(F.col("total_profit") * 100, revenue, 2).alias("margin_pct"),
    )


def as_long(primitives: DataFrame) -> DataFrame:
    """Primitives and derived KPIs as (name, value)."""
    derived = kpi_derived(primitives)
    one = primitives.crossJoin(F.broadcast(derived))
    parts = ", ".join(f"'{c}', cast({c} as decimal(28,4))" for c in one.columns)
    return one.selectExpr(f"stack({len(one.columns)}, {parts}) as (name, value)")


def kpi_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Both (name, value) tables side by side with a drift flag.

    A KPI missing on either side has drifted; unknown names compare to the cent.
    """
    b = baseline.select(F.col("name").alias("_b"), F.col("value").alias("baseline"))
    c = current.select(F.col("name").alias("_c"), F.col("value").alias("current"))
    both = b.join(c, F.col("_b") == F.col("_c"), "full").select(
        F.coalesce("_b", "_c").alias("name"), "baseline", "current"
    ).withColumn("kind", _kind())
    return both.withColumn("drift", _differ("baseline", "current")).orderBy("name")


def _kind() -> Column:
    kind = F.lit("currency")
    for name, value in KINDS.items():
        kind = F.when(F.col("name") == name, value).otherwise(kind)
    return kind


def _differ(a: str, b: str) -> Column:
    """Whether two values of a KPI differ by its kind; a missing one does."""
    exact = F.col("kind").isin("count", "grain")
    same = F.when(exact, F.col(a).cast("bigint") == F.col(b).cast("bigint")).otherwise(F.round(a, 2) == F.round(b, 2))
    return F.col(a).isNull() | F.col(b).isNull() | ~same


def drift_history(history: DataFrame) -> DataFrame:
    """(version, name, value) of stored versions, each beside the version before it.

    The first version has nothing to drift from; a KPI that a version lacks has drifted there.
    """
    versions = history.select("version").distinct()
    every = history.select("name").distinct().crossJoin(F.broadcast(versions))  # versions x KPIs
    now = every.join(history.select("version", "name", "value"), ["version", "name"], "left")
    was = now.select((F.col("version") + 1).alias("_version"), F.col("name").alias("_name"), F.col("value").alias("previous"))
    both = now.join(was, (F.col("version") == F.col("_version")) & (F.col("name") == F.col("_name")), "left").withColumn("kind", _kind())
    drift = (F.col("version") > 1) & ~(F.col("value").isNull() & F.col("previous").isNull()) & _differ("value", "previous")
    return both.select("version", "name", "kind", "previous", "value", drift.alias("drift"))


def before(curated: DataFrame, lines: DataFrame, cutoff: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both facts up to the month of the one row (cutoff_month), as an earlier snapshot of the data."""
    limit = F.broadcast(cutoff.select(F.last_day("cutoff_month").alias("_limit")))
    return tuple(f.join(limit, F.col("order_date") <= F.col("_limit")).drop("_limit") for f in (curated, lines))
