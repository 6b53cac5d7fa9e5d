"""Recency, frequency and monetary scores, segments and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.config import SCORE_TILES, SEGMENT_BANDS, RetailConfig
from tallyloom.functions.numeric import money, rounded, rounded_mean, rounded_ratio, ratio
from tallyloom.operators.ordering import ntiles


def customer_rfm(curated: DataFrame) -> DataFrame:
    """One row per customer with orders; recency counts from the last day in the data."""
    value, profit = F.col("order_value"), F.col("order_profit")
    newest = F.struct("order_date", "order_id")
    place = F.max_by(F.struct("country", "state", "city"), newest)
    customers = curated.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("*").alias("frequency_orders"),
        money(F.sum(value)).alias("monetary_value"),
        money(F.sum(profit)).alias("total_profit"),
        # Weighted by revenue, whatever its name says.
        rounded_ratio(F.sum(profit), F.sum(value), 4).alias("avg_margin_pct"),
        rounded_mean(value, 2).alias("avg_order_value"),
        F.sum("total_units").alias("total_units"),
        rounded_mean(F.col("distinct_products"), 1).alias("avg_products_per_order"),
        place.alias("place"),
    )
    anchor = curated.agg(F.max("order_date").alias("data_as_of_date"))  # one row
    return customers.crossJoin(F.broadcast(anchor)).select(
        "customer_id", "data_as_of_date", "last_order_date",
        F.datediff("data_as_of_date", "last_order_date").cast("bigint").alias("recency_days"),
        "frequency_orders", "monetary_value", "total_profit", "avg_margin_pct", "avg_order_value",
        "total_units", "avg_products_per_order",
        F.col("place.country").alias("primary_country"),
        F.col("place.state").alias("primary_state"),
        F.col("place.city").alias("primary_city"),
    )


def _banded(total: Column, index: int) -> Column:
    out = None
    for band in SEGMENT_BANDS[:-1]:
        test = total >= band[0]
        out = F.when(test, band[index]) if out is None else out.when(test, band[index])
    return out.otherwise(SEGMENT_BANDS[-1][index])


def rfm_customer_segments(rfm: DataFrame, cfg: RetailConfig) -> DataFrame:
    """Quintile scores (ties broken by customer id), total, segment and action.

    ``rfm`` is read twice, so pass a stage table.
    """
    scored = ntiles(
        rfm, "customer_id",
        {"r_score": "-recency_days", "f_score": "frequency_orders", "m_score": "monetary_value"},
        SCORE_TILES,
    )
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return scored.select(
        "customer_id", F.lit(cfg.as_of_date).alias("snapshot_date"), "data_as_of_date",
        "last_order_date", "recency_days", "frequency_orders", "monetary_value", "total_profit",
        "avg_margin_pct", "avg_order_value", "total_units", "avg_products_per_order",
        "primary_country", "primary_state", "primary_city", "r_score", "f_score", "m_score",
        F.format_string("R%02dF%02dM%02d", "r_score", "f_score", "m_score").alias("rfm_cell"),
        total.alias("rfm_total_score"),
        _banded(total, 1).alias("rfm_segment"),
        _banded(total, 2).alias("recommended_action"),
    )


def rfm_for_bi(segments: DataFrame) -> DataFrame:
    return segments.drop("snapshot_date").withColumnsRenamed({
        "data_as_of_date": "analysis_date",
        "frequency_orders": "order_count",
        "monetary_value": "total_spend",
        "avg_margin_pct": "margin_pct",
        "primary_country": "country",
        "primary_state": "state",
        "primary_city": "city",
        "rfm_total_score": "health_score",
        "rfm_segment": "segment",
        "recommended_action": "action",
    })


def segment_summary(segments: DataFrame) -> DataFrame:
    per_segment = segments.groupBy("rfm_segment", "recommended_action").agg(
        F.count("*").alias("customer_count"),
        rounded_mean(F.col("monetary_value"), 2).alias("avg_monetary"),
        rounded_mean(F.col("total_profit"), 2).alias("avg_profit"),
        rounded(ratio(F.sum("avg_margin_pct"), F.count("avg_margin_pct")) * 100, 1).alias("avg_margin_pct"),
        rounded_mean(F.col("recency_days"), 0).alias("avg_recency_days"),
        rounded_mean(F.col("frequency_orders"), 1).alias("avg_frequency"),
        F.min("rfm_total_score").alias("min_score"),
        F.max("rfm_total_score").alias("max_score"),
    )
    whole = segments.agg(F.count("*").alias("_all"))
    return (
        per_segment.crossJoin(F.broadcast(whole))
        .withColumn("pct_of_total", rounded_ratio(F.col("customer_count") * 100, F.col("_all"), 1))
        .drop("_all").orderBy(F.desc("min_score"))
    )
