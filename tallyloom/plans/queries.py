"""Registered queries: one per operator, over the driver's tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, IntegerType, ShortType

from tallyloom.config import WIN_BACK_SEGMENTS
from tallyloom.operators import (
    audit, cleaning, display, distinct, explore, facts, kpi, lifecycle, marts, measures as m, pilot,
)
from tallyloom.operators import reports as q, rfm, winback
from tallyloom.plans.build import Shop, open_shop, shop_of
from tallyloom.sources import feed, shapes, shards
from tallyloom.sources.baselines import Baselines

Query = Callable[[SparkSession, str], DataFrame]

# Home-region countries and a filter used by the measure queries.
CORE_COUNTRIES = ("EUROPE", "ASIA")
ONE_COUNTRY = {"customer.country": ["EUROPE"]}
ONE_STATE = {"customer.country": ["EUROPE"], "customer.state": ["NATION_3", "NATION_8", "NATION_13"]}
SEGMENT_COUNTRY = ["customer.segment", "customer.country"]
PILOT_WINDOW = (date(2000, 8, 1), date(2001, 7, 31))
AUDIT_DAY = date(2001, 6, 30)


def present(df: DataFrame) -> DataFrame:
    """Columns in types every engine shares: decimals as double, dates as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            c = c.cast("bigint")
        if f.name != "audit_run_at":  # wall clock
            out.append(c.alias(f.name))
    return df.select(*out)


def _schema_contract(s: Shop, inventory: DataFrame) -> DataFrame:
    parts = [
        audit.schema_contract(inventory, kind, expected, s.cfg)
        for kind, expected in (("orders", audit.ORDER_HEADERS), ("items", audit.ITEM_HEADERS))
    ]
    return parts[0].unionByName(parts[1])


def _mixed_shapes(s: Shop) -> DataFrame:
    """Shards of three shapes as one table: what each month holds of the columns that some shards lack or retype."""
    parts = []
    for kind in ("orders", "items"):
        columns = [feed.FAULTS[kind][fault][1] for fault in ("dropped", "retyped")]
        rows = shapes.read_shapes(s.spark, s.faulty_shapes[kind], kind)
        parts.append(rows.groupBy("source_month").agg(
            F.count("*").alias("rows"), F.count("OrderID").alias("order_ids"),
            F.count(columns[0]).alias("dropped_column_values"), F.count(columns[1]).alias("retyped_column_values"), F.min(columns[1]).alias("least_retyped"),
        ).withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1])


def _half_guarded(s: Shop) -> DataFrame:
    """Faulty order shards beside sound item shards: the checks on orders are skipped, those on items are not."""
    found = {"orders": s.faulty_shapes["orders"], "items": s.shard_shapes["items"]}
    both = s.faulty_inventory.filter("table_name LIKE 'orders%'").unionByName(s.inventory.filter("table_name LIKE 'items%'"))
    return s.audit_of(found, both)


def _incremental_rebuild(s: Shop) -> DataFrame:
    """One month of orders arrives anew: which months of the kept stages are written again, and what they hold then."""
    month, column = feed.FAULTS["orders"]["retyped"]
    if not s.rebuilt:
        root = f"{s.folder}/kept"
        before = open_shop(s.spark, s.source, s.raw, s.cfg, root)
        late = s.raw.orders.filter((F.col("source_month") != month) | ~F.coalesce(F.col(column).endswith("7"), F.lit(False)))
        after = open_shop(s.spark, s.source, dataclasses.replace(s.raw, orders=late), s.cfg, root)
        s.rebuilt.extend((before.orders_cleaned, after.orders_cleaned, before.versions, after.versions))
    _, cleaned, old, new = s.rebuilt
    versions = s.spark.createDataFrame(
        [(m, v != old["orders_cleaned"][m]) for m, v in new["orders_cleaned"].items()], "month string, rewritten boolean"
    )
    held = cleaned.groupBy("source_month").agg(F.count("*").alias("rows"), F.count("order_id").alias("order_ids"))
    return held.join(F.broadcast(versions), held.source_month == versions.month).select("source_month", "rewritten", "rows", "order_ids")


def _reloaded(s: Shop, kind: str) -> DataFrame:
    """Raw rows written as month partitions, read back in the window."""
    return shards.check_schema(shards.read_months(s.spark, s.shard_folders[kind], kind, s.cfg), kind)


def _item_load(s: Shop) -> DataFrame:
    return _reloaded(s, "items").groupBy("source_month").agg(
        F.count("*").alias("rows"), F.count("OrderID").alias("order_ids"),
        F.countDistinct("ProductID").alias("product_texts"), F.count("LineNetAmount").alias("amounts"),
        F.count_if(F.col("ProductID") != F.trim("ProductID")).alias("padded_products"),
    )


def _shard_load(s: Shop) -> DataFrame:
    return _reloaded(s, "orders").groupBy("source_month").agg(
        F.count("*").alias("rows"), F.count("OrderID").alias("order_ids"),
        F.countDistinct("CustomerID").alias("customer_texts"),
        F.count_if(F.col("CustomerID") != F.trim("CustomerID")).alias("padded_customers"),
    )


def _baselines(s: Shop) -> Baselines:
    """Baselines of the shop: line totals, and KPIs up to the last closed month and of all data."""
    stored = Baselines(s.spark, f"{s.folder}/baselines")
    if stored.store.entry("kpis") is None:
        lines = s.lines.agg(F.sum("line_net_amount").alias("revenue"), F.countDistinct("order_id").alias("orders"))
        totals = lines.crossJoin(F.broadcast(s.segments.agg(F.count("*").alias("customers")))).selectExpr(
            "stack(3, 'total_revenue', cast(revenue as decimal(28,4)), 'distinct_orders', cast(orders as decimal(28,4)), "
            "'distinct_customers', cast(customers as decimal(28,4))) as (name, value)"
        )
        stored.accept("line_totals", totals, "totals of the line grain")
        earlier = kpi.before(s.curated, s.lines, marts.last_complete_month(s.curated))
        stored.accept("kpis", kpi.as_long(kpi.kpi_primitives(*earlier)), "up to the last closed month")
        stored.accept("kpis", kpi.as_long(kpi.kpi_primitives(s.curated, s.lines)), "all data")
    return stored


def _baseline_reconciliation(s: Shop) -> DataFrame:
    """KPIs of the order grain against the stored totals of the lines."""
    current = kpi.as_long(kpi.kpi_primitives(s.curated, s.lines)).filter(
        F.col("name").isin("total_revenue", "distinct_orders", "distinct_customers")
    )
    return kpi.kpi_drift(_baselines(s).read("line_totals"), current)


def _kpi_drift(s: Shop) -> DataFrame:
    """The stored KPIs up to the last closed month against those of all data."""
    return kpi.kpi_drift(_baselines(s).read("kpis", 1), kpi.as_long(kpi.kpi_primitives(s.curated, s.lines)))


def _pilot(s: Shop) -> DataFrame:
    """Pilot groups read out on the last year of orders."""
    groups = pilot.assigned(s.segments)
    return pilot.outcomes(groups, s.curated, PILOT_WINDOW[0], PILOT_WINDOW[1])


def _category_customers(s: Shop) -> DataFrame:
    """Customers of every category and year, with subtotals, from bitmaps by category and month."""
    months = s.lines.groupBy("product_id", F.trunc("order_date", "month").alias("month"), "customer_id").agg(F.lit(1).alias("_one"))
    months = months.join(s.products.select("product_id", "product_category"), "product_id")
    maps = distinct.bitmaps(months, ["product_category", "month"], "customer_id")
    by = {"product_category": F.col("product_category"), "year": F.year("month")}
    names = list(by)
    return distinct.distinct_counts(maps, by, [names, names[:1], names[1:], []], "customers")


def _six_digits(df: DataFrame) -> DataFrame:
    """The ends of intervals as far as sums of doubles agree."""
    return df.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


def _marts(s: Shop) -> dict[str, DataFrame]:
    return {
        "v_monthly_revenue": marts.monthly_revenue(s.curated),
        "v_product_performance": marts.product_performance(s.items, s.products),
        "v_brand_profitability": marts.brand_profitability(s.costed),
        "v_regional_performance": marts.regional_performance(s.curated),
        "v_category_monthly_trend": marts.category_monthly_trend(s.costed, s.curated),
        "v_country_summary": marts.country_summary(s.curated),
    }


def _base_measures(s: Shop, names: list[str], by: list[str], where=None) -> DataFrame:
    return m.evaluate(s.star, names, by, where)


_BUILDERS: dict[str, Callable[[Shop], DataFrame]] = {
    # Sources
    "s1_shard_load": _shard_load,
    "s1_shard_load_items": _item_load,
    "s8_column_inventory": lambda s: s.inventory,
    "s8_faulty_inventory": lambda s: s.faulty_inventory,
    "s3_mixed_shapes": _mixed_shapes,
    "s9_incremental_rebuild": _incremental_rebuild,
    "s13_half_guarded_audit": _half_guarded,
    "d1_faulty_contract": lambda s: _schema_contract(s, s.faulty_inventory),
    "d2_faulty_audit": lambda s: s.audit_of(s.faulty_shapes, s.faulty_inventory),
    "d2_faulty_audit_findings": lambda s: audit.audit_findings(s.audit_of(s.faulty_shapes, s.faulty_inventory)),
    # Audit, standardise, clean, validate
    "d1_schema_contract": lambda s: _schema_contract(s, s.inventory),
    "d2_raw_audit": lambda s: s.raw_audit,
    "d2_raw_audit_findings": lambda s: audit.audit_findings(s.raw_audit),
    "d3_standardize_customers": lambda s: s.customers,
    "d4_standardize_products": lambda s: s.products,
    "d5_orders_intake": lambda s: s.orders_intake,
    "d5_items_intake": lambda s: s.items_intake,
    "d6_orders_cleaned": lambda s: s.orders_cleaned,
    "d7_items_cleaned": lambda s: s.items_cleaned,
    "d8_orders_validated": lambda s: s.orders,
    "d9_items_validated": lambda s: s.items,
    "d10_cleaning_log": lambda s: cleaning.cleaning_log(s.orders_cleaned, s.orders, s.items_cleaned, s.items),
    "d11_stage_row_counts": lambda s: cleaning.stage_row_counts(s.orders_cleaned, s.orders, s.items_cleaned, s.items),
    "d12_clean_audit": lambda s: s.clean_audit(AUDIT_DAY),
    "d13_audit_findings": lambda s: audit.audit_findings(s.clean_audit(AUDIT_DAY)),
    "d14_country_coverage": lambda s: audit.country_coverage(s.curated, s.segments, s.customers),
    "d15_country_coverage_faults": lambda s: audit.country_coverage_faults(s.curated, s.segments, s.customers),
    "d16_column_inventory": lambda s: audit.filled_columns(s.dim_customers),
    "d16_customer_dim_validation": lambda s: audit.customer_dim_validation(s.dim_customers, s.customers),
    # Exploration
    "e1_order_value_distribution": lambda s: explore.order_value_distribution(s.baskets),
    "e2_order_value_outliers": lambda s: explore.order_value_outliers(s.baskets, s.customers),
    "e2_largest_outliers": lambda s: explore.largest_outliers(explore.order_value_outliers(s.baskets, s.customers)),
    "e3_country_breakdown": lambda s: explore.country_breakdown(s.baskets, s.customers),
    "e4_monthly_temporal_pattern": lambda s: explore.monthly_temporal_pattern(s.baskets),
    "e5_customer_frequency_distribution": lambda s: explore.customer_frequency_distribution(s.baskets),
    "e6_recency_distribution": lambda s: explore.recency_distribution(s.baskets),
    "e7_pareto_concentration": lambda s: explore.pareto_concentration(s.baskets),
    "e8_basket_composition": lambda s: explore.basket_composition(s.baskets, s.customers),
    "e9_baseline_reconciliation": _baseline_reconciliation,
    "e10_population_split": lambda s: explore.population_split(s.baskets),
    "e11_month_coverage": lambda s: explore.month_coverage(s.baskets),
    "e12_cumulative_concentration": lambda s: explore.cumulative_concentration(explore.pareto_concentration(s.baskets)),
    # Facts and RFM
    "f1_sales_curated": lambda s: s.curated,
    "f2_customer_rfm": lambda s: s.customer_rfm,
    "f3_rfm_customer_segments": lambda s: s.segments,
    "f4_rfm_for_bi": lambda s: s.rfm_for_bi,
    "f5_product_analytics": lambda s: facts.product_analytics(s.priced, s.curated),
    "f6_segment_summary": lambda s: rfm.segment_summary(s.segments),
    "f7_items_for_bi": lambda s: s.lines,
    "f8_line_fact_totals": lambda s: facts.line_fact_totals(s.lines),
    "f9_dim_customers_for_bi": lambda s: s.dim_customers,
    "p10_items_display": lambda s: display.with_display_names(s.lines),
    # Marts and lifecycle
    "m1_last_complete_month": lambda s: marts.last_complete_month(s.curated),
    "m2_monthly_revenue": lambda s: marts.monthly_revenue(s.curated),
    "m3_product_performance": lambda s: marts.product_performance(s.items, s.products),
    "m4_brand_profitability": lambda s: marts.brand_profitability(s.costed),
    "m5_regional_performance": lambda s: marts.regional_performance(s.curated),
    "m6_category_monthly_trend": lambda s: marts.category_monthly_trend(s.costed, s.curated),
    "m7_country_summary": lambda s: marts.country_summary(s.curated),
    "m8_mart_row_counts": lambda s: marts.mart_row_counts(_marts(s)),
    "m8_last_month_check": lambda s: marts.last_month_check(
        marts.monthly_revenue(s.curated), marts.category_monthly_trend(s.costed, s.curated)),
    "m9_cohort_retention": lambda s: s.retention,
    "m10_revenue_new_returning": lambda s: s.new_returning,
    # Measures
    "b1_revenue_profit_orders": lambda s: _base_measures(
        s, ["total_revenue", "total_profit", "distinct_orders", "total_orders"], ["date.year", "customer.segment"]),
    "b2_total_customers": lambda s: _base_measures(s, ["total_customers"], ["customer.state"]),
    "b3_ratios": lambda s: _base_measures(
        s, ["avg_order_value", "avg_customer_ltv", "profit_margin_pct"], ["customer.country"]),
    "b4_rfm_averages": lambda s: _base_measures(
        s, ["avg_recency_days", "avg_frequency", "avg_monetary"], ["customer.segment"]),
    "b5_score_averages": lambda s: _base_measures(
        s, ["avg_r_score", "avg_f_score", "avg_m_score", "avg_health_score"], ["customer.city"]),
    "b6_medians": lambda s: m.medians(s.star, {"customer.segment": list(WIN_BACK_SEGMENTS)}),
    "b6_medians_all": lambda s: m.medians(s.star),
    "b6_medians_by_axes": lambda s: m.medians_by(
        s.star, SEGMENT_COUNTRY, [SEGMENT_COUNTRY, SEGMENT_COUNTRY[:1], SEGMENT_COUNTRY[1:], []]),
    "b3_ratios_with_subtotals": lambda s: m.evaluate_levels(
        s.star, ["total_revenue", "avg_order_value", "avg_customer_ltv", "profit_margin_pct"], SEGMENT_COUNTRY,
        [SEGMENT_COUNTRY, SEGMENT_COUNTRY[:1], SEGMENT_COUNTRY[1:], []]),
    "a2_category_customers": _category_customers,
    "b7_line_measures": lambda s: _base_measures(
        s, ["line_revenue", "line_profit", "line_quantity", "line_margin_pct"], ["product.product_category"]),
    "b8_grain_reconciliation": lambda s: _base_measures(s, ["grain_reconciliation"], []),
    "b9_product_counts": lambda s: _base_measures(s, ["total_products", "total_brands"], []),
    "b10_brand_benchmarks": lambda s: m.brand_headline(s.star).select(
        "top_brand_revenue", "avg_brand_margin_pct", "margin_baseline"),
    "b11_shares_by_segment": lambda s: m.share_of_all(s.star, "customer.segment"),
    "b11_shares_by_country": lambda s: m.share_of_all(s.star, "customer.country"),
    "b12_revenue_at_risk": lambda s: m.revenue_at_risk(s.star),
    "b12_revenue_at_risk_filtered": lambda s: m.revenue_at_risk(s.star, ONE_COUNTRY),
    "b12_revenue_at_risk_segment": lambda s: m.revenue_at_risk(s.star, {"customer.segment": ["Champions"]}),
    "b12_risk_by_segment": lambda s: m.evaluate(
        s.star, ["revenue_at_risk", "customers_at_risk", "customer_spend"], ["customer.segment"]),
    "b13_recency_revenue": lambda s: _base_measures(
        s, ["revenue_active", "revenue_cooling", "revenue_dormant"], ["customer.country"]),
    "b14_customer_decile": lambda s: m.with_decile(s.star.customers).select("customer_id", "state", "total_spend", "customer_decile"),
    "b15_what_if": lambda s: m.what_if(s.star, s.spark),
    "b16_kpi_selector": lambda s: m.all_kpis(s.star),
    "b17_arpu_by_country": lambda s: _base_measures(s, ["arpu", "total_revenue"], ["customer.country"]),
    "b18_lifecycle_share": lambda s: m.lifecycle_share(s.star),
    "b19_filter_flags": lambda s: m.filter_flags(s.star, ONE_STATE),
    "b20_customer_readout": lambda s: m.customer_readout(s.star, q.best_customer(s.star)),
    "b21_health_indicator": lambda s: m.health_indicator(s.star, ["customer.segment"]),
    "b22_map_shares": lambda s: m.map_shares(s.star, CORE_COUNTRIES),
    "b22_map_shares_filtered": lambda s: m.map_shares(s.star, CORE_COUNTRIES, ONE_STATE),
    "b22_map_shares_state": lambda s: m.map_shares(
        s.star, CORE_COUNTRIES, {"customer.state": ONE_STATE["customer.state"]}),
    "b23_brand_headline": lambda s: m.brand_headline(s.star),
    "b22_contexts_by_year": lambda s: m.evaluate_contexts(
        s.star, ["total_revenue", "distinct_orders"],
        {"all": {}, "core": {"customer.country": CORE_COUNTRIES}, "states": ONE_STATE, "at_risk": {"customer.segment": ["At Risk"]}}, ["date.year"]),
    "b24_context_counts": lambda s: m.context_counts(s.star),
    "t1_prior_year_month": lambda s: m.prior_year(s.star, "start_of_month").select(
        "start_of_month", "total_revenue", "revenue_py", "total_profit", "profit_py", "profit_margin_pct", "profit_margin_py"),
    "t2_yoy_quarter": lambda s: m.prior_year(s.star, "start_of_quarter").select(
        "start_of_quarter", "revenue_yoy_pct", "profit_yoy_pct"),
    "t3_margin_yoy_year": lambda s: m.prior_year(s.star, "start_of_year").select(
        "start_of_year", "profit_margin_pct", "profit_margin_yoy_pp"),
    "t4_rolling_12m_month": lambda s: m.rolling_12m(s.star, "start_of_month"),
    "t5_prior_year_filtered": lambda s: m.prior_year(s.star, "start_of_month", ONE_COUNTRY).select(
        "start_of_month", "total_revenue", "revenue_py"),
    "t1_prior_year_country_month": lambda s: m.prior_year(s.star, "start_of_month", by=["customer.country"]).select(
        "country", "start_of_month", "total_revenue", "revenue_py", "total_profit", "profit_py", "profit_margin_pct", "profit_margin_py"),
    "t2_yoy_segment_quarter": lambda s: m.prior_year(s.star, "start_of_quarter", ONE_COUNTRY, ["customer.segment"]).select(
        "segment", "start_of_quarter", "revenue_yoy_pct", "profit_yoy_pct"),
    "t4_rolling_12m_segment_week": lambda s: m.rolling_12m(s.star, "start_of_week", by=["customer.segment"]),
    "t4_rolling_12m_country_state_month": lambda s: m.rolling_12m(s.star, "start_of_month", by=["customer.country", "customer.state"]),
    "p15_calendar": lambda s: m.closed_months(s.star.days, s.star.orders),
    # Report queries
    "q1_weekly_revenue": lambda s: q.weekly_revenue(s.star),
    "q2_segment_bars": lambda s: q.revenue_and_customers_by_segment(s.star),
    "q3_segment_profile": lambda s: q.segment_profile(s.star),
    "q4_recency_histogram": lambda s: q.recency_histogram(s.star),
    "q5_revenue_by_score": lambda s: q.revenue_by_every_score(s.star),
    "q6_revenue_by_brand": lambda s: q.revenue_by_brand(s.star),
    "q7_revenue_by_decile": lambda s: q.revenue_by_decile(s.star),
    "q8_recency_stages": lambda s: q.recency_stages(s.star),
    "q9_customer_kpis": lambda s: q.customer_kpis(s.star, q.best_customer(s.star)),
    "q9_customer_orders": lambda s: q.customer_orders(s.star, q.best_customer(s.star)),
    "q9_customer_months": lambda s: q.customer_monthly_revenue(s.star, q.best_customer(s.star)),
    "q9_customer_categories": lambda s: q.customer_top_categories(s.star, q.best_customer(s.star)),
    "q10_rf_heatmap": lambda s: q.rf_heatmap(s.star),
    "q11_cohort_matrix": lambda s: lifecycle.retention_matrix(s.retention),
    "q12_category_trend": lambda s: q.category_trend(s.star),
    "q13_profitability_matrix": lambda s: q.profitability_matrix(s.star),
    "q13_matrix_with_totals": lambda s: q.matrix_with_totals(s.star),
    "q14_frequency_monetary": lambda s: q.frequency_monetary_by_segment(s.star),
    "q14_win_back_customers": lambda s: q.win_back_customers(s.star),
    "q15_risk_table": lambda s: q.risk_table(s.star, s.spark),
    "q16_segment_mix": lambda s: q.segment_mix(s.star),
    "q17_market_ranking": lambda s: q.market_ranking(s.star),
    "q18_kpi_snapshot": lambda s: q.kpi_snapshot(s.star),
    "q18_segment_reconciliation": lambda s: q.segment_reconciliation(s.star),
    "q19_segment_strategy": lambda s: q.segment_strategy(s.star, s.spark),
    "k2_top_products": lambda s: marts.top_products(marts.product_performance(s.items, s.products)).select(
        "product_id", "brand", "total_revenue", "revenue_rank"),
    "k2_top_products_by_line_revenue": lambda s: q.top_products(s.star),
    # Win-back economics
    "v1_segment_shares": lambda s: winback.segment_shares(s.segments),
    "v2_focus_margin": lambda s: winback.focus_margin(s.economics),
    "v3_contribution_per_euro": lambda s: winback.contribution_per_euro(s.economics),
    "v4_rate_grid": lambda s: winback.rate_grid(s.economics),
    "v5_segment_margin_all": lambda s: winback.segment_margin_all(s.economics),
    "v6_compound_discount": lambda s: winback.compound_discount(winback.focus_margin(s.economics)),
    "v7_playbook": lambda s: winback.playbook_budgets(s.spark, s.segments),
    "v8_figures": lambda s: winback.figures(s.economics, s.segments, s.baskets, s.items),
    # KPI regression
    "h1_kpi_primitives": lambda s: kpi.kpi_primitives(s.curated, s.lines),
    "h2_kpi_derived": lambda s: kpi.kpi_derived(kpi.kpi_primitives(s.curated, s.lines)),
    "h3_kpi_drift": _kpi_drift,
    "h3_baseline_history": lambda s: kpi.drift_history(_baselines(s).history("kpis")),
    # Documented computations
    "x1_order_reconciliation": lambda s: winback.reconciliation(s.baskets, s.items),
    "x2_shared_order_counts": lambda s: winback.shared_order_counts(s.segments),
    "x4_pilot_readout": lambda s: pilot.readout(_pilot(s)),
    "x4_pilot_intervals": lambda s: _six_digits(pilot.pilot_intervals(_pilot(s))),
    "x4_pilot_replicates": lambda s: pilot.replicates(_pilot(s), 50).select(
        "draw", "segment", "group", F.round("per_customer", 6).alias("per_customer"), F.round("per_euro", 6).alias("per_euro")),
    "x4_pilot_contrasts": lambda s: pilot.contrasts(_pilot(s)),
    "x4_pilot_decisions": lambda s: _six_digits(pilot.pilot_decisions(_pilot(s))),
    "x3_cohort_rebound": lambda s: lifecycle.cohort_rebound(s.retention),
    "x3_dilution_correlation": lambda s: lifecycle.dilution_correlation(s.customer_months, s.retention),
}


def _query(build: Callable[[Shop], DataFrame]) -> Query:
    return lambda spark, sf_dir: present(build(shop_of(spark, sf_dir)))


def all_queries() -> dict[str, Query]:
    return {name: _query(build) for name, build in _BUILDERS.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers, spend and margin per segment."""
    return present(rfm.segment_summary(shop_of(spark, sf_dir).segments))
