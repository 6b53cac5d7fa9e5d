"""Win-back economics: what a euro of discount keeps, per segment and rate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.config import DEFAULT_REACTIVATION_RATE, WIN_BACK_SEGMENTS
from tallyloom.functions.numeric import money, ratio
from tallyloom.operators.measures import segment_table
from tallyloom.sources.staging import kept


def playbook(spark: SparkSession) -> DataFrame:
    """Discount rate and budget share of the win-back segments, from their labels."""
    rate = F.regexp_extract("discount_approach", r"^Win-back (\d+)%$", 1)
    share = F.regexp_extract("budget_allocation", r"^\w+ \((\d+)%\)$", 1)
    return segment_table(spark).filter(F.col("segment").isin(*WIN_BACK_SEGMENTS)).select(
        "segment", "sort_order",
        (rate.cast("int") / 100).alias("discount_rate"),
        "budget_allocation", share.cast("int").alias("budget_share_pct"),
    )


def playbook_budgets(spark: SparkSession, segments: DataFrame) -> DataFrame:
    """The playbook next to the number of customers it addresses."""
    counts = segments.groupBy("rfm_segment").agg(F.count("*").alias("customers"))
    return counts.join(F.broadcast(playbook(spark)), F.col("rfm_segment") == F.col("segment")).select(
        "segment", "discount_rate", "budget_allocation", "budget_share_pct", "customers"
    )


def segment_shares(segments: DataFrame) -> DataFrame:
    per_segment = segments.groupBy(F.col("rfm_segment").alias("segment")).agg(
        F.count("*").alias("customers"),
        F.sum("frequency_orders").alias("orders"),
        money(F.sum("monetary_value")).alias("revenue"),
        money(F.sum("total_profit")).alias("profit"),
    )
    whole = segments.agg(F.count("*").alias("_c"), F.sum("monetary_value").alias("_r"))
    return per_segment.crossJoin(F.broadcast(whole)).withColumns({
        "customer_share_pct": ratio(F.col("customers"), F.col("_c")) * 100,
        "revenue_share_pct": ratio(F.col("revenue"), F.col("_r")) * 100,
    }).drop("_c", "_r")


def segment_economics(curated: DataFrame, segments: DataFrame) -> DataFrame:
    """Order sums per segment: at most seven rows, which all figures below share.

    Orders are summed per customer first, so the join is one row per customer on
    both sides. Orders of unscored customers stay, under a NULL segment.
    """
    pct = F.col("order_discount_pct")
    per_customer = curated.groupBy("customer_id").agg(
        F.count("*").alias("orders"), F.sum("order_value").alias("revenue"),
        F.sum("order_cost").alias("cost"), F.sum("order_profit").alias("profit"),
        F.sum(pct).alias("pct_sum"), F.count(pct).alias("pct_n"), F.max(pct).alias("pct_max"),
    )
    names = segments.select(F.col("customer_id").alias("_c"), F.col("rfm_segment").alias("segment"))
    return (
        per_customer.join(names, F.col("customer_id") == F.col("_c"), "left").groupBy("segment").agg(
            F.count("*").alias("customers"),
            F.sum("orders").alias("orders"),
            money(F.sum("revenue")).alias("revenue"),
            money(F.sum("cost")).alias("cost"),
            money(F.sum("profit")).alias("profit"),
            F.sum("pct_sum").cast("decimal(28,9)").alias("pct_sum"),
            F.sum("pct_n").alias("pct_n"),
            F.max("pct_max").alias("pct_max"),
        )
    )


def _with_margin(economics: DataFrame) -> DataFrame:
    return economics.filter("segment IS NOT NULL").withColumns({
        "gross_margin": ratio(F.col("profit"), F.col("revenue")),
        "mean_order_discount_pct": ratio(F.col("pct_sum"), F.col("pct_n")),
    })


def focus_margin(economics: DataFrame) -> DataFrame:
    """Margin and contribution of the two win-back segments at the playbook's rates."""
    rates = playbook(economics.sparkSession).select("segment", F.col("discount_rate").alias("discount"))
    mean = F.round(F.col("mean_order_discount_pct").cast("decimal(38,8)"), 4).cast("decimal(18,4)")
    return _with_margin(economics).join(F.broadcast(rates), "segment").select(
        "segment", "customers", "orders", "revenue", "cost", "profit",
        mean.alias("mean_order_discount_pct"), "discount",
        ratio(F.col("revenue"), F.col("orders")).alias("aov"), "gross_margin",
        (F.col("gross_margin") - F.col("discount")).alias("contribution"),
    )


def kept_per_euro(margin: Column, rate: Column) -> Column:
    """Contribution kept per euro of discount."""
    return (margin - rate) / rate


def contribution_per_euro(economics: DataFrame) -> DataFrame:
    rates = playbook(economics.sparkSession).select("segment", "discount_rate")
    kept = kept_per_euro(F.col("gross_margin"), F.col("discount_rate"))
    return _with_margin(economics).join(F.broadcast(rates), "segment").select(
        "segment", "discount_rate", "gross_margin",
        kept.alias("contribution_per_eur"), (kept * 1000).alias("contribution_per_1000"),
    )


def rate_grid(economics: DataFrame) -> DataFrame:
    """Both segments at both playbook rates, with the ratio of the two at each rate."""
    rates = playbook(economics.sparkSession).select("discount_rate")
    grid = (
        _with_margin(economics).filter(F.col("segment").isin(*WIN_BACK_SEGMENTS))
        .select("segment", "gross_margin").crossJoin(F.broadcast(rates))  # 2 x 2 rows
        .withColumn("contribution_per_eur", kept_per_euro(F.col("gross_margin"), F.col("discount_rate")))
    )
    first, second = WIN_BACK_SEGMENTS
    value = lambda s: F.max(F.when(F.col("segment") == s, F.col("contribution_per_eur")))
    common = grid.groupBy(F.col("discount_rate").alias("_rate")).agg(
        F.try_divide(value(first), value(second)).alias("common_ratio")
    )
    return grid.join(F.broadcast(common), F.col("discount_rate") == F.col("_rate")).drop("_rate")


def segment_margin_all(economics: DataFrame) -> DataFrame:
    """Margins of all six segments, the overall totals, and whether each step down
    the segments lowers the margin."""
    order = segment_table(economics.sparkSession).select("segment", "sort_order")
    rows = _with_margin(economics).join(F.broadcast(order), "segment").select(
        "segment", "revenue", "profit", "mean_order_discount_pct", "gross_margin", "sort_order"
    )
    above = rows.select((F.col("sort_order") + 1).alias("_next"), F.col("gross_margin").alias("_above"))
    totals = economics.agg(
        F.sum("orders").alias("all_orders"), F.sum("revenue").alias("all_revenue"),
        F.sum("profit").alias("all_profit"), F.max("pct_max").alias("max_order_discount_pct"),
    )
    return (
        rows.join(F.broadcast(above), F.col("sort_order") == F.col("_next"), "left")
        .withColumn("falls_from_above", F.coalesce(F.col("_above") > F.col("gross_margin"), F.lit(False)))
        .drop("_next", "_above").crossJoin(F.broadcast(totals)).orderBy("sort_order")
    )


def compound_discount(focus: DataFrame) -> DataFrame:
    """Discount off list with the offer on top, and the contact cost that uses up
    the contribution of one recovered order."""
    per_order = F.col("aov") * F.col("contribution")
    contacts = 100 / DEFAULT_REACTIVATION_RATE
    return focus.select(
        "segment",
        (1 - (1 - F.col("mean_order_discount_pct").cast("double")) * (1 - F.col("discount"))).alias("off_list_with_offer"),
        per_order.alias("contribution_per_order"),
        (per_order / contacts).alias("break_even_contact_cost"),
    )


def reconciliation(baskets: DataFrame, items: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Orders whose value over list value strays from 1 - discount."""
    gross = items.groupBy("order_id").agg(
        F.sum(F.col("quantity").cast("decimal(18,0)") * F.col("unit_price")).alias("list_value")
    )
    gap = F.abs(
        ratio(F.col("line_value"), F.col("list_value")) - (1 - F.col("order_discount_pct").cast("double"))
    )
    return baskets.filter("line_count > 0").join(gross, "order_id").agg(
        F.count("*").alias("orders"),
        F.count_if(gap <= tolerance).alias("within_tolerance"),
        F.count_if(gap > tolerance).alias("outside_tolerance"),
    )


def _long(df: DataFrame, group: str, key: str | None, figures: dict[str, tuple[str, str, str | None]]) -> DataFrame:
    """Columns of a small frame as rows (name, value, text, unit, class, formula)."""
    parts = ", ".join(
        f"'{name}', " + (f"cast(null as double), {column}, " if unit == "text" else f"cast({column} as double), cast(null as string), ") + f"'{unit}', "
        + ("'live', cast(null as string)" if formula is None else f"'derived', '{formula}'")
        for name, (column, unit, formula) in figures.items()
    )
    prefix = f"'{group}.'" if key is None else f"'{group}.' || lower(replace({key}, ' ', '_')) || '.'"
    return df.selectExpr(
        f"{prefix} as _p", f"stack({len(figures)}, {parts}) as (_name, value, text, unit, class, formula)"
    ).select(F.concat("_p", "_name").alias("name"), "value", "text", "unit", "class", "formula")


def figures(economics: DataFrame, segments: DataFrame, baskets: DataFrame, items: DataFrame) -> DataFrame:
    """Every figure of the win-back analysis as a long table.

    ``economics`` is read many times, so pass a stage table. Names and formula texts are
    fixed values. Figures quoted from documents, which no table yields, are not among them.
    """
    spark = economics.sparkSession
    shares = kept(segment_shares(segments), "segment_shares")  # six rows
    margins = segment_margin_all(economics)
    focus = focus_margin(economics)
    per_euro = contribution_per_euro(economics)
    grid = rate_grid(economics)
    extra = compound_discount(focus)
    totals = margins.limit(1)
    pool = shares.filter(F.col("segment").isin(*WIN_BACK_SEGMENTS)).agg(
        F.sum("customers").alias("customers"), F.sum("revenue").alias("spend"),
        F.sum("customer_share_pct").alias("customer_share"), F.sum("revenue_share_pct").alias("revenue_share"),
    )
    scored = shares.agg(F.sum("customers").alias("customers"), F.sum("revenue").alias("revenue"))
    first, second = WIN_BACK_SEGMENTS
    pick = lambda s: F.max(F.when(F.col("segment") == s, F.col("contribution_per_eur")))
    ratios = per_euro.agg(F.try_divide(pick(first), pick(second)).alias("playbook")).crossJoin(
        grid.agg(F.min_by("common_ratio", "discount_rate").alias("common"))
    )
    slug = lambda c: F.lower(F.replace(c, F.lit(" "), F.lit("_")))
    at = grid.select(
        F.concat(slug(F.col("segment")), F.lit(".r"), F.round(F.col("discount_rate") * 100).cast("int").cast("string")).alias("segment"),
        "contribution_per_eur", slug(F.col("segment")).alias("_of"), F.round(F.col("discount_rate") * 100).cast("int").cast("string").alias("_rate"),
    )

    def rates(group: str, scale: int, unit: str) -> DataFrame:
        tail = "" if scale == 1 else f" x {scale:,}"
        return at.select(
            F.concat(F.lit(f"rates.{group}."), "segment").alias("name"), (F.col("contribution_per_eur") * scale).alias("value"),
            F.lit(None).cast("string").alias("text"), F.lit(unit).alias("unit"), F.lit("derived").alias("class"),
            F.concat(F.lit("(focus."), "_of", F.lit(".gross_margin_pct - "), "_rate", F.lit(") / "), "_rate", F.lit(tail)).alias("formula"),
        )

    offered = playbook(spark)
    common = grid.agg(F.min(F.round(F.col("discount_rate") * 100).cast("int")).cast("string").alias("_r"))
    a, b = (s.lower().replace(" ", "_") for s in WIN_BACK_SEGMENTS)
    parts = [
        _long(reconciliation(baskets, items), "totals", None, {
            "orders_outside_tolerance": ("outside_tolerance", "count", None), "order_value_tolerance": ("0.001", "number", None)}),
        _long(scored, "totals", None, {
            "scored_customers": ("customers", "count", None), "revenue_base_eur": ("revenue", "eur", None)}),
        _long(totals, "totals", None, {
            "orders": ("all_orders", "count", None),
            "profit_margin_pct": ("100 * cast(all_profit as double) / cast(all_revenue as double)", "pct", None)}),
        _long(shares, "segments", "segment", {
            "customers": ("customers", "count", None),
            "customer_share_pct": ("customer_share_pct", "pct", "customers / totals.scored_customers x 100"),
            "lifetime_spend_eur": ("revenue", "eur", None),
            "revenue_share_pct": ("revenue_share_pct", "pct", "lifetime_spend_eur / totals.revenue_base_eur x 100")}),
        _long(margins, "segments", "segment", {"gross_margin_pct": ("100 * gross_margin", "pct", None)}),
        _long(pool, "win_back", None, {
            "customers": ("customers", "count", f"segments.{a}.customers + segments.{b}.customers"),
            "customer_share_pct": ("customer_share", "pct", "customers / totals.scored_customers x 100"),
            "lifetime_spend_eur": ("spend", "eur", f"segments.{a}.lifetime_spend_eur + segments.{b}.lifetime_spend_eur"),
            "revenue_share_pct": ("revenue_share", "pct", "lifetime_spend_eur / totals.revenue_base_eur x 100")}),
        _long(focus, "focus", "segment", {
            "orders": ("orders", "count", None), "revenue_eur": ("revenue", "eur", None),
            "profit_eur": ("profit", "eur", None), "aov_eur": ("aov", "eur", "revenue_eur / orders"),
            "gross_margin_pct": ("100 * gross_margin", "pct", None),
            "discount_pct": ("100 * discount", "pct", None),
            "kept_pts": ("100 * contribution", "pts", "gross_margin_pct - discount_pct"),
            "mean_realised_discount_pct": ("100 * mean_order_discount_pct", "pct", None)}),
        _long(per_euro, "focus", "segment", {
            "per_euro": ("contribution_per_eur", "ratio", "kept_pts / discount_pct"),
            "per_1000_eur": ("contribution_per_1000", "eur", "per_euro x 1,000")}),
        _long(extra, "focus", "segment", {
            "per_order_eur": ("contribution_per_order", "eur", "aov_eur x kept_pts / 100"),
            "off_list_with_offer_pct": ("100 * off_list_with_offer", "pct", "100 x (1 - (1 - mean_realised_discount_pct / 100) x (1 - discount_pct / 100))"),
            "contact_cost_eur": ("break_even_contact_cost", "eur", "per_order_eur / (100 / other.planning_reactivation_rate_pct)")}),
        _long(offered, "focus", "segment", {"budget_allocation": ("budget_allocation", "text", None)}),
        _long(offered, "focus", "segment", {"budget_share_pct": ("budget_share_pct", "pct", "the percentage in focus.")})
        .withColumn("formula", F.concat("formula", F.element_at(F.split("name", "[.]"), 2), F.lit(".budget_allocation"))),
        rates("per_euro", 1, "ratio"), rates("per_1000_eur", 1000, "eur"),
        _long(ratios, "ratios", None, {
            "playbook": ("playbook", "ratio", f"focus.{a}.per_euro / focus.{b}.per_euro"),
            "common": ("common", "ratio", "")}).join(F.broadcast(common)).withColumn("formula", F.when(
                F.col("formula") != "", F.col("formula")).otherwise(F.concat(
                    F.lit(f"rates.per_euro.{a}.r"), "_r", F.lit(f" / rates.per_euro.{b}.r"), "_r",
                    F.lit("; the other playbook rate gives the same ratio at 1 dp")))).drop("_r"),
        _long(totals, "other", None, {
            "observed_max_discount_pct": ("100 * max_order_discount_pct", "pct", None),
            "planning_reactivation_rate_pct": (str(DEFAULT_REACTIVATION_RATE), "pct", None)}),
    ]
    return reduce(DataFrame.unionByName, parts)


def shared_order_counts(segments: DataFrame) -> DataFrame:
    """Customers who share an order count with a customer of another quintile."""
    per_count = segments.groupBy("frequency_orders").agg(
        F.count("*").alias("customers"), F.min("f_score").alias("low"), F.max("f_score").alias("high")
    )
    return per_count.agg(
        F.sum("customers").alias("scored_customers"),
        F.coalesce(F.sum(F.when(F.col("low") < F.col("high"), F.col("customers"))), F.lit(0)).alias("customers_split_across_quintiles"),
    )
