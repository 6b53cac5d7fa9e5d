"""Business measures over the star, by any axes and under any filters.

A measure aggregates one fact table. Filters and axes name dimension columns as
``"customer.country"``; they reach a fact only along these paths:

    orders    -> customer, date          lines -> customer, product, date
    customers -> customer                products -> product
    lifecycle -> date

A filter on a dimension without a path to the measure's fact leaves the measure
unchanged, and on such an axis the measure repeats its total.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.config import (
    ACTIVE_MAX_DAYS, COOLING_MAX_DAYS, DEFAULT_REACTIVATION_RATE, HEALTH_BANDS, KPI_CHOICES,
    REACTIVATION_RATES, RECENCY_BIN_DAYS, SEGMENT_STRATEGY, WIN_BACK_SEGMENTS,
)
from tallyloom.functions.numeric import ratio
from tallyloom.operators.ordering import group_percentiles, percentiles, rank_bands

PATHS = {
    "orders": ("customer", "date"),
    "lines": ("customer", "product", "date"),
    "customers": ("customer",),
    "products": ("product",),
    "lifecycle": ("date",),
}


def calendar(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """One row per day from first to last."""
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("date"))
    d = F.col("date")
    week_start = F.date_trunc("week", d).cast("date")
    jan1 = F.trunc(d, "year")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"),
        # Weeks start on Sunday and week 1 holds January 1.
        (F.floor((F.dayofyear(d) + F.dayofweek(jan1) - 2) / 7) + 1).cast("int").alias("week_of_year"),
        F.day(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.year(d) * 100 + F.month(d)).alias("year_month_number"),
        (F.weekday(d) + 1).alias("day_number"),
        week_start.alias("start_of_week"),
        F.trunc(d, "month").alias("start_of_month"),
        F.trunc(d, "quarter").alias("start_of_quarter"),
        jan1.alias("start_of_year"),
    )


def closed_months(days: DataFrame, orders: DataFrame) -> DataFrame:
    """Adds is_closed_month: the whole month lies within the order data."""
    last = orders.agg(F.max("order_date").alias("_last"))
    return (
        days.crossJoin(F.broadcast(last))
        .withColumn("is_closed_month", F.last_day("date") <= F.col("_last")).drop("_last")
    )


def recency_bin(days: Column) -> Column:
    return (F.floor(days / RECENCY_BIN_DAYS) * RECENCY_BIN_DAYS).cast("int")


def with_decile(customers: DataFrame) -> DataFrame:
    """Adds the spend decile over all customers; those without spend rank last."""
    spend = F.coalesce("total_spend", F.lit(0).cast("decimal(18,2)"))
    return customers.withColumn("customer_decile", rank_bands(customers, spend, 10))


def segment_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SEGMENT_STRATEGY,
        "segment string, email_cadence string, loyalty_tier string, discount_approach string, "
        "budget_allocation string, sort_order int",
    )


def reactivation_rates(spark: SparkSession) -> DataFrame:
    first, last, step = REACTIVATION_RATES
    return spark.range(first, last + 1, step).select(F.col("id").cast("int").alias("reactivation_rate"))


@dataclass(frozen=True)
class Star:
    """Facts and dimensions of the measure layer; the shop builds each when it is first asked for."""

    shop: object
    days: DataFrame

    @classmethod
    def of(cls, shop) -> "Star":
        cfg = shop.cfg
        return cls(shop, calendar(
            shop.spark, F.make_date(F.lit(cfg.start_year), F.lit(1), F.lit(1)), F.last_day(F.lit(cfg.as_of_date))
        ))

    @property
    def orders(self) -> DataFrame:
        return self.shop.curated

    @property
    def lines(self) -> DataFrame:
        return self.shop.lines

    @property
    def customers(self) -> DataFrame:
        return self.shop.dim_customers

    @property
    def products(self) -> DataFrame:
        return self.shop.products

    @property
    def lifecycle(self) -> DataFrame:
        return self.shop.new_returning

    @property
    def retention(self) -> DataFrame:
        return self.shop.retention

    def fact(self, name: str) -> DataFrame:
        if name == "lifecycle":
            return self.lifecycle.withColumn("order_date", F.col("revenue_month"))
        return getattr(self, name)

    def dimension(self, name: str) -> tuple[DataFrame, str, str]:
        """(table, key in the table, key in a fact)"""
        if name == "customer":
            return self.customers.withColumn("recency_bin", recency_bin(F.col("recency_days"))), "customer_id", "customer_id"
        return {"product": (self.products, "product_id", "product_id"), "date": (self.days, "date", "order_date")}[name]


@dataclass(frozen=True)
class Measure:
    """An aggregate of one fact, or a formula over other measures.

    A measure with its own filter on a dimension column replaces any axis or
    filter on that column: ``replaces`` names it.
    """

    fact: str | None
    build: Callable[..., Column]
    of: tuple[str, ...] = ()
    replaces: tuple[str, ...] = ()


def _at_risk() -> Column:
    return F.col("segment").isin(*WIN_BACK_SEGMENTS)


def _has_orders() -> Column:
    return F.col("order_count").isNotNull()


def _spend(test: Column) -> Callable[[], Column]:
    return lambda: F.sum(F.when(test, F.col("total_spend")))


def _sum(column: str) -> Callable[[], Column]:
    return lambda: F.sum(column)


def _avg(column: str) -> Callable[[], Column]:
    return lambda: ratio(F.sum(column), F.count(column))


def _or_zero(n: Column, d: Column) -> Column:
    return F.coalesce(ratio(n, d), F.lit(0.0))


# Order ids are unique in the order fact and customer ids in the customer
# table, so distinct counts of them are plain counts.
MEASURES: dict[str, Measure] = {
    "total_revenue": Measure("orders", _sum("order_value")),
    "total_profit": Measure("orders", _sum("order_profit")),
    "distinct_orders": Measure("orders", lambda: F.count("order_id")),
    "total_customers": Measure("customers", lambda: F.count_if(_has_orders() & F.col("customer_id").isNotNull())),
    "customer_spend": Measure("customers", _sum("total_spend")),
    "avg_recency_days": Measure("customers", _avg("recency_days")),
    "avg_frequency": Measure("customers", _avg("order_count")),
    "avg_monetary": Measure("customers", _avg("total_spend")),
    "avg_r_score": Measure("customers", _avg("r_score")),
    "avg_f_score": Measure("customers", _avg("f_score")),
    "avg_m_score": Measure("customers", _avg("m_score")),
    "avg_health_score": Measure("customers", _avg("health_score")),
    "revenue_at_risk": Measure("customers", lambda: F.sum(F.when(_at_risk(), F.col("total_spend"))), replaces=("customer.segment",)),
    "customers_at_risk": Measure("customers", lambda: F.count_if(_at_risk() & _has_orders()), replaces=("customer.segment",)),
    "revenue_active": Measure("customers", lambda: F.sum(F.when(F.col("recency_days") <= ACTIVE_MAX_DAYS, F.col("total_spend")))),
    "revenue_cooling": Measure("customers", lambda: F.sum(F.when(
        (F.col("recency_days") > ACTIVE_MAX_DAYS) & (F.col("recency_days") <= COOLING_MAX_DAYS), F.col("total_spend")))),
    "revenue_dormant": Measure("customers", lambda: F.sum(F.when(F.col("recency_days") > COOLING_MAX_DAYS, F.col("total_spend")))),
    "line_revenue": Measure("lines", _sum("line_net_amount")),
    "line_profit": Measure("lines", _sum("line_profit")),
    "line_quantity": Measure("lines", _sum("quantity")),
    "total_products": Measure("products", lambda: F.countDistinct("product_id")),
    "total_brands": Measure("products", lambda: F.countDistinct("brand")),
    "lifecycle_revenue": Measure("lifecycle", _sum("revenue")),
    "returning_revenue": Measure("lifecycle", lambda: F.sum(F.when(F.col("customer_type") == "Returning", F.col("revenue")))),
    # Formulas
    "total_orders": Measure(None, lambda o: o, ("distinct_orders",)),
    "avg_order_value": Measure(None, _or_zero, ("total_revenue", "distinct_orders")),
    "avg_customer_ltv": Measure(None, _or_zero, ("total_revenue", "total_customers")),
    "profit_margin_pct": Measure(None, _or_zero, ("total_profit", "total_revenue")),
    "line_margin_pct": Measure(None, _or_zero, ("line_profit", "line_revenue")),
    "grain_reconciliation": Measure(None, lambda o, l: o - l, ("total_revenue", "line_revenue")),
    "arpu": Measure(None, _or_zero, ("customer_spend", "total_customers")),
}

# The choices of the KPI selector, by label.
KPI_MEASURES = dict(zip(KPI_CHOICES, (
    "total_revenue", "total_customers", "avg_order_value", "avg_recency_days", "revenue_at_risk",
)))


def _reached(fact: str, names: Sequence[str]) -> list[str]:
    return [n for n in names if n.split(".")[0] in PATHS[fact]]


def _short(name: str) -> str:
    return name.split(".", 1)[1]


def _joined(star: Star, fact: str, names: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """The fact with the dimension columns ``names``, the dimension already pruned."""
    base = star.fact(fact) if base is None else base
    own = {"customers": "customer", "products": "product"}.get(fact)
    for dimension in _dimensions(names):
        columns = [_short(n) for n in names if n.startswith(f"{dimension}.")]
        table, key, fact_key = star.dimension(dimension)
        if dimension == own:
            base = table.withColumns({f"_{dimension}_{c}": F.col(c) for c in columns})
            continue
        side = table.select(
            F.col(key).alias("_key"), *[F.col(c).alias(f"_{dimension}_{c}") for c in columns]
        )
        if dimension == "date":
            side = F.broadcast(side)  # one row per calendar day
        base = base.join(side, F.col(fact_key) == F.col("_key"), "left").drop("_key")
    return base


def _dimensions(names: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(n.split(".")[0] for n in names))


def _aggregated(
    star: Star, fact: str, measures: Sequence[str], axes: Sequence[str], where: dict[str, Sequence],
    levels: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """One fact's measures per axis combination, or per grouping of ``levels`` with its number in ``grouping``.

    The measures of the order and line facts are sums and counts, so these facts
    are first summed per dimension key: a customer or product holding very many
    rows is folded into one row before the join.
    """
    columns = list(dict.fromkeys([*axes, *where]))
    build = {n: MEASURES[n].build() for n in measures}
    base = None
    if fact in ("orders", "lines") and columns:
        base = _folded(star, fact, measures, columns)
        build = {n: F.sum(n) for n in measures}
    base = _joined(star, fact, columns, base)
    for name, values in where.items():
        if isinstance(values, DataFrame):  # a few rows
            wanted = F.broadcast(values.select(F.col(values.columns[0]).alias("_wanted")))
            base = base.join(wanted, F.col(_flat(name)) == F.col("_wanted"), "left_semi")
        else:
            base = base.filter(F.col(_flat(name)).isin(*values))
    if levels is not None:
        flat = [_flat(a) for a in axes]
        grouped = base.groupingSets([[F.col(_flat(a)) for a in one] for one in levels], *flat)
        rows = grouped.agg(F.grouping_id().alias("grouping"), *[c.alias(n) for n, c in build.items()])
        return rows.select(*[F.col(_flat(a)).alias(_short(a)) for a in axes], "grouping", *build)
    return base.groupBy(*[F.col(_flat(a)).alias(_short(a)) for a in axes]).agg(
        *[c.alias(n) for n, c in build.items()]
    )


def _folded(star: Star, fact: str, measures: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Additive measures per key of the dimensions that the columns belong to."""
    keys = [star.dimension(d)[2] for d in _dimensions(columns)]
    return star.fact(fact).groupBy(*keys).agg(*[MEASURES[n].build().alias(n) for n in measures])


def _flat(name: str) -> str:
    dimension, column = name.split(".", 1)
    return f"_{dimension}_{column}"


def evaluate(
    star: Star, names: Sequence[str], by: Sequence[str] = (), where: dict[str, Sequence] | None = None
) -> DataFrame:
    """Measures ``names`` per combination of axis columns ``by``.

    ``where`` keeps the listed values of dimension columns, or those of a small
    frame's first column. Rows are the axis values the filtered facts know; axis
    columns carry their short names.
    """
    where = where or {}
    needed = list(dict.fromkeys(
        base for n in names for base in (MEASURES[n].of or (n,))
    ))
    groups: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    for n in needed:
        groups.setdefault((MEASURES[n].fact, MEASURES[n].replaces), []).append(n)
    if any(set(replaced) & set(by) for _, replaced in groups):
        # the axis values of a replaced column come from the customers
        groups.setdefault(("customers", ()), []).append("customer_spend")
    axes = [_short(a) for a in by]
    frames = []
    for (fact, replaced), members in groups.items():
        reached = [a for a in _reached(fact, by) if a not in replaced]
        filters = {f: where[f] for f in _reached(fact, list(where)) if f not in replaced}
        frame = _aggregated(star, fact, list(dict.fromkeys(members)), reached, filters)
        frames.append(([_short(a) for a in reached], frame))
    # The widest frames first: they define the axis rows.
    frames.sort(key=lambda f: -len(f[0]))
    covered, out = frames[0]
    for keys, frame in frames[1:]:
        if not keys:
            out = out.crossJoin(F.broadcast(frame))  # one row
            continue
        other = frame.withColumnsRenamed({k: f"_r_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
        how = "full" if keys == covered else "left"
        out = out.join(other, same, how)
        if how == "full":
            out = out.withColumns({k: F.coalesce(k, f"_r_{k}") for k in keys})
        out = out.drop(*[f"_r_{k}" for k in keys])
    formulas = {
        n: MEASURES[n].build(*[F.col(c) for c in MEASURES[n].of]) for n in names if MEASURES[n].fact is None
    }
    return out.withColumns(formulas).select(*axes, *names) if formulas else out.select(*axes, *names)


def evaluate_levels(
    star: Star, names: Sequence[str], by: Sequence[str], levels: Sequence[Sequence[str]], where: dict[str, Sequence] | None = None
) -> DataFrame:
    """``evaluate`` for several groupings of ``by`` at once: details, subtotals and totals, one scan per fact.

    ``grouping`` has a bit per axis, the first one highest, set where a row sums over the axis.
    Ratios are formed at each grouping from its own sums. Every fact must reach every axis.
    """
    where = where or {}
    needed = list(dict.fromkeys(base for n in names for base in (MEASURES[n].of or (n,))))
    groups: dict[str, list[str]] = {}
    for n in needed:
        if set(MEASURES[n].replaces) & {*by, *where} or len(_reached(MEASURES[n].fact, by)) < len(by):
            raise ValueError(f"{n} has no subtotals by {', '.join(by)}")
        groups.setdefault(MEASURES[n].fact, []).append(n)
    axes = [*map(_short, by), "grouping"]
    out = None
    for fact, members in groups.items():
        filters = {f: where[f] for f in _reached(fact, list(where))}
        frame = _aggregated(star, fact, members, by, filters, levels)
        if out is None:
            out = frame
            continue
        other = frame.withColumnsRenamed({k: f"_r_{k}" for k in axes})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in axes])
        out = out.join(other, same, "full").withColumns({k: F.coalesce(k, f"_r_{k}") for k in axes})
    formulas = {n: MEASURES[n].build(*[F.col(c) for c in MEASURES[n].of]) for n in names if MEASURES[n].fact is None}
    return out.withColumns(formulas).select(*axes, *names)


def evaluate_contexts(
    star: Star, names: Sequence[str], contexts: dict[str, dict[str, Sequence]], by: Sequence[str] = ()
) -> DataFrame:
    """Measures of one order or line fact under several filters at once: one scan, whatever their number.

    ``contexts`` names the filters, each as ``where`` in ``evaluate``. A row per combination of axis
    values has a column ``context_measure`` for each pair, and ``context_seen``, whether the context
    holds any row. An axis value that no context holds has its row too, with NULL.
    """
    fact = MEASURES[names[0]].fact
    if fact not in ("orders", "lines") or any(MEASURES[n].fact != fact for n in names):
        raise ValueError(f"{', '.join(names)} are no sums over one order or line fact")
    filters = {c: {f: where[f] for f in _reached(fact, list(where))} for c, where in contexts.items()}
    axes = _reached(fact, by)
    columns = list(dict.fromkeys([*axes, *(f for where in filters.values() for f in where)]))
    base = _joined(star, fact, columns, _folded(star, fact, names, columns))
    out = []
    for number, (context, where) in enumerate(filters.items()):
        inside = F.lit(True)
        for place, (name, values) in enumerate(where.items()):
            if isinstance(values, DataFrame):  # a few rows
                flag, wanted = f"_in_{number}_{place}", f"_wanted_{number}_{place}"
                marked = values.select(F.col(values.columns[0]).alias(wanted)).distinct().withColumn(flag, F.lit(True))
                base = base.join(F.broadcast(marked), F.col(_flat(name)) == F.col(wanted), "left").drop(wanted)
                inside = inside & F.coalesce(F.col(flag), F.lit(False))
            else:
                inside = inside & F.coalesce(F.col(_flat(name)).isin(*values), F.lit(False))
        out += [F.sum(F.when(inside, F.col(n))).alias(f"{context}_{n}") for n in names]
        out.append((F.count_if(inside) > 0).alias(f"{context}_seen"))
    return base.groupBy(*[F.col(_flat(a)).alias(_short(a)) for a in axes]).agg(*out)


# --- measures that need more than one aggregation ----------------------------

def kpi_selector(star: Star, choice: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """The chosen KPI as (axis..., kpi, value); an unknown choice means revenue."""
    name = KPI_MEASURES.get(choice or "", "total_revenue")
    axes = [_short(a) for a in by]
    return evaluate(star, [name], by).select(
        *axes, F.lit(choice or KPI_CHOICES[0]).alias("kpi"), F.col(name).cast("double").alias("value")
    )


def all_kpis(star: Star) -> DataFrame:
    """Every choice of the KPI selector, in order."""
    row = evaluate(star, list(dict.fromkeys(KPI_MEASURES.values())))
    parts = ", ".join(
        f"{i}, '{label}', cast({name} as double)" for i, (label, name) in enumerate(KPI_MEASURES.items(), 1)
    )
    return row.selectExpr(f"stack({len(KPI_MEASURES)}, {parts}) as (sort_order, kpi, value)")


def share_of_all(star: Star, by: str, where: dict[str, Sequence] | None = None) -> DataFrame:
    """Customers and spend per axis value, and their shares of all customers."""
    part = evaluate(star, ["total_customers", "customer_spend"], [by], where)
    whole = evaluate(star, ["total_customers", "customer_spend"]).withColumnsRenamed(
        {"total_customers": "_customers", "customer_spend": "_spend"}
    )
    return part.crossJoin(F.broadcast(whole)).select(
        _short(by), "total_customers", "customer_spend",
        F.coalesce(ratio(F.col("total_customers"), F.col("_customers")), F.lit(0.0)).alias("customer_share"),
        F.coalesce(ratio(F.col("customer_spend"), F.col("_spend")), F.lit(0.0)).alias("revenue_share"),
    )


def revenue_at_risk(star: Star, where: dict[str, Sequence] | None = None) -> DataFrame:
    part = evaluate(star, ["revenue_at_risk", "customers_at_risk"], (), where)
    whole = evaluate(star, ["customer_spend"])
    return part.crossJoin(F.broadcast(whole)).select(
        "revenue_at_risk", "customers_at_risk",
        F.coalesce(ratio(F.col("revenue_at_risk"), F.col("customer_spend")), F.lit(0.0)).alias("pct_revenue_at_risk"),
    )


def what_if(star: Star, spark: SparkSession, rate: int | None = None) -> DataFrame:
    """Spend recovered at each reactivation rate, or at one rate (10 by default)."""
    rates = reactivation_rates(spark)
    if rate is not None:
        rates = rates.filter(F.col("reactivation_rate") == rate)
    return rates.crossJoin(F.broadcast(evaluate(star, ["revenue_at_risk"]))).select(
        "reactivation_rate",
        (F.col("revenue_at_risk").cast("double") * F.col("reactivation_rate") / 100).alias("revenue_impact"),
        (F.col("reactivation_rate") == DEFAULT_REACTIVATION_RATE).alias("is_default"),
    )


def medians(star: Star, where: dict[str, Sequence] | None = None) -> DataFrame:
    """Median recency and spend of the selected customers."""
    customers = _joined(star, "customers", list(where or {}) or ["customer.segment"])
    for name, values in (where or {}).items():
        customers = customers.filter(F.col(_flat(name)).isin(*values))
    out = {}
    for column in ("recency_days", "total_spend"):
        cut = percentiles(customers, F.col(column), ["0.5"]).get("0.5")
        out[f"median_{column}"] = None if cut is None else float(cut)
    return star.customers.sparkSession.createDataFrame(
        [(out["median_recency_days"], out["median_total_spend"])],
        "median_recency_days double, median_total_spend double",
    )


def medians_by(star: Star, by: Sequence[str], levels: Sequence[Sequence[str]], where: dict[str, Sequence] | None = None) -> DataFrame:
    """Median recency and spend of every group of several groupings of the customers, in one job."""
    customers = _joined(star, "customers", list(dict.fromkeys([*by, *(where or {})])))
    for name, values in (where or {}).items():
        customers = customers.filter(F.col(_flat(name)).isin(*values))
    found = group_percentiles(
        customers, [_flat(a) for a in by], [[_flat(a) for a in one] for one in levels],
        {f"median_{c}": (c, "0.5") for c in ("recency_days", "total_spend")},
    )
    return found.withColumnsRenamed({_flat(a): _short(a) for a in by})


def brand_margins(star: Star) -> DataFrame:
    """Line revenue, profit and margin per brand with sales."""
    return evaluate(star, ["line_revenue", "line_profit", "line_margin_pct"], ["product.brand"])


def brand_headline(star: Star) -> DataFrame:
    """Sold brands, the leading brand, and the margin measures over all brands; an unsold one has margin 0."""
    sold = brand_margins(star).filter("line_revenue IS NOT NULL").withColumnRenamed("brand", "_sold")
    every = star.products.select("brand").distinct().join(sold, F.col("brand") == F.col("_sold"), "left")
    brands = every.withColumn("line_margin_pct", F.coalesce("line_margin_pct", F.lit(0.0)))
    return brands.agg(
        F.count("line_revenue").alias("sold_brands"),
        # Largest revenue; on a tie the first name.
        F.min_by("brand", F.struct((-F.col("line_revenue")).alias("a"), F.col("brand").alias("b"))).alias("top_brand"),
        F.max("line_revenue").alias("top_brand_revenue"),
        # Ten digits: a sum of doubles depends on row order beyond that.
        F.round(ratio(F.sum("line_margin_pct"), F.count("line_margin_pct")), 10).alias("avg_brand_margin_pct"),
        F.min("line_margin_pct").alias("min_brand_margin_pct"),
        F.max("line_margin_pct").alias("max_brand_margin_pct"),
        F.coalesce(ratio(F.sum("line_profit"), F.sum("line_revenue")), F.lit(0.0)).alias("margin_baseline"),
    )


def lifecycle_share(star: Star) -> DataFrame:
    """Lifecycle revenue and the returning share, to the nearest 5 percent."""
    row = evaluate(star, ["lifecycle_revenue", "returning_revenue"])
    share = ratio(F.col("returning_revenue"), F.col("lifecycle_revenue"))
    return row.select(
        "lifecycle_revenue", "returning_revenue", share.alias("returning_share"),
        (F.round(share * 100 / 5) * 5).cast("int").alias("returning_pct_nearest_5"),
    )


def health_band(score: Column) -> Column:
    out = None
    for least, name in HEALTH_BANDS[:-1]:
        out = F.when(score >= least, name) if out is None else out.when(score >= least, name)
    return out.otherwise(HEALTH_BANDS[-1][1])


def health_indicator(star: Star, by: Sequence[str]) -> DataFrame:
    return evaluate(star, ["avg_health_score"], by).withColumn(
        "health_indicator", health_band(F.col("avg_health_score"))
    )


def filter_flags(star: Star, where: dict[str, Sequence] | None = None) -> DataFrame:
    """1 when the filters narrow the regions / leave fewer countries than all."""
    where = where or {}
    visible = star.customers
    for name in ("customer.country", "customer.state"):
        if name in where:
            visible = visible.filter(F.col(_short(name)).isin(*where[name]))
    seen = visible.agg(F.countDistinct("country").alias("visible_countries"))
    every = star.customers.agg(F.countDistinct("country").alias("all_countries"))
    country_named = F.lit("customer.country" in where)
    return seen.crossJoin(every).select(
        "visible_countries", "all_countries",
        F.lit(int("customer.state" in where)).alias("region_filter_active"),
        F.when(country_named & (F.col("visible_countries") < F.col("all_countries")), 1).otherwise(0)
        .alias("country_filter_active"),
    )


def map_shares(star: Star, core: Sequence[str], where: dict[str, Sequence] | None = None) -> DataFrame:
    """Core-market share, and the selection's share of the total and of its countries.

    ``core`` lists the countries of the home region; they replace a filter on countries.
    The country total is that of the countries the selection shows, without a filter on states.
    """
    where = where or {}
    rest = {k: v for k, v in where.items() if k not in ("customer.state", "customer.country")}
    contexts = {"selected": where, "all": {}, "rest": rest, "core": {**where, "customer.country": list(core)}}
    countries = evaluate_contexts(star, ["total_revenue"], contexts, ["customer.country"])
    row = countries.agg(
        F.sum("selected_total_revenue").alias("selected_revenue"), F.sum("all_total_revenue").alias("all_revenue"),
        F.sum(F.when(F.col("selected_seen") & F.col("country").isNotNull(), F.col("rest_total_revenue"))).alias("country_total_revenue"),
        F.sum("core_total_revenue").alias("core_revenue"),
    )
    return row.select(
        "selected_revenue", "country_total_revenue",
        ratio(F.col("core_revenue"), F.col("selected_revenue")).alias("core_share"),
        ratio(F.col("selected_revenue"), F.col("all_revenue")).alias("share_of_total"),
        ratio(F.col("selected_revenue"), F.col("country_total_revenue")).alias("share_of_country"),
    )


def context_counts(star: Star) -> DataFrame:
    """The counts quoted in captions."""
    orders = star.orders.agg(F.countDistinct("source_month").alias("source_months"))
    places = star.customers.agg(F.countDistinct("country").alias("countries")).crossJoin(
        star.customers.agg(F.countDistinct("state").alias("states"))
    ).crossJoin(
        star.customers.agg(F.countDistinct("city").alias("cities"))
    ).crossJoin(
        star.customers.agg(F.countDistinct("segment").alias("segments"))
    )
    cohorts = star.retention.agg(
        F.count_if(F.col("months_since_acquisition") == 0).alias("cohorts"),
        F.min("cohort_month").alias("first_cohort"),
        F.max("cohort_month").alias("last_cohort"),
        F.max("months_since_acquisition").alias("tenure_months"),
    )
    return orders.crossJoin(places).crossJoin(cohorts)


def of_customer(df: DataFrame, customer: DataFrame) -> DataFrame:
    """The rows of the customer that a one-row frame names."""
    wanted = F.broadcast(customer.select(F.col("customer_id").alias("_wanted")))
    return df.join(wanted, F.col("customer_id") == F.col("_wanted"), "left_semi")


def customer_readout(star: Star, customer: DataFrame) -> DataFrame:
    """Recency, health score and score label of one customer."""
    label = F.when(
        F.col("r_score").isNotNull(),
        F.concat(
            F.lit("R"), F.col("r_score").cast("string"), F.lit(" · F"), F.col("f_score").cast("string"),
            F.lit(" · M"), F.col("m_score").cast("string"),
        ),
    )
    return of_customer(star.customers, customer).select(
        "customer_id", "segment", "city", "country", "recency_days", "health_score",
        label.alias("rfm_label"), health_band(F.col("health_score")).alias("health_indicator"),
    )


# --- time intelligence --------------------------------------------------------

def daily_totals(star: Star, where: dict[str, Sequence] | None = None, by: Sequence[str] = ()) -> DataFrame:
    return evaluate(star, ["total_revenue", "total_profit"], [*by, "date.date"], where)


def prior_year(
    star: Star, period: str = "start_of_month", where: dict[str, Sequence] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Revenue, profit and margin per period, and per value of the axes ``by``, beside those of the same dates a year before.

    The dates in context are shifted, not the periods: a period that the calendar cuts
    short meets the same days of the year before. A sale counts as last year's for the
    date twelve months on, so a leap day counts for February 28. Periods appear when
    they have sales of their own or of the year before. Works on daily totals.
    """
    if period not in ("start_of_month", "start_of_quarter", "start_of_year"):
        raise ValueError("period must be a month, quarter or year start")
    daily, axes = daily_totals(star, where, by), [_short(a) for a in by]
    days = F.broadcast(star.days.select(F.col("date").alias("_d"), period))  # one row per calendar day

    def side(date: Column, revenue: str, profit: str, key: str) -> DataFrame:
        dated = daily.select(*axes, date.alias("_on"), "total_revenue", "total_profit").join(days, F.col("_on") == F.col("_d"))
        return dated.groupBy(F.col(period).alias(key), *[F.col(a).alias(f"{key}_{a}") for a in axes]).agg(
            F.sum("total_revenue").cast("decimal(28,2)").alias(revenue), F.sum("total_profit").cast("decimal(28,2)").alias(profit),
        )

    now = side(F.col("date"), "total_revenue", "total_profit", "_now")
    past = side(F.add_months("date", 12), "revenue_py", "profit_py", "_past")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(28,2)"))
    same = reduce(lambda a, b: a & b, [F.col(f"_now_{a}").eqNullSafe(F.col(f"_past_{a}")) for a in axes], F.col("_now") == F.col("_past"))
    return now.join(past, same, "full").withColumns({
        **{a: F.coalesce(f"_now_{a}", f"_past_{a}") for a in axes},
        period: F.coalesce("_now", "_past"),
        "profit_margin_pct": _or_zero(F.col("total_profit"), F.col("total_revenue")),
        "profit_margin_py": _or_zero(F.col("profit_py"), F.col("revenue_py")),
        "revenue_yoy_pct": ratio(zero("total_revenue") - zero("revenue_py"), F.col("revenue_py")),
        "profit_yoy_pct": ratio(zero("total_profit") - zero("profit_py"), F.col("profit_py")),
    }).drop("_now", "_past", *[f"{side}_{a}" for side in ("_now", "_past") for a in axes]).withColumn("profit_margin_yoy_pp", F.col("profit_margin_pct") - F.col("profit_margin_py"))


def rolling_12m(
    star: Star, period: str = "start_of_week", where: dict[str, Sequence] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Revenue per period, and over the 12 months up to the period's last day.

    With axes ``by``, see ``_rolling_by``.

    NULL for periods that begin after the last sale and before a full window
    exists. Works on the calendar (one row per day): the window sum is the
    difference of two running sums, so no row meets a year of rows.
    """
    if by:
        return _rolling_by(star, period, where, by)
    daily = daily_totals(star, where)
    running = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = star.days.select("date").join(
        daily.select(F.col("date").alias("_d"), "total_revenue"), F.col("date") == F.col("_d"), "left"
    ).select("date", F.sum(F.coalesce("total_revenue", F.lit(0).cast("decimal(28,2)"))).over(running).alias("to_date"))
    span = star.orders.agg(F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"))
    revenue = evaluate(star, ["total_revenue"], [f"date.{period}"], where)
    points = star.days.groupBy(period).agg(F.min("date").alias("first_day"), F.max("date").alias("point"))
    start = sums.select(F.col("date").alias("_s"), F.col("to_date").alias("before"))
    end = sums.select(F.col("date").alias("_e"), "to_date")
    framed = (
        points.join(end, F.col("point") == F.col("_e"))
        .join(start, F.add_months("point", -12) == F.col("_s"), "left")
        .crossJoin(F.broadcast(span))
    )
    shown = (F.col("first_day") <= F.col("last_sale")) & (
        F.date_add(F.add_months("point", -12), 1) >= F.col("first_sale")
    )
    return framed.join(
        revenue.withColumnRenamed(period, "_p"), F.col(period) == F.col("_p"), "left"
    ).select(
        period, "total_revenue",
        F.when(shown, F.col("to_date") - F.coalesce("before", F.lit(0))).cast("decimal(28,2)").alias("revenue_rolling_12m"),
    ).orderBy(period)


def _rolling_by(star: Star, period: str, where: dict[str, Sequence] | None, by: Sequence[str]) -> DataFrame:
    """``rolling_12m`` per value of the axes, for values and periods with sales in the period or its window.

    A day's total counts for the periods whose window it lies in; those pairs follow from the
    calendar alone. Totals are summed per axis value and period, partly before the shuffle, so
    no axis value needs a window or a task of its own, and empty days take no rows.
    """
    axes = [_short(a) for a in by]
    span = star.orders.agg(F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale"))
    since = F.date_add(F.add_months("point", -12), 1)
    points = star.days.groupBy(period).agg(F.min("date").alias("first_day"), F.max("date").alias("point")).crossJoin(F.broadcast(span)).select(
        period, "first_day", F.explode(F.sequence(since, F.col("point"))).alias("_d"),
        ((F.col("first_day") <= F.col("last_sale")) & (since >= F.col("first_sale"))).alias("shown"),
    )
    daily = evaluate(star, ["total_revenue"], [*by, "date.date"], where)
    met = daily.join(F.broadcast(points), F.col("date") == F.col("_d"))  # a row per period and day of its window
    own = F.when(F.col("date") >= F.col("first_day"), F.col("total_revenue"))
    return met.groupBy(*axes, period, "shown").agg(
        F.sum(own).cast("decimal(28,2)").alias("total_revenue"), F.sum("total_revenue").cast("decimal(28,2)").alias("rolled"),
    ).withColumn("revenue_rolling_12m", F.when(F.col("shown"), F.col("rolled"))).filter(
        "total_revenue IS NOT NULL OR revenue_rolling_12m IS NOT NULL"
    ).select(*axes, period, "total_revenue", "revenue_rolling_12m")
