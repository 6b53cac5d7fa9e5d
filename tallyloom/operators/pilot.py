"""Readout of a win-back pilot: offer groups against holdouts, with intervals.

Customers of the win-back segments are assigned to groups by a seeded hash.
Contribution counts per assigned customer, zero without orders: order profit
less the offer's discount. A group's effect is its mean against its segment's
holdout; divided by the discount spent it is contribution per euro.

Intervals are bias-corrected and accelerated bootstrap intervals. A replicate
weights every customer by a Poisson(1) draw from a hash of customer and
replicate, so replicates are drawn where the rows are, summed before the
shuffle, and come out the same when a task is run again.
"""

from __future__ import annotations

import math
from datetime import date
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.numeric import ratio

# (segment, group, offer rate, upper end of the group's hash range)
PILOT_GROUPS = (
    ("At Risk", "offer_15", 0.15, 0.5),
    ("At Risk", "holdout", 0.0, 1.0),
    ("Hibernating", "offer_20", 0.20, 1 / 3),
    ("Hibernating", "offer_15", 0.15, 2 / 3),
    ("Hibernating", "holdout", 0.0, 1.0),
)


def hash_share(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of a seeded MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / 2**32


def assigned(segments: DataFrame, seed: int = 42) -> DataFrame:
    """(customer_id, segment, group, rate) of every eligible customer."""
    share = hash_share(F.col("customer_id"), seed)
    group = rate = None
    for segment, name, offer, end in PILOT_GROUPS:
        hit = (F.col("rfm_segment") == segment) & (share < end)
        group = F.when(hit, name) if group is None else group.when(hit, name)
        rate = F.when(hit, offer) if rate is None else rate.when(hit, offer)
    return segments.select(
        "customer_id", F.col("rfm_segment").alias("segment"), group.alias("group"), rate.alias("rate")
    ).filter("group IS NOT NULL")


def outcomes(groups: DataFrame, curated: DataFrame, first: date, last: date, contact_cost: float = 0.0) -> DataFrame:
    """Contribution and discount spend per assigned customer in the window.

    ``contact_cost`` is what contacting a customer of an offer group costs; holdouts are not contacted.
    """
    placed = (
        curated.filter(F.col("order_date").between(F.lit(first), F.lit(last)))
        .groupBy(F.col("customer_id").alias("_c"))
        .agg(F.sum("order_value").alias("value"), F.sum("order_profit").alias("profit"))
    )
    value = F.coalesce("value", F.lit(0)).cast("decimal(18,2)")
    profit = F.coalesce("profit", F.lit(0)).cast("decimal(18,2)")
    rate = F.col("rate").cast("decimal(4,2)")
    return groups.join(placed, F.col("customer_id") == F.col("_c"), "left").select(
        "customer_id", "segment", "group", "rate",
        (profit - rate * value - F.when(F.col("group") == "holdout", 0).otherwise(F.lit(contact_cost)).cast("decimal(10,4)")).alias("x"),
        (rate * value).alias("d"),
    )


def _effects(sums: DataFrame, extra: list[str]) -> DataFrame:
    """Effects from (segment, group, n, x, d): at most a few rows per replicate."""
    base = sums.filter("group = 'holdout'").select(
        F.col("segment").alias("_s"), *[F.col(c).alias(f"_{c}") for c in extra],
        ratio(F.col("x"), F.col("n")).alias("holdout_mean"),
    )
    same = F.col("segment") == F.col("_s")
    for c in extra:
        same = same & (F.col(c) == F.col(f"_{c}"))
    mean = ratio(F.col("x"), F.col("n"))
    return sums.filter("group <> 'holdout'").join(base, same).select(
        *extra, "segment", "group", "n", mean.alias("offer_mean"), "holdout_mean",
        (mean - F.col("holdout_mean")).alias("per_customer"),
        F.col("d").cast("double").alias("discount_spend"),
        ratio((mean - F.col("holdout_mean")) * F.col("n"), F.col("d")).alias("per_euro"),
    )


def readout(customers: DataFrame) -> DataFrame:
    """Incremental contribution per customer and per euro, per offer group."""
    sums = customers.groupBy("segment", "group").agg(
        F.count("*").cast("double").alias("n"), F.sum("x").alias("x"), F.sum("d").alias("d")
    )
    effects = _effects(sums, [])
    money = ("offer_mean", "holdout_mean", "per_customer", "discount_spend")
    return effects.withColumns({
        "n": F.col("n").cast("bigint"),
        **{c: F.round(c, 4) for c in money},
        "per_euro": F.round("per_euro", 8),
    })


def _poisson(draw: Column) -> Column:
    """Poisson(1) from a uniform draw of 52 bits: the chance of a weight above 18 is below one such bit."""
    weight, reached = F.lit(0), 0.0
    for k in range(18):
        reached += math.exp(-1) / math.factorial(k)
        weight = weight + F.when(draw >= reached, 1).otherwise(0)
    return weight


def replicates(customers: DataFrame, draws: int, seed: int = 42) -> DataFrame:
    """Effects of every bootstrap replicate."""
    rows = customers.select("*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("draw"), F.col("customer_id")))
    w = _poisson(F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / 2**52)
    sums = rows.withColumn("w", w).groupBy("draw", "segment", "group").agg(
        F.sum("w").cast("double").alias("n"), F.sum(F.col("w") * F.col("x")).alias("x"),
        F.sum(F.col("w") * F.col("d")).alias("d"),
    )
    return _effects(sums, ["draw"])


def acceleration(customers: DataFrame) -> DataFrame:
    """Skewness of the leave-one-out values of per_euro, per offer group.

    Leaving one customer out only changes the sums of the customer's own group,
    so every value follows from the sums of the two groups, a handful of rows.
    """
    sums = customers.groupBy("segment", "group").agg(
        F.count("*").cast("double").alias("n"), F.sum("x").cast("double").alias("sx"),
        F.sum("d").cast("double").alias("sd"),
    )
    offers = sums.filter("group <> 'holdout'")
    holdouts = sums.filter("group = 'holdout'").select(
        F.col("segment").alias("_h"), F.col("n").alias("nh"), F.col("sx").alias("sh")
    )
    pairs = offers.join(holdouts, F.col("segment") == F.col("_h")).select(
        F.col("segment").alias("_s"), F.col("group").alias("offer"), "n", "sx", "sd", "nh", "sh"
    )
    # Five sums: each customer meets one or two of them.
    met = customers.join(
        F.broadcast(pairs),
        (F.col("segment") == F.col("_s")) & ((F.col("group") == F.col("offer")) | (F.col("group") == "holdout")),
    )
    own = F.col("group") == F.col("offer")
    n, sx, sd = (
        F.when(own, F.col(t) - c).otherwise(F.col(t))
        for t, c in (("n", F.lit(1)), ("sx", F.col("x")), ("sd", F.col("d")))
    )
    nh = F.when(own, F.col("nh")).otherwise(F.col("nh") - 1)
    sh = F.when(own, F.col("sh")).otherwise(F.col("sh") - F.col("x"))
    left_out = F.try_divide(sx - n * F.try_divide(sh, nh), sd)
    moments = met.select("segment", "offer", left_out.alias("t")).groupBy("segment", "offer").agg(
        F.count("t").alias("m"), F.skewness("t").alias("skew")
    )
    # Sum of cubes over the 1.5th power of squares, times -1/6.
    return moments.select(
        "segment", F.col("offer").alias("group"), (-F.col("skew") / (6 * F.sqrt("m"))).alias("a")
    )


def normal_cdf(x: Column) -> Column:
    """Chance of a standard normal value up to x, by its power series; beyond 8 deviations as at 8."""
    x = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), x))
    start = F.struct(x.alias("term"), x.alias("total"))

    def add(s: Column, k: Column) -> Column:
        term = s["term"] * x * x / (2 * k + 1).cast("double")
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return F.lit(0.5) + density * F.aggregate(F.sequence(F.lit(1), F.lit(120)), start, add, lambda s: s["total"])


def normal_quantile(p: Column) -> Column:
    """The value that a standard normal one stays below with chance p, by Newton's steps from 0."""
    def step(z: Column, _: Column) -> Column:
        return z - (normal_cdf(z) - p) * math.sqrt(2 * math.pi) * F.exp(z * z / 2)

    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.lit(0.0), step)


def intervals(points: DataFrame, draws: DataFrame, skews: DataFrame, keys: list[str], level: float = 0.95) -> DataFrame:
    """(keys..., lower, upper): BCa intervals of the ``estimate`` in points.

    ``draws`` holds a ``value`` per replicate, ``skews`` the acceleration ``a``; a missing one is 0.
    A group's replicates, whose number is a parameter, are sorted as one array; a group without an
    estimate or a replicate has no row. Places between two replicates are interpolated.
    """
    known = points.filter("estimate IS NOT NULL").select(*keys, "estimate")
    ordered = draws.filter("value IS NOT NULL").groupBy(*keys).agg(F.sort_array(F.collect_list("value")).alias("ordered"))
    rows = known.join(ordered, keys).join(skews.select(*keys, "a"), keys, "left")
    below = F.size(F.filter("ordered", lambda v: v < F.col("estimate"))) + F.size(F.filter("ordered", lambda v: v == F.col("estimate"))) / 2
    rows = rows.withColumns({"size": F.size("ordered"), "below": below, "a": F.coalesce(F.nanvl("a", F.lit(0.0)), F.lit(0.0))})
    least = F.lit(0.5) / F.col("size")
    rows = rows.withColumn("z0", normal_quantile(F.least(F.greatest(F.col("below") / F.col("size"), least), 1 - least)))
    out = []
    for name, p in (("lower", (1 - level) / 2), ("upper", (1 + level) / 2)):
        z = F.col("z0") + NormalDist().inv_cdf(p)
        rows = rows.withColumn(f"_{name}", normal_cdf(F.col("z0") + z / (1 - F.col("a") * z)) * (F.col("size") - 1))
        at = F.col(f"_{name}")
        low = F.floor(at).cast("int")
        here, after = F.get("ordered", low), F.get("ordered", F.least(low + 1, F.col("size") - 1))
        out.append((here + (after - here) * (at - low)).alias(name))
    return rows.select(*keys, *out)


def pilot_intervals(customers: DataFrame, draws: int = 1000, seed: int = 42) -> DataFrame:
    """The readout with a 95 % BCa interval of contribution per euro."""
    keys = ["segment", "group"]
    point = readout(customers)
    drawn = replicates(customers, draws, seed).select(*keys, F.col("per_euro").alias("value"))
    bounds = intervals(point.withColumn("estimate", F.col("per_euro")), drawn, acceleration(customers), keys)
    return point.join(F.broadcast(bounds), keys, "left").withColumn(  # one row per offer group
        "verdict",
        F.when(F.col("upper") < 0, "stop").when(F.col("lower") > 0, "above break-even").otherwise("unresolved"),
    )


# --- decisions: differences between offers ---------------------------------------

# name: (offer, offer it is measured against, per euro of discount or per assigned customer)
CONTRASTS = {
    "rate_per_euro": (("Hibernating", "offer_15"), ("Hibernating", "offer_20"), True),
    "rate_per_customer": (("Hibernating", "offer_15"), ("Hibernating", "offer_20"), False),
    "priority_at_15": (("At Risk", "offer_15"), ("Hibernating", "offer_15"), True),
    "priority_at_20": (("At Risk", "offer_15"), ("Hibernating", "offer_20"), True),
}


def _group_key(segment: str, group: str) -> str:
    return f"{segment.lower().replace(' ', '_')}_{group}"


def _wide(customers: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """Weighted n, x and d of every group side by side."""
    sums = []
    for segment, group, *_ in PILOT_GROUPS:
        own = (F.col("segment") == segment) & (F.col("group") == group)
        key = _group_key(segment, group)
        sums += [
            F.sum(F.when(own, weight)).cast("double").alias(f"{key}_n"), F.sum(F.when(own, weight * F.col("x"))).cast("double").alias(f"{key}_x"),
            F.sum(F.when(own, weight * F.col("d"))).cast("double").alias(f"{key}_d"),
        ]
    return customers.groupBy(*by).agg(*sums)


def _contrast(name: str, at) -> Column:
    """A contrast from the sums that ``at`` gives for a group and one of n, x, d."""
    def effect(segment: str, group: str, per_euro: bool) -> Column:
        mean = lambda g: F.try_divide(at(segment, g, "x"), at(segment, g, "n"))
        gain = mean(group) - mean("holdout")
        return F.try_divide(gain * at(segment, group, "n"), at(segment, group, "d")) if per_euro else gain

    one, other, per_euro = CONTRASTS[name]
    return effect(*one, per_euro) - effect(*other, per_euro)


def _plain(segment: str, group: str, what: str) -> Column:
    return F.col(f"{_group_key(segment, group)}_{what}")


def contrasts(customers: DataFrame) -> DataFrame:
    """(contrast, value): the differences that the decision rule looks at."""
    row = _wide(customers, [], F.lit(1)).select(*[F.round(_contrast(c, _plain), 6).alias(c) for c in CONTRASTS])
    parts = ", ".join(f"'{c}', {c}" for c in CONTRASTS)
    return row.selectExpr(f"stack({len(CONTRASTS)}, {parts}) as (contrast, value)")


def replicate_contrasts(customers: DataFrame, draws: int, seed: int = 42) -> DataFrame:
    """Every contrast in every bootstrap replicate; a replicate's sums are taken before the shuffle."""
    rows = customers.select("*", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw"))
    digest = F.md5(F.concat_ws("|", F.lit(seed), F.col("draw"), F.col("customer_id")))
    weighted = rows.withColumn("w", _poisson(F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / 2**52))
    return _wide(weighted, ["draw"], F.col("w")).select("draw", *[_contrast(c, _plain).alias(c) for c in CONTRASTS])


def contrast_accelerations(customers: DataFrame) -> DataFrame:
    """One row: a jackknife acceleration per contrast, over the customers of its groups."""
    whole = F.broadcast(_wide(customers, [], F.lit(1)))  # one row

    def left_out(segment: str, group: str, what: str) -> Column:
        own = (F.col("segment") == segment) & (F.col("group") == group)
        part = {"n": F.lit(1.0), "x": F.col("x").cast("double"), "d": F.col("d").cast("double")}[what]
        return _plain(segment, group, what) - F.when(own, part).otherwise(0.0)

    met = customers.crossJoin(whole)
    out = []
    for name, ((s1, g1), (s2, g2), _) in CONTRASTS.items():
        member = ((F.col("segment") == s1) & F.col("group").isin(g1, "holdout")) | ((F.col("segment") == s2) & F.col("group").isin(g2, "holdout"))
        value = F.when(member, _contrast(name, left_out))
        out.append((-F.skewness(value) / (6 * F.sqrt(F.count(value)))).alias(name))
    return met.agg(*out)


def pilot_decisions(customers: DataFrame, draws: int = 1000, seed: int = 42) -> DataFrame:
    """(contrast, value, lower, upper, decided): decided when the 95 % interval lies above zero.

    The rate moves to 15 % on ``rate_*``, At Risk goes first on ``priority_*`` at the selected
    rate; anything unresolved keeps the playbook.
    """
    parts = ", ".join(f"'{c}', {c}" for c in CONTRASTS)
    point = contrasts(customers)
    drawn = replicate_contrasts(customers, draws, seed).selectExpr(f"stack({len(CONTRASTS)}, {parts}) as (contrast, value)")
    skews = contrast_accelerations(customers).selectExpr(f"stack({len(CONTRASTS)}, {parts}) as (contrast, a)")
    bounds = intervals(point.withColumnRenamed("value", "estimate"), drawn, skews, ["contrast"])
    return point.join(F.broadcast(bounds), ["contrast"], "left").withColumn("decided", F.coalesce(F.col("lower") > 0, F.lit(False)))
