"""Positions in a global order without a one-task window.

A window with no partition column, such as ``ntile(5) OVER (ORDER BY spend)``,
sends every row to one task. Scores, deciles and percentiles need only the rows
at a handful of positions, so:

1. the rows are range-partitioned on a full order and written once, each with
   the number of its block (the written copy pins the blocks: a range shuffle
   samples its input, so recomputing it could move rows between blocks);
2. rows are counted per block, and the few blocks that hold wanted positions
   are looked up from those counts;
3. only those blocks are sorted, and only the wanted rows leave the cluster.

Scores then follow from comparing each row with the few cut rows, a narrow
expression over the original table: no join back, no second shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tallyloom.sources.staging import kept


def _blocks(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    parted = df.repartitionByRange(*order)
    return kept(parted.withColumn("_block", F.spark_partition_id()), "blocks")


def rows_at(
    df: DataFrame,
    order: Sequence[Column],
    positions: Callable[[int], Sequence[int]],
    group: str | None = None,
    weight: str | None = None,
) -> dict[object, tuple[int, dict[int, Row]]]:
    """Rows at 1-based positions of each group's order.

    ``positions`` maps a group's row count to the wanted positions. With
    ``weight``, a row stands for that many equal rows. Returns, per group, its
    row count and the row at each position. The driver sees one count per block
    and group, and one row per position.
    """
    key = F.col(group) if group else F.lit(None).cast("string")
    size = F.col(weight) if weight else F.lit(1).cast("bigint")
    blocks = _blocks(df.withColumn("_group", key).withColumn("_size", size), [F.col("_group"), *order])
    counted = blocks.groupBy("_group", "_block").agg(F.sum("_size").alias("n")).collect()

    per_group: dict[object, list[tuple[int, int]]] = {}
    for row in counted:
        per_group.setdefault(row["_group"], []).append((row["_block"], row["n"]))
    totals: dict[object, int] = {}
    wanted: list[tuple[object, int, int, int]] = []  # group, block, position, offset in block
    for name, parts in per_group.items():
        totals[name] = sum(n for _, n in parts)
        targets = sorted({p for p in positions(totals[name]) if 1 <= p <= totals[name]})
        before = 0
        for block, n in sorted(parts):
            wanted += [(name, block, p, p - before) for p in targets if before < p <= before + n]
            before += n
    found: dict[object, tuple[int, dict[int, Row]]] = {g: (n, {}) for g, n in totals.items()}
    if not wanted:
        return found

    # Each of these blocks is one range partition, so its window is task-sized.
    here = F.sum("_size").over(
        Window.partitionBy("_group", "_block").orderBy(*order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    picked = blocks.filter(F.col("_block").isin(sorted({w[1] for w in wanted}))).withColumn("_end", here)
    hits = [
        F.col("_group").eqNullSafe(F.lit(g)) & (F.col("_block") == b)
        & (F.col("_end") >= at) & (F.col("_end") - F.col("_size") < at)
        for g, b, _, at in wanted
    ]
    any_hit = hits[0]
    for hit in hits[1:]:
        any_hit = any_hit | hit
    rows = picked.filter(any_hit).collect()
    for g, b, position, at in wanted:
        for row in rows:
            if row["_group"] == g and row["_block"] == b and row["_end"] - row["_size"] < at <= row["_end"]:
                found[g][1][position] = row
    return found


def _tile_ends(n: int, tiles: int) -> list[int]:
    """Last position of every tile but the last; early tiles take the remainder."""
    size, extra = divmod(n, tiles)
    return [t * size + min(t, extra) for t in range(1, tiles)]


def ntiles(
    df: DataFrame, id_column: str, scores: dict[str, str], tiles: int
) -> DataFrame:
    """``ntile(tiles) OVER (ORDER BY expression, id)`` for several scores at once.

    ``scores`` maps an output column to a numeric SQL expression, ascending. All
    scores share one range shuffle of (score, key, id).
    """
    keyed = df.select(
        id_column,
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("score"), F.expr(e).cast("decimal(38,9)").alias("k"))
                for name, e in scores.items()
            ])
        ).alias("s"),
    ).select(F.col("s.score").alias("score"), F.col("s.k").alias("k"), F.col(id_column).alias("id"))
    cuts = rows_at(keyed, [F.col("k"), F.col("id")], lambda n: _tile_ends(n, tiles), group="score")
    out = df
    for name, expression in scores.items():
        k, ident = F.expr(expression).cast("decimal(38,9)"), F.col(id_column)
        tile = F.lit(1).cast("bigint")
        n, found = cuts.get(name, (0, {}))
        for end in _tile_ends(n, tiles):
            if end in found:
                cut = F.lit(found[end]["k"]).cast("decimal(38,9)")
                after = (k > cut) | ((k == cut) & (ident > F.lit(found[end]["id"])))
                tile = tile + F.when(after, 1).otherwise(0)
        out = out.withColumn(name, tile)
    return out


def value_counts(df: DataFrame, value: Column) -> DataFrame:
    """Distinct values with their number of rows; counts before the shuffle."""
    return df.select(value.alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))


def percentiles(df: DataFrame, value: Column, at: Sequence[str]) -> dict[str, Decimal]:
    """Exact interpolated percentiles of a numeric column, NULLs left out."""
    def spots(n: int) -> list[int]:
        out = []
        for p in at:
            whole = int(Fraction(p) * (n - 1))
            out += [whole + 1, whole + 2]
        return out

    found = rows_at(value_counts(df, value.cast("decimal(18,2)")), [F.col("v")], spots, weight="n")
    if not found:
        return {}
    n, rows = next(iter(found.values()))
    result = {}
    for p in at:
        exact = Fraction(p) * (n - 1)
        whole = int(exact)
        low = Fraction(rows[whole + 1]["v"])
        high = Fraction(rows[whole + 2]["v"]) if whole + 2 in rows else low
        between = low + (high - low) * (exact - whole)
        result[p] = Decimal(between.numerator) / Decimal(between.denominator)
    return result


def group_percentiles(
    df: DataFrame, keys: Sequence[str], sets: Sequence[Sequence[str]], wanted: dict[str, tuple[str, str]]
) -> DataFrame:
    """Exact interpolated percentiles of every group of several groupings, all in one job.

    ``sets`` are the groupings of ``keys``, ``wanted`` maps an output column to (numeric column,
    percentile). Rows are (keys..., grouping, percentiles...): ``grouping`` has a bit per key, the
    first one highest, set where the grouping leaves the key out. NULL values don't count; a group
    with none has NULL, and there is no row for a grouping without rows. Nine digits, half up.

    Values are counted once per key combination and shared by all groupings; a value's place in
    its group is what stands in earlier range blocks, and before it in its own. Nothing passes
    through the driver, and a group of any size is spread over its blocks.
    """
    columns = list(dict.fromkeys(column for column, _ in wanted.values()))
    stacked = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_name"), F.col(c).cast("decimal(18,2)").alias("_v")) for c in columns
    ])).alias("_s")).select(*keys, "_s.*")
    counted = stacked.groupBy(*keys, "_name", "_v").agg(F.count("_v").alias("_n"))
    level = F.shiftright(F.grouping_id(), 2).alias("grouping")  # the two last columns are in every grouping
    grouped = counted.groupingSets([[*map(F.col, one), F.col("_name"), F.col("_v")] for one in sets], *keys, "_name", "_v")
    group = ["grouping", *keys, "_name"]
    blocks = _blocks(grouped.agg(level, F.sum("_n").alias("_n")).select(*group, "_v", "_n"), [*map(F.col, group), F.col("_v")])

    # one row per group and block
    parts = blocks.groupBy(*group, "_block").agg(F.sum("_n").alias("_part"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        *[F.col(c).alias(f"_s{c}") for c in [*group, "_block"]],
        F.coalesce(F.sum("_part").over(earlier), F.lit(0)).alias("_start"), F.sum("_part").over(whole).alias("_all"),
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s{c}")) for c in [*group, "_block"]])
    inside = Window.partitionBy(*group, "_block").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = blocks.withColumn("_upto", F.sum("_n").over(inside)).join(starts, same)
    last = F.col("_start") + F.col("_upto")

    cuts, out = [], []
    for name, (column, p) in wanted.items():
        share = Fraction(p)
        steps = (F.col("_all") - 1) * share.numerator
        position = F.expr(f"((_all - 1) * {share.numerator}) div {share.denominator}")
        mine = F.col("_name") == column
        for end, at in (("low", position + 1), ("high", F.least(position + 2, F.col("_all")))):
            cuts.append(F.max(F.when(mine & (last >= at) & (last - F.col("_n") < at), F.col("_v"))).alias(f"_{name}_{end}"))
        cuts.append(F.max(F.when(mine, steps % share.denominator)).alias(f"_{name}_rest"))
        low, high, rest = (F.col(f"_{name}_{x}") for x in ("low", "high", "rest"))
        step = (high - low) * rest.cast("decimal(9,0)") / F.lit(share.denominator).cast("decimal(9,0)")
        out.append((low + F.coalesce(step, F.lit(0))).cast("decimal(28,9)").alias(name))
    return placed.groupBy("grouping", *keys).agg(*cuts).select(*keys, "grouping", *out)


def rank_bands(df: DataFrame, value: Column, bands: int) -> Column:
    """Band of a row's rank by value, largest first, ties sharing a rank.

    The band is ``floor((rank - 1) * bands / n) + 1`` over all n rows. A row is
    in band d or later exactly when at least ceil((d-1) n / bands) rows hold a
    larger value, that is, when its value is below the row at that position.
    """
    def spots(n: int) -> list[int]:
        return [-(-(d - 1) * n // bands) for d in range(2, bands + 1)]

    found = rows_at(value_counts(df, value), [F.col("v").desc()], spots, weight="n")
    band = F.lit(1).cast("bigint")
    for n, rows in found.values():
        for spot in spots(n):
            if spot in rows:
                band = band + F.when(value < F.lit(rows[spot]["v"]), 1).otherwise(0)
    return band


def ranks(df: DataFrame, wanted: dict[str, tuple[str, str | None]]) -> DataFrame:
    """``rank() OVER ([PARTITION BY group] ORDER BY value DESC)`` for several columns.

    ``wanted`` maps an output column to (numeric value column, group column or
    None). Ranks are computed per distinct value, so rows sharing a value never
    gather in one task, and the blocks of one group are ranked in parallel. The
    join back is on the value, where adaptive execution can split a hot one.
    """
    per_value = [
        df.groupBy(
            F.lit(name).alias("_rank"),
            (F.col(group) if group else F.lit(None)).cast("string").alias("_g"),
            F.col(value).cast("decimal(38,9)").alias("_v"),
        ).agg(F.count("*").alias("_n"))
        for name, (value, group) in wanted.items()
    ]
    blocks = _blocks(
        reduce(DataFrame.unionByName, per_value), [F.col("_rank"), F.col("_g"), F.col("_v").desc()]
    )
    above = Window.unboundedPreceding
    earlier = Window.partitionBy("_rank", "_g").orderBy("_block").rowsBetween(above, -1)
    starts = blocks.groupBy("_rank", "_g", "_block").agg(F.sum("_n").alias("_m")).select(
        F.col("_rank").alias("_sr"), F.col("_g").alias("_sg"), F.col("_block").alias("_sb"),
        F.coalesce(F.sum("_m").over(earlier), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy("_rank", "_g", "_block").orderBy(F.col("_v").desc()).rowsBetween(above, -1)
    same_block = (
        (F.col("_rank") == F.col("_sr")) & F.col("_g").eqNullSafe(F.col("_sg")) & (F.col("_block") == F.col("_sb"))
    )
    ranked = kept(
        blocks.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(starts, same_block)
        .select("_rank", "_g", "_v", (F.col("_start") + F.col("_before") + 1).alias("_place")),
        "ranks",
    )
    out = df
    for name, (value, group) in wanted.items():
        side = ranked.filter(F.col("_rank") == name).select(
            F.col("_g").alias("_rg"), F.col("_v").alias("_rv"),
            F.col("_place").alias(name),
        )
        same = F.col(value).cast("decimal(38,9)").eqNullSafe(F.col("_rv"))
        if group:
            same = same & F.col(group).cast("string").eqNullSafe(F.col("_rg"))
        out = out.join(side, same, "left").drop("_rg", "_rv")
    return out
