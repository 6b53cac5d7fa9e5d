"""Exact distinct counts that add up: bitmaps per axis values, merged for any coarser grouping.

A count of distinct customers by month can't be summed to years. A bitmap of the customers by
month can be merged: values get dense numbers once, a bitmap row holds the numbers of one range
of 32,768 for one combination of axis values, and a coarser count merges rows and counts bits.
Every step is an ordinary grouping with partial aggregation; a group of any size is spread over
its ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.ordering import _blocks
from tallyloom.sources.staging import kept


def numbered(df: DataFrame, column: str) -> DataFrame:
    """(value, number): the distinct values that are not NULL, numbered from 1 in their order.

    A number is the values of earlier range blocks plus the place in the own one.
    """
    blocks = _blocks(df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct(), [F.col("value")])
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    sizes = blocks.groupBy(F.col("_block").alias("_b")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_block").orderBy("value"))
    return blocks.withColumn("_place", inside).join(starts, F.col("_block") == F.col("_b")).select(
        "value", (F.col("_start") + F.col("_place")).alias("number")
    )


def bitmaps(df: DataFrame, axes: Sequence[str], column: str, numbers: DataFrame | None = None) -> DataFrame:
    """(axes..., _range, _bits): the values of the column that each combination of axis values holds, written once.

    ``numbers`` may come from an earlier ``numbered``, so that bitmaps of several tables can be
    merged; values it lacks are not counted. NULLs are not counted either, and their axis values stay.
    """
    numbers = numbered(df, column) if numbers is None else numbers
    pairs = df.groupBy(*axes, F.col(column).alias("_value")).agg(F.lit(1).alias("_one")).drop("_one")  # a hot value is folded before the join
    known = pairs.join(numbers.select(F.col("value").alias("_of"), "number"), F.col("_value") == F.col("_of"), "left")
    number = F.col("number")
    maps = known.groupBy(*axes, F.bitmap_bucket_number(number).alias("_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    )
    return kept(maps, "bitmaps")


def distinct_counts(
    maps: DataFrame, by: dict[str, Column], levels: Sequence[Sequence[str]] | None = None, name: str = "values"
) -> DataFrame:
    """Distinct values per grouping: ``by`` names expressions over the axes of the bitmaps.

    ``levels`` lists groupings of these names, all of them by default; ``grouping`` has a bit per
    name, the first one highest, set where a row counts over it.
    """
    named = maps.select(*[c.alias(n) for n, c in by.items()], "_range", "_bits")
    sets = [list(by)] if levels is None else levels
    merged = named.groupBy(*by, "_range").agg(F.bitmap_or_agg("_bits").alias("_bits"))  # before the levels copy rows
    every = merged.groupingSets([[*map(F.col, one), F.col("_range")] for one in sets], *by, "_range").agg(
        F.shiftright(F.grouping_id(), 1).alias("grouping"), F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n")
    )
    return every.groupBy(*by, "grouping").agg(F.sum(F.when(F.col("_range").isNull(), 0).otherwise(F.col("_n"))).alias(name))
