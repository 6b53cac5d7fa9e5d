"""Rows whose columns are worked out once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """df with its columns given out by a generator.

    Spark puts the expressions of a projection in the place of their names in later filters
    and projections. Long ones that are used several times would be worked out each time,
    in code too long to compile; a generator's columns are worked out once a row.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
