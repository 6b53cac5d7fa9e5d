"""Money and ratio arithmetic.

Money is decimal(18,2), so sums do not depend on row order. Ratios are divided
as doubles and rounded half away from zero through a decimal: Spark's decimal
division keeps as few as six digits for wide operands, which would round twice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column) -> Column:
    return F.round(c, 2).cast(MONEY)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as a double; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def rounded(c: Column, digits: int) -> Column:
    """Half away from zero, as a decimal with that many digits."""
    return F.round(c.cast("decimal(38,8)"), digits).cast(f"decimal(28,{digits})")


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    return rounded(ratio(numerator, denominator), digits)


def rounded_mean(c: Column, digits: int) -> Column:
    """Mean over non-NULL values; avg() of a decimal would keep six digits."""
    return rounded_ratio(F.sum(c), F.count(c), digits)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return rounded(ratio(part * 100, whole), digits)
