"""Rounding, exact sums and averages.

Sums of doubles depend on the order of addition, hence on partitioning. Money is therefore
summed as decimal, which gives the same answer for any number of partitions. Nothing is rounded
before it is summed; results are rounded once, by those who show them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 18 places hold every double of a cent or more to its last digit; 20 digits are left in front.
EXACT = "decimal(38,18)"


def round_half_up(x: Column, digits: int) -> Column:
    """``x`` rounded by its decimal digits."""
    return F.round(x.cast("double"), digits)


def as_decimal(x: Column) -> Column:
    """NaN counts as missing; a number that does not fit is an error, not a null."""
    return F.when(~F.isnan(x.cast("double")), x).cast(EXACT)


def exact_sum(x: Column) -> Column:
    return F.sum(as_decimal(x)).cast("double")


def exact_avg(x: Column) -> Column:
    exact = as_decimal(x)
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact))
