"""Sums and means that do not depend on the order in which partitions finish.

Double addition is not associative, so a sum over many tasks changes in its last digits from
run to run.  Values with a known number of decimals can be added as decimals instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["as_col", "exact_mean", "exact_sum", "rounded"]


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str, scale: int | None = None) -> Column:
    """Sum as double; with `scale`, added as decimals of that many digits."""
    c = as_col(c)
    if scale is None:
        return F.sum(c.cast("double"))
    return F.sum(c.cast(f"decimal(28,{scale})")).cast("double")


def exact_mean(c: Column | str, scale: int | None = None) -> Column:
    """Mean as double over non-null values; null when there are none."""
    c = as_col(c)
    if scale is None:
        return F.avg(c.cast("double"))
    n = F.count(c)
    return F.when(n > 0, exact_sum(c, scale) / n)


def rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)
