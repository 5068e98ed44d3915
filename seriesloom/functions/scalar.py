"""Small column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero (plain division raises under ANSI mode)."""
    return F.try_divide(a, b)


def percent(a: Column, b: Column) -> Column:
    """Relative change from b to a, in percent."""
    return (F.try_divide(a, b) - 1) * 100


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows where both are set; null for a constant side."""
    a_ = F.when(b.isNotNull(), a)
    b_ = F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a_) * F.stddev_pop(b_))
