"""Aggregates that stay defined on constant columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def correlation_of(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present; NULL when one is constant."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))
