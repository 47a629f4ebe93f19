"""Running totals over whole groups without a task that holds a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 5_000


def bucket_count(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """So many buckets that one holds about ``per_bucket`` rows, whatever the input's size."""
    return max(1, -(-rows // per_bucket))


def total_before(df: DataFrame, groups: Sequence[str], bucket: str, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the group's earlier rows, by (bucket, order).

    Each (group, bucket) is summed and sorted on its own; the sums of the earlier buckets
    come from a table with one row per (group, bucket). ``df`` is read twice and should be
    a written table. Null group values are a group. Rows that tie in ``order`` follow each
    other in any order, so ``order`` should end in all columns that tell rows apart.
    """
    df = df.withColumn("_value", value)
    sums = df.groupBy(*groups, bucket).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = F.col(bucket) == F.col("_bucket")
    for i, g in enumerate(groups):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return (
        df.join(offsets, same)
        .withColumn(name, local + F.col("_offset"))
        .drop("_value", "_bucket", "_offset", *[f"_g{i}" for i in range(len(groups))])
    )
