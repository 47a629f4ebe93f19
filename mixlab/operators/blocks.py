"""Series that are longer than a task should hold: positions by counted offsets, and halo blocks.

A series is cut by time into spans. Rows are numbered within their span, and each span
starts at the number of rows in the spans before it, from a table with one row per span. Blocks
of equal length are cut by that number, so any window that looks back a bounded number of
rows can run block by block, if the block before lends its last rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

SPAN_DAYS = 366
ROWS_PER_BLOCK = 100_000


def span_of(df: DataFrame, time_col: str, days: float) -> Column:
    """The number of the span that a date or timestamp lies in; null times come first."""
    if isinstance(df.schema[time_col].dataType, DateType):
        count = F.unix_date(time_col) / F.lit(float(days))
    else:
        count = F.unix_micros(F.col(time_col).cast("timestamp")) / F.lit(86400e6 * days)
    return F.coalesce(F.floor(count).cast("long"), F.lit(-(1 << 62)).cast("long"))


def positions(
    df: DataFrame,
    name: str,
    id_cols: Sequence[str] = (),
    order: Sequence[str] = ("date",),
    days: float = SPAN_DAYS,
    total: str | None = None,
) -> DataFrame:
    """Add ``name``, the 0-based place of the row in its series, and its length as ``total``, if named.

    ``order`` starts with a date or timestamp; ``days`` is the length of a span. A task sorts
    one span of one series. ``df`` is read twice, once for the counts, which are combined in the map tasks;
    stage it if it is dear. Null ids are a series of their own.
    """
    spans = df.withColumn("_span", span_of(df, order[0], days))
    counts = spans.groupBy(*id_cols, "_span").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per span; the constant stands for a missing id.
    series = [*id_cols] or [F.lit(0)]
    earlier = W.partitionBy(*series).orderBy("_span").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_at_{i}") for i, c in enumerate(id_cols)],
        F.col("_span").alias("_at_span"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(W.partitionBy(*series)).alias("_length"),
    )
    same = F.col("_span") == F.col("_at_span")
    for i, c in enumerate(id_cols):
        same &= F.col(c).eqNullSafe(F.col(f"_at_{i}"))
    local = F.row_number().over(W.partitionBy(*id_cols, "_span").orderBy(*order)) - 1
    placed = spans.withColumn("_local", local).join(offsets, same)
    added = {name: F.col("_offset") + F.col("_local")} | ({total: F.col("_length")} if total else {})
    return placed.withColumns(added).drop("_span", "_local", "_offset", "_length", "_at_span", *[f"_at_{i}" for i in range(len(id_cols))])


def in_blocks(
    df: DataFrame,
    apply: Callable[[DataFrame, list[str]], DataFrame],
    halo: int,
    id_cols: Sequence[str] = (),
    order: Sequence[str] = ("date",),
    rows: int = ROWS_PER_BLOCK,
    days: float = SPAN_DAYS,
) -> DataFrame:
    """``apply(df, ids)`` to every block of a series by itself: no window holds more than ``rows + halo`` rows.

    ``apply`` may add columns that depend on a row and the ``halo`` rows before it, in windows over
    the ids it is given. A row that a later block needs to look back on goes there as a copy
    and is dropped afterwards, so the result is that of ``apply(df, id_cols)`` for any block length.
    """
    if halo < 0 or rows < 1:
        raise ValueError("a block has a row at least, and looks back on 0 or more")
    placed = positions(df, "_place", id_cols, order, days, "_rows_in_all")
    own = F.floor(F.col("_place") / rows).cast("long")
    reach = F.least(F.col("_place") + halo, F.col("_rows_in_all") - 1)
    last = F.floor(reach / rows).cast("long")
    lent = placed.withColumn("_own", own).withColumn("_block", F.explode(F.sequence(F.col("_own"), last)))
    done = apply(lent.drop("_place", "_rows_in_all"), [*id_cols, "_block"])
    return done.filter(F.col("_block") == F.col("_own")).drop("_block", "_own")
