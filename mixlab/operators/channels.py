"""Carry-over and saturation of channel columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlab.functions.carryover import carry_over, channel_weights, saturate_channel


def adstock(
    df: DataFrame,
    col: str,
    weights: Sequence[float],
    id_cols: Sequence[str] = (),
    date_col: str = "date",
    name: str = "adstock",
) -> DataFrame:
    """Add the carry-over of one column over the rows of its series."""
    w = W.partitionBy(*id_cols).orderBy(date_col)
    return df.withColumn(name, carry_over(F.col(col), weights, w))


def channel_transform(
    df: DataFrame,
    channels: Sequence[str],
    params: Mapping[str, Mapping],
    id_cols: Sequence[str] = (),
    date_col: str = "date",
) -> DataFrame:
    """``{channel}_adstock`` for each channel column present: carry-over, then saturation.

    All channels share one window, and the column is added in place, so no
    channel costs a shuffle or a self-join of its own. Channels without
    parameters get the defaults.
    """
    w = W.partitionBy(*id_cols).orderBy(date_col)
    present = [c for c in channels if c in df.columns]
    carried = {
        f"{c}_adstock": carry_over(F.col(c), channel_weights(params.get(c, {})), w) for c in present
    }
    saturated = {
        f"{c}_adstock": saturate_channel(F.col(f"{c}_adstock"), params.get(c, {})) for c in present
    }
    return df.withColumns(carried).withColumns(saturated)
