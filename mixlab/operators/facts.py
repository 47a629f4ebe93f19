"""Joining per-id facts (one row per id) to many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, facts: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Add per-id facts to the rows; without ids the facts are one row of scalars.

    The join carries no hint: adaptive execution broadcasts or splits by measured bytes.
    """
    if not id_cols:
        packed = facts.select(F.struct(*facts.columns)).scalar()
        return df.withColumn("_facts", packed).select(*df.columns, "_facts.*")
    return df.join(facts, list(id_cols), "left")
