"""Distinct counts that roll up: one pass over the lines serves the day, the month, the weekday and the country.

Ids are numbered in the order in which they first appear, so that the ids of a day lie side by side, and kept as
bitmaps per group and bucket of 32,768 numbers. Bitmaps of groups merge by OR, so any coarser
group is counted exactly without the lines. ``exact=False`` keeps HLL sketches, which need no numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from mixlab.operators.blocks import positions
from mixlab.session import stage


@dataclass(frozen=True)
class Cube:
    """Sums and members per group: ``sums`` has a row per group; ``members`` a row per group, counted
    name and bucket (``exact``), or a row per group with a sketch per counted name."""

    sums: DataFrame
    members: DataFrame
    measures: tuple[str, ...]
    counted: tuple[str, ...]
    exact: bool

    def by(self, **keys: Column | str) -> DataFrame:
        """(keys, measures, counted names) per value of the keys, which are expressions of the
        cube's dimensions; groups with a null key are left out."""
        named = {k: F.col(c) if isinstance(c, str) else c for k, c in keys.items()}
        present = reduce(lambda a, b: a & b, [c.isNotNull() for c in named.values()], F.lit(True))
        by = [c.alias(k) for k, c in named.items()]
        sums = self.sums.filter(present).groupBy(*by).agg(*[F.sum(m).alias(m) for m in self.measures])
        decimal = [f.name for f in sums.schema if isinstance(f.dataType, DecimalType) and f.name in self.measures]
        sums = sums.withColumns({m: F.col(m).cast("double") for m in decimal})
        if self.exact:
            # A hot group is as many rows as it has buckets until it is one number per bucket.
            merged = self.members.filter(present).groupBy(*by, "_counted", "_bucket").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
            counts = merged.groupBy(*keys).agg(
                *[F.coalesce(F.sum(F.when(F.col("_counted") == c, F.col("_n"))), F.lit(0)).alias(f"_{c}") for c in self.counted]
            )
        else:
            estimates = [F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"_{c}") for c in self.counted]
            counts = self.members.filter(present).groupBy(*by).agg(*estimates)
        values = [F.coalesce(F.col(f"_{c}"), F.lit(0).cast("long")).alias(c) for c in self.counted]
        if not keys:
            packed = counts.select(F.struct(*counts.columns)).scalar()
            return sums.withColumn("_all", packed).select(*self.measures, "_all.*").select(*self.measures, *values)
        return sums.join(counts, list(keys), "left").select(*keys, *self.measures, *values)


def visits(df: DataFrame, dims: Sequence[str], ids: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """The lines as one row per group and ids with the sums of the measures; combined in the map tasks."""
    return df.groupBy(*dims, *ids).agg(*[F.sum(c).alias(name) for name, c in measures.items()])


def numbered(df: DataFrame, id_col: str, time_col: str) -> DataFrame:
    """(id, _code): the present ids numbered from 0 without gaps, by the day they first appear on."""
    first = df.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(time_col).alias("_first"))
    return positions(stage(first, "ids"), "_code", order=("_first", id_col)).select(id_col, "_code")


def cube(
    df: DataFrame,
    dims: Sequence[str],
    measures: Mapping[str, str],
    counted: Mapping[str, str],
    time_col: str = "InvoiceDate",
    exact: bool = True,
) -> Cube:
    """One pass over ``df``: sums of ``measures`` and members of ``counted`` ({name: column}) per ``dims``.

    ``time_col`` is one of ``dims``. Null ids are counted nowhere, null dimensions are groups of their own.
    The lines are reduced to their visits first; nothing else reads them. Sums of decimals stay exact.
    """
    if time_col not in dims:
        raise ValueError(f"{time_col} is not among the dimensions")
    if not exact:
        sketches = [F.hll_sketch_agg(c).alias(name) for name, c in counted.items()]
        sums = [F.sum(c).alias(name) for name, c in measures.items()]
        whole = stage(df.groupBy(*dims).agg(*sums, *sketches), "cube")
        return Cube(whole.select(*dims, *measures), whole.select(*dims, *counted), tuple(measures), tuple(counted), False)
    rows = stage(visits(df, dims, list(dict.fromkeys(counted.values())), measures), "visits")
    sums = stage(rows.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures]), "cube")
    members = None
    for name, c in counted.items():
        code = F.col("_code") + 1
        part = (
            rows.select(*dims, c)
            .join(numbered(rows, c, time_col), c)
            .groupBy(*dims, F.lit(name).alias("_counted"), F.bitmap_bucket_number(code).alias("_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(code)).alias("_bits"))
        )
        members = part if members is None else members.unionByName(part)
    return Cube(sums, stage(members, "members"), tuple(measures), tuple(counted), True)
