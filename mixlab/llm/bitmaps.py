"""Fixed-size bitmaps of 64-bit hashes: an over-approximate membership test for any number of rows.

2**bits bits in rows of 32,768, so 2**(bits - 15) rows of 4 KB at most: 2 MB at the default
24, whatever the input. A set bit may come from another hash; no member is ever missed.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 24
_ROW = 1 << 15


def slot(value: Column, bits: int = BITS) -> Column:
    """From 1, as the built-in bitmap functions count."""
    return F.pmod(value, F.lit(1 << bits).cast("long")) + 1


def bitmap(df: DataFrame, value: Column, bits: int = BITS) -> DataFrame:
    """Rows (__bit_row, __bits) of the bitmap of ``value``, merged in the map tasks first."""
    spot = df.select(slot(value, bits).alias("__slot"))
    return spot.groupBy(F.expr("bitmap_bucket_number(__slot)").alias("__bit_row")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(__slot))").alias("__bits")
    )


def mark(df: DataFrame, value: Column, rows: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """Add ``name``: whether the bit of ``value`` is set. The bitmap's rows are broadcast (see the bound above)."""
    spot = df.withColumn("__slot", slot(value, bits)).withColumn("__row", F.expr("bitmap_bucket_number(__slot)"))
    byte = F.conv(F.hex(F.expr("substring(__bits, cast(bitmap_bit_position(__slot) / 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = F.expr("cast(bitmap_bit_position(__slot) % 8 as int)")
    joined = spot.join(F.broadcast(rows), F.col("__row") == F.col("__bit_row"), "left")
    flag = F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), hit)) != 0, F.lit(False))
    return joined.withColumn(name, flag).drop("__slot", "__row", "__bit_row", "__bits")


def without(docs: DataFrame, listed: DataFrame, value: Column, listed_value: Column, same: Column) -> DataFrame:
    """The rows of ``docs`` that match no row of ``listed`` by ``same``; matching rows have equal values.

    Rows whose bit is not set stay where they are; only the others are shuffled to an
    anti-join. ``listed`` is read twice and should be a written table.
    """
    names = docs.columns
    marked = mark(docs, value, bitmap(listed, listed_value), "__maybe")
    unsure = marked.where("__maybe").select(*[docs[c] for c in names]).join(listed, same, "left_anti")
    return marked.where(~F.col("__maybe")).select(*[docs[c] for c in names]).unionAll(unsure)


def to_array(rows: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bitmap as packed bytes on the driver, 2**(bits - 3) of them."""
    out = np.zeros((1 << bits) // 8, np.uint8)
    for row in rows.toLocalIterator():
        at = (row["__bit_row"] - 1) * _ROW // 8
        out[at : at + _ROW // 8] = np.frombuffer(row["__bits"], np.uint8)
    return out


def contains(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the signed 64-bit ``values`` have their bit set."""
    at = values.astype(np.int64) & np.int64(len(packed) * 8 - 1)
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0
