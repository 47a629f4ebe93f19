"""Sharding by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlab.llm.ranks import bucket_count, total_before
from mixlab.session import stage


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: keys jump forward until the next jump leaves the range."""
    state = keys.astype(np.int64).view(np.uint64).copy()
    at, ahead = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        at[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[moving] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[moving] = ((at[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Jump consistent hash of an integer key; a null key counts as 0."""

    @F.pandas_udf(T.IntegerType())
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def shard(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot, grown_shard.

    The id and the number of shards alone decide, so equal texts with different ids may
    lie in different shards. ``grown_shard`` is the place with one shard more: it is
    ``shard`` or the new one. Slots count from 0 within each shard without gaps, in the
    order of (bucket, id, checksum, size); buckets are hashes of the id, so a shard is
    never sorted in one task. Only ids and checksums are shuffled.

    A null text has size 1 and the checksum of the empty text. A null id is sharded as 0.
    Repeated rows get a slot each. An empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(
        docs.select(
            F.col(id_col).alias(id_col),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
        .withColumn("shard", shard_of(F.col(id_col), shards))
        .withColumn("grown_shard", shard_of(F.col(id_col), shards + 1)),
        "shards",
    )
    buckets = bucket_count(-(-rows.count() // shards))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64(id_col, "text_crc32"), F.lit(buckets)))
    placed = total_before(rows, ["shard"], "_part", [id_col, "text_crc32", "size"], F.lit(1).cast("long"), "slot")
    return placed.select(id_col, "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
