"""Tables laid out once by a join key, so that later joins and groupings on it move no row."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from mixlab.session import staging_path


def bucketed(df: DataFrame, key: str | Sequence[str], buckets: int, name: str = "bucketed", path: str | None = None) -> DataFrame:
    """``df`` written as a table with ``buckets`` files, each with the rows of its keys in order, and read from there.

    Tables with equal bucket counts and key types meet without an exchange of either side. Choose the count so that
    a bucket is some 100 to 200 MB of the larger table; a bucket is one task, so a key that holds a large share
    of the rows should not be bucketed by (such joins are split by adaptive execution instead).
    The layout costs one shuffle, once; ``path`` keeps it, else it is a staged table. Null keys share a bucket.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark, table = df.sparkSession, f"mixlab_{name}_{uuid.uuid4().hex}"
    place = path or staging_path(spark, name)
    writer = df.repartition(buckets, *keys).write.option("path", place).format("parquet")
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return spark.table(table)


def reopened(like: DataFrame, path: str, key: str | Sequence[str], buckets: int, name: str = "bucketed") -> DataFrame:
    """A layout that ``bucketed`` kept at ``path``, in a later session; ``like`` is a frame with its columns.

    Only the layout is declared; no row is read or written.
    """
    keys = [key] if isinstance(key, str) else list(key)
    spark, table = like.sparkSession, f"mixlab_{name}_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
    by = ", ".join(f"`{k}`" for k in keys)
    at = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{at}'")
    return spark.table(table)
