"""Noise as a function of the row's key, not of its partition.

A task that is retried on another executor, or a plan with other partition
counts, draws the same values again, which ``rand(seed)`` does not promise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 32


def uniform(key: Column, seed: int, tag: str) -> Column:
    """A double in [0, 1) from the first 32 bits of an MD5 of key, seed and tag."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(tag)))
    head = F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")
    return head / F.lit(float(2**_BITS))


def normal(key: Column, seed: int, tag: str) -> Column:
    """A standard normal by Box-Muller from two uniform draws."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(key, seed, tag + "/r")))
    return radius * F.cos(F.lit(2 * math.pi) * uniform(key, seed, tag + "/a"))


def pick(key: Column, seed: int, tag: str, values: list[str]) -> Column:
    """One of ``values``, all equally likely."""
    index = F.floor(uniform(key, seed, tag) * F.lit(len(values))).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), index + 1)
