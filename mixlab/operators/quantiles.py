"""Exact quantiles, with no task that holds a whole group.

The built-in exact percentile keeps a map of every distinct value of a group in
one task. That is fine for daily series (``bounded=True`` in ``quantile_columns``:
one row per date, so a group is no longer than the calendar) and fails on invoice
lines. ``exact_quantiles`` shuffles counters only:

1. the needed columns are written once, and nothing below them runs again;
2. a mergeable sketch per group gives edges around every requested rank. An edge value is a slice of its own, so a
   value with many rows never sits in a slice with others; the values between two edges are another. Rows are counted
   per slice, which tells the slice that holds each rank;
3. while such a slice between edges has more than ``most`` rows, its rows alone are cut again by their own
   quantiles, to a fiftieth or less each time, wherever the mass lies;
4. only the distinct values of the slices that are left are ordered.

The answer is exact whatever the sketch error: edges and slices only decide how
much work is left, and the counts decide where the rank lies.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlab.session import stage

_ACCURACY = 10_000
_MARGIN = 2.5 / _ACCURACY
_CUTS = 64
ROWS_PER_SLICE = 1_000_000


def _long(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str]) -> DataFrame:
    """(ids, _c, _v): one row per value, missing values dropped."""
    if len(cols) == 1:
        long = df.select(*id_cols, F.lit(cols[0]).alias("_c"), F.col(cols[0]).cast("double").alias("_v"))
    else:
        pairs = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in cols]
        long = df.select(*id_cols, F.inline(F.array(*pairs)))
    return long.filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _before(keys: Sequence[str], order: str) -> Column:
    """How many values lie in earlier steps of the same group."""
    running = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(running), F.lit(0))


def _slice(n_edges: int) -> Column:
    """A monotone slice number for ``_v`` from sorted ``_edges``: odd on an edge, even between two."""
    edges = [F.get("_edges", F.lit(i)) for i in range(n_edges)]
    reached = sum((F.when(F.col("_v") >= e, 1).otherwise(0) for e in edges), F.lit(0))
    on_edge = reduce(lambda a, b: a | b, [F.col("_v") == e for e in edges])
    return reached * 2 - F.when(on_edge, 1).otherwise(0)


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    id_cols: Sequence[str] = (),
    most: int = ROWS_PER_SLICE,
) -> DataFrame:
    """(ids, column, quantiles): linearly interpolated quantiles in the order of ``probs``.

    A group without any value has no row. ``most`` bounds the distinct values that one task orders.
    """
    ids = list(id_cols)
    keys = [*ids, "_c"]
    values = stage(_long(df, cols, ids), "values")
    splits = sorted({min(1.0, max(0.0, p + s)) for p in probs for s in (-_MARGIN, _MARGIN)})

    # Two neighbouring ranks per probability: floor and ceiling of p * (n - 1).
    def rank(i: int, p: float) -> Column:
        return F.struct(F.lit(i).alias("_p"), (F.lit(p) * F.col("_last")).alias("_pos"))

    def held(t: Column) -> Column:
        low, high = F.floor(t["_pos"]), F.ceil(t["_pos"])
        return (high >= F.col("_b")) & (low < F.col("_b") + F.col("_n"))

    group, known = keys, None
    while True:
        n_edges = len(splits) + 2
        approximate = F.percentile_approx("_v", splits, _ACCURACY)
        sketch = stage(values.groupBy(*group).agg(F.concat(F.array(F.min("_v")), approximate, F.array(F.max("_v"))).alias("_edges")))
        if ids or len(cols) > 1 or known is not None:
            edged = values.join(sketch, group)
        else:
            edged = values.withColumn("_edges", sketch.select("_edges").scalar())
        sliced = edged.select(*group, "_v", _slice(n_edges).cast("long").alias("_s"))
        counts = sliced.groupBy(*group, "_s").agg(F.count("*").alias("_n"))
        if known is None:
            ranks = F.array(*[rank(i, p) for i, p in enumerate(probs)])
            counts = counts.withColumns({"_b": _before(group, "_s"), "_last": F.sum("_n").over(W.partitionBy(*group)) - 1})
        else:
            ranks = F.col("_t")
            counts = counts.withColumn("_b", _before(group, "_s")).join(known, group).withColumn("_b", F.col("_base") + F.col("_b"))
        targets = stage(
            counts.withColumn("_t", F.filter(ranks, held)).filter(F.size("_t") > 0).select(*group, "_s", "_t", F.col("_b").alias("_base"), "_n")
        )
        slice_keys = [*group, "_s"]
        inside = sliced.join(targets.drop("_n"), slice_keys)
        largest = targets.filter(F.col("_s") % 2 == 0).agg(F.max("_n")).first()[0]
        if largest is None or largest <= most:
            break
        path = F.col("_s") if known is None else F.col("_g") * (2 * n_edges + 1) + F.col("_s")
        values = stage(inside.select(*keys, path.alias("_g"), "_v"), "values")
        known = targets.select(*keys, path.alias("_g"), "_t", "_base")
        group, splits = [*keys, "_g"], [i / _CUTS for i in range(1, _CUTS)]

    found = (
        inside.groupBy(*slice_keys, "_v")
        .agg(F.count("*").alias("_n"), F.first("_t").alias("_t"), F.first("_base").alias("_base"))
        .withColumn("_b", F.col("_base") + _before(slice_keys, "_v"))
        .withColumn("_t", F.filter("_t", held))
        .filter(F.size("_t") > 0)
        .select(*keys, "_v", F.inline("_t"))
    )
    part = F.first("_pos") - F.floor(F.first("_pos"))
    quantile = F.min("_v") + (F.max("_v") - F.min("_v")) * part
    answers = found.groupBy(*keys, "_p").agg(quantile.alias("_q"))
    per_prob = [F.max(F.when(F.col("_p") == i, F.col("_q"))) for i in range(len(probs))]
    return answers.groupBy(*keys).agg(F.array(*per_prob).alias("quantiles")).withColumnRenamed(
        "_c", "column"
    )


def quantile_columns(
    df: DataFrame,
    cols: Sequence[str],
    probs: dict[str, float],
    id_cols: Sequence[str] = (),
    exact: bool = True,
    bounded: bool = False,
) -> DataFrame:
    """One row per id with a column ``{col}_{name}`` per column and named probability."""
    ids, names, levels = list(id_cols), list(probs), list(probs.values())
    if exact and not bounded:
        found = exact_quantiles(df, cols, levels, ids)
        return found.groupBy(*ids).agg(
            *[
                F.max(F.when(F.col("column") == c, F.get("quantiles", F.lit(i)))).alias(f"{c}_{n}")
                for c in cols
                for i, n in enumerate(names)
            ]
        )
    aggregates = []
    for c in cols:
        value = F.col(c).cast("double")
        value = F.when(~F.isnan(value), value)
        found = F.percentile(value, levels) if exact else F.percentile_approx(value, levels, _ACCURACY)
        aggregates += [F.get(found, F.lit(i)).alias(f"{c}_{n}") for i, n in enumerate(names)]
    return df.groupBy(*ids).agg(*aggregates)
