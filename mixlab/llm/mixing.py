"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlab.llm.ranks import bucket_count, total_before
from mixlab.session import stage

WORD = r"[^\x20\x09-\x0D]+"
EPOCHS = 3


def source_targets(sizes: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Target words of each source of ``sizes`` (source, source_size).

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and share the sum of
    all sizes; no target passes ``epochs`` times its source's size, and the excess is
    shared again by weight. Sorted by limit over weight, a source is limited exactly if
    what the earlier ones leave over would give it more than its limit, so one window
    decides it, in integers. The table has one row per source.
    """
    ranked = sizes.withColumn(
        "weight", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1
    ).withColumn("most", F.col("source_size") * epochs)
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
    limited = ranked.withColumn("limited", left * F.col("weight") > F.col("most") * F.sum("weight").over(after))
    free = F.sum("source_size").over(whole) - F.coalesce(F.sum(F.when(F.col("limited"), F.col("most"))).over(whole), F.lit(0))
    share = F.sum(F.when(~F.col("limited"), F.col("weight"))).over(whole)
    target = F.when(F.col("limited"), F.col("most").cast("double")).otherwise(
        free.cast("double") * F.col("weight") / share.cast("double")
    )
    return limited.select("source", "source_size", target.alias("target"))


def sampling_key(doc_id: Column, weight: Column, seed: int) -> Column:
    """-ln(u) / weight with u from a hash of the id: smaller keys first draws by weight without replacement."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(uniform) / weight


def key_buckets(rows: DataFrame, weight: str, key: str, per_bucket: int | None = None) -> Column:
    """The bucket of a key, in the order of the keys, so that all buckets hold about as many rows.

    A key of weight w has the distribution 1 - exp(-w key). Weights are counted in classes of
    one power of two (2,100 at most), and a key's place is the classes' distributions
    weighed by their shares: any weights fill the buckets evenly to a small factor.
    """
    power = F.floor(F.log2(F.col(weight)) + 0.5).cast("int")
    shares = {r["power"]: r["count"] for r in rows.groupBy(power.alias("power")).count().collect()}
    total = max(1, sum(shares.values()))
    place = F.lit(0.0)
    for p, count in sorted(shares.items()):
        place = place + F.lit(count / total) * (1 - F.exp(-F.col(key) * float(2.0**p)))
    buckets = bucket_count(total, per_bucket) if per_bucket else bucket_count(total)
    return F.floor(F.least(place, F.lit(1.0)) * buckets)


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    seed: int = 7,
    epochs: int = EPOCHS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    tags: Sequence[str] = (),
) -> DataFrame:
    """Per row: id, source, size, source_size, target, taken, and the columns ``tags`` of the document.

    Every document is taken as often as whole epochs of its source fit the target; the
    rest of the target goes to the documents with the smallest exponential keys, as long
    as the running sum comes nearer to it, so a source ends within half the size of its
    last document. ``weights`` are rows (id, weight), one per id: the documents' quality
    weights (positive; without a row, or null, it is 1). They meet sizes, not texts.

    The running sum is cut by the keys' own distribution into buckets of bounded size
    (``key_buckets``), so a source is never sorted in one task. Keys are hashes of ids: reruns
    agree. Null texts and texts without words have size 0 and are taken 0 times; a null
    source is a source, after the others; rows that repeat an id count as rows with equal
    keys, ordered by size. Very long texts only cost their count of words. An empty table
    gives an empty result; extra columns are not looked at, whatever they are called.
    """
    tagged = [f"_tag_{i}" for i in range(len(tags))]
    rows = docs.select(
        *[F.col(c).alias(t) for c, t in zip(tags, tagged)],
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    weight = F.lit(1.0)
    if weights is not None:
        rows = rows.join(weights.toDF("_weighted", "_weight"), F.col("_id") == F.col("_weighted"), "left")
        weight = F.coalesce(F.col("_weight").cast("double"), F.lit(1.0))
    rows = stage(rows.select("_id", "source", "size", *tagged, weight.alias("_w"), sampling_key(F.col("_id"), weight, seed).alias("_key")), "mix")
    targets = stage(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), epochs), "targets")
    rows = rows.withColumn("_part", key_buckets(rows, "_w", "_key"))
    summed = total_before(rows, ["source"], "_part", ["_key", "_id", "size", *tagged], F.col("size"), "_before")
    summed = summed.join(targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - rounds * F.col("source_size")
    taken = F.col("size") * (rounds + (F.col("_before") + F.col("size") / 2 <= rest).cast("long"))
    return summed.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", taken.cast("long").alias("taken"), *[F.col(t).alias(c) for c, t in zip(tags, tagged)])
