"""Exact deduplication by progressive refinement, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlab.llm import bitmaps
from mixlab.session import stage

SPACE = " \t\n\x0b\x0c\r"
PREFIX = 64


def normalised(text: Column) -> Column:
    """The text without the characters of ``[\\x20\\x09-\\x0D]``; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, digest_all: bool = False) -> DataFrame:
    """Per row: id, keep_id, group_size, kept, digest.

    1. Group by (length, hash of the first ``prefix`` characters) of the normalised text;
       a length that nobody shares ends here, as does a prefix nobody of that length shares.
       Only counts are shuffled.
    2. The keys of groups of two or more become a bitmap of fixed size. A second scan
       computes SHA-256 of the full content only for rows whose bit is set; neither pass
       shuffles a text.
    3. Rows with equal digests are a group: the row with the most code points in the
       original text stays, then the smallest id. Counting happens in the map tasks first
       and the join back is one that adaptive execution can split, so a hot group is not
       gathered anywhere.

    ``digest_all`` fills ``digest`` for the other rows too (else it is null there).

    Null texts are empty texts, and all empty texts are equal. A null id is an id that
    comes after all others. Rows that repeat id and text are one document: they carry the
    same decision. An empty table gives an empty result; extra columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    content = normalised(F.col("_text"))
    rows = rows.select(
        "_id",
        F.length(F.coalesce("_text", F.lit(""))).alias("_points"),
        content.alias("_content"),
        F.octet_length(content).alias("_length"),
        F.xxhash64(F.substring(content, 1, prefix)).alias("_prefix"),
    )
    key = F.xxhash64("_length", "_prefix")
    shared = rows.groupBy("_length", "_prefix").count().where("count > 1")
    marked = bitmaps.mark(rows, key, bitmaps.bitmap(shared, key), "_again")
    full = F.sha2(F.col("_content").cast("binary"), 256)
    found = stage(
        marked.select("_id", "_points", "_again", (full if digest_all else F.when(F.col("_again"), full)).alias("digest")),
        "digests",
    )
    order = F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"))
    again = found.where("_again")
    groups = stage(again.groupBy("digest").agg(F.min(order).alias("_best"), F.count("*").alias("group_size")), "groups")
    keep = F.col("_best.i")
    members = again.join(groups, "digest").select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        "group_size",
        keep.eqNullSafe(F.col("_id")).alias("kept"),
        "digest",
    )
    alone = found.where(~F.col("_again")).select(
        F.col("_id").alias(id_col), F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    return alone.unionByName(members)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group of equal texts, with all its columns: that of ``exact_dedup``.

    Of rows that repeat the id too, the one with the most code points stays, then that with
    the least text; of fully equal rows, one. Other texts of the same id stay. Null and empty texts
    are one group. Extra columns stay, whatever they are called.
    """
    found = exact_dedup(docs, id_col, text_col).where("group_size > 1")
    listed = found.groupBy(F.col(id_col).alias("__id"), F.col("digest").alias("__digest")).agg(F.max("kept").alias("__kept"), F.count("*").alias("__rows"))
    listed = stage(listed.where("not __kept or __rows > 1"), "dropped")
    digest = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (digest == F.col("__digest"))
    alone = bitmaps.without(docs, listed, F.xxhash64(id_col), F.xxhash64("__id"), same)
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    repeated = listed.where("__kept")
    if not repeated.take(1):
        return alone
    # Only rows whose id may be listed are hashed again, and only these move.
    rows = bitmaps.mark(docs.toDF(*names), F.xxhash64(at[id_col]), bitmaps.bitmap(repeated, F.xxhash64("__id")), "_maybe").where("_maybe")
    text = F.coalesce(F.col(at[text_col]), F.lit(""))
    own = rows.withColumn("_digest", F.sha2(normalised(text).cast("binary"), 256))
    own = own.join(repeated, F.col(at[id_col]).eqNullSafe(F.col("__id")) & (F.col("_digest") == F.col("__digest")))
    best = F.min_by(F.struct(*names), F.struct((-F.length(text)).alias("n"), text.alias("t"))).alias("row")
    return alone.unionAll(own.groupBy("__id", "__digest").agg(best).select("row.*").toDF(*docs.columns))
