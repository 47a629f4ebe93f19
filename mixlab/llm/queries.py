"""The registered queries of this package and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlab.llm.checks import PREFIX_TRIE, vector_codes_sql, winnowing_sql
from mixlab.llm.embedding_dedup import vector_components
from mixlab.llm.exact_dedup import exact_dedup
from mixlab.llm.mixing import mix
from mixlab.llm.ngram_join import ngram_components
from mixlab.llm.packing import pack
from mixlab.llm.prefix_trie import prefix_trie
from mixlab.llm.sharding import shard
from mixlab.llm.substring_dedup import remove_repeats
from mixlab.llm.token_counts import token_counts
from mixlab.llm.toxicity import held_out, toxicity
from mixlab.llm.vector_codes import vector_codes
from mixlab.llm.warc import archive_round_trip
from mixlab.llm.winnowing import edited_fingerprints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op3_sharding")
def op3_sharding(spark, d) -> DataFrame:
    return shard(table(spark, d, "documents"), shards=8)


@query(
    "op5_exact_dedup",
    r"""
    WITH rows AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY content) AS group_size,
           doc_id = first_value(doc_id) OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) AS kept,
           sha256(content) AS text_sha256
    FROM rows
    """,
)
def op5_exact_dedup(spark, d) -> DataFrame:
    return exact_dedup(table(spark, d, "documents"), digest_all=True).withColumnRenamed("digest", "text_sha256")


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, weight) of labelled documents: 2 for good quality, 0.5 for bad."""
    return labels.groupBy("doc_id").agg(F.when(F.max("quality") == 1, 2.0).when(F.max("quality") == 0, 0.5).alias("weight"))


@query(
    "op8_mixing",
    r"""
    WITH quality AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
    sized AS (
        SELECT d.doc_id, d.source,
               CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
               -ln((CAST(CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':7'), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)
                   / CASE WHEN q.quality = 1 THEN 2.0 WHEN q.quality = 0 THEN 0.5 ELSE 1.0 END AS key
        FROM documents d LEFT JOIN quality q ON d.doc_id = q.doc_id
    ),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(3 * sum(size) AS BIGINT) AS most,
               CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS weight
        FROM sized GROUP BY source
    ),
    limits AS (
        SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER w, 0) + most) * weight
                   > most * (sum(weight) OVER () - sum(weight) OVER w + weight) AS limited
        FROM sources WINDOW w AS (ORDER BY CAST(most AS DOUBLE) / CAST(weight AS DOUBLE), source NULLS LAST ROWS UNBOUNDED PRECEDING)
    ),
    targets AS (
        SELECT source, source_size,
               CASE WHEN limited THEN CAST(most AS DOUBLE)
                    ELSE CAST(sum(source_size) OVER () - coalesce(sum(most) FILTER (limited) OVER (), 0) AS DOUBLE) * CAST(weight AS DOUBLE)
                         / CAST(sum(weight) FILTER (NOT limited) OVER () AS DOUBLE) END AS target
        FROM limits
    ),
    summed AS (
        SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before FROM sized
    )
    SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
           CAST(s.size * (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END
                + CASE WHEN s.before + s.size / 2.0 <= t.target - (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END) * t.source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM summed s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    """,
)
def op8_mixing(spark, d) -> DataFrame:
    return mix(table(spark, d, "documents"), quality_weights(table(spark, d, "labels")))


@query(
    "op10_warc",
    """
    WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    sized AS (
        SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM payloads
    ),
    best AS (
        SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) ELSE page_id END AS response
        FROM sized
    )
    SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
           CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id = response THEN NULL ELSE response END AS refers_to
    FROM best
    """,
)
def op10_warc(spark, d) -> DataFrame:
    return archive_round_trip(table(spark, d, "pages"))


@query("op7_packing")
def op7_packing(spark, d) -> DataFrame:
    return pack(table(spark, d, "documents"))


@query("op9_token_counts")
def op9_token_counts(spark, d) -> DataFrame:
    return token_counts(table(spark, d, "documents"))


@query("op1_ngram_jaccard")
def op1_ngram_jaccard(spark, d) -> DataFrame:
    return ngram_components(table(spark, d, "documents"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark, d) -> DataFrame:
    return remove_repeats(table(spark, d, "documents")).drop("kept_text")


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark, d) -> DataFrame:
    return vector_components(table(spark, d, "embeddings"))


@query("op6_toxicity")
def op6_toxicity(spark, d) -> DataFrame:
    scored = toxicity(table(spark, d, "documents"), table(spark, d, "labels"))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "rejected"
    )


@query("op11_vector_codes", vector_codes_sql())
def op11_vector_codes(spark, d) -> DataFrame:
    return vector_codes(table(spark, d, "embeddings"))


@query("op12_prefix_trie", PREFIX_TRIE)
def op12_prefix_trie(spark, d) -> DataFrame:
    return prefix_trie(table(spark, d, "conversations"))


@query("op13_winnowing", winnowing_sql())
def op13_winnowing(spark, d) -> DataFrame:
    return edited_fingerprints(table(spark, d, "documents"))
