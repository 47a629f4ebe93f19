"""Token counts for every context limit, from an exact histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlab.llm.ranks import total_before
from mixlab.llm.tokens import encoded, tokenizer_path
from mixlab.session import stage


def token_lengths(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per document: n_tokens, the number of ids of the whole text. Null has none."""
    path = path or tokenizer_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, coder, words in encoded(batches, "text", path):
            yield pa.RecordBatch.from_arrays([pa.array(coder.counts(words), pa.int64())], names=["n_tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(count, "n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Per length: n_docs and n_tokens (their sum), combined in the map tasks first."""
    return lengths.groupBy(F.col("n_tokens").alias("length")).agg(
        F.count("*").alias("n_docs"), F.sum("n_tokens").cast("long").alias("n_tokens")
    )


def context_report(histogram: DataFrame, span: int = 1024) -> DataFrame:
    """For every length L that occurs, as a context limit: what fits and what is cut.

    length, n_docs, n_tokens; docs_longer and tokens_longer (suffix sums over the greater
    lengths); docs_up_to; quantile (the share of documents of at most L tokens, so the
    q-quantile is the least L whose quantile is q or more); truncated_total (tokens left if
    every document is cut to L, the sum of min(length, L)); total_tokens. Between two
    occurring lengths a < L < b the truncated total is that of a plus (L - a) times
    docs_longer of a.

    Sums run within spans of ``span`` lengths and over spans, so no task holds the whole
    histogram. An empty histogram gives an empty report.
    """
    histogram = stage(histogram.withColumn("_span", F.floor(F.col("length") / span)).withColumn("_all", F.lit(0)), "histogram")
    docs = total_before(histogram, ["_all"], "_span", ["length"], F.col("n_docs"), "_docs_before")
    both = total_before(stage(docs, "histogram"), ["_all"], "_span", ["length"], F.col("n_tokens"), "_tokens_before")
    totals = histogram.agg(F.struct(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"))).scalar()
    up_to = F.col("_docs_before") + F.col("n_docs")
    tokens_up_to = F.col("_tokens_before") + F.col("n_tokens")
    longer = F.col("_totals.d") - up_to
    return both.withColumn("_totals", totals).select(
        "length",
        "n_docs",
        "n_tokens",
        longer.alias("docs_longer"),
        (F.col("_totals.t") - tokens_up_to).alias("tokens_longer"),
        up_to.alias("docs_up_to"),
        (up_to / F.col("_totals.d")).alias("quantile"),
        (tokens_up_to + F.col("length") * longer).alias("truncated_total"),
        F.col("_totals.t").alias("total_tokens"),
    )


def truncated_total(report: DataFrame, limit: int) -> int:
    """The tokens that remain if every document is cut to ``limit``, for any limit, from the report."""
    below = report.where(F.col("length") <= limit).agg(F.max_by(F.struct("truncated_total", "docs_longer", "length"), "length").alias("b")).first()["b"]
    if below is None:
        docs = report.agg(F.sum("n_docs")).first()[0] or 0
        return docs * limit
    return below["truncated_total"] + (limit - below["length"]) * below["docs_longer"]


def token_counts(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """The report over all documents. Null and empty texts count as length 0; extra columns are not read."""
    return context_report(length_histogram(token_lengths(docs, text_col, path)))
