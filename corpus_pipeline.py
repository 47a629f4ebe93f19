"""The training-data pipeline: toxic documents go, copies go, sources are mixed, sequences are packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlab.llm.exact_dedup import drop_copies
from mixlab.llm.mixing import mix
from mixlab.llm.ngram_join import drop_near_copies
from mixlab.llm.packing import pack
from mixlab.llm.queries import quality_weights, table
from mixlab.llm.toxicity import toxicity
from mixlab.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of their language go; the labels train the classifier.

    Empty and null texts have a score too, that of a text without words; a text of any length is read
    whole. A score equal to the threshold rejects. Repeated rows and null ids are scored each.
    Extra columns stay, also if they are called like those of the operator.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(docs.columns, names)}
    scored = toxicity(docs.toDF(*names), table(spark, sf_dir, "labels").withColumnRenamed("doc_id", at["doc_id"]), at["doc_id"], at["text"], at["lang"])
    return scored.where(~F.col("rejected")).select(*names).toDF(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space one row stays (``drop_copies``); null and empty texts are equal."""
    return drop_copies(docs)


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents with a similarity of 0.8 or more on five-word shingles one row stays (``drop_near_copies``).

    Texts without words are like nothing and stay; those with fewer words are one shingle.
    """
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's mix takes it, whole; documents taken no time go.

    What the mix takes goes by the whole row, not by its id: repeated ids, null ids and repeated
    rows get what they are taken for, and the words taken of a source end within half a document of its
    target. Null texts and texts without words are taken no time. Extra columns stay, whatever they are called.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]
    at = dict(zip(docs.columns, names))
    kinds = dict(docs.toDF(*names).dtypes)
    told = [n for n in names if "map<" not in kinds[n] and kinds[n] != "variant"]
    rows = docs.toDF(*names).withColumns({"tag": F.xxhash64(*told), "mark": F.hash(*told)})
    weights = quality_weights(table(spark, sf_dir, "labels"))
    mixed = mix(rows, weights, id_col=at["doc_id"], text_col=at["text"], source_col=at["source"], tags=["tag", "mark"])
    taken = mixed.where("taken > 0").groupBy("tag", "mark").agg(F.sum((F.col("taken") / F.col("size")).cast("int")).alias("times"))
    one = rows.groupBy("tag", "mark").agg(F.first(F.struct(*names)).alias("row")).join(taken, ["tag", "mark"])
    repeated = one.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return repeated.select("row.*").toDF(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of at most 4096 tokens.

    Texts without tokens are one piece of the end id; repeated rows, as the mix makes them, are packed each.
    """
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard", drop_similar),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
# A trained classifier and a tokenizer cannot be stated in SQL; tests/llm checks each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
