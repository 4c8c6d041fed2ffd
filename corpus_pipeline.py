"""Corpus cleaning and tokenizing as a chain of stages over ``documents``.

Each stage takes (spark, docs, sf_dir), where docs has the columns of
``documents``, and returns a DataFrame; it is written as Parquet and read back
before the next stage begins.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontam, lines, ngram_join, toxicity
from tessera.llm.common import cut_lineage, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on these documents and the
    labels, scores 0.3 or more go."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")), 0.3)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand on more than a tenth of their source's documents go."""
    return (lines.drop_boilerplate(docs, "source", "text")
            .withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates (shingles of five words, Jaccard similarity of 0.8 or
    more, also by way of others) the document with the smallest id stays."""
    return ngram_join.keep_one(docs, width=5, num=80, den=100)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of a benchmark item's five-word shingles go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, n_bytes): the ids, and the length of their decoding."""
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = cut_lineage(bpe.encode(docs, path))       # so that no task has two Python workers
    return bpe.decode(ids, path).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.length("bytes").cast("long").alias("n_bytes"))


STAGES = [("toxicity", without_toxic), ("line dedup", without_boilerplate), ("n-gram Jaccard join", one_of_each_group),
          ("benchmark decontamination", without_benchmark), ("byte-level BPE", tokenized)]

#: SQL can express neither the toxicity model nor the byte-level BPE; tests
#: compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs
