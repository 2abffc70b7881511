"""A corpus pipeline of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns what the next one gets: toxic
documents go, of equal texts one stays, of near-duplicate texts (five words, Jaccard
0.8) one stays, and what remains is packed into training sequences.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripcast.llm import exact_dedup, ngram_join, packing, toxicity
from tripcast.llm.common import small_batches, table, written
from tripcast.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return ngram_join.keep_one_each(docs, words=5, num=80, den=100)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies),
          ("packing", pack_sequences)]

#: language models, graph components and tokenizers have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; between stages the rows are written and read again."""
    out = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, out, sf_dir)
        if i < len(STAGES) - 1:
            out = written(out, name)
    return out
