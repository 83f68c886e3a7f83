"""From raw documents to token digests: toxic documents go, near duplicates go, sources are mixed, texts are encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retail_lens.llm import bpe_automaton, mixing, ngram_join, toxicity
from retail_lens.llm.common import importable, staging
from retail_lens.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labelled ones, does not find toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.grade(docs, model, into="_toxicity").filter(~F.col("_toxicity.toxic")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixing.repeated(docs, weights=(5, 2, 1), limit=3)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of each document's ids and of what they decode to."""
    importable(spark)
    return bpe_automaton.round_trip(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("mixing", mix_sources), ("bpe", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents, each written and read again."""
    stage = staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs


#: A fitted model and a seeded hash decide which rows stay, which SQL cannot express.
ORACLE_SQL = None
