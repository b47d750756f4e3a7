"""From raw documents to shards: five stages, each a function of (spark, docs, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarifold.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from tarifold.llm.common import free_name, stored, table

SHARDS = 24
SEED = 11


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the compression-distance classifier gives 0.5 or more."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "toxicity_score")
    return toxicity.toxicity_scores(docs, model, score_col=score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word shingle sets at Jaccard 0.8 or more."""
    return ngram_join.one_of_each_component(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold 80 % or more of a benchmark item's shingles."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All sources alike in expectation, in the expected size of the input; copies are rows, in shuffled order."""
    return mixing.mix_sources(docs, seed=SEED).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's shard and slot, in the shuffled order."""
    return sharding.shard_by_bytes(docs, SHARDS, keep_order=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]
#: The classifier can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
