"""Corpus pipeline: quality rules, exact dedup, SimHash near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of documents. `run` writes each stage's result below the shared checkpoint folder and reads it
again, so a lost executor never repeats an earlier stage.

`run` removes what a stage's result was made from, scratch tables and the result before it, once the
result is written. Who calls the stages one by one keeps their scratch tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hirefunnel.llm import bpe, exact_dedup, mixing, quality, simhash
from hirefunnel.llm.common import documents, noting_scratch, remove, stored
from hirefunnel.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.distinct_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# EM, XXH64 and BPE have no counterpart in SQL: the tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        with noting_scratch() as paths:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # The last folder is the result.
        remove(spark, before + paths[:-1])
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
