"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hirefunnel.llm import (
    automaton_dedup,
    bpe,
    centroids,
    exact_dedup,
    html_text,
    lexical,
    mixing,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
)
from hirefunnel.llm.common import documents
from hirefunnel.llm.oracle import CENTROIDS, LEXICAL, WARC
from hirefunnel.workspace import scratch


def vocabulary() -> str:
    """Path of the vocabulary file; looked up where it is used, so the rest works without it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")



def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(documents(spark, sf_dir))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.resharded(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(documents(spark, sf_dir))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(documents(spark, sf_dir))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton_dedup.digests(documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.scored(documents(spark, sf_dir), labels)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(documents(spark, sf_dir), vocabulary())


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(documents(spark, sf_dir)).drop("key", "copies")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return warc.records(spark, folder)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return lexical.ranked(documents(spark, sf_dir), items)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_text": op1_html_text,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_sharding": op3_sharding,
    "op4_quality_rules": op4_quality_rules,
    "op5_simhash_near_dedup": op5_simhash_near_dedup,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_bpe": op9_bpe,
    "op10_mixing": op10_mixing,
    "op11_warc": op11_warc,
    "op12_centroids": op12_centroids,
    "op13_lexical": op13_lexical,
}

ORACLE: dict[str, str] = {
    "op6_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                       'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)
        WINDOW same AS (PARTITION BY body)
    """,
    "op11_warc": WARC,
    "op12_centroids": CENTROIDS,
    "op13_lexical": LEXICAL,
}
