"""Checks between the layers and between the writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirefunnel.operators.merge import union_sources
from hirefunnel.operators.metrics import bid_amount
from hirefunnel.schema import BATCH, COUNTS, FACT_KEYS, STREAM
from hirefunnel.sources import segments


def layer_counts(events: DataFrame, messages: DataFrame, fact: DataFrame) -> DataFrame:
    """Rows at the source, messages on the topic, and events the fact table accounts for.

    The warehouse figure adds all four counts. Events of unknown kinds are in the first
    two figures only.
    """
    counted = sum((F.col(c) for c in COUNTS), F.lit(0))
    layers = {
        "source": events.agg(F.count(F.lit(1)).alias("n")),
        "broker": messages.agg(F.count(F.lit(1)).alias("n")),
        "warehouse": fact.agg(F.coalesce(F.sum(counted), F.lit(0)).alias("n")),
    }
    return union_sources(
        *[n.select(F.lit(layer).alias("layer"), F.col("n")) for layer, n in layers.items()]
    )


def recorded_counts(spark: SparkSession, published: int, table: str) -> DataFrame:
    """Events per layer as the jobs recorded them while they ran; the log is not read again.

    `published` is what `publish_messages` gave back. The stream and the batch account for every event
    they counted, whatever its kind, and the batch's quarantine for those it refused.
    """
    held = {
        "stream": segments.read_state(spark, table, STREAM).agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n")),
        "warehouse": segments.read_state(spark, table, BATCH).agg(F.coalesce(F.sum("events"), F.lit(0)).alias("n")),
        "quarantine": segments.read_rejects(spark, table, BATCH).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")),
    }
    sent = spark.range(1).select(F.lit(published).cast("bigint").alias("n"))
    layers = {"broker": sent} | held
    return union_sources(
        *[n.select(F.lit(layer).alias("layer"), F.col("n")) for layer, n in layers.items()]
    )


def drift(fact: DataFrame, batch: str = BATCH, stream: str = STREAM) -> DataFrame:
    """Counts of both writers side by side per business key, and batch minus stream.

    NULL keys match NULL keys, and a key only one writer has counts 0 for the other. One
    scan and one shuffle: the two writers are told apart while adding up, not joined.
    """
    of_batch = F.col("sources") == batch
    totals = [
        F.coalesce(F.sum(F.when(side, F.col(c))), F.lit(0)).alias(f"{c}_{name}")
        for c in COUNTS
        for name, side in (("batch", of_batch), ("stream", ~of_batch))
    ]
    both = fact.where(F.col("sources").isin(batch, stream)).groupBy(*FACT_KEYS).agg(*totals)
    return both.withColumns(
        {f"{c}_drift": F.col(f"{c}_batch") - F.col(f"{c}_stream") for c in COUNTS}
    )


def agreement(drifts: DataFrame) -> DataFrame:
    """Keys, keys whose counts agree, and their share."""
    same = F.lit(True)
    for c in COUNTS:
        same = same & (F.col(f"{c}_drift") == 0)
    return drifts.agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(same).alias("n_agree")
    ).withColumn("agreement", F.try_divide(F.col("n_agree"), F.col("n_keys")))


def unusable_bids(events: DataFrame) -> DataFrame:
    """Clicks per date whose bid is there but cannot be added: not a number, or too large."""
    lost = events.where((F.col("custom_track") == "click") & F.col("bid").isNotNull()).where(
        bid_amount(F.col("bid")).isNull()
    )
    return lost.groupBy(F.to_date("ts").alias("date")).agg(F.count("*").alias("clicks"))
