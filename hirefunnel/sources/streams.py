"""Streaming readers. Offsets live in the checkpoint of the query that reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hirefunnel.schema import TOPIC


def read_messages(spark: SparkSession, servers: str, topic: str = TOPIC, **options: str) -> DataFrame:
    """Key and value of a Kafka topic from its beginning.

    Lost offsets stop the query by default, so that a gap is noticed.
    """
    settings = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **options,
    }
    return spark.readStream.format("kafka").options(**settings).load()


def read_files(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files that appear under a path (or glob), each read once."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
