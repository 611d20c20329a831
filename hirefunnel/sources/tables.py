"""Batch readers. The format and its options are parameters; nothing here knows a vendor."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from hirefunnel.operators import merge
from hirefunnel.operators.enrich import job_columns
from hirefunnel.schema import FACT, JOB, STATE
from hirefunnel.sources import files, segments


def read_table(
    spark: SparkSession, fmt: str, schema: StructType | None = None, **options: str
) -> DataFrame:
    """A whole table, e.g. parquet files (`path`), Cassandra (`keyspace`, `table`) or JDBC."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load()


def read_dimension(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """The job table under the names the joins use; only these columns leave the source."""
    schema = JOB if fmt in ("parquet", "json", "csv", "orc") else None
    return job_columns(read_table(spark, fmt, schema, **options))


def read_query(spark: SparkSession, fmt: str, query: str, **options: str) -> DataFrame:
    """The result of a query that the source itself runs (JDBC `query` option)."""
    return spark.read.format(fmt).options(query=query, **options).load()


def read_fact(spark: SparkSession, path: str, averages: bool = False) -> DataFrame:
    """The fact table, or no rows if nothing has been published yet.

    The frame is bound to what was published when it was made. Rows that were merely appended
    come as they are. `averages` adds the average bid of each row and how many bids its spend
    misses; appended rows have neither.
    """
    shown = [
        merge.served(segments.read_state(spark, path, writer), averages)
        for writer in segments.writers(spark, path)
    ]
    plain = appended(spark, path)
    if plain is not None:
        shown.append(plain)
    if not shown:
        return merge.served(spark.createDataFrame([], STATE), averages)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shown)


def appended(spark: SparkSession, path: str, schema: StructType = FACT) -> DataFrame | None:
    """Rows that lie in a folder as plain parquet; None if it holds none."""
    if not any(n[0] not in "_." for n in files.names(spark, path)):
        return None
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def from_rows(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A few local values as a frame, one list per column."""
    return spark.createDataFrame(list(zip(*columns.values())), list(columns))
