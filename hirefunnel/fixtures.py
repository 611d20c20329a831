"""The supplied benchmark tables seen as event log and job dimension.

`events` plays the tracking log, `customer` with `nation` the job table. Every row of
them is used. Half the events belong to five busy jobs, so that hours hold several events of a
job; the others keep their ids, which reach over as much of the job table as the log knows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirefunnel.functions.envelope import to_envelope
from hirefunnel.functions.timeuuid import timestamp_to_timeuuid
from hirefunnel.operators.enrich import job_columns
from hirefunnel.operators.merge import to_fact, union_sources
from hirefunnel.plans.jobs import enriched_metrics
from hirefunnel.operators.enrich import prepare_dimension
from hirefunnel.schema import BATCH, STREAM, TRACKING
from hirefunnel.sources import files
from hirefunnel.sources.streams import read_files

KIND_OF_TYPE = {"signup": "conversion", "purchase": "qualified", "error": "unqualified"}

# Where a lagging writer stopped, and fixed time stamps for comparable results.
SPLIT = "2024-01-20 12:30:00"
EARLY = "2024-01-08 00:00:00"
BATCH_STAMP = "2024-02-01 00:00:00"
STREAM_STAMP = "2024-01-20 13:00:00"

MESSAGES = "key string, value string"
# Bytes of the log whose messages make one file.
FILE_BYTES = 4 << 20


def stamp(text: str):
    return F.lit(text).cast("timestamp")


def as_tracking(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    for event_type, name in KIND_OF_TYPE.items():
        kind = F.when(F.col("event_type") == event_type, name).otherwise(kind)
    parity = (k % 2).cast("int")
    columns = {
        "create_time": timestamp_to_timeuuid(F.col("ts")),
        "ts": F.col("ts"),
        "job_id": F.when(parity == 0, F.col("user_id") % 5).otherwise(F.col("user_id")).cast("int"),
        "custom_track": kind,
        "bid": F.when(k % 13 != 0, F.col("value")),
        "publisher_id": F.when(k % 11 != 0, parity),
        "campaign_id": parity.cast("string"),
        "group_id": F.when(k % 7 != 0, parity.cast("string")),
    }
    return events.select(*[columns[n].alias(n) for n in TRACKING.fieldNames()])


def with_fine_bids(events: DataFrame) -> DataFrame:
    """The log with bids of six decimals, some of which are too large to be added."""
    fine = F.round(F.col("bid") * 100).cast("bigint") * 1237 / F.lit(1e6)
    large = F.col("group_id").isNull() & (F.col("campaign_id") == "1")
    return events.withColumn("bid", F.when(large, fine * 1e18).otherwise(fine))


def with_text_times(events: DataFrame) -> DataFrame:
    """The log with `ts` as text, which some events lack and which cannot be read in others."""
    bad = F.when((F.col("job_id") == 1) & F.col("group_id").isNull(), F.lit("not a time"))
    text = F.when((F.col("job_id") == 2) & F.col("publisher_id").isNull(), F.lit(None))
    return events.withColumn("ts", F.coalesce(bad, text.otherwise(F.col("ts").cast("string"))))


def is_late() -> Column:
    """Events of the two hours before SPLIT that a first run has not seen yet."""
    since = F.lit(SPLIT).cast("timestamp_ntz") - F.expr("INTERVAL 2 HOURS")
    return (F.col("ts") >= since) & F.col("group_id").isNull()


def dated_ahead(events: DataFrame) -> DataFrame:
    """Events of one job with a clock sixty years ahead."""
    ahead = F.col("ts") + F.expr("INTERVAL 60 YEARS")
    return events.where("job_id = 3 AND publisher_id IS NULL").withColumn("ts", ahead)


def epochs(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    n: int = 5,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The log sent to a folder of messages in `n` lots more, each with events of all times, and the
    stream of these messages, a lot per micro-batch. A lot is one file; of a larger log it is several
    files, so that as many tasks write and read it. `shape` makes rows of the log from `events`, row
    by row.

    Stored rows are dealt out, not messages: they are smaller, and however few row groups the log has
    or however it is ordered, all tasks shape rows and write them as text."""
    each, before = _files_of_lot(spark, events, n), _parts(spark, path)
    dealt = events.repartition(n * each, *events.columns)
    to_envelope(shape(dealt) if shape else dealt).write.mode("append").parquet(path)
    if each > 1:
        # Lots are told apart by the number of their files, and no message means no file.
        for _ in range(before + n * each - _parts(spark, path)):
            spark.createDataFrame([], MESSAGES).write.mode("append").parquet(path)
    return read_files(spark, path, MESSAGES, maxFilesPerTrigger=str(each))


def _files_of_lot(spark: SparkSession, events: DataFrame, n: int) -> int:
    size = sum(length for _, length, _ in files.fingerprint(spark, events.inputFiles()))
    return max(1, math.ceil(size / (n * FILE_BYTES)))


def _parts(spark: SparkSession, path: str) -> int:
    return sum(name.startswith("part-") for name in files.names(spark, path))


def epochs_in_order(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """The log as three micro-batches of messages, the oldest events first. Two of them share an
    hour, which no watermark of an hour or more has closed."""
    ts = F.col("ts")
    for part in (ts < EARLY, (ts >= EARLY) & (ts < SPLIT), ts >= SPLIT):
        messages = epochs(spark, events.where(part), path, 1, shape)
    return messages


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_tracking(events(spark, sf_dir))


def tracking_before_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log held when a lagging writer last ran."""
    ts = F.col("ts")
    return tracking(spark, sf_dir).where(ts < F.lit(SPLIT).cast("timestamp_ntz"))


def tracking_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a stream. The bracket makes it a glob, so that the table may be one
    file or a folder of files."""
    schema: StructType = events(spark, sf_dir).schema
    return as_tracking(read_files(spark, f"{sf_dir}/events.parque[t]", schema))


def raw_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        # One up: no customer stands for job 0, so its events find no dimension row.
        (F.col("c_custkey") + 1).cast("int").alias("id"),
        F.col("c_nationkey").cast("string").alias("company_id"),
        F.col("c_mktsegment").alias("campaign_id"),
        F.nullif(F.col("n_regionkey"), F.lit(0)).cast("string").alias("group_id"),
    )


def job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_columns(raw_job(spark, sf_dir))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_dimension(job(spark, sf_dir))


def batch_fact(spark: SparkSession, sf_dir: str, dim: DataFrame | None = None) -> DataFrame:
    dim = dimension(spark, sf_dir) if dim is None else dim
    metrics = enriched_metrics(tracking(spark, sf_dir), dim)
    return to_fact(metrics, BATCH, stamp(BATCH_STAMP))


def lagging_fact(spark: SparkSession, sf_dir: str, dim: DataFrame | None = None) -> DataFrame:
    """What the stream writer had stored when it stopped at SPLIT."""
    dim = dimension(spark, sf_dir) if dim is None else dim
    metrics = enriched_metrics(tracking_before_split(spark, sf_dir), dim)
    return to_fact(metrics, STREAM, stamp(STREAM_STAMP))


def both_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimension(spark, sf_dir)
    return union_sources(batch_fact(spark, sf_dir, dim), lagging_fact(spark, sf_dir, dim))
