"""Joining the job dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def job_columns(job: DataFrame) -> DataFrame:
    return job.select(F.col("id").alias("job_id"), "company_id", "campaign_id", "group_id")


def prepare_dimension(
    dim: DataFrame, key: str = "job_id", broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Prove the key unique, measure the rows, and mark for broadcast what is small.

    One distributed pass that brings back one row. A dimension above the limit is joined
    by shuffle, where adaptive execution splits a hot job. A repeated key would multiply
    measures, so it is an error.
    """
    dim = dim.where(F.col(key).isNotNull())
    return F.broadcast(dim) if proven_bytes(dim, key) <= broadcast_bytes else dim


def proven_bytes(dim: DataFrame, key: str = "job_id") -> int:
    """Size of a dimension whose keys are found to be unique; an error if they are not."""
    width = sum(
        (F.coalesce(F.octet_length(F.col(f.name).cast("string")), F.lit(0)) for f in dim.schema),
        F.lit(16 * len(dim.columns)),
    )
    size = (
        dim.groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"), F.sum(width).alias("bytes"))
        .agg(
            F.max("copies").alias("copies"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        )
        .first()
    )
    if (size.copies or 0) > 1:
        raise ValueError(f"dimension key {key} is not unique: one value has {size.copies} rows")
    return size.bytes


def attach(df: DataFrame, dim: DataFrame, *columns: str, key: str = "job_id") -> DataFrame:
    """Left join of dimension columns. Rows without a match stay, with NULLs.

    A column that both sides have is taken from the dimension.
    """
    return df.drop(*columns).join(dim.select(key, *columns), key, "left")


def hourly_metrics_of_dimension(
    events: DataFrame, dim: DataFrame, extra: tuple[str, ...] = (), **options
) -> DataFrame:
    """Hourly metrics whose campaign and group come from the job, not from the event.

    The job fixes both, so grouping by job first and joining the groups gives the same
    rows as joining every event, and no event row is shuffled to the join.
    """
    from hirefunnel.operators.metrics import hourly_metrics

    by_job = hourly_metrics(events, keys=["job_id", "publisher_id", *extra], **options)
    return attach(by_job, dim, "campaign_id", "group_id", "company_id")


def unmatched(df: DataFrame, dim: DataFrame, key: str = "job_id") -> DataFrame:
    """Rows whose key the dimension does not have."""
    return df.join(dim.select(key), key, "left_anti")
