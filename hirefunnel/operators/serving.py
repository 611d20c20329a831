"""Queries on the fact table for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirefunnel.operators.metrics import half_up
from hirefunnel.schema import EVENT_KEYS

# Funnel stages and the total each one shows.
FUNNEL = {"Views": "clicks", "Applications": "conversions", "Qualified": "qualified"}


def _total(column: str):
    return F.coalesce(F.sum(column), F.lit(0))


def job_list(fact: DataFrame) -> DataFrame:
    return fact.select("job_id").where(F.col("job_id").isNotNull()).distinct()


def job_totals(fact: DataFrame) -> DataFrame:
    """Clicks, conversions and qualified applications per job, NULL counted as 0."""
    return fact.groupBy("job_id").agg(
        _total("clicks").alias("clicks"),
        _total("conversion").alias("conversions"),
        _total("qualified_application").alias("qualified"),
    )


def lookup(df: DataFrame, job_id: int) -> DataFrame:
    """Rows of one job."""
    return df.where(F.col("job_id") == job_id)


def funnel(fact: DataFrame) -> DataFrame:
    """Three stages per job: value and percent of the first stage.

    The percent has two decimals and is NULL for a job without views.
    """
    stages = [
        F.struct(
            F.lit(rank).cast("int").alias("step"),
            F.lit(stage).alias("stage"),
            F.col(total).alias("value"),
        )
        for rank, (stage, total) in enumerate(FUNNEL.items(), start=1)
    ]
    first = next(iter(FUNNEL.values()))
    return job_totals(fact).select(
        "job_id", F.col(first).alias("_first"), F.inline(F.array(*stages))
    ).select(
        "job_id",
        "step",
        "stage",
        "value",
        half_up(F.col("value") * 10_000, F.col("_first")).alias("percent_initial"),
    )


def grand_total(fact: DataFrame) -> DataFrame:
    return fact.agg((_total("clicks") + _total("conversion")).alias("total"))


def _newest() -> list:
    """Latest rows first; the whole key is part of the order, so that ties decide nothing."""
    latest = [F.col("updated_at").desc(), F.col("dates").desc(), F.col("hours").desc()]
    return [*latest, *EVENT_KEYS, "company_id"]


def newest_per_source(fact: DataFrame, n: int) -> DataFrame:
    """The first n rows of every writer with their `rank`, in one pass.

    Each task keeps n rows per writer before anything is shuffled, and only those are ranked.
    """
    rank = F.row_number().over(Window.partitionBy("sources").orderBy(*_newest()))
    return fact.withColumn("rank", rank).where(F.col("rank") <= n)


def newest_first(fact: DataFrame, source: str, n: int | None = None) -> DataFrame:
    """Rows of one writer, latest `updated_at` first; `n` keeps the first n of them.

    The whole key is part of the order, so ties do not decide which rows are kept.
    """
    rows = fact.where(F.col("sources") == source).orderBy(*_newest())
    return rows if n is None else rows.limit(n)
