"""Fact rows, and the two ways a writer's new rows meet the stored ones.

Both are plain DataFrame operators. `plans.publish` applies them to a stored table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirefunnel.operators.metrics import rounded_amounts
from hirefunnel.schema import COUNTS, FACT, FACT_KEYS, MERGE_KEYS, STATE, SUMS, check_sink_schema

# Most new rows whose keys are sent to every task. The size of their files says little: keys that
# repeat the same few values take a hundredfold of it in memory.
BROADCAST_ROWS = 100_000

# Amounts of the fact table have two decimals and are added as such.
_CENTS = "decimal(28,2)"


def to_fact(metrics: DataFrame, source: str, updated_at: Column | None = None) -> DataFrame:
    """Metrics as rows of the fact table: lineage, time stamp, column order, types.

    `updated_at` is by default the processing time. Counts that are NULL become 0.
    """
    stamp = F.current_timestamp() if updated_at is None else updated_at
    rows = metrics.withColumns({"updated_at": stamp, "sources": F.lit(source)})
    rows = rows.na.fill(0, ["spend_hour", *COUNTS])
    return check_sink_schema(rows.select(*[F.col(f.name).cast(f.dataType) for f in FACT]))


def to_state(metrics: DataFrame, source: str, updated_at: Column | None = None) -> DataFrame:
    """Exact metrics (`hourly_metrics` with `exact`) as rows of the stored table."""
    stamp = F.current_timestamp() if updated_at is None else updated_at
    rows = metrics.withColumns({"updated_at": stamp, "sources": F.lit(source)})
    return check_sink_schema(rows.select(*[F.col(f.name).cast(f.dataType) for f in STATE]), STATE)


def state_of_fact(fact: DataFrame) -> DataFrame:
    """Fact rows as rows of the stored table. Their amounts are as exact as two decimals allow;
    how many bids and other events they hold is not known, so they count none."""
    known = {"spend": F.col("spend_hour"), "events": sum((F.col(c) for c in COUNTS), F.lit(0))}
    rows = fact.withColumns(known)
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(0)).cast(f.dataType).alias(f.name)
            for f in STATE
        ]
    )


def served(state: DataFrame, averages: bool = False) -> DataFrame:
    """Stored rows as fact rows: amounts are rounded here and nowhere before.

    `averages` adds the average bid (`bid_set`) and how many bids the spend misses.
    """
    spend, average = rounded_amounts(F.col("spend"), F.col("bids"))
    rows = state.withColumn("spend_hour", spend)
    if not averages:
        return rows.select(*FACT.fieldNames())
    return rows.withColumn("bid_set", average).select(*FACT.fieldNames(), "bid_set", "unusable_bids")


def added(state: DataFrame) -> DataFrame:
    """Stored rows of one key and company added up, exactly."""
    return (
        state.groupBy(*MERGE_KEYS, "company_id")
        .agg(
            *[F.sum(c).cast(STATE[c].dataType).alias(c) for c in SUMS],
            F.max("updated_at").alias("updated_at"),
        )
        .select(*STATE.fieldNames())
    )


def with_late(state: DataFrame, late: DataFrame, source: str) -> DataFrame:
    """A writer's stored rows and the late ones beside them, added up under the writer's label."""
    return added(state.unionByName(late).withColumn("sources", F.lit(source)))


def same_key(left: str, right: str, keys: list[str]) -> Column:
    """Equality of key columns of two aliased frames in which NULL equals NULL."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def untouched(fact: DataFrame, rows: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """The rows of `fact` whose key is not among `rows`.

    Up to `BROADCAST_ROWS` of `rows` are sent to the fact's partitions; otherwise both are shuffled
    once by key. Of a stored table only the footers are read to count them.
    """
    few = rows.count() <= BROADCAST_ROWS
    known = rows.select(*keys).hint("broadcast" if few else "merge")
    return fact.alias("f").join(known.alias("r"), same_key("f", "r", keys), "left_anti")


def replace(fact: DataFrame, rows: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """Insert `rows`; what is stored under one of their `keys` goes.

    Takes full totals: repeating the merge changes nothing. `keys` are what the writer
    recomputes whole: `JOB_MERGE_KEYS` when campaign and group are looked up in the job, so
    that a job that changes them leaves no total behind. `rows` is read twice, so it should
    be a stored table rather than a long computation.
    """
    return untouched(fact, rows, keys).unionByName(rows)


def accumulate(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert `rows`; where a key is stored already the measures are added to it.

    Takes totals of new events only, each set once. The company is part of the key, so
    a job that changes owner within the hour keeps both owners' shares.
    """
    keys = MERGE_KEYS + ["company_id"]
    return (
        fact.unionByName(rows)
        .groupBy(*keys)
        .agg(
            F.sum(F.col("spend_hour").cast(_CENTS)).alias("_spend"),
            *[F.sum(c).alias(c) for c in COUNTS],
            F.max("updated_at").alias("updated_at"),
        )
        .withColumn("spend_hour", F.col("_spend").cast("double"))
        .select(*FACT.fieldNames())
    )


def union_sources(*facts: DataFrame) -> DataFrame:
    """Rows of several writers under each other, told apart by `sources`."""
    return reduce(DataFrame.unionByName, facts)


def corrected_view(fact: DataFrame, precedence: list[str]) -> DataFrame:
    """For each business key the rows of the best writer that has it.

    `precedence` lists the writers, best first. One scan and one shuffle by key; a key has
    at most a few rows per writer, so no partition of the window can grow large.
    """
    rank = F.array_position(F.lit(precedence), F.col("sources"))
    best = F.min("_rank").over(Window.partitionBy(*FACT_KEYS))
    return (
        fact.where(F.col("sources").isin(precedence))
        .withColumn("_rank", rank)
        .withColumn("_best", best)
        .where(F.col("_rank") == F.col("_best"))
        .drop("_rank", "_best")
    )
