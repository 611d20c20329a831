"""High-water marks, the new-data gate and the scan of what changed.

The mark is an event time. A run reads from the start of the hour that holds the mark (or from
some hours before it), recomputes these hours whole and replaces them, so reading the boundary
again is harmless. Whether there is anything to do is not told by the mark, which late events and
events dated in the future would deceive, but by the number of events in each of these hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirefunnel.schema import EMPTY_MARK


def high_water_mark(df: DataFrame, column: str = "ts", default: str = EMPTY_MARK) -> DataFrame:
    """One row, one column `mark`: the largest time, or the default of an empty frame."""
    kind = df.schema[column].dataType
    return df.agg(F.coalesce(F.max(column), F.lit(default).cast(kind)).alias("mark"))


def recent_mark(minutes: int = 1) -> Column:
    """Where a capture without a stored mark begins: a little before now."""
    return F.current_timestamp() - F.expr(f"INTERVAL {minutes} MINUTE")


def has_new_data(source_mark: DataFrame, sink_mark: DataFrame) -> DataFrame:
    """One row with both marks and whether the source is ahead of the sink."""
    marks = source_mark.select(
        F.col("mark").alias("source_mark"),
        sink_mark.scalar().cast(source_mark.schema["mark"].dataType).alias("sink_mark"),
    )
    return marks.withColumn("has_new", F.col("source_mark") > F.col("sink_mark"))


def newer_than(
    events: DataFrame,
    mark: Column,
    column: str = "ts",
    inclusive: bool = True,
    day_column: str | None = None,
) -> DataFrame:
    """Events past a mark. The column stays bare, so the test reaches the file reader.

    `mark` is a literal or a scalar subquery. `day_column` names a partition column that
    holds the date of `column`, if the log has one.
    """
    kind = events.schema[column].dataType
    mark = mark.cast(kind)
    events = events.where(F.col(column) >= mark if inclusive else F.col(column) > mark)
    if day_column:
        day = mark.cast("date").cast(events.schema[day_column].dataType)
        events = events.where(F.col(day_column) >= day)
    return events


def touched_hours(
    events: DataFrame,
    mark: Column,
    column: str = "ts",
    lookback: str | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """All events of every hour that new events can fall into.

    `lookback` is an interval text such as '2 hours' for events that arrive late;
    later ones are repaired by the full batch run.
    """
    mark = mark.cast("timestamp")
    if lookback:
        mark = mark - F.expr(f"INTERVAL {lookback}")
    return newer_than(events, F.date_trunc("hour", mark), column, day_column=day_column)


def stamp_data_time(rows: DataFrame, latest: str = "latest") -> DataFrame:
    """`updated_at` = the latest event time of the input, as a scalar subquery.

    `rows` are groups with the latest time of each (`hourly_metrics(latest=True)`). They are read
    twice, so they should be stored rows; the log they were made from is not read again.
    """
    mark = rows.agg(F.max(latest).cast("timestamp").alias("mark"))
    return rows.drop(latest).withColumn("updated_at", mark.scalar())


def hour_before(spark: SparkSession, mark: str, lookback: str | None = None) -> str:
    """The hour ('yyyy-MM-dd HH') that lies `lookback` before a mark."""
    at = F.lit(mark).cast("timestamp")
    if lookback:
        at = at - F.expr(f"INTERVAL {lookback}")
    return spark.range(1).select(F.date_format(at, "yyyy-MM-dd HH")).first()[0]


def arrivals(events: DataFrame, state: DataFrame, limit: Column, column: str = "ts") -> DataFrame:
    """One row: hours that have more events than are stored (`changed`), and the latest event up
    to `limit` as text (`mark`).

    An hour with fewer events than are stored is no news: a log may let old events go. `events`
    and `state` cover the same hours. Both are counted per hour, laid under each other
    and compared in one shuffle of a row per hour and task.
    """
    time = F.col(column)
    found = events.groupBy(
        F.to_date(time).cast("string").alias("dates"), F.hour(time).alias("hours")
    ).agg(
        F.count("*").alias("n"),
        F.max(F.when(time.cast("timestamp") <= limit, time.cast("timestamp"))).alias("latest"),
    )
    known = state.groupBy("dates", "hours").agg((-F.sum("events")).alias("n"))
    by_hour = (
        found.unionByName(known, allowMissingColumns=True)
        .groupBy("dates", "hours")
        .agg(F.sum("n").alias("n"), F.max("latest").alias("latest"))
    )
    return by_hour.agg(
        F.count_if(F.col("n") > 0).alias("changed"), F.max("latest").cast("string").alias("mark")
    )
