"""Cleaning, filtering and building single event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hirefunnel.functions.timeuuid import is_timeuuid, new_timeuuid, time_of_timeuuid
from hirefunnel.schema import KINDS, TRACKING

# What the four ids and the bid become when they are absent.
KEY_FILL = {"job_id": 0, "publisher_id": 0, "campaign_id": "0", "group_id": "0"}
BID_FILL = {"bid": 0}


def with_event_time(events: DataFrame, uuid_col: str = "create_time") -> DataFrame:
    """Take `ts` from the time-UUID; rows without a readable UUID are dropped.

    Testing the text first means that each UUID is decoded once, not once for the test and
    once for the value.
    """
    uuid = F.col(uuid_col)
    return events.where(is_timeuuid(uuid)).withColumn("ts", time_of_timeuuid(uuid))


# Reasons for which an event is not counted.
NO_TIME, UNREADABLE_TIME = "no time", "unreadable time"


def sifted(events: DataFrame, uuid_col: str | None = None, time_col: str = "ts") -> DataFrame:
    """Every event with `ts` as a timestamp, or NULL and then why (`reason`) and the event as it came
    (`event`, JSON). The time comes from the time-UUID, or from `time_col`, which may be text.

    Nothing raises and nothing is dropped: what follows decides on `reason`, in the same scan.
    """
    raw = F.col(uuid_col or time_col)
    if uuid_col:
        time = F.when(is_timeuuid(raw), time_of_timeuuid(raw))
    elif isinstance(events.schema[time_col].dataType, StringType):
        time = F.try_to_timestamp(raw)
    else:
        time = raw
    reason = F.when(raw.isNull(), NO_TIME).when(time.isNull(), UNREADABLE_TIME)
    rows = events.withColumns({"reason": reason, "event": F.to_json(F.struct(*events.columns))})
    # The text is made for events that are not counted only.
    rows = rows.withColumn("event", F.when(F.col("reason").isNotNull(), F.col("event")))
    return rows.withColumn("ts", time)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where none of the columns is NULL."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def of_kind(events: DataFrame, kind: str) -> DataFrame:
    return events.where(F.col("custom_track") == kind)


def known_only(events: DataFrame) -> DataFrame:
    return events.where(F.col("custom_track").isin(KINDS))


def fill_keys(events: DataFrame, bid: bool = False) -> DataFrame:
    """NULL ids become 0 (text ids '0'); with `bid` a NULL bid becomes 0 as well."""
    return events.na.fill({**KEY_FILL, **(BID_FILL if bid else {})})


def ids_as_int(df: DataFrame, column: str) -> DataFrame:
    """The non-NULL values of an id column as integers."""
    return df.where(F.col(column).isNotNull()).select(F.col(column).cast("int").alias(column))


def from_action(actions: DataFrame, at: Column | None = None) -> DataFrame:
    """Rows of `(job_id, action)` as full events: a click bids 1, any other action 0.

    `at` is the time of the action, by default now; each event gets a UUID of its own. Publisher, campaign and group are
    not known to the caller and stay NULL.
    """
    at = F.current_timestamp() if at is None else at
    values = {
        "create_time": new_timeuuid(at),
        "ts": at.cast("timestamp"),
        "job_id": F.col("job_id"),
        "custom_track": F.col("action"),
        "bid": F.when(F.col("action") == "click", 1).otherwise(0),
    }
    return actions.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in TRACKING]
    )
