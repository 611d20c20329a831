"""The batch job and the incremental job."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirefunnel.functions.events import require, sifted
from hirefunnel.operators.enrich import attach, hourly_metrics_of_dimension, prepare_dimension
from hirefunnel.operators.incremental import arrivals, hour_before, touched_hours
from hirefunnel.operators.merge import to_state
from hirefunnel.operators.metrics import hourly_metrics
from hirefunnel.plans.publish import upsert
from hirefunnel.schema import (
    BATCH,
    EMPTY_MARK,
    EVENT_KEYS,
    INCREMENTAL,
    JOB_MERGE_KEYS,
    MERGE_KEYS,
    STATE,
)
from hirefunnel.sources import segments

# How far back an incremental run looks for events that arrived late, and how far ahead of the
# clock an event may be dated and still move the mark.
LOOKBACK = "1 day"
TOLERANCE = "5 minutes"


def enriched_metrics(
    events: DataFrame,
    dim: DataFrame,
    key_source: str = "event",
    extra: tuple[str, ...] = (),
    **options,
) -> DataFrame:
    """Hourly metrics with the company of the job.

    `key_source` says whose campaign and group the metrics are grouped by: those of the
    'event' or those of the job ('dimension'). `extra` are more columns to group by.
    """
    if key_source == "dimension":
        return hourly_metrics_of_dimension(events, dim, extra, **options)
    return attach(hourly_metrics(events, keys=[*EVENT_KEYS, *extra], **options), dim, "company_id")


def merge_keys(key_source: str) -> list[str]:
    return JOB_MERGE_KEYS if key_source == "dimension" else MERGE_KEYS


def run_batch(
    tracking: DataFrame,
    job: DataFrame,
    table: str,
    key_source: str = "event",
    uuid_col: str | None = "create_time",
    updated_at: Column | None = None,
    run_id: str | None = None,
) -> None:
    """Recompute every hour from the whole log and replace all that the writer has stored.

    Hours and keys that the log no longer has are gone afterwards. The time of an event comes
    from its time-UUID, or from `ts`, which may be text, if `uuid_col` is None. Events whose time is
    missing or unreadable are put into the table's quarantine with the reason. They are groups of
    their own in the one aggregation of the log, and the groups are kept for the two writes.
    """
    started = time.time()
    events = sifted(tracking, uuid_col)
    dim = prepare_dimension(job)
    groups = enriched_metrics(events, dim, key_source, ("reason", "event"), exact=True).persist()
    try:
        rows = to_state(groups.where("reason IS NULL"), BATCH, updated_at)
        rejects = groups.where("reason IS NOT NULL").select("reason", "event", F.col("events").alias("n"))
        run = run_id or uuid.uuid4().hex
        upsert(rows, table, BATCH, run, "rewrite", started=started, rejects=rejects)
    finally:
        groups.unpersist()


def run_incremental(
    tracking: DataFrame,
    job: DataFrame,
    table: str,
    lookback: str | None = LOOKBACK,
    day_column: str | None = None,
    key_source: str = "event",
    tolerance: str = TOLERANCE,
    now: Column | None = None,
) -> bool:
    """Recompute the hours from the mark on if events were added there; False if none were.

    The mark is the latest event time that a run took as past: events dated more than `tolerance`
    after the clock are counted, but do not move it. It is kept with the published version, so the
    fact table is not searched for it. From `lookback` before the mark's hour on, the log's events
    per hour are compared with those of the last run, which the stored rows hold; any difference,
    be it new, late, in the boundary second or dated in the future, makes the run recompute all
    hours from there. What arrives later than `lookback` is repaired by the batch job.
    """
    started, spark = time.time(), tracking.sparkSession
    last = segments.version(spark, table, INCREMENTAL)
    events, since = require(tracking, "ts"), None
    state = spark.createDataFrame([], STATE)
    if last is not None:
        since = hour_before(spark, last.mark, lookback)
        events = touched_hours(events, F.lit(f"{since}:00:00"), "ts", None, day_column)
        state = segments.resolved(spark, table, INCREMENTAL, last.segments)
        state = state.where(segments.from_hour(since))
    limit = (F.current_timestamp() if now is None else now) + F.expr(f"INTERVAL {tolerance}")
    found = arrivals(events, state, limit).first()
    if not found.changed:
        return False
    mark = found.mark or (last.mark if last else EMPTY_MARK)
    metrics = enriched_metrics(events, prepare_dimension(job), key_source, exact=True)
    rows = to_state(metrics, INCREMENTAL, F.lit(mark).cast("timestamp"))
    how = "rewrite" if since is None else "hours"
    upsert(rows, table, INCREMENTAL, uuid.uuid4().hex, how, since=since, mark=mark, started=started)
    return True
