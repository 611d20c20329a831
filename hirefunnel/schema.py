"""Column vocabulary of the event log, the job dimension, the messages and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


# Event kinds, and the fact column that counts each of them.
MEASURE_OF_KIND = {
    "click": "clicks",
    "conversion": "conversion",
    "qualified": "qualified_application",
    "unqualified": "disqualified_application",
}
KINDS = list(MEASURE_OF_KIND)
COUNTS = list(MEASURE_OF_KIND.values())

# Lineage labels of the three writers, best first when a fact is served.
BATCH = "Cassandra_Batch"
STREAM = "Kafka_Streaming"
INCREMENTAL = "Cassandra"
PRECEDENCE = [BATCH, INCREMENTAL, STREAM]
# Our own label: events that a bounded stream met after their hour was closed.
LATE = "Kafka_Late"

# Topic of the event messages, and the mark of an empty warehouse.
TOPIC = "tracking_events"
EMPTY_MARK = "1998-01-01 00:00:00"

EVENT_KEYS = ["job_id", "publisher_id", "campaign_id", "group_id"]
TIME_KEYS = ["dates", "hours"]
FACT_KEYS = TIME_KEYS + EVENT_KEYS
# The whole grouping key plus the writer; rows that differ in group_id stay apart.
MERGE_KEYS = FACT_KEYS + ["sources"]
# What a run recomputes whole when campaign and group come from the job: these may change
# between runs, and the rows under their old values have to go.
JOB_MERGE_KEYS = TIME_KEYS + ["job_id", "publisher_id", "sources"]

TRACKING = _struct(
    create_time=StringType(),
    ts=TimestampType(),
    job_id=IntegerType(),
    custom_track=StringType(),
    bid=DoubleType(),
    publisher_id=IntegerType(),
    campaign_id=StringType(),
    group_id=StringType(),
)

JOB = _struct(
    id=IntegerType(),
    company_id=StringType(),
    campaign_id=StringType(),
    group_id=StringType(),
)

# Message value. ts and bid travel as text and are cast leniently by the reader.
ENVELOPE = _struct(
    job_id=IntegerType(),
    custom_track=StringType(),
    ts=StringType(),
    publisher_id=IntegerType(),
    bid=StringType(),
    campaign_id=StringType(),
    group_id=StringType(),
    create_time=StringType(),
)

FACT = _struct(
    dates=StringType(),
    hours=IntegerType(),
    job_id=IntegerType(),
    publisher_id=IntegerType(),
    campaign_id=StringType(),
    group_id=StringType(),
    company_id=StringType(),
    spend_hour=DoubleType(),
    clicks=LongType(),
    conversion=LongType(),
    qualified_application=LongType(),
    disqualified_application=LongType(),
    updated_at=TimestampType(),
    sources=StringType(),
)

# What the table stores: measures that can be added up at any time without a loss. `spend` is
# exact, `bids` counts the bids in it, `unusable_bids` the clicks whose bid it misses, and
# `events` every event, those of unknown kinds too.
SUMS = ["spend", "bids", "unusable_bids", "events", *COUNTS]
STATE = _struct(
    **{name: FACT[name].dataType for name in FACT_KEYS + ["company_id"]},
    spend=DecimalType(38, 9),
    bids=LongType(),
    unusable_bids=LongType(),
    events=LongType(),
    **{name: LongType() for name in COUNTS},
    updated_at=TimestampType(),
    sources=StringType(),
)

# Events that were not counted: why, the event as JSON, and how many alike there were.
REJECTS = _struct(reason=StringType(), event=StringType(), n=LongType())


def check_sink_schema(df: DataFrame, expected: StructType = FACT) -> DataFrame:
    """Refuse rows that do not fit the sink before anything is written."""
    got = {f.name: f.dataType for f in df.schema}
    want = {f.name: f.dataType for f in expected}
    problems = [f"missing column {n}" for n in want if n not in got]
    problems += [f"unexpected column {n}" for n in got if n not in want]
    problems += [
        f"column {n} is {got[n].simpleString()}, expected {want[n].simpleString()}"
        for n in want
        if n in got and got[n] != want[n]
    ]
    if problems:
        raise ValueError("rows do not fit the sink: " + "; ".join(problems))
    return df.select(*want)
