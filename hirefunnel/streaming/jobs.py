"""Messages to fact rows, continuously.

Three forms, all safe to replay:

* running totals: the state store keeps every hour; each trigger emits the full totals of
  the hours that changed, which replace the stored ones.
* deltas: no state store; each trigger's events are aggregated on their own and added to
  the stored totals, once per epoch. The totals belong to one checkpoint: a query with a new
  one would add the log a second time, so it raises. To start over, use a new table.
* bounded: either of them with a watermark. Running totals drop the state of an hour a given time
  after its end, and what comes later is left to the batch job; deltas close the hour and put what
  comes later aside.

A run is named by the query's id, which Spark keeps in the checkpoint, and the epoch. After a
checkpoint was lost, running totals are recomputed from the log and replace what is stored.

A message whose time cannot be read counts under a NULL date and hour, except in the bounded
form, which has no place for it. Sifting such messages out before grouping would make Spark
parse every message twice, once for the test and once for the values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hirefunnel.functions.envelope import parse_envelope, to_envelope
from hirefunnel.operators.enrich import attach
from hirefunnel.operators.incremental import hour_before
from hirefunnel.operators.merge import to_state
from hirefunnel.operators.metrics import hourly_metrics
from hirefunnel.plans.jobs import enriched_metrics, merge_keys
from hirefunnel.plans.publish import upsert
from hirefunnel.schema import EVENT_KEYS, LATE, STREAM
from hirefunnel.sources import files, segments
from hirefunnel.streaming.dimension import Dimension, Reader
from hirefunnel.workspace import ADAPTIVE, STATE, setting, settings

# Fixed value: how often the stream looks for new messages.
TRIGGER = {"processingTime": "30 seconds"}


def _keys(key_source: str) -> list[str]:
    return EVENT_KEYS if key_source == "event" else ["job_id", "publisher_id"]


def _columns(key_source: str) -> list[str]:
    return ["company_id"] if key_source == "event" else ["campaign_id", "group_id", "company_id"]


def _run_ids(checkpoint: str) -> Callable[[DataFrame, int], str]:
    """Names of the epochs of the query that owns the checkpoint."""
    known: list[str] = []

    def run_id(batch: DataFrame, epoch: int) -> str:
        if not known:
            metadata = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata")
            known.append(metadata.first().id)
        return f"{known[0]}#{epoch}"

    return run_id


def _start(
    rows: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str,
    trigger: dict,
    name: str | None,
) -> StreamingQuery:
    wanted = rows.sparkSession.conf.get(ADAPTIVE)

    def publish(batch: DataFrame, epoch: int) -> None:
        # Spark turns adaptive execution off for a stateful stream. Its own steps are planned by now;
        # without it the writes of the sink would not be sized by date, and each state partition would
        # leave a file in each date.
        with setting(batch.sparkSession, ADAPTIVE, wanted):
            sink(batch, epoch)

    writer = rows.writeStream.outputMode(mode).foreachBatch(publish).trigger(**trigger)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).start()


def start_running_totals(
    messages: DataFrame,
    job: DataFrame | Reader,
    table: str,
    checkpoint: str,
    key_source: str = "event",
    watermark: str | None = None,
    trigger: dict = TRIGGER,
    updated_at: Column | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Stateful totals in update mode, replaced in the table; `watermark` bounds the state.

    Job columns are joined to the few rows a trigger emits, after grouping, so the state
    holds no dimension values. A changed job shows from the next trigger on, in the hours
    that get new events: their totals move to the job's new campaign and group as a whole.
    """
    events = parse_envelope(messages)
    totals = hourly_metrics(events, keys=_keys(key_source), watermark=watermark, exact=True)
    run_id, keys, dimension = _run_ids(checkpoint), merge_keys(key_source), Dimension(job)

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = attach(batch, dimension.current(batch.sparkSession), *_columns(key_source))
        rows = to_state(rows, STREAM, updated_at)
        upsert(rows, table, STREAM, run_id(batch, epoch), keys=keys)

    # State in RocksDB lives on disk with a cache, not on the executors' heap. A query
    # keeps the setting it was started with.
    with settings(messages.sparkSession, STATE):
        return _start(totals, sink, checkpoint, "update", trigger, name)


def start_deltas(
    messages: DataFrame,
    job: DataFrame | Reader,
    table: str,
    checkpoint: str,
    key_source: str = "event",
    watermark: str | None = None,
    trigger: dict = TRIGGER,
    updated_at: Column | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Totals of each trigger's events only, added to the table once per epoch.

    With `watermark`, an hour is closed that much after its end, by the latest event of the triggers
    before. Events of closed hours are not lost: they are added up under the writer `schema.LATE`,
    from the same aggregation, until `merge.with_late` or the batch job puts them where they belong.
    """
    events = parse_envelope(messages)
    run_id, dimension = _run_ids(checkpoint), Dimension(job)

    def sink(batch: DataFrame, epoch: int) -> None:
        spark, this = batch.sparkSession, run_id(batch, epoch)
        last = segments.version(spark, table, STREAM)
        if last and last.run_id.split("#")[0] != this.split("#")[0]:
            raise ValueError(f"{table} holds totals of another query: {last.run_id}, not of {this}")
        dim = dimension.current(spark)
        if watermark is None:
            rows = enriched_metrics(batch, dim, key_source, exact=True)
            upsert(to_state(rows, STREAM, updated_at), table, STREAM, this, "accumulate")
            return
        groups = enriched_metrics(batch, dim, key_source, exact=True, latest=True).persist()
        try:
            mark = groups.agg(F.max("latest").cast("string")).first()[0]
            closed = F.lit(False)
            if last and last.mark:
                # Hours that ended at least `watermark` before the mark.
                until = hour_before(spark, last.mark, watermark)
                closed = F.coalesce(segments.before_hour(until) & F.col("dates").isNotNull(), F.lit(False))
            # The late ones first: the stream's version is what says that the epoch has happened, and
            # its mark decides again in the same way if the epoch is repeated.
            late = to_state(groups.where(closed), LATE, updated_at)
            upsert(late, table, LATE, this, "accumulate")
            rows = to_state(groups.where(~closed), STREAM, updated_at)
            latest = max(filter(None, (mark, last.mark if last else None)), default=None)
            upsert(rows, table, STREAM, this, "accumulate", mark=latest)
        finally:
            groups.unpersist()

    return _start(events, sink, checkpoint, "append", trigger, name)


def publish_messages(messages: DataFrame, fmt: str, checkpoint: str | None = None, **options):
    """Write keyed messages to a topic (`fmt='kafka'`) or to files.

    A batch frame is written at once; the number of messages that were written comes back. A
    streaming frame is captured from now on: its checkpoint remembers which source rows were
    published, and its progress how many.
    """
    if messages.isStreaming:
        writer = messages.writeStream.format(fmt).options(**options)
        return writer.option("checkpointLocation", checkpoint).start()
    # Counted while they are written, not by a second scan.
    seen = Observation()
    counted = messages.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.format(fmt).mode("append").options(**options).save()
    return seen.get.get("n", 0)


def start_capture(
    events: DataFrame,
    fmt: str,
    checkpoint: str,
    lookback: str = "1 minute",
    time_col: str = "ts",
    now: Column | None = None,
    trigger: dict = TRIGGER,
    **options,
) -> StreamingQuery:
    """Publish the events of a streaming log that are dated from `lookback` before now on.

    Where the capture begins is written down beside its checkpoint when it is started first, and
    holds for every later start; the test reaches the file reader. Each event is published once.
    """
    spark, record = events.sparkSession, f"{checkpoint}-begin.json"
    folder, name = record.rsplit("/", 1)
    if name not in files.names(spark, folder):
        at = (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {lookback}")
        files.write_new(spark, record, spark.range(1).select(at.cast("string")).first()[0])
    begin = F.lit(files.read(spark, record)).cast(events.schema[time_col].dataType)
    messages = to_envelope(events.where(F.col(time_col) >= begin))
    writer = messages.writeStream.format(fmt).options(**options).trigger(**trigger)
    return writer.option("checkpointLocation", checkpoint).start()
