"""Every operator as a query on the supplied tables: `(spark, sf_dir) -> DataFrame`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirefunnel import fixtures as fx
from hirefunnel.functions import envelope, events as ev
from hirefunnel.functions.timeuuid import timestamp_to_timeuuid, timeuuid_to_text
from hirefunnel.operators import enrich, incremental, merge, metrics, reconcile, serving
from hirefunnel.plans import publish
from hirefunnel.plans.jobs import enriched_metrics, run_batch, run_incremental
from hirefunnel.schema import BATCH, INCREMENTAL, KINDS, PRECEDENCE, STREAM
from hirefunnel.sources import segments
from hirefunnel.sources.streams import read_files
from hirefunnel.sources.tables import read_fact
from hirefunnel.streaming import jobs as streaming
from hirefunnel.workspace import scratch

LOOKUP_JOB = 2
LOOKBACK = "2 hours"
NEWEST = 25


def _stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Fact rows written and read back, as a job stages them: computed once, used twice."""
    path = scratch(spark, name)
    rows.write.parquet(path)
    return read_fact(spark, path)


# --- scans ---------------------------------------------------------------------------

def event_scan(spark: SparkSession, sf: str) -> DataFrame:
    return fx.tracking(spark, sf)


def dimension_scan(spark: SparkSession, sf: str) -> DataFrame:
    return fx.job(spark, sf)


def dimension_ids(spark: SparkSession, sf: str) -> DataFrame:
    return ev.ids_as_int(fx.job(spark, sf), "group_id")


# --- metrics -------------------------------------------------------------------------

def hourly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = enriched_metrics(fx.tracking(spark, sf), fx.dimension(spark, sf))
    return rows.withColumn("sources", F.lit(BATCH))


def hourly_metrics_dimension_keys(spark: SparkSession, sf: str) -> DataFrame:
    return enriched_metrics(
        fx.tracking(spark, sf), fx.dimension(spark, sf), key_source="dimension"
    )


def hourly_metrics_known_only(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_metrics(fx.tracking(spark, sf), known_only=True)


def hourly_metrics_filled(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_metrics(ev.fill_keys(fx.tracking(spark, sf)))


def job_hour_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.hourly_metrics(fx.tracking(spark, sf), keys=["job_id"])


def _by_kind(kind: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return metrics.kind_by_hour(fx.tracking(spark, sf), kind)

    return query


def metrics_full_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.tracking(spark, sf)
    return metrics.join_kinds(*[metrics.kind_by_hour(rows, kind) for kind in KINDS])


def metrics_full_join_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.tracking(spark, sf)
    by_kind = [metrics.kind_by_hour(rows, kind, fill=False) for kind in KINDS]
    return metrics.join_kinds(*by_kind, fill=True)


def metrics_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.to_fact_names(metrics.sparse_metrics(fx.tracking(spark, sf)))


def enriched_events(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["campaign_id", "group_id", "company_id"]
    return enrich.attach(fx.tracking(spark, sf), fx.dimension(spark, sf), *columns)


def unmatched_jobs(spark: SparkSession, sf: str) -> DataFrame:
    rows = metrics.hourly_metrics(ev.require(fx.tracking(spark, sf), "job_id"))
    return enrich.unmatched(rows, fx.dimension(spark, sf))


# --- functions -----------------------------------------------------------------------

def timeuuid_decode(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.events(spark, sf).select(
        "event_id", timestamp_to_timeuuid(F.col("ts")).alias("create_time")
    )
    return rows.withColumn("ts", timeuuid_to_text(F.col("create_time")))


def keyed_publish(spark: SparkSession, sf: str) -> DataFrame:
    return envelope.to_envelope(fx.tracking(spark, sf))


def json_envelope_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    messages = envelope.to_envelope(fx.tracking(spark, sf))
    return envelope.parse_envelope(messages.select(F.encode("value", "UTF-8").alias("value")))


def event_from_action(spark: SparkSession, sf: str) -> DataFrame:
    actions = fx.events(spark, sf).select(
        F.col("user_id").cast("int").alias("job_id"), F.col("event_type").alias("action"), "ts"
    )
    made = ev.from_action(actions, at=F.col("ts"))
    # Ids are random beyond their time: shown are what they decode to and that none repeats.
    ids = F.size(F.collect_set("create_time"))
    decoded = made.withColumn("decoded", timeuuid_to_text(F.col("create_time")))
    keys = [c for c in decoded.columns if c != "create_time"]
    return decoded.groupBy(*keys).agg(F.count("*").alias("n"), ids.alias("n_ids"))


# --- incremental ---------------------------------------------------------------------

def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.high_water_mark(fx.tracking(spark, sf)).select(
        F.date_format("mark", "yyyy-MM-dd HH:mm:ss").alias("mark")
    )


def new_data_gate(spark: SparkSession, sf: str) -> DataFrame:
    source = incremental.high_water_mark(fx.tracking(spark, sf))
    sink = incremental.high_water_mark(fx.tracking_before_split(spark, sf))
    return incremental.has_new_data(source, sink)


def _sink_mark(spark: SparkSession, sf: str):
    return incremental.high_water_mark(fx.tracking_before_split(spark, sf)).scalar()


def incremental_delta(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.newer_than(
        fx.tracking(spark, sf), _sink_mark(spark, sf), inclusive=False
    )


def incremental_recompute(spark: SparkSession, sf: str) -> DataFrame:
    dim = fx.dimension(spark, sf)
    stored = enriched_metrics(fx.tracking_before_split(spark, sf), dim)
    changed = incremental.touched_hours(
        fx.tracking(spark, sf), _sink_mark(spark, sf), lookback=LOOKBACK
    )
    rows = merge.to_fact(enriched_metrics(changed, dim), INCREMENTAL, fx.stamp(fx.BATCH_STAMP))
    return merge.replace(
        merge.to_fact(stored, INCREMENTAL, fx.stamp(fx.STREAM_STAMP)),
        _stored(spark, rows, "changed"),
    )


def data_time_stamp(spark: SparkSession, sf: str) -> DataFrame:
    rows, path = metrics.hourly_metrics(fx.tracking(spark, sf), latest=True), scratch(spark, "stamped")
    rows.write.parquet(path)
    return incremental.stamp_data_time(spark.read.schema(rows.schema).parquet(path))


# --- merges and whole jobs -----------------------------------------------------------

def merge_replace(spark: SparkSession, sf: str) -> DataFrame:
    dim = fx.dimension(spark, sf)
    stored = fx.lagging_fact(spark, sf, dim).withColumn("sources", F.lit(BATCH))
    return merge.replace(stored, _stored(spark, fx.batch_fact(spark, sf, dim), "rows"))


def merge_accumulate(spark: SparkSession, sf: str) -> DataFrame:
    dim = fx.dimension(spark, sf)
    since = fx.tracking(spark, sf).where(F.col("ts") >= F.lit(fx.SPLIT).cast("timestamp_ntz"))
    added = merge.to_fact(enriched_metrics(since, dim), STREAM, fx.stamp(fx.BATCH_STAMP))
    return merge.accumulate(fx.lagging_fact(spark, sf, dim), added)


def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One writer's rows appended after another's."""
    table = scratch(spark, "append")
    dim = fx.dimension(spark, sf)
    publish.append(fx.lagging_fact(spark, sf, dim), table)
    publish.append(fx.batch_fact(spark, sf, dim), table)
    return read_fact(spark, table)


def batch_job(spark: SparkSession, sf: str) -> DataFrame:
    """The log decoded from its time-UUIDs, aggregated, staged and published, then read."""
    table = scratch(spark, "batch")
    run_batch(
        fx.tracking(spark, sf), fx.job(spark, sf), table, updated_at=fx.stamp(fx.BATCH_STAMP)
    )
    return read_fact(spark, table)


def batch_late_job(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches keyed by the job's campaign: many jobs are known to the second one only, and
    the others have changed their campaign in between."""
    table = scratch(spark, "late-job")
    rows, job = fx.tracking(spark, sf), fx.job(spark, sf)
    early = job.where("id % 2 = 0").withColumn("campaign_id", F.lit("before"))
    for dim in (early, job):
        run_batch(rows, dim, table, key_source="dimension", updated_at=fx.stamp(fx.BATCH_STAMP))
    return read_fact(spark, table)


def batch_averages(spark: SparkSession, sf: str) -> DataFrame:
    """Spend and average bid as the stored table serves them."""
    table = scratch(spark, "averages")
    rows = fx.with_fine_bids(fx.tracking(spark, sf))
    run_batch(rows, fx.job(spark, sf), table, updated_at=fx.stamp(fx.BATCH_STAMP))
    return read_fact(spark, table, averages=True)


def _batch_of_text_times(spark: SparkSession, sf: str) -> str:
    table = scratch(spark, "text-times")
    rows, stamp = fx.with_text_times(fx.tracking(spark, sf)), fx.stamp(fx.BATCH_STAMP)
    run_batch(rows, fx.job(spark, sf), table, uuid_col=None, updated_at=stamp)
    return table


def batch_text_times(spark: SparkSession, sf: str) -> DataFrame:
    """A batch over a log with text times, some of them missing or unreadable."""
    return read_fact(spark, _batch_of_text_times(spark, sf))


def batch_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The events that this batch did not count, and why."""
    refused = segments.read_rejects(spark, _batch_of_text_times(spark, sf), BATCH)
    names = ("create_time", "job_id", "custom_track", "ts")
    fields = [F.get_json_object("event", f"$.{n}").alias(n) for n in names]
    return refused.select("reason", *fields, "n")


def batch_tombstones(spark: SparkSession, sf: str) -> DataFrame:
    """A second batch over a log that has lost every sixth hour and one publisher."""
    table = scratch(spark, "tombstones")
    rows, job = fx.tracking(spark, sf), fx.job(spark, sf)
    run_batch(rows, job, table)
    kept = rows.where("hour(ts) % 6 <> 0 AND publisher_id IS NOT NULL")
    run_batch(kept, job, table, updated_at=fx.stamp(fx.BATCH_STAMP))
    return read_fact(spark, table)


def fact_of_version(spark: SparkSession, sf: str) -> DataFrame:
    """What a reader sees that is bound to a version after the next one was published."""
    table = scratch(spark, "versions")
    job, stamp = fx.job(spark, sf), fx.stamp(fx.STREAM_STAMP)
    run_batch(fx.tracking_before_split(spark, sf), job, table, updated_at=stamp)
    bound = read_fact(spark, table)
    run_batch(fx.tracking(spark, sf), job, table, updated_at=stamp)
    return bound


def incremental_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs: one that sees events dated ahead and lacks late ones, one that adds the late
    ones only, behind the mark, and one that adds the rest."""
    table = scratch(spark, "late")
    job, now = fx.job(spark, sf), F.lit(fx.BATCH_STAMP).cast("timestamp")
    whole = fx.tracking(spark, sf).unionByName(fx.dated_ahead(fx.tracking(spark, sf)))
    seen = whole.where((F.col("ts") < fx.SPLIT) | (F.year("ts") > 2050))
    for log in (seen.where(~fx.is_late()), seen, whole):
        run_incremental(log, job, table, LOOKBACK, now=now)
    return read_fact(spark, table).drop("updated_at")


def incremental_job(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: up to the split, then what came after it."""
    table = scratch(spark, "incremental")
    job = fx.job(spark, sf)
    run_incremental(fx.tracking_before_split(spark, sf), job, table, LOOKBACK)
    run_incremental(fx.tracking(spark, sf), job, table, LOOKBACK)
    return read_fact(spark, table)


# --- streaming -----------------------------------------------------------------------

def _stream(spark: SparkSession, sf: str, start, name: str, **options) -> DataFrame:
    """Three micro-batches: each with events of all times, or with a watermark in order of time."""
    folder, rows = scratch(spark, name), fx.events(spark, sf)
    if "watermark" in options:
        messages = fx.epochs_in_order(spark, rows, f"{folder}/topic", fx.as_tracking)
    else:
        messages = fx.epochs(spark, rows, f"{folder}/topic", 3, fx.as_tracking)
    query = start(
        messages,
        fx.job(spark, sf),
        f"{folder}/events",
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
        updated_at=fx.stamp(fx.STREAM_STAMP),
        **options,
    )
    query.awaitTermination()
    return read_fact(spark, f"{folder}/events")


def stream_hourly_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, streaming.start_running_totals, "running")


def stream_dimension_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, streaming.start_running_totals, "dimension", key_source="dimension")


def stream_hourly_watermarked(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, streaming.start_running_totals, "bounded", watermark="2 hours")


def stream_delta_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _stream(spark, sf, streaming.start_deltas, "deltas")


def stream_deltas_fine_bids(spark: SparkSession, sf: str) -> DataFrame:
    """Bids of six decimals added over five micro-batches, and the average the table serves."""
    folder = scratch(spark, "fine")
    messages = fx.epochs(spark, fx.with_fine_bids(fx.tracking(spark, sf)), f"{folder}/topic")
    query = streaming.start_deltas(
        messages,
        fx.job(spark, sf),
        f"{folder}/events",
        f"{folder}/checkpoint",
        trigger={"availableNow": True},
        updated_at=fx.stamp(fx.STREAM_STAMP),
    )
    query.awaitTermination()
    return read_fact(spark, f"{folder}/events", averages=True)


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Three micro-batches with a watermark: the newest events, the oldest, and those between. All
    but the first come after their hours were closed."""
    folder, rows, ts = scratch(spark, "late"), fx.events(spark, sf), F.col("ts")
    parts = (ts >= fx.SPLIT, ts < fx.EARLY, (ts >= fx.EARLY) & (ts < fx.SPLIT))
    for part in parts:
        messages = fx.epochs(spark, rows.where(part), f"{folder}/topic", 1, fx.as_tracking)
    query = streaming.start_deltas(
        messages,
        fx.job(spark, sf),
        f"{folder}/events",
        f"{folder}/checkpoint",
        watermark="2 hours",
        trigger={"availableNow": True},
        updated_at=fx.stamp(fx.STREAM_STAMP),
    )
    query.awaitTermination()
    return read_fact(spark, f"{folder}/events")


def capture_since(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of a capture that began one minute before SPLIT, was stopped and started again."""
    folder, now = scratch(spark, "capture"), F.lit(fx.SPLIT).cast("timestamp")
    for _ in range(2):
        query = streaming.start_capture(
            fx.tracking_stream(spark, sf),
            "parquet",
            f"{folder}/checkpoint",
            now=now,
            trigger={"availableNow": True},
            path=f"{folder}/topic",
        )
        query.awaitTermination()
        now = now + F.expr("INTERVAL 1 DAY")
    return spark.read.schema("key string, value string").parquet(f"{folder}/topic")


def stream_epochs_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """Running totals over four micro-batches, keyed by a job table whose files are replaced after
    the second. The log is sent twice, so every total moves to the job's new campaign."""
    folder, job = scratch(spark, "epochs"), fx.job(spark, sf)
    early = job.where("job_id % 2 = 0").withColumn("campaign_id", F.lit("before"))

    def read_job(session: SparkSession) -> DataFrame:
        return session.read.schema(job.schema).parquet(f"{folder}/job")

    for dim in (early, job):
        dim.coalesce(1).write.mode("overwrite").parquet(f"{folder}/job")
        query = streaming.start_running_totals(
            fx.epochs(spark, fx.events(spark, sf), f"{folder}/topic", 2, fx.as_tracking),
            read_job,
            f"{folder}/events",
            f"{folder}/checkpoint",
            key_source="dimension",
            trigger={"availableNow": True},
            updated_at=fx.stamp(fx.STREAM_STAMP),
        )
        query.awaitTermination()
    return read_fact(spark, f"{folder}/events")


# --- serving -------------------------------------------------------------------------

def job_list(spark: SparkSession, sf: str) -> DataFrame:
    return serving.job_list(fx.batch_fact(spark, sf))


def job_totals(spark: SparkSession, sf: str) -> DataFrame:
    return serving.job_totals(fx.batch_fact(spark, sf))


def job_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return serving.lookup(fx.tracking(spark, sf), LOOKUP_JOB)


def conversion_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return serving.funnel(fx.batch_fact(spark, sf))


def grand_total(spark: SparkSession, sf: str) -> DataFrame:
    return serving.grand_total(fx.batch_fact(spark, sf))


def latest_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return serving.newest_first(fx.both_facts(spark, sf), STREAM)


def newest_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return serving.newest_per_source(fx.both_facts(spark, sf), NEWEST)


# --- reconciliation ------------------------------------------------------------------

def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.tracking(spark, sf)
    return reconcile.layer_counts(rows, envelope.to_envelope(rows), fx.batch_fact(spark, sf))


def recorded_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Events per layer as the sink of messages, the stream and the batch counted them."""
    folder, job = scratch(spark, "counts"), fx.job(spark, sf)
    log = fx.with_text_times(fx.tracking(spark, sf))
    typed = ev.sifted(log).drop("reason", "event")
    sent = streaming.publish_messages(envelope.to_envelope(typed), "parquet", path=f"{folder}/topic")
    messages = read_files(spark, f"{folder}/topic", "key string, value string")
    query = streaming.start_deltas(
        messages, job, f"{folder}/events", f"{folder}/checkpoint", trigger={"availableNow": True}
    )
    query.awaitTermination()
    run_batch(log, job, f"{folder}/events", uuid_col=None)
    return reconcile.recorded_counts(spark, sent, f"{folder}/events")


def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.drift(fx.both_facts(spark, sf))


def drift_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return reconcile.agreement(reconcile.drift(fx.both_facts(spark, sf)))


def corrected_view(spark: SparkSession, sf: str) -> DataFrame:
    """The stream has everything, the batch writer stopped at the split."""
    dim = fx.dimension(spark, sf)
    batch = fx.lagging_fact(spark, sf, dim).withColumn("sources", F.lit(BATCH))
    stream = fx.batch_fact(spark, sf, dim).withColumn("sources", F.lit(STREAM))
    return merge.corrected_view(merge.union_sources(batch, stream), PRECEDENCE)


QUERIES = {
    f.__name__: f
    for f in (
        hourly_metrics,
        hourly_metrics_dimension_keys,
        hourly_metrics_known_only,
        hourly_metrics_filled,
        job_hour_metrics,
        metrics_full_join,
        metrics_full_join_null_keys,
        metrics_one_pass,
        event_scan,
        dimension_scan,
        dimension_ids,
        enriched_events,
        unmatched_jobs,
        timeuuid_decode,
        keyed_publish,
        json_envelope_roundtrip,
        event_from_action,
        high_water_mark,
        new_data_gate,
        incremental_delta,
        incremental_recompute,
        data_time_stamp,
        merge_replace,
        merge_accumulate,
        append_rows,
        batch_job,
        batch_late_job,
        batch_averages,
        batch_text_times,
        batch_rejects,
        batch_tombstones,
        fact_of_version,
        incremental_job,
        incremental_late_events,
        stream_hourly_metrics,
        stream_dimension_keys,
        stream_hourly_watermarked,
        stream_delta_metrics,
        stream_deltas_fine_bids,
        job_list,
        job_totals,
        job_lookup,
        conversion_funnel,
        grand_total,
        latest_by_source,
        newest_per_source,
        capture_since,
        stream_late_rows,
        stream_epochs_dimension,
        recorded_counts,
        layer_counts,
        drift_report,
        drift_agreement,
        corrected_view,
    )
} | {
    "clicks_by_hour_sql": _by_kind("click"),
    "conversions_by_hour_sql": _by_kind("conversion"),
    "qualified_by_hour_sql": _by_kind("qualified"),
    "unqualified_by_hour_sql": _by_kind("unqualified"),
}
