import pytest
from pyspark.sql import functions as F

from builders import event, events, jobs, stored
from hirefunnel import fixtures as fx
from hirefunnel.functions import envelope
from hirefunnel.operators import metrics
from hirefunnel.plans import publish
from hirefunnel.schema import STREAM
from hirefunnel.sources.streams import read_files
from hirefunnel.sources.tables import read_fact
from hirefunnel.streaming import jobs as streaming
from hirefunnel.workspace import STATE_STORE

SF = "/root/testdata/sf0.001"
NOW = {"availableNow": True}


class Topic:
    """A folder of message files; each `send` is one file and one micro-batch."""

    def __init__(self, spark, folder):
        self.spark, self.path = spark, f"{folder}/topic"

    def send(self, *rows):
        messages = envelope.to_envelope(events(self.spark, *rows))
        streaming.publish_messages(messages.coalesce(1), "parquet", path=self.path)

    def stream(self):
        schema = "key string, value string"
        return read_files(self.spark, self.path, schema, maxFilesPerTrigger="1")


@pytest.fixture
def topic(spark, folder):
    return Topic(spark, folder)


@pytest.fixture
def dim(spark):
    return jobs(spark, (1, "x", "jc", "jg"))


def run(start, topic, dim, folder, **options):
    query = start(
        topic.stream(), dim, f"{folder}/t", f"{folder}/checkpoint", trigger=NOW, **options
    )
    query.awaitTermination()
    return query


def counts(spark, folder):
    rows = read_fact(spark, f"{folder}/t").collect()
    return {(r.hours, r.publisher_id): r.clicks for r in rows}


FORMS = [streaming.start_running_totals, streaming.start_deltas]


@pytest.mark.parametrize("start", FORMS)
def test_totals_over_several_triggers(spark, topic, dim, folder, start):
    topic.send(*[event()] * 3)
    topic.send(*[event()] * 2, event("2024-01-01 11:00:00", publisher_id=None))
    run(start, topic, dim, folder)
    assert counts(spark, folder) == {(10, 1): 5, (11, None): 1}
    topic.send(event("2024-01-01 11:00:00", publisher_id=None), event("bad"))
    run(start, topic, dim, folder)
    assert counts(spark, folder) == {(10, 1): 5, (11, None): 2, (None, 1): 1}
    (company,) = {r.company_id for r in read_fact(spark, f"{folder}/t").collect()}
    assert company == "x"


@pytest.mark.parametrize("start", FORMS)
@pytest.mark.parametrize("step", ["before", "after"])
def test_epoch_is_applied_once_when_it_is_delivered_twice(
    spark, topic, dim, folder, start, step, monkeypatch
):
    topic.send(event())
    run(start, topic, dim, folder)
    topic.send(*[event()] * 2)
    publish_once = publish._publish

    def lost(*args):
        if step == "after":
            publish_once(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(publish, "_publish", lost)
        with pytest.raises(Exception, match="driver lost"):
            run(start, topic, dim, folder)
    topic.send(*[event()] * 4)
    run(start, topic, dim, folder)
    assert counts(spark, folder) == {(10, 1): 7}


def test_dimension_keys(spark, topic, dim, folder):
    topic.send(event(), event(group_id="other"))
    run(streaming.start_running_totals, topic, dim, folder, key_source="dimension")
    (row,) = read_fact(spark, f"{folder}/t").collect()
    assert (row.clicks, row.campaign_id, row.group_id) == (2, "jc", "jg")


def test_watermark_leaves_late_hours_to_the_batch(spark, topic, dim, folder):
    topic.send(event("2024-01-01 08:10:00"))
    topic.send(event("2024-01-01 12:00:00"))
    topic.send(event("2024-01-01 12:00:01"))
    topic.send(event("2024-01-01 08:20:00"), event("2024-01-01 12:00:02"))
    query = run(streaming.start_running_totals, topic, dim, folder, watermark="1 hour")
    assert counts(spark, folder) == {(8, 1): 1, (12, 1): 3}
    dropped = sum(
        s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]
    )
    assert dropped == 1


def test_without_watermark_late_hours_count(spark, topic, dim, folder):
    topic.send(event("2024-01-01 08:10:00"))
    topic.send(event("2024-01-01 12:00:00"))
    topic.send(event("2024-01-01 08:20:00"))
    query = run(streaming.start_running_totals, topic, dim, folder)
    assert counts(spark, folder) == {(8, 1): 2, (12, 1): 1}
    state = query.recentProgress[0]["stateOperators"][0]
    assert any("rocksdb" in name for name in state["customMetrics"])
    assert "RocksDB" not in spark.conf.get(STATE_STORE)


def test_failure_in_the_sink_stops_the_query(spark, topic, dim, folder):
    topic.send(event())
    twice = dim.union(dim)
    with pytest.raises(Exception, match="not unique"):
        run(streaming.start_running_totals, topic, twice, folder)
    assert read_fact(spark, f"{folder}/t").isEmpty()


def test_messages_are_parsed_once(spark, topic):
    topic.send(event())
    events_ = envelope.parse_envelope(spark.read.parquet(topic.path))
    plan = metrics.hourly_metrics(events_)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_named_query(spark, topic, dim, folder):
    topic.send(event())
    query = run(streaming.start_deltas, topic, dim, folder, name="funnel")
    assert query.name == "funnel"


def test_capture_publishes_each_row_once(spark, folder):
    log, out = f"{folder}/log", f"{folder}/out"
    schema = fx.tracking(spark, SF).schema

    def capture():
        messages = envelope.to_envelope(read_files(spark, log, schema))
        streaming.publish_messages(messages, "json", f"{folder}/ck", path=out).processAllAvailable()
        for query in spark.streams.active:
            query.stop()

    fx.tracking(spark, SF).write.parquet(log)
    capture()
    fx.tracking(spark, SF).limit(10).write.mode("append").parquet(log)
    capture()
    sent = spark.read.schema("key string, value string").json(out)
    assert sent.count() == fx.tracking(spark, SF).count() + 10
    assert sent.where(F.col("key") != F.get_json_object("value", "$.job_id")).isEmpty()


@pytest.mark.parametrize("start", FORMS)
def test_stream_equals_batch(spark, folder, start):
    log = fx.tracking(spark, SF)
    streaming.publish_messages(
        envelope.to_envelope(log).repartition(3), "parquet", path=f"{folder}/topic"
    )
    run(start, Topic(spark, folder), fx.job(spark, SF), folder)
    whole = fx.batch_fact(spark, SF).withColumn("sources", F.lit(STREAM))
    assert stored(read_fact(spark, f"{folder}/t")) == stored(whole)


def test_job_that_changes_leaves_no_total_behind(spark, topic, folder):
    topic.send(event(), event())
    run(streaming.start_running_totals, topic, jobs(spark, (1, "x", "old", "g")), folder, key_source="dimension")
    topic.send(event())
    run(streaming.start_running_totals, topic, jobs(spark, (1, "x", "new", "g")), folder, key_source="dimension")
    (row,) = read_fact(spark, f"{folder}/t").collect()
    assert (row.clicks, row.campaign_id) == (3, "new")


def _restart(start, topic, dim, folder):
    query = start(topic.stream(), dim, f"{folder}/t", f"{folder}/checkpoint2", trigger=NOW)
    query.awaitTermination()


def test_running_totals_after_a_lost_checkpoint(spark, topic, dim, folder):
    topic.send(event())
    run(streaming.start_running_totals, topic, dim, folder)
    topic.send(event(), event(ts="2024-01-01 15:00:00"))
    _restart(streaming.start_running_totals, topic, dim, folder)
    assert counts(spark, folder) == {(10, 1): 2, (15, 1): 1}


def test_deltas_refuse_a_second_checkpoint(spark, topic, dim, folder):
    topic.send(event())
    run(streaming.start_deltas, topic, dim, folder)
    with pytest.raises(Exception, match="totals of another query"):
        _restart(streaming.start_deltas, topic, dim, folder)
    assert counts(spark, folder) == {(10, 1): 1}


# --- dimension, capture, counts ------------------------------------------------------

def test_dimension_is_proven_anew_only_when_its_files_change(spark, folder, monkeypatch):
    from hirefunnel.streaming.dimension import Dimension, enrich

    proofs = []
    prove = enrich.proven_bytes
    monkeypatch.setattr(enrich, "proven_bytes", lambda *a, **k: proofs.append(1) or prove(*a, **k))
    path = f"{folder}/job"
    jobs(spark, (1, "x", "c", "g")).write.parquet(path)
    schema = "job_id int, company_id string, campaign_id string, group_id string"
    dim = Dimension(lambda s: s.read.schema(schema).parquet(path))
    assert [dim.current(spark).collect() for _ in range(3)] and len(proofs) == 1
    plan = dim.current(spark)._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan
    jobs(spark, (1, "y", "c", "g"), (2, "y", "c", "g")).write.mode("overwrite").parquet(path)
    assert {r.company_id for r in dim.current(spark).collect()} == {"y"}
    assert len(dim.current(spark).collect()) == 2 and len(proofs) == 2
    jobs(spark, (2, "z", "c", "g")).write.mode("append").parquet(path)
    with pytest.raises(ValueError, match="not unique"):
        dim.current(spark)
    # Rows at hand have no files that could tell, so they are proven each time.
    plain = Dimension(jobs(spark, (1, "x", "c", "g")))
    plain.current(spark), plain.current(spark)
    assert len(proofs) == 5


def test_job_that_changes_between_epochs(spark, topic, folder):
    path = f"{folder}/job"
    schema = "job_id int, company_id string, campaign_id string, group_id string"
    read = lambda s: s.read.schema(schema).parquet(path)
    for company in ("x", "y"):
        jobs(spark, (1, company, "c", "g")).write.mode("overwrite").parquet(path)
        topic.send(event(), event("2024-01-01 11:00:00" if company == "y" else "2024-01-01 12:00:00"))
        run(streaming.start_running_totals, topic, read, folder)
    rows = {(r.hours, r.company_id): r.clicks for r in read_fact(spark, f"{folder}/t").collect()}
    assert rows == {(10, "y"): 2, (11, "y"): 1, (12, "x"): 1}


def test_capture_begins_where_it_first_began(spark, folder):
    log = f"{folder}/log"
    schema = events(spark, event()).schema

    def capture(now):
        query = streaming.start_capture(
            read_files(spark, log, schema), "json", f"{folder}/ck",
            now=F.lit(now).cast("timestamp"), trigger=NOW, path=f"{folder}/out",
        )
        query.awaitTermination()
        rows = spark.read.schema("key string, value string").json(f"{folder}/out")
        return sorted(r[0] for r in rows.select(F.get_json_object("value", "$.ts")).collect())

    rows = [event(t) for t in ("2024-01-01 09:58:59", "2024-01-01 09:59:00", "2024-01-01 10:30:00", "bad")]
    events(spark, *rows).coalesce(1).write.parquet(log)
    first = capture("2024-01-01 10:00:00")
    assert [t[11:19] for t in first] == ["09:59:00", "10:30:00"]
    events(spark, event("2024-01-01 09:00:00"), event("2024-01-01 09:59:30")).coalesce(1).write.mode("append").parquet(log)
    assert [t[11:19] for t in capture("2024-01-02 00:00:00")] == ["09:59:00", "09:59:30", "10:30:00"]


def test_a_lost_message_shows_in_the_counts(spark, folder, dim):
    from hirefunnel.operators import reconcile
    from hirefunnel.plans.jobs import run_batch

    log = events(spark, event(), event(kind="view"), event("bad"), event("2024-01-01 11:00:00"))
    sent = streaming.publish_messages(envelope.to_envelope(log).coalesce(1), "parquet", path=f"{folder}/topic")
    assert sent == 4 and streaming.publish_messages(envelope.to_envelope(log.limit(0)), "parquet", path=f"{folder}/none") == 0
    kept = spark.read.schema("key string, value string").parquet(f"{folder}/topic").limit(3)
    kept.write.parquet(f"{folder}/arrived")
    stream = read_files(spark, f"{folder}/arrived", "key string, value string")
    streaming.start_deltas(stream, dim, f"{folder}/t", f"{folder}/ck", trigger=NOW).awaitTermination()
    run_batch(log, dim, f"{folder}/t", uuid_col=None)
    counted = {r.layer: r.n for r in reconcile.recorded_counts(spark, sent, f"{folder}/t").collect()}
    assert counted == {"broker": 4, "stream": 3, "warehouse": 3, "quarantine": 1}


def test_late_rows_are_put_aside_and_none_is_lost(spark, topic, dim, folder):
    from hirefunnel.operators import merge
    from hirefunnel.schema import LATE
    from hirefunnel.sources import segments

    batches = [
        [event("2024-01-01 08:10:00"), event("2024-01-01 12:30:00"), event("bad")],
        [event("2024-01-01 10:59:59"), event("2024-01-01 11:00:00"), event("2024-01-01 13:00:00")],
        [event("2024-01-01 11:30:00"), event("2024-01-01 12:00:00"), event("2024-01-01 08:20:00"), event("bad")],
    ]
    for rows in batches:
        topic.send(*rows)
    run(streaming.start_deltas, topic, dim, folder, watermark="1 hour")
    state, late = (segments.read_state(spark, f"{folder}/t", w) for w in (STREAM, LATE))
    # Hours up to 10 are closed after the first trigger, hour 11 after the second.
    assert {r.hours: r.clicks for r in state.collect()} == {8: 1, 11: 1, 12: 2, 13: 1, None: 2}
    assert {r.hours: r.clicks for r in late.collect()} == {8: 1, 10: 1, 11: 1}
    both = merge.served(merge.with_late(state, late, STREAM))
    log = [row for rows in batches for row in rows]
    want = fx.enriched_metrics(events(spark, *log), dim, exact=True)
    want = merge.served(merge.to_state(want, STREAM))
    assert stored(both) == stored(want)


@pytest.mark.parametrize("lost_at", [0, 1])
def test_epoch_with_late_rows_lost_between_its_writers(spark, topic, dim, folder, monkeypatch, lost_at):
    from hirefunnel.schema import LATE
    from hirefunnel.sources import segments

    topic.send(event("2024-01-01 12:30:00"))
    run(streaming.start_deltas, topic, dim, folder, watermark="1 hour")
    topic.send(event("2024-01-01 08:00:00"), event("2024-01-01 12:40:00"))
    real, calls = publish._publish, []

    def lost(*args):
        calls.append(args)
        if len(calls) > lost_at:
            raise RuntimeError("driver lost")
        real(*args)

    with monkeypatch.context() as m:
        m.setattr(publish, "_publish", lost)
        with pytest.raises(Exception, match="driver lost"):
            run(streaming.start_deltas, topic, dim, folder, watermark="1 hour")
    run(streaming.start_deltas, topic, dim, folder, watermark="1 hour")
    found = {w: {r.hours: r.clicks for r in segments.read_state(spark, f"{folder}/t", w).collect()} for w in (STREAM, LATE)}
    assert found == {STREAM: {12: 2}, LATE: {8: 1}}


def _log(spark, folder, n=4000):
    """A stored log over ten days, and what it holds."""
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * (864_000 // n))
    rows = spark.range(n).select(at.alias("ts"), (F.col("id") % 7).cast("int").alias("job_id"))
    rows = rows.withColumns({"custom_track": F.lit("click"), "bid": F.lit(1.0), "publisher_id": F.lit(1)})
    fields = (F.lit(None).cast("string").alias(c) for c in ("create_time", "campaign_id", "group_id"))
    rows.select("*", *fields).write.parquet(f"{folder}/log")
    return spark.read.parquet(f"{folder}/log")


def _micro_batches(spark, messages, folder):
    """Messages, files that held them, first and last time of each micro-batch."""
    seen = []

    def sink(batch, epoch):
        rows = batch.select(F.get_json_object("value", "$.ts").alias("ts"), F.input_file_name().alias("f"))
        seen.append(tuple(rows.agg(F.count("*"), F.count_distinct("f"), F.min("ts"), F.max("ts")).first()))

    query = messages.writeStream.foreachBatch(sink).trigger(**NOW)
    query.option("checkpointLocation", f"{folder}/seen").start().awaitTermination()
    return seen


def test_a_larger_log_is_sent_in_more_files_and_as_many_micro_batches(spark, folder, monkeypatch):
    log = _log(spark, folder)
    monkeypatch.setattr(fx, "FILE_BYTES", 4000, raising=False)
    for _ in range(2):
        messages = fx.epochs(spark, log, f"{folder}/topic", 2)
    seen = _micro_batches(spark, messages, folder)
    assert len(seen) == 4
    assert sum(n for n, *_ in seen) == 8000
    assert all(files > 1 for _, files, *_ in seen)


@pytest.mark.parametrize("early", [fx.EARLY, "2024-01-01 00:00:01"])
def test_a_larger_log_stays_in_order(spark, folder, monkeypatch, early):
    log = _log(spark, folder)
    monkeypatch.setattr(fx, "FILE_BYTES", 4000, raising=False)
    monkeypatch.setattr(fx, "EARLY", early)
    messages = fx.epochs_in_order(spark, log, f"{folder}/topic")
    first, second, third = _micro_batches(spark, messages, folder)
    # All of the log is before SPLIT; the first part may have a single message.
    assert first[0] + second[0] == 4000 and third[0] == 0
    assert first[3] < early <= second[2]
    assert second[1] > 1


def test_messages_are_made_in_as_many_tasks_as_write_them(spark, folder, monkeypatch):
    log = _log(spark, folder).coalesce(1)
    size = sum(length for _, length, _ in fx.files.fingerprint(spark, log.inputFiles()))
    monkeypatch.setattr(fx, "FILE_BYTES", size // 4, raising=False)
    tasks = []

    def shape(rows):
        tasks.append(rows.select("ts").rdd.getNumPartitions())
        return rows

    fx.epochs_in_order(spark, log, f"{folder}/topic", shape)
    assert len(tasks) == 3 and min(tasks) >= 4
    assert spark.read.schema(fx.MESSAGES).parquet(f"{folder}/topic").count() == 4000


def test_a_trigger_saves_the_changes_of_the_state_only(spark, topic, dim, folder):
    from hirefunnel.sources import files

    for at in ("10:00:00", "10:30:00", "11:00:00"):
        topic.send(event(f"2024-01-01 {at}"))
        query = run(streaming.start_running_totals, topic, dim, folder)
        state = query.recentProgress[0]["stateOperators"][0]
        assert state["customMetrics"]["rocksdbGetCount"] == state["numRowsUpdated"] == 1
    assert sum(r.clicks for r in read_fact(spark, f"{folder}/t").collect()) == 3
    saved = [
        name
        for part in range(state["numStateStoreInstances"])
        for name in files.names(spark, f"{folder}/checkpoint/state/0/{part}")
    ]
    assert any(name.endswith(".changelog") for name in saved)


def test_state_partitions_leave_no_file_each_in_every_date(spark, folder):
    log = _log(spark, folder)
    query = streaming.start_running_totals(
        fx.epochs(spark, log, f"{folder}/topic", 1),
        jobs(spark, (1, "x", "jc", "jg")),
        f"{folder}/t",
        f"{folder}/checkpoint",
        trigger=NOW,
    )
    query.awaitTermination()
    rows = read_fact(spark, f"{folder}/t")
    assert rows.agg(F.sum("clicks")).first()[0] == 4000
    assert len(rows.inputFiles()) == 10
