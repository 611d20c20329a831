"""The stored table: versions, lost runs, tiers, exact amounts, the arrival gate."""

import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from builders import STAMP, event, events, fact, jobs
from hirefunnel.functions import envelope
from hirefunnel.operators import merge
from hirefunnel.operators.metrics import hourly_metrics
from hirefunnel.plans import publish
from hirefunnel.plans.jobs import run_batch, run_incremental
from hirefunnel.schema import BATCH, INCREMENTAL, STREAM
from hirefunnel.sources import files, segments
from hirefunnel.sources.streams import read_files
from hirefunnel.sources.tables import read_fact
from hirefunnel.streaming import jobs as streaming

NOON = "2024-01-01 12:00:00"


def state(df, source=BATCH, company="x"):
    exact = hourly_metrics(df, exact=True).withColumn("company_id", F.lit(company))
    return merge.to_state(exact, source, F.lit(STAMP).cast("timestamp"))


def clicks(df):
    return {(r.dates, r.hours): r.clicks for r in df.collect()}


def size(folder):
    return sum(
        os.path.getsize(f"{at}/{name}")
        for at, _, names in os.walk(folder)
        for name in names
        if name.endswith(".parquet")
    )


# --- versions ------------------------------------------------------------------------

def test_reader_keeps_the_state_it_was_bound_to(spark, folder):
    table = f"{folder}/t"
    for hour in range(6):
        publish.upsert(state(events(spark, *[event(f"2024-01-01 0{hour}:00:00")] * (hour + 1))),
                       table, BATCH, str(hour), "rewrite")
        if hour == 2:
            bound = read_fact(spark, table)
    assert clicks(bound) == {("2024-01-01", 2): 3}
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 5): 6}
    assert clicks(merge.served(segments.read_state(spark, table, BATCH, 4))) == {("2024-01-01", 3): 4}


STEPS = ["_write_segment", "_publish", "_merge_tier", "_remove_old"]


@pytest.mark.parametrize("how", ["accumulate", "replace", "rewrite"])
@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("done", [False, True])
def test_run_lost_at_any_step_has_happened_or_not(spark, folder, monkeypatch, step, how, done):
    table = f"{folder}/t"
    rows = state(events(spark, event()), STREAM)
    publish.upsert(rows, table, STREAM, "1", how)
    real = getattr(publish, step)

    def lost(*args):
        if done:
            real(*args)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(publish, step, lost)
        with pytest.raises(RuntimeError):
            publish.upsert(rows, table, STREAM, "2", how)
    happened = STEPS.index(step) > 1 or (step == "_publish" and done)
    total = 2 if how == "accumulate" else 1
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 10): total if happened else 1}
    assert publish.last_run(spark, table, STREAM) == ("2" if happened else "1")
    assert publish.upsert(rows, table, STREAM, "2", how) is not happened
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 10): total}


def test_version_is_never_written_over(spark, folder):
    files.write_new(spark, f"{folder}/v/1.json", "one")
    with pytest.raises(FileExistsError):
        files.write_new(spark, f"{folder}/v/1.json", "two")
    assert files.read(spark, f"{folder}/v/1.json") == "one"
    assert [n for n in files.names(spark, f"{folder}/v") if not n.endswith(".crc")] == ["1.json"]
    assert files.names(spark, f"{folder}/absent") == []


def test_small_run_writes_little_however_much_is_stored(spark, folder):
    table = f"{folder}/t"
    many = [event(f"2024-01-01 {h:02}:00:00", job_id=j, campaign_id=f"c{j * h}") for h in range(24) for j in range(60)]
    publish.upsert(state(events(spark, *many), STREAM), table, STREAM, "0", "accumulate")
    first = size(segments.segment_path(table, STREAM, 1))
    sizes = []
    for run in range(1, 5):
        publish.upsert(state(events(spark, event()), STREAM), table, STREAM, str(run), "accumulate")
        sizes.append(size(segments.segment_path(table, STREAM, run + 1)))
    assert max(sizes) == min(sizes) < first
    assert read_fact(spark, table).agg(F.sum("clicks")).first()[0] == len(many) + 4


@pytest.mark.parametrize("how", ["accumulate", "replace"])
def test_tiers_keep_segments_few_and_rows_right(spark, folder, monkeypatch, how):
    monkeypatch.setattr(publish, "TIER", 3)
    monkeypatch.setattr(publish, "KEPT_VERSIONS", 2)
    table, want = f"{folder}/t", {}
    for run in range(14):
        hour = run % 4
        publish.upsert(
            state(events(spark, *[event(f"2024-01-01 0{hour}:00:00")] * (run + 1)), STREAM),
            table, STREAM, str(run), how,
        )
        key = ("2024-01-01", hour)
        want[key] = run + 1 + (want.get(key, 0) if how == "accumulate" else 0)
    assert clicks(read_fact(spark, table)) == want
    last = segments.version(spark, table, STREAM)
    assert len(last.segments) <= 6 and max(s.level for s in last.segments) == 2
    assert len(segments.version_numbers(spark, table, STREAM)) == 2
    assert len(files.names(spark, f"{table}/_segments/writer={STREAM}")) <= 9
    publish.compact(spark, table, STREAM)
    assert clicks(read_fact(spark, table)) == want
    assert publish.last_run(spark, table, STREAM) == "13"
    publish.upsert(state(events(spark, event("2024-01-01 09:00:00")), STREAM), table, STREAM, "14", how)
    assert clicks(read_fact(spark, table)) == want | {("2024-01-01", 9): 1}


def test_segments_of_every_kind_follow_each_other(spark, folder):
    table = f"{folder}/t"

    def put(run, how, *rows, **more):
        publish.upsert(state(events(spark, *rows)), table, BATCH, run, how, **more)

    put("1", "rewrite", event("2024-01-01 08:00:00"), event("2024-01-01 10:00:00"), event("2024-01-02 01:00:00"))
    put("2", "accumulate", event("2024-01-01 08:30:00"))
    put("3", "hours", event("2024-01-01 11:00:00"), since="2024-01-01 10")
    put("4", "hours", *[event("2024-01-01 12:00:00")] * 2, since="2024-01-01 12")
    put("5", "replace", *[event("2024-01-01 11:00:00")] * 5)
    assert clicks(read_fact(spark, table)) == {
        ("2024-01-01", 8): 2, ("2024-01-01", 11): 5, ("2024-01-01", 12): 2,
    }
    put("6", "hours", since="2024-01-01 12")
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 8): 2, ("2024-01-01", 11): 5}
    rows = {r.run_id: r for r in segments.history(spark, table).collect()}
    assert rows["6"].stored_rows == 7 and all(r.seconds > 0 and r.finished for r in rows.values())


def test_appended_rows_stand_beside_published_ones(spark, folder):
    table = f"{folder}/t"
    publish.append(fact(events(spark, event()), BATCH), table)
    publish.upsert(state(events(spark, event()), STREAM), table, STREAM, "1")
    assert sorted(r.sources for r in read_fact(spark, table).collect()) == [BATCH, STREAM]


def test_dates_prune_partitions(spark, folder):
    table = f"{folder}/t"
    publish.upsert(state(events(spark, event(), event("2024-01-02 10:00:00"))), table, BATCH, "1", "rewrite")
    plan = read_fact(spark, table).where("dates = '2024-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dates" in plan


# --- tombstones ----------------------------------------------------------------------

def test_batch_removes_what_the_log_has_lost(spark, folder):
    dim = jobs(spark, (1, "x", "c", "g"))
    rows = [event(), event("2024-01-01 11:00:00"), event("2024-01-02 10:00:00"), event(publisher_id=7)]
    for log in (rows, rows[:1], []):
        run_batch(events(spark, *log), dim, f"{folder}/t", uuid_col=None)
        kept = events(spark, *log)
        run_batch(kept, dim, f"{folder}/fresh{len(log)}", uuid_col=None)
        got, want = read_fact(spark, f"{folder}/t"), read_fact(spark, f"{folder}/fresh{len(log)}")
        assert got.drop("updated_at").exceptAll(want.drop("updated_at")).isEmpty()
        assert got.count() == want.count()


# --- exact amounts -------------------------------------------------------------------

def test_fine_bids_over_many_epochs_equal_the_batch(spark, folder):
    pick = random.Random(2)
    dim = jobs(spark, (1, "x", "c", "g"))
    bids = [round(pick.uniform(0, 0.02), pick.randrange(3, 8)) for _ in range(60)]
    log = [event(f"2024-01-01 1{k % 3}:00:00", bid=b) for k, b in enumerate(bids)] + [event(bid=1e15)]
    for k in range(0, len(log), 12):
        messages = envelope.to_envelope(events(spark, *log[k : k + 12]))
        streaming.publish_messages(messages.coalesce(1), "parquet", path=f"{folder}/topic")
    stream = read_files(spark, f"{folder}/topic", "key string, value string", maxFilesPerTrigger="1")
    streaming.start_deltas(
        stream, dim, f"{folder}/t", f"{folder}/ck", trigger={"availableNow": True}
    ).awaitTermination()
    run_batch(events(spark, *log), dim, f"{folder}/b", uuid_col=None)
    got, want = (
        sorted(tuple(r) for r in read_fact(spark, t, averages=True).drop("updated_at", "sources").collect())
        for t in (f"{folder}/t", f"{folder}/b")
    )
    assert got == want
    shown = {r.hours: r for r in read_fact(spark, f"{folder}/t", averages=True).collect()}
    for hour, row in shown.items():
        mine = [Decimal(repr(b)) for k, b in enumerate(bids) if 10 + k % 3 == hour]
        assert abs(Decimal(repr(row.spend_hour)) - sum(mine)) <= Decimal("0.005")
        assert row.unusable_bids == (hour == 10)


# --- the gate ------------------------------------------------------------------------

def incremental(spark, table, *rows, **options):
    dim = jobs(spark, (1, "x", "c", "g"))
    return run_incremental(events(spark, *rows), dim, table, now=F.lit(NOON).cast("timestamp"), **options)


def test_future_boundary_and_late_events_are_counted(spark, folder):
    table = f"{folder}/t"
    log = [event("2024-01-01 10:00:00"), event("2099-01-01 00:00:00")]
    assert incremental(spark, table, *log)
    assert segments.version(spark, table, INCREMENTAL).mark == "2024-01-01 10:00:00"
    assert not incremental(spark, table, *log)
    for late in ("2024-01-01 10:00:00", "2024-01-01 09:30:00", "2024-01-01 11:00:00", "2099-01-01 00:30:00"):
        log.append(event(late))
        assert incremental(spark, table, *log), late
        assert not incremental(spark, table, *log)
    assert clicks(read_fact(spark, table)) == {
        ("2024-01-01", 9): 1, ("2024-01-01", 10): 2, ("2024-01-01", 11): 1, ("2099-01-01", 0): 2,
    }


def test_events_of_unknown_kinds_and_without_a_time(spark, folder):
    table = f"{folder}/t"
    log = [event("2024-01-01 10:00:00", kind="view"), event("bad")]
    assert incremental(spark, table, *log)
    assert not incremental(spark, table, *log)
    assert incremental(spark, table, *log, event("2024-01-01 10:10:00", kind="view"))


def test_only_future_events(spark, folder):
    table = f"{folder}/t"
    assert incremental(spark, table, event("2099-01-01 00:00:00"))
    assert incremental(spark, table, event("2099-01-01 00:00:00"), event("2024-01-01 10:00:00"))
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 10): 1, ("2099-01-01", 0): 1}


def test_mark_is_not_read_from_the_fact(spark, folder, monkeypatch):
    table = f"{folder}/t"
    log = [event("2023-12-01 10:00:00"), event("2024-01-01 10:00:00")]
    incremental(spark, table, *log)
    read = []
    resolved = segments.resolved

    def watched(*args):
        rows = resolved(*args)
        read.append(rows)
        return rows

    monkeypatch.setattr(segments, "resolved", watched)
    assert not incremental(spark, table, *log, lookback="2 hours")
    plan = read[0].where(segments.from_hour("2024-01-01 08"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "dates" in plan[plan.index("PartitionFilters") :][:200]


# --- events that are not counted -----------------------------------------------------

def test_unreadable_text_time_goes_to_the_quarantine(spark, folder):
    table, dim = f"{folder}/t", jobs(spark, (1, "x", "c", "g"))
    log = events(spark, event(), event("2024-01-01 11:00:00"), event(job_id=5), event(job_id=5), event(job_id=6))
    bad = F.when(F.col("job_id") == 5, "not a time").when(F.col("job_id") == 6, F.lit(None))
    log = log.withColumn("ts", bad.otherwise(F.col("ts").cast("string")))
    run_batch(log, dim, table, uuid_col=None, key_source="dimension")
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 10): 1, ("2024-01-01", 11): 1}
    refused = segments.read_rejects(spark, table, BATCH)
    shown = refused.select("reason", F.get_json_object("event", "$.ts"), F.get_json_object("event", "$.job_id"), "n")
    assert sorted(map(tuple, shown.collect())) == [("no time", None, "6", 1), ("unreadable time", "not a time", "5", 2)]
    # The next run's rejects take their place, a version keeps its own.
    run_batch(events(spark, event()), dim, table, uuid_col=None)
    assert segments.read_rejects(spark, table, BATCH).isEmpty()
    assert segments.read_rejects(spark, table, BATCH, 1).count() == 2
    assert segments.read_rejects(spark, table, STREAM).isEmpty()


def test_malformed_time_uuid_goes_to_the_quarantine(spark, folder):
    good = "1b21dd00-a8a1-11ee-8000-000000000000"
    log = events(spark, event(create_time=good), event(create_time="zzz"), event())
    run_batch(log, jobs(spark, (1, "x", "c", "g")), f"{folder}/t")
    assert read_fact(spark, f"{folder}/t").agg(F.sum("clicks")).first()[0] == 1
    reasons = {r.reason: r.n for r in segments.read_rejects(spark, f"{folder}/t", BATCH).collect()}
    assert reasons == {"no time": 1, "unreadable time": 1}


def test_metrics_and_rejects_come_from_one_scan(spark, folder, monkeypatch):
    from hirefunnel.plans import jobs as plans

    kept = []
    to_state = merge.to_state
    monkeypatch.setattr(plans, "to_state", lambda rows, *a: kept.append(rows) or to_state(rows, *a))
    events(spark, event(), event("x")).write.parquet(f"{folder}/log")
    run_batch(spark.read.parquet(f"{folder}/log"), jobs(spark, (1, "x", "c", "g")), f"{folder}/t", uuid_col=None)
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") <= 1


def test_hourly_metrics_of_text_times(spark):
    log = events(spark, event(), event(), event("2024-01-01 11:00:00")).withColumn("ts", F.col("ts").cast("string"))
    log = log.withColumn("ts", F.when(F.col("ts") < "2024-01-01 11", F.col("ts")).otherwise("soon"))
    assert clicks(hourly_metrics(log)) == {("2024-01-01", 10): 2, (None, None): 1}
