import pytest
from pyspark.sql import functions as F

from builders import STAMP, event, events, fact, jobs, stored
from hirefunnel.operators import merge, reconcile, serving
from hirefunnel.plans import publish
from hirefunnel.plans.jobs import run_batch
from hirefunnel.schema import BATCH, FACT, PRECEDENCE, STREAM, check_sink_schema
from hirefunnel.sources.segments import segment_path
from hirefunnel.sources.tables import read_fact

LATER = "2024-03-02 00:00:00"


def clicks(df):
    return {(r.dates, r.hours, r.group_id): r.clicks for r in df.collect()}


def test_replace_matches_null_keys(spark):
    old = fact(events(spark, event(publisher_id=None)), STREAM)
    new = fact(events(spark, *[event(publisher_id=None)] * 3), STREAM, LATER)
    (row,) = merge.replace(old, new).collect()
    assert row.clicks == 3


def test_accumulate_matches_null_keys_and_keeps_owners_apart(spark):
    old = fact(events(spark, event(publisher_id=None, bid=0.1)), STREAM)
    new = fact(events(spark, event(publisher_id=None, bid=0.2)), STREAM, LATER)
    (row,) = merge.accumulate(old, new).collect()
    assert (row.clicks, row.spend_hour, str(row.updated_at)) == (2, 0.3, LATER)
    other = new.withColumn("company_id", F.lit("y"))
    assert merge.accumulate(old, other).count() == 2


def test_two_groups_of_one_business_key_survive(spark):
    new = fact(events(spark, event(group_id="a"), event(group_id="b")), BATCH)
    assert merge.replace(new, new).count() == 2


def test_replace_twice_is_replace_once(spark):
    old = fact(events(spark, event(), event("2024-01-01 12:00:00")), BATCH)
    new = fact(events(spark, event(), event()), BATCH, LATER)
    once = merge.replace(old, new)
    assert stored(merge.replace(once, new)) == stored(once)


def test_many_keys_in_small_files_are_not_sent_to_every_task(spark, folder, capsys):
    # Repeated values make these files far smaller than what a task would hold of them.
    one = fact(events(spark, event()), BATCH)
    many = spark.range(150_000).select(F.col("id").cast("int").alias("job_id"))
    many.crossJoin(one.drop("job_id")).select(*FACT.fieldNames()).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    old = fact(events(spark, event(job_id=7), event(job_id=-1), event(job_id=None)), BATCH)
    merged = merge.replace(old, rows)
    capsys.readouterr()
    merged.explain()
    assert "BroadcastHashJoin" not in capsys.readouterr().out
    assert merged.count() == 150_002
    few = merge.replace(rows, old)
    few.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out
    assert few.count() == 150_002


def test_to_fact_default_stamp_is_now(spark):
    rows = merge.to_fact(
        fact(events(spark, event()), BATCH).drop("updated_at", "sources"), BATCH
    )
    age = F.timestamp_diff("SECOND", F.col("updated_at"), F.current_timestamp())
    assert rows.select(age).first()[0] == 0
    assert [f.name for f in rows.schema] == FACT.fieldNames()


def test_sink_schema_is_checked_before_writing(spark, folder):
    rows = fact(events(spark, event()), BATCH)
    for bad in (
        rows.withColumn("bid_set", F.lit(1.0)),
        rows.drop("clicks"),
        rows.withColumn("hours", F.col("hours").cast("string")),
    ):
        with pytest.raises(ValueError, match="do not fit"):
            publish.upsert(bad, f"{folder}/t", BATCH, "1")
        with pytest.raises(ValueError, match="do not fit"):
            publish.append(bad, f"{folder}/t")
    assert read_fact(spark, f"{folder}/t").isEmpty()
    assert check_sink_schema(rows).columns == FACT.fieldNames()


# --- the stored table ----------------------------------------------------------------

def files_of(spark, folder):
    names = spark.read.parquet(folder).select(F.input_file_name().alias("f")).distinct()
    return {r.f for r in names.collect()}


def test_upsert_writes_its_own_dates_only(spark, folder):
    table = f"{folder}/t"
    publish.upsert(
        fact(events(spark, event("2024-01-01 10:00:00"), event("2024-01-02 10:00:00")), BATCH),
        table, BATCH, "1",
    )
    before = files_of(spark, segment_path(table, BATCH, 1))
    publish.upsert(
        fact(events(spark, event("2024-01-02 10:00:00"), event("2024-01-02 10:30:00")), BATCH, LATER),
        table, BATCH, "2",
    )
    assert files_of(spark, segment_path(table, BATCH, 1)) == before
    assert all("2024-01-02" in f for f in files_of(spark, segment_path(table, BATCH, 2)))
    assert clicks(read_fact(spark, table)) == {
        ("2024-01-01", 10, "g"): 1,
        ("2024-01-02", 10, "g"): 2,
    }


def test_writers_keep_to_their_own_partitions(spark, folder):
    table = f"{folder}/t"
    for source in (BATCH, STREAM):
        publish.upsert(fact(events(spark, event()), source), table, source, "1")
    assert {r.sources for r in read_fact(spark, table).collect()} == {BATCH, STREAM}


def test_rows_without_a_date_are_merged_too(spark, folder):
    table = f"{folder}/t"
    for run in ("1", "2"):
        publish.upsert(fact(events(spark, event(ts="bad")), STREAM), table, STREAM, run, "accumulate")
    assert clicks(read_fact(spark, table)) == {(None, None, "g"): 2}


def test_replayed_run_is_applied_once(spark, folder):
    table = f"{folder}/t"
    rows = fact(events(spark, event()), STREAM)
    for run in ("1", "2", "2", "2"):
        publish.upsert(rows, table, STREAM, run, "accumulate")
    assert clicks(read_fact(spark, table)) == {("2024-01-01", 10, "g"): 2}


def test_upsert_without_rows_changes_nothing(spark, folder):
    table = f"{folder}/t"
    rows = fact(events(spark, event()), BATCH)
    publish.upsert(rows, table, BATCH, "1")
    publish.upsert(rows.where("false"), table, BATCH, "2")
    assert read_fact(spark, table).count() == 1


def test_hot_date_gets_several_files(spark, folder):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2024-01-01"))
        .otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 20 + 2).cast("string"), 2, "0")))
        .alias("dates"),
        (F.col("id") % 24).cast("int").alias("hours"),
        F.col("id").cast("int").alias("job_id"),
        F.lit(1).alias("publisher_id"),
        F.md5(F.col("id").cast("string")).alias("campaign_id"),
        F.lit("g").alias("group_id"),
        F.lit("x").alias("company_id"),
        F.lit(1.0).alias("spend_hour"),
        *[F.lit(1).cast("long").alias(c) for c in FACT.fieldNames()[8:12]],
        F.lit(STAMP).cast("timestamp").alias("updated_at"),
        F.lit(BATCH).alias("sources"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
    try:
        publish.upsert(rows, f"{folder}/t", BATCH, "1")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = (
        spark.read.parquet(segment_path(f"{folder}/t", BATCH, 1))
        .select("dates", F.input_file_name().alias("f"))
        .distinct()
        .groupBy("dates")
        .agg(F.count("f").alias("n"))
    )
    n = {str(r.dates): r.n for r in files.collect()}
    assert n["2024-01-01"] > 1
    assert n["2024-01-01"] == max(n.values())
    assert sum(n.values()) < 8 * len(n)
    assert read_fact(spark, f"{folder}/t").count() == 200_000


def test_batch_job_twice(spark, folder):
    df = events(
        spark,
        event(create_time="1b21dd00-a8a1-11ee-8000-000000000000"),
        event(create_time="zzz"),
        event(),
    )
    dim = jobs(spark, (1, "x", "c", "g"))
    for _ in range(2):
        run_batch(df, dim, f"{folder}/t")
    (row,) = read_fact(spark, f"{folder}/t").collect()
    assert (row.clicks, row.company_id, row.sources) == (1, "x", BATCH)


# --- reconciliation ------------------------------------------------------------------

def test_both_sources(spark):
    stream = fact(events(spark, *[event()] * 4), STREAM)
    batch = fact(events(spark, *[event()] * 5), BATCH, LATER)
    both = merge.union_sources(stream, batch)
    (row,) = reconcile.drift(both).collect()
    assert (row.clicks_batch, row.clicks_stream, row.clicks_drift) == (5, 4, 1)
    assert reconcile.agreement(reconcile.drift(both)).first().agreement == 0.0
    (row,) = merge.corrected_view(both, PRECEDENCE).collect()
    assert (row.clicks, row.sources) == (5, BATCH)


def test_corrected_view_keeps_what_only_the_stream_has(spark):
    stream = fact(events(spark, event(), event("2024-01-01 11:00:00", publisher_id=None)), STREAM)
    batch = fact(events(spark, event()), BATCH)
    view = merge.corrected_view(merge.union_sources(stream, batch), PRECEDENCE)
    assert sorted((r.hours, r.sources) for r in view.collect()) == [(10, BATCH), (11, STREAM)]


def test_agreement_without_rows(spark):
    none = fact(events(spark, event()).where("false"), BATCH)
    row = reconcile.agreement(reconcile.drift(none)).first()
    assert (row.n_keys, row.agreement) == (0, None)


def test_newest_first(spark):
    rows = merge.union_sources(
        fact(events(spark, event()), BATCH),
        fact(events(spark, event("2024-01-01 11:00:00")), BATCH, LATER),
        fact(events(spark, event()), STREAM, LATER),
    )
    assert [r.hours for r in serving.newest_first(rows, BATCH).collect()] == [11, 10]
    assert [r.hours for r in serving.newest_first(rows, BATCH, 1).collect()] == [11]


def test_job_that_arrives_late_replaces_its_unmatched_rows(spark, folder):
    rows = events(spark, event(), event(publisher_id=None))
    for dim in (jobs(spark, (2, "x", "c", "g")), jobs(spark, (1, "x", "c", "g"))):
        run_batch(rows, dim, f"{folder}/t", key_source="dimension", uuid_col=None)
    got = sorted((r.clicks, r.campaign_id) for r in read_fact(spark, f"{folder}/t").collect())
    assert got == [(1, "c"), (1, "c")]


def test_newest_per_source_with_ties(spark):
    rows = merge.union_sources(
        *[
            fact(events(spark, *[event(f"2024-01-01 {h:02}:00:00", group_id=g) for h in range(4) for g in ("a", None)]), s)
            for s in (BATCH, STREAM)
        ]
    )
    got = serving.newest_per_source(rows, 3)
    want = [(3, None, 1), (3, "a", 2), (2, None, 3)]
    for source in (BATCH, STREAM):
        mine = got.where(F.col("sources") == source).orderBy("rank").collect()
        assert [(r.hours, r.group_id, r["rank"]) for r in mine] == want
        assert [r.hours for r in serving.newest_first(rows, source, 3).collect()] == [3, 3, 2]
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
