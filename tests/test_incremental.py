import json

from pyspark.sql import functions as F

from builders import event, events, fact, jobs, stored
from hirefunnel import fixtures as fx
from hirefunnel.operators import incremental, metrics
from hirefunnel.plans.jobs import run_incremental
from hirefunnel.schema import EMPTY_MARK, FACT, INCREMENTAL, JOB
from hirefunnel.sources import tables

SF = "/root/testdata/sf0.001"


def run(spark, df, table, **options):
    return run_incremental(df, jobs(spark, (1, "x", "c", "g")), table, **options)


def counts(spark, table):
    return {(r.dates, r.hours): r.clicks for r in tables.read_fact(spark, table).collect()}


def test_mark_of_an_empty_fact(spark, folder):
    mark = incremental.high_water_mark(tables.read_fact(spark, f"{folder}/none"), "updated_at")
    assert mark.select(F.col("mark").cast("string")).first()[0] == EMPTY_MARK


def test_second_run_without_news_does_nothing(spark, folder):
    df = events(spark, event())
    assert run(spark, df, f"{folder}/t") is True
    assert run(spark, df, f"{folder}/t") is False
    assert run(spark, df.where("false"), f"{folder}/t") is False
    assert counts(spark, f"{folder}/t") == {("2024-01-01", 10): 1}


def test_late_event_of_the_boundary_second_is_counted_once(spark, folder):
    first = [event("2024-01-01 10:00:05")]
    run(spark, events(spark, *first), f"{folder}/t")
    second = first + [event("2024-01-01 10:00:05"), event("2024-01-01 11:00:00")]
    run(spark, events(spark, *second), f"{folder}/t")
    assert counts(spark, f"{folder}/t") == {("2024-01-01", 10): 2, ("2024-01-01", 11): 1}


def test_lookback_repairs_late_hours(spark, folder):
    first = [event("2024-01-01 08:00:00"), event("2024-01-01 10:00:00")]
    run(spark, events(spark, *first), f"{folder}/t")
    later = first + [event("2024-01-01 08:30:00"), event("2024-01-01 11:00:00")]
    run(spark, events(spark, *later), f"{folder}/t", lookback="2 hours")
    assert counts(spark, f"{folder}/t") == {
        ("2024-01-01", 8): 2, ("2024-01-01", 10): 1, ("2024-01-01", 11): 1,
    }


def test_incremental_equals_full(spark, folder):
    log, job = fx.tracking(spark, SF), fx.job(spark, SF)
    for until in ("2024-01-05 03:04:05", "2024-01-17 23:59:59", "2024-02-01 00:00:00"):
        seen = log.where(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
        assert run_incremental(seen, job, f"{folder}/t")
    dim = fx.dimension(spark, SF)
    whole = fx.batch_fact(spark, SF, dim).withColumn("sources", F.lit(INCREMENTAL))
    assert stored(tables.read_fact(spark, f"{folder}/t")) == stored(whole)


def test_day_column_prunes_partitions(spark, folder, capsys):
    df = events(spark, *[event(f"2024-01-{d:02} 10:00:00") for d in range(1, 11)])
    df.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    mark = F.lit("2024-01-09 12:00:00")
    plan = incremental.touched_hours(log, mark, lookback="1 hour", day_column="day")
    plan.explain("formatted")
    text = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(day" in text
    assert "GreaterThanOrEqual(ts,2024-01-09 11:00:00.0)" in text
    assert plan.count() == 1


def test_exclusive_scan_and_pushed_subquery(spark):
    log = fx.tracking(spark, SF)
    mark = incremental.high_water_mark(log).scalar()
    assert incremental.newer_than(log, mark, inclusive=False).isEmpty()
    assert incremental.newer_than(log, mark).count() == 1
    plan = incremental.newer_than(log, mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in plan


def test_recent_mark(spark):
    age = F.timestamp_diff("SECOND", incremental.recent_mark(2), F.current_timestamp())
    assert spark.range(1).select(age).first()[0] == 120


def test_capture_starts_shortly_before_now(spark):
    now = spark.sql("select cast(current_timestamp() as string)").first()[0]
    df = events(spark, event(now), event())
    assert incremental.newer_than(df, incremental.recent_mark(), inclusive=False).count() == 1


# --- readers -------------------------------------------------------------------------

def test_dimension_reader_takes_only_its_columns(spark, folder):
    rows = [(1, "x", "c", "7", "unused")]
    spark.createDataFrame(rows, JOB.simpleString()[7:-1].replace(":", " ") + ", title string").write.parquet(
        f"{folder}/job"
    )
    dim = tables.read_dimension(spark, "parquet", path=f"{folder}/job")
    assert dim.columns == ["job_id", "company_id", "campaign_id", "group_id"]
    assert "title" not in dim._jdf.queryExecution().executedPlan().toString()


def test_table_readers(spark, folder):
    with open(f"{folder}/rows.json", "w") as f:
        f.write(json.dumps({"job_id": 1, "custom_track": "click"}))
    assert tables.read_table(spark, "json", path=f"{folder}/rows.json").first().job_id == 1
    pairs = tables.from_rows(spark, {"create_time": ["a", "b"], "ts": ["1", "2"]})
    assert [tuple(r) for r in pairs.collect()] == [("a", "1"), ("b", "2")]


def test_fact_read_back(spark, folder):
    rows = fact(events(spark, event()), INCREMENTAL)
    rows.write.parquet(f"{folder}/t")
    back = tables.read_fact(spark, f"{folder}/t")
    assert back.columns == FACT.fieldNames() and back.limit(1).count() == 1


def test_time_of_day_reads_the_same_from_either_timestamp_type(spark):
    ntz = fx.tracking(spark, SF)
    ltz = ntz.withColumn("ts", F.col("ts").cast("timestamp"))
    a, b = metrics.hourly_metrics(ntz), metrics.hourly_metrics(ltz)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
