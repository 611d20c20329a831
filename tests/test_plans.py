"""Shape of the physical plans, and results on skewed input against brute force."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

import __spark_entry__ as contract
from builders import event, events
from hirefunnel import fixtures as fx
from hirefunnel.operators import metrics
from hirefunnel.schema import COUNTS, EVENT_KEYS, MEASURE_OF_KIND

SF = "/root/testdata/sf0.001"
# These run a job while they are built; what they return is a plain read.
JOBS = [n for n in contract.queries() if n.endswith("_job") or n.startswith("stream_")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(JOBS)))
def test_no_query_leaves_the_jvm_or_crosses_rows(spark, name):
    plan = plan_of(contract.queries()[name](spark, SF))
    for node in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "SortAggregate"):
        assert node not in plan


def test_metrics_take_one_scan_and_one_shuffle(spark):
    log = fx.tracking(spark, SF)
    for df in (metrics.hourly_metrics(log), metrics.sparse_metrics(log)):
        plan = plan_of(df)
        assert plan.count("FileScan") == 1
        assert plan.count("Exchange ") == 1
        assert plan.count("partial_sum") == 1


def test_data_time_comes_from_the_groups_and_not_from_a_second_scan(spark):
    plan = plan_of(contract.queries()["data_time_stamp"](spark, SF))
    assert "events.parquet" not in plan
    assert plan.count("FileScan") == 2


def test_only_needed_columns_are_read(spark):
    plan = plan_of(metrics.hourly_metrics(fx.tracking(spark, SF)))
    assert "event_id" not in plan[plan.index("ReadSchema") :]


def test_company_is_joined_to_groups_by_broadcast(spark):
    plan = plan_of(contract.queries()["hourly_metrics_dimension_keys"](spark, SF))
    assert plan.index("BroadcastHashJoin [job_id") < plan.index("HashAggregate")
    assert "SortMergeJoin" not in plan


def test_hot_job_against_brute_force(spark):
    rng = random.Random(7)
    rows = [
        event(
            f"2024-01-{rng.randint(1, 2):02} {rng.randint(0, 5):02}:{rng.randint(0, 59):02}:00",
            rng.choice(["click"] * 6 + ["conversion", "qualified", "unqualified", "view"]),
            rng.choice([None, round(rng.uniform(0, 99), 2)]),
            job_id=1 if rng.random() < 0.34 else rng.randint(2, 40),
            publisher_id=rng.choice([None, 1, 2]),
            campaign_id=rng.choice(["c", "d"]),
            group_id=rng.choice([None, "g"]),
        )
        for _ in range(4000)
    ]
    want = defaultdict(lambda: {"bids": [], **dict.fromkeys(COUNTS, 0)})
    for row in rows:
        group = want[(row["ts"][:10], int(row["ts"][11:13]), *[row[k] for k in EVENT_KEYS])]
        if row["custom_track"] in MEASURE_OF_KIND:
            group[MEASURE_OF_KIND[row["custom_track"]]] += 1
        if row["custom_track"] == "click" and row["bid"] is not None:
            group["bids"].append(Decimal(str(row["bid"])))

    def cents(value):
        return float(value.quantize(Decimal("0.01"), ROUND_HALF_UP))

    got = metrics.hourly_metrics(events(spark, *rows)).collect()
    assert len(got) == len(want)
    for r in got:
        group = want[(r.dates, r.hours, *[r[k] for k in EVENT_KEYS])]
        bids = group["bids"]
        assert [r[c] for c in COUNTS] == [group[c] for c in COUNTS]
        assert r.spend_hour == cents(sum(bids, Decimal(0)))
        assert r.bid_set == (cents(sum(bids) / len(bids)) if bids else None)
