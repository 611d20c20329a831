"""Hourly funnel metrics, in one pass and in the per-kind form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hirefunnel.functions.events import fill_keys, known_only as only_known_kinds, of_kind
from hirefunnel.schema import EVENT_KEYS, MEASURE_OF_KIND, STATE

# Money is added up as decimals, so the order of addition cannot change a sum. A sum has ten
# more digits than an amount: ten thousand million of the largest ones still fit.
AMOUNT = "decimal(24,9)"
MICROS = 1_000_000


def bid_amount(bid: Column) -> Column:
    """A bid as an exact amount; NULL if it is not a number or is 10**15 or more.

    `reconcile.unusable_bids` counts what becomes NULL here.
    """
    return bid.try_cast(AMOUNT)


def average_half_up(total: Column, count: Column) -> Column:
    """`total / count` of exact amounts with two decimals, ties away from zero; NULL for none."""
    parts = (F.abs(total) * F.lit(200).cast("decimal(3,0)")).cast("decimal(36,9)")
    n = count.cast("decimal(19,0)")
    cents = F.call_function("div", parts + n, n * 2) * F.sign(total).cast("bigint")
    return F.when(count > 0, cents / F.lit(100.0))


def _micros(total: Column) -> Column:
    return (total * F.lit(MICROS).cast("decimal(7,0)")).cast("double")


def half_up(total: Column, divisor: Column) -> Column:
    """`total / divisor` as an amount with two decimals, ties away from zero.

    `divisor` counts the units of `total` that make one cent; NULL when it is 0.
    """
    doubled = F.abs(total) * 2 + divisor
    cents = F.call_function("div", doubled, divisor * 2) * F.sign(total).cast("bigint")
    return F.when(divisor > 0, cents / F.lit(100.0))


def _is(kind: str) -> Column:
    return F.col("custom_track") == kind


def hourly_metrics(
    events: DataFrame,
    keys: list[str] = EVENT_KEYS,
    time_col: str = "ts",
    known_only: bool = False,
    watermark: str | None = None,
    exact: bool = False,
    latest: bool = False,
) -> DataFrame:
    """Spend, average click bid and the four counts per date, hour and `keys`.

    Groups by a day number and an hour number; the text of the date is made once per
    group. A group of unknown kinds only is kept with zero counts unless `known_only`.
    On a stream, `watermark` bounds the state: hours older than it are closed and what
    arrives for them later is left to the batch job. With `exact` the measures are those of
    `schema.STATE`, which can be added up further, instead of rounded amounts.

    A text time that cannot be read counts under a NULL date and hour. `latest` adds the latest time
    of each group.
    """
    if known_only:
        events = only_known_kinds(events)
    if isinstance(events.schema[time_col].dataType, StringType):
        events = events.withColumn(time_col, F.try_to_timestamp(time_col))
    bid = F.when(_is("click"), bid_amount(F.col("bid")))
    unusable = _is("click") & F.col("bid").isNotNull() & bid.isNull()
    measures = [
        F.sum(bid).alias("_spend"),
        F.count(bid).alias("_bids"),
        *([F.count_if(unusable).alias("unusable_bids"), F.count("*").alias("events")] if exact else []),
        *([F.max(time_col).alias("latest")] if latest else []),
        *[F.count_if(_is(kind)).alias(name) for kind, name in MEASURE_OF_KIND.items()],
    ]
    if watermark:
        grouped = events.withWatermark(time_col, watermark).groupBy(
            F.window(time_col, "1 hour").alias("_window"), *keys
        )
        day, hour = F.to_date("_window.start"), F.hour("_window.start")
    else:
        grouped = events.groupBy(
            F.to_date(time_col).alias("_day"), F.hour(time_col).alias("_hour"), *keys
        )
        day, hour = F.col("_day"), F.col("_hour")
    spend = F.coalesce("_spend", F.lit(0))
    if exact:
        shown = [
            spend.cast(STATE["spend"].dataType).alias("spend"),
            F.col("_bids").alias("bids"),
            "unusable_bids",
            "events",
        ]
    else:
        shown = rounded_amounts(spend, F.col("_bids"))
    return grouped.agg(*measures).select(
        day.cast("string").alias("dates"),
        hour.alias("hours"),
        *keys,
        *shown,
        *MEASURE_OF_KIND.values(),
        *(["latest"] if latest else []),
    )


def rounded_amounts(spend: Column, bids: Column) -> list[Column]:
    """Spend and average bid as they are shown: two decimals, ties away from zero."""
    return [
        F.round(spend, 2).cast("double").alias("spend_hour"),
        average_half_up(spend, bids).alias("bid_set"),
    ]


# Column that the per-kind form uses for the count of each kind.
KIND_COUNT = {
    "click": "clicks",
    "conversion": "conversions",
    "qualified": "qualified",
    "unqualified": "unqualified",
}
SPARSE_KEYS = ["job_id", "date", "hour", "publisher_id", "campaign_id", "group_id"]
SPARSE_MEASURES = ["bid_set", "spend_hour", *KIND_COUNT.values()]


def kind_by_hour(events: DataFrame, kind: str, fill: bool = True) -> DataFrame:
    """One kind by hour through SQL.

    Clicks carry the plain average and sum of their bids, the other kinds a count only.
    With `fill`, NULL ids and bids are 0 before grouping.
    """
    rows = of_kind(events, kind)
    if fill:
        rows = fill_keys(rows, bid=kind == "click")
    rows = rows.withColumn("amount", bid_amount(F.col("bid")))
    money = (
        f", try_divide(cast(sum(amount) * {MICROS} AS double), count(amount)) / {MICROS} AS bid_set"
        f", cast(sum(amount) * {MICROS} AS double) / {MICROS} AS spend_hour"
        if kind == "click"
        else ""
    )
    query = f"""
        SELECT job_id, date(ts) AS date, hour(ts) AS hour, publisher_id, campaign_id, group_id,
               count(*) AS {KIND_COUNT[kind]} {money}
        FROM {{rows}}
        GROUP BY job_id, date(ts), hour(ts), publisher_id, campaign_id, group_id
    """
    return events.sparkSession.sql(query, rows=rows)


def join_kinds(*by_kind: DataFrame, fill: bool = False) -> DataFrame:
    """Full outer join of per-kind metrics on the six keys, NULL keys matching NULL keys.

    Each input holds a key once, so laying them under each other and regrouping gives
    the rows of the chained full joins with a single shuffle and no sort. A measure is
    NULL where its kind has no events, or 0 with `fill`.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), by_kind)
    joined = stacked.groupBy(*SPARSE_KEYS).agg(
        *[F.max(c).alias(c) for c in stacked.columns if c not in SPARSE_KEYS]
    )
    return joined.na.fill(0, [c for c in joined.columns if c in SPARSE_MEASURES]) if fill else joined


def sparse_metrics(events: DataFrame, fill_ids: bool = True, fill: bool = False) -> DataFrame:
    """What joining all four kinds gives, from one scan and one shuffle.

    Measures of absent kinds are NULL; groups without any known kind are absent.
    """
    rows = only_known_kinds(events)
    if fill_ids:
        rows = fill_keys(rows, bid=True)
    bid = F.when(_is("click"), bid_amount(F.col("bid")))
    found = rows.groupBy(
        "job_id",
        F.to_date("ts").alias("date"),
        F.hour("ts").alias("hour"),
        "publisher_id",
        "campaign_id",
        "group_id",
    ).agg(
        F.sum(bid).alias("_spend"),
        F.count(bid).alias("_bids"),
        *[F.count_if(_is(kind)).alias(name) for kind, name in KIND_COUNT.items()],
    )
    sparse = found.select(
        *SPARSE_KEYS,
        F.when(F.col("_bids") > 0, _micros(F.col("_spend")) / F.col("_bids") / MICROS).alias("bid_set"),
        (_micros(F.col("_spend")) / MICROS).alias("spend_hour"),
        *[F.nullif(F.col(name), F.lit(0)).alias(name) for name in KIND_COUNT.values()],
    )
    return sparse.na.fill(0, SPARSE_MEASURES) if fill else sparse


def to_fact_names(sparse: DataFrame) -> DataFrame:
    """Columns of the per-kind form under the names of the fact table."""
    renamed = sparse.withColumnsRenamed(
        {
            "date": "dates",
            "hour": "hours",
            "conversions": "conversion",
            "qualified": "qualified_application",
            "unqualified": "disqualified_application",
        }
    )
    return renamed.withColumn("dates", F.col("dates").cast("string"))
