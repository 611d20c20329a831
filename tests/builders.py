"""Small literal frames."""

from pyspark.sql import functions as F

from hirefunnel.operators.merge import to_fact
from hirefunnel.operators.metrics import hourly_metrics
from hirefunnel.schema import TRACKING

STAMP = "2024-03-01 00:00:00"


def events(spark, *rows):
    """Rows as dicts; what is left out is NULL. `ts` is text."""
    names = TRACKING.fieldNames()
    text = ", ".join(
        f"{f.name} {'string' if f.name == 'ts' else f.dataType.simpleString()}" for f in TRACKING
    )
    data = [tuple(row.get(n) for n in names) for row in rows]
    return spark.createDataFrame(data, text).withColumn("ts", F.try_to_timestamp("ts"))


def event(ts="2024-01-01 10:00:00", kind="click", bid=1.0, **more):
    row = {"ts": ts, "custom_track": kind, "bid": bid, "job_id": 1, "publisher_id": 1}
    return row | {"campaign_id": "c", "group_id": "g"} | more


def jobs(spark, *rows):
    return spark.createDataFrame(
        list(rows), "job_id int, company_id string, campaign_id string, group_id string"
    )


def fact(df, source, stamp=STAMP, company="x"):
    metrics = hourly_metrics(df).withColumn("company_id", F.lit(company))
    return to_fact(metrics, source, F.lit(stamp).cast("timestamp"))


def stored(df):
    """Rows of a fact frame without the stamp, as a comparable list."""
    rows = df.drop("updated_at").collect()
    return sorted((tuple(r) for r in rows), key=repr)
