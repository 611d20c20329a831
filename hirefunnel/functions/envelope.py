"""Events as keyed JSON messages, and messages back to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirefunnel.schema import ENVELOPE, TRACKING

_TEXT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def to_envelope(events: DataFrame) -> DataFrame:
    """One message per event: `key` is the job id, `value` the whole event as JSON.

    NULL fields are left out of the JSON text, as `to_json` does by default.
    """
    fields = {
        "ts": F.date_format("ts", _TEXT_TIME),
        "bid": F.col("bid").cast("string"),
    }
    value = F.struct(*[fields.get(n, F.col(n)).alias(n) for n in ENVELOPE.fieldNames()])
    return events.select(
        F.col("job_id").cast("string").alias("key"), F.to_json(value).alias("value")
    )


def parse_envelope(messages: DataFrame) -> DataFrame:
    """Binary or text `value` to the columns of the event log.

    Malformed JSON, a field of the wrong type, an unreadable time or bid give NULL.
    """
    parsed = (
        messages.selectExpr("CAST(value AS STRING) AS value")
        .select(F.from_json("value", ENVELOPE).alias("data"))
        .select("data.*")
    )
    return parsed.select(
        *[
            {
                "ts": F.try_to_timestamp("ts"),
                "bid": F.col("bid").try_cast("double"),
            }
            .get(n, F.col(n))
            .alias(n)
            for n in TRACKING.fieldNames()
        ]
    )
