"""Version-1 UUIDs to time and back, as Catalyst expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Microseconds and 100-ns ticks from 1582-10-15 to 1970-01-01.
_EPOCH_MICROS = 12_219_292_800_000_000
_EPOCH_TICKS = 122_192_928_000_000_000
_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-1[0-9a-fA-F]{3}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def is_timeuuid(uuid: Column) -> Column:
    return F.coalesce(uuid.rlike(_PATTERN), F.lit(False))


def time_of_timeuuid(uuid: Column) -> Column:
    """Time of a text that is known to be a version-1 UUID, microsecond precision."""
    ticks = F.conv(
        F.concat(F.substring(uuid, 16, 3), F.substring(uuid, 10, 4), F.substring(uuid, 1, 8)),
        16,
        10,
    ).cast("bigint")
    micros = F.call_function("div", ticks, F.lit(10)) - F.lit(_EPOCH_MICROS)
    return F.timestamp_micros(micros)


def timeuuid_to_timestamp(uuid: Column) -> Column:
    """Time of a version-1 UUID; NULL for NULL or malformed text."""
    return F.when(is_timeuuid(uuid), time_of_timeuuid(uuid))


def timeuuid_to_text(uuid: Column) -> Column:
    """The same as `yyyy-MM-dd HH:mm:ss` text."""
    return F.date_format(timeuuid_to_timestamp(uuid), "yyyy-MM-dd HH:mm:ss")


def timestamp_to_timeuuid(ts: Column) -> Column:
    """Smallest version-1 UUID of a time (clock sequence and node are zero), for bounds."""
    ticks = F.unix_micros(ts.cast("timestamp")) * F.lit(10) + F.lit(_EPOCH_TICKS)
    h = F.lower(F.lpad(F.hex(ticks), 16, "0"))
    return F.concat(
        F.substring(h, 9, 8),
        F.lit("-"),
        F.substring(h, 5, 4),
        F.lit("-1"),
        F.substring(h, 2, 3),
        F.lit("-8000-000000000000"),
    )


def new_timeuuid(ts: Column) -> Column:
    """A version-1 UUID of a time with a random clock sequence and node, different per row.

    The last two groups are those of a random UUID: their variant is the same.
    """
    return F.concat(F.substring(timestamp_to_timeuuid(ts), 1, 19), F.substring(F.uuid(), 20, 17))
