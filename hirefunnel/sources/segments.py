"""The stored fact table: segments written once, and versions that say which of them count.

    <table>/_segments/writer=<w>/segment=<n>/dates=<d>/   rows of one run, never changed
    <table>/_quarantine/writer=<w>/segment=<n>/           events that the run did not count
    <table>/_versions/<w>/<n>.json                        the segments of one state, and its run

A version appears with one rename and is never changed, so a writer's state is that of its latest
version and changes at once. A reader is bound to the version it found: later runs add files beside
the ones it reads, and segments are removed only when they have dropped out of the last versions.

How a run's rows meet the earlier ones is recorded with the segment and worked out when reading:

* base: everything before is gone.
* hours: everything from an hour on is recomputed; earlier rows from that hour on are gone.
* totals: a row replaces all earlier rows under its key.
* deltas: rows are added to what is there.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict, dataclass
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hirefunnel.operators.merge import added
from hirefunnel.schema import MERGE_KEYS, REJECTS, STATE
from hirefunnel.sources import files

BASE, HOURS, TOTALS, DELTAS = "base", "hours", "totals", "deltas"
_STORED = StructType([*STATE.fields, StructField("segment", LongType())])


@dataclass(frozen=True)
class Segment:
    number: int
    kind: str
    rows: int
    # First hour that an `hours` segment recomputes, as 'yyyy-MM-dd HH'.
    since: str | None = None
    # What a `totals` segment recomputes whole.
    keys: tuple[str, ...] = tuple(MERGE_KEYS)
    # How often its rows have been put together with those of others.
    level: int = 0


@dataclass(frozen=True)
class Version:
    number: int
    run_id: str
    segments: tuple[Segment, ...]
    # Latest event time the run took as past, and how long it took.
    mark: str | None = None
    seconds: float | None = None
    finished: str | None = None
    # Number of the segment with the events that the run did not count.
    rejects: int | None = None

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def parse(text: str) -> Version:
        values = json.loads(text)
        segments = (Segment(**{**s, "keys": tuple(s["keys"])}) for s in values.pop("segments"))
        return Version(segments=tuple(segments), **values)


def version_path(table: str, writer: str, number: int) -> str:
    return f"{table}/_versions/{writer}/{number:012}.json"


def segment_path(table: str, writer: str, number: int) -> str:
    return f"{table}/_segments/writer={writer}/segment={number}"


def rejects_path(table: str, writer: str, number: int) -> str:
    return f"{table}/_quarantine/writer={writer}/segment={number}"


def version_numbers(spark: SparkSession, table: str, writer: str) -> list[int]:
    """Numbers of the versions that are kept, ascending."""
    found = files.names(spark, f"{table}/_versions/{writer}")
    return [int(n.removesuffix(".json")) for n in found if n.endswith(".json") and n[0] != "."]


def version(spark: SparkSession, table: str, writer: str, number: int | None = None) -> Version | None:
    """The latest version of a writer, or the one with a number; None if nothing was published."""
    if number is None:
        known = version_numbers(spark, table, writer)
        if not known:
            return None
        number = known[-1]
    return Version.parse(files.read(spark, version_path(table, writer, number)))


def writers(spark: SparkSession, table: str) -> list[str]:
    return files.names(spark, f"{table}/_versions")


def segments(spark: SparkSession, table: str, writer: str, chosen: Iterable[Segment]) -> DataFrame:
    """The rows of some segments with the number of their segment, in one scan."""
    paths = [segment_path(table, writer, s.number) for s in chosen]
    reader = spark.read.schema(_STORED).option("basePath", f"{table}/_segments/writer={writer}")
    return reader.parquet(*paths).withColumn("sources", F.lit(writer)).select(*_STORED.fieldNames())


def before_hour(since: str) -> Column:
    """Rows of hours before 'yyyy-MM-dd HH', and those without an hour. The date stays bare, so
    that partitions are pruned."""
    day, hour = since.split(" ")
    earlier = (F.col("dates") == day) & (F.col("hours") < int(hour))
    return (F.col("dates") < day) | earlier | F.col("dates").isNull()


def from_hour(since: str) -> Column:
    day, hour = since.split(" ")
    later = (F.col("dates") == day) & (F.col("hours") >= int(hour))
    return (F.col("dates") > day) | later


def resolved(spark: SparkSession, table: str, writer: str, chosen: Iterable[Segment]) -> DataFrame:
    """What a row of segments amounts to, with the columns of the stored table.

    Segments of one kind that follow each other are read in one scan and, if there is anything to
    put together, cost one shuffle; base and hours cost none.
    """
    state = None
    for (kind, keys), group in groupby(chosen, key=lambda s: (s.kind, s.keys)):
        group = list(group)
        rows = segments(spark, table, writer, group)
        if kind == BASE:
            state = segments(spark, table, writer, group[-1:])
        elif kind == HOURS:
            # Rows count up to the hour where those of a later run begin.
            still = F.col("segment") == group[-1].number
            for i, earlier in enumerate(group[:-1]):
                end = min(s.since for s in group[i + 1 :])
                still = still | ((F.col("segment") == earlier.number) & before_hour(end))
            rows = rows.where(still)
            if state is not None:
                state = state.where(before_hour(min(s.since for s in group)))
            state = rows if state is None else state.unionByName(rows)
        elif kind == TOTALS:
            if state is not None:
                rows = rows.unionByName(state)
            if state is not None or len(group) > 1:
                latest = F.max("segment").over(Window.partitionBy(*keys))
                rows = rows.withColumn("_latest", latest).where("segment = _latest").drop("_latest")
            state = rows
        else:
            if state is not None:
                rows = rows.unionByName(state)
            if state is not None or len(group) > 1:
                number = F.lit(group[-1].number).cast("long")
                rows = added(rows).withColumn("segment", number)
            state = rows
    if state is None:
        return spark.createDataFrame([], STATE)
    return state.select(*STATE.fieldNames())


def read_state(spark: SparkSession, table: str, writer: str, number: int | None = None) -> DataFrame:
    """The rows of a writer's latest version (or of the one with a number)."""
    found = version(spark, table, writer, number)
    return resolved(spark, table, writer, found.segments if found else [])


def read_rejects(spark: SparkSession, table: str, writer: str, number: int | None = None) -> DataFrame:
    """The events that the latest run (or the one with a number) of a writer did not count: reason,
    event as JSON, how often. It belongs to the version, as the rows do."""
    found = version(spark, table, writer, number)
    if found is None or found.rejects is None:
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(rejects_path(table, writer, found.rejects))


def history(spark: SparkSession, table: str) -> DataFrame:
    """The versions that are kept: writer, number, run, mark, rows and segments, elapsed seconds."""
    rows = []
    for writer in writers(spark, table):
        for number in version_numbers(spark, table, writer):
            v = version(spark, table, writer, number)
            held = sum(s.rows for s in v.segments)
            rows.append((writer, number, v.run_id, v.mark, len(v.segments), held, v.seconds, v.finished))
    columns = "writer string, version long, run_id string, mark string, segments int, stored_rows long"
    return spark.createDataFrame(rows, f"{columns}, seconds double, finished string")
