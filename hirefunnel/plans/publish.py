"""Publishing a writer's rows.

A run writes its own rows as a new segment (see `sources.segments`), then a version that names it
beside the segments that still count. The version appears with one rename: a run that is lost before
leaves the old state, one that is lost after has happened, and running it again changes nothing.
What a run writes does not depend on how much is stored. A failure raises; nothing is swallowed.

Segments of one kind are put together in tiers: when `TIER` of one level have piled up, they become
one of the next level, so every row is rewritten a few times at most (once per level) and readers
meet few segments. `compact` makes one base of everything.

A table has one process per writer at a time; several writers do not touch each other.
"""

from __future__ import annotations

import time
from dataclasses import replace as changed

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirefunnel.operators import merge
from hirefunnel.schema import FACT, MERGE_KEYS, REJECTS, STATE, check_sink_schema
from hirefunnel.sources import files, segments
from hirefunnel.sources.segments import BASE, DELTAS, HOURS, TOTALS, Segment, Version

# How a run's rows meet the stored ones, and the kind of segment they make.
KIND_OF = {"rewrite": BASE, "hours": HOURS, "replace": TOTALS, "accumulate": DELTAS}
# Segments of one level that are put together, and versions that readers may still be bound to.
TIER = 8
KEPT_VERSIONS = 10
_LAYOUT = ["sources", "dates"]


def append(rows: DataFrame, path: str, schema: StructType = FACT) -> None:
    """Add rows without looking at what is stored. Running twice stores them twice."""
    rows = check_sink_schema(rows, schema)
    _laid_out(rows, _LAYOUT).mode("append").parquet(path)


def last_run(spark: SparkSession, path: str, source: str) -> str | None:
    """The id of the run that a writer published last."""
    found = segments.version(spark, path, source)
    return found.run_id if found else None


def upsert(
    rows: DataFrame,
    path: str,
    source: str,
    run_id: str,
    how: str = "replace",
    keys: list[str] = MERGE_KEYS,
    since: str | None = None,
    mark: str | None = None,
    started: float | None = None,
    rejects: DataFrame | None = None,
) -> bool:
    """Publish the rows of one run of one writer, once; whether they were published now.

    `how` is 'rewrite' for all that the writer has, 'hours' for all from the hour `since` on,
    'replace' for the full totals of some `keys`, or 'accumulate' for totals of new events only.
    Rows have the columns of `schema.STATE`; fact rows are taken too, with amounts rounded as they
    are. `run_id` names the run: giving the last one again changes nothing. `rejects` are the events
    that the run does not count; they are published with its version.
    """
    spark = rows.sparkSession
    started = time.time() if started is None else started
    if "spend_hour" in rows.columns:
        rows = merge.state_of_fact(check_sink_schema(rows))
    rows = check_sink_schema(rows, STATE)
    last = segments.version(spark, path, source)
    if last and last.run_id == run_id:
        # Executed even so: a streaming state store moves on only if its batch is.
        rows.write.format("noop").mode("overwrite").save()
        return False
    number = _next(spark, path, source)
    held = _write_segment(rows, path, source, number)
    if rejects is not None:
        refused = check_sink_schema(rejects, REJECTS)
        refused.write.mode("overwrite").parquet(segments.rejects_path(path, source, number))
    new = Segment(number, KIND_OF[how], held, since, tuple(keys))
    earlier = () if how == "rewrite" or last is None else last.segments
    kept = (*earlier, new) if held or how == "hours" else earlier
    version = Version(
        number,
        run_id,
        kept,
        mark=mark or (last.mark if last else None),
        seconds=round(time.time() - started, 3),
        finished=time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime()),
        rejects=number if rejects is not None else None,
    )
    _publish(spark, path, source, version)
    while _merge_tier(spark, path, source):
        pass
    _remove_old(spark, path, source)
    return True


def compact(spark: SparkSession, path: str, source: str) -> None:
    """Put all that a writer has together as one base. Its last run stays its last run."""
    last = segments.version(spark, path, source)
    if last is None or len(last.segments) <= 1:
        return
    number = _next(spark, path, source)
    held = _write_segment(segments.resolved(spark, path, source, last.segments), path, source, number)
    _publish(spark, path, source, changed(last, number=number, segments=(Segment(number, BASE, held),)))
    _remove_old(spark, path, source)


def _next(spark: SparkSession, path: str, source: str) -> int:
    known = segments.version_numbers(spark, path, source)
    return known[-1] + 1 if known else 1


def _write_segment(rows: DataFrame, path: str, source: str, number: int) -> int:
    """Write the rows of a run over whatever an earlier attempt left there; how many they are."""
    spark = rows.sparkSession
    place = segments.segment_path(path, source, number)
    _laid_out(rows.drop("sources"), ["dates"]).mode("overwrite").parquet(place)
    # Row counts stand in the footers: no column is read.
    return segments.segments(spark, path, source, [Segment(number, BASE, 0)]).count()


def _publish(spark: SparkSession, path: str, source: str, new: Version) -> None:
    files.write_new(spark, segments.version_path(path, source, new.number), new.text())


def _merge_tier(spark: SparkSession, path: str, source: str) -> bool:
    """Put the last `TIER` segments together if they are of one kind and level."""
    last = segments.version(spark, path, source)
    tail = last.segments[-TIER:]
    alike = {(s.kind, s.keys, s.level) for s in tail}
    if len(tail) < TIER or len(alike) > 1 or tail[0].kind == BASE:
        return False
    number = _next(spark, path, source)
    held = _write_segment(segments.resolved(spark, path, source, tail), path, source, number)
    since = min(s.since for s in tail) if tail[0].kind == HOURS else None
    merged = changed(tail[-1], number=number, rows=held, level=tail[0].level + 1, since=since)
    _publish(spark, path, source, changed(last, number=number, segments=(*last.segments[:-TIER], merged)))
    return True


def _remove_old(spark: SparkSession, path: str, source: str) -> None:
    """Remove versions that no reader is bound to any more, and segments that only they name."""
    known = segments.version_numbers(spark, path, source)
    for number in known[:-KEPT_VERSIONS]:
        files.delete(spark, segments.version_path(path, source, number))
    kept = [segments.version(spark, path, source, n) for n in known[-KEPT_VERSIONS:]]
    used = {s.number for v in kept for s in v.segments}
    for folder, named in (("_segments", used), ("_quarantine", {v.rejects for v in kept})):
        for name in files.names(spark, f"{path}/{folder}/writer={source}"):
            number = int(name.removeprefix("segment="))
            # A later number may belong to a run that is about to publish.
            if number not in named and number <= known[-1]:
                files.delete(spark, f"{path}/{folder}/writer={source}/{name}")


def _laid_out(rows: DataFrame, layout: list[str]) -> DataFrameWriter:
    # Files of a useful size per date: small dates share a task, a large one gets several.
    # Sorting by job lets a lookup of one job skip most row groups.
    rows = rows.hint("rebalance", *layout).sortWithinPartitions(*layout, "job_id", "hours")
    return rows.write.partitionBy(*layout)
