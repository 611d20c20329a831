"""The job dimension of a running stream: copied and proven once, reused until its files change.

A trigger only lists the dimension's files. Where path, length and time of all of them are those of
the last trigger, the copy that was proven and measured then is used again; a small one is kept in
memory, so nothing of it is read. The copy is what is proven and what is joined, so files that change
in between cannot make the two differ. A dimension that does not come from files cannot tell that it
is unchanged and is proven at every trigger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirefunnel.operators import enrich
from hirefunnel.sources import files
from hirefunnel.workspace import scratch

Reader = Callable[[SparkSession], DataFrame]


class Dimension:
    """`source` is the job dimension, or a function that reads it, which sees files that are added,
    replaced or removed while the stream runs."""

    def __init__(self, source: DataFrame | Reader, broadcast_bytes: int = enrich.BROADCAST_BYTES):
        self.source, self.limit = source, broadcast_bytes
        self.seen: tuple = ()
        self.path: str | None = None
        self.copy: DataFrame | None = None
        self.proven: DataFrame | None = None

    def current(self, spark: SparkSession) -> DataFrame:
        """The dimension, ready to be joined."""
        rows = self.source if isinstance(self.source, DataFrame) else self.source(spark)
        found = files.fingerprint(spark, rows.inputFiles())
        if not found:
            return enrich.prepare_dimension(rows, broadcast_bytes=self.limit)
        if found != self.seen:
            self._copy(spark, rows)
            self.seen = found
        return self.proven

    def _copy(self, spark: SparkSession, rows: DataFrame) -> None:
        old, before = self.path, self.copy
        self.path = scratch(spark, "dimension")
        rows.where(F.col("job_id").isNotNull()).write.parquet(self.path)
        self.copy = spark.read.schema(rows.schema).parquet(self.path)
        if enrich.proven_bytes(self.copy) <= self.limit:
            # What a lost executor held in memory is read from the copy again.
            self.copy = self.copy.persist()
            self.proven = F.broadcast(self.copy)
        else:
            self.proven = self.copy
        if before is not None:
            before.unpersist()
            files.delete(spark, old)
