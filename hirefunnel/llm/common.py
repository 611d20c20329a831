"""Small helpers that the operators share: texts as bytes, words, scratch tables, batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hirefunnel.sources import files
from hirefunnel.workspace import scratch

# The characters between words, space and U+0009 to U+000D. They are also what
# bytes.split() without an argument splits at.
BLANKS = " \t\n\x0b\x0c\r"
# Frequent function words of the four languages.
STOP_WORDS = frozenset(
    """the of and to a in is that it was for on are with as be at by this from or an have not
    de la le et les des en un une du que est pour qui dans par sur pas au avec
    der die und das den von zu mit ist des im für auf dem nicht ein eine als auch es sich
    el los del y se las por con no su para al lo como más o este""".split()
)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Ids that are sent to every task; beyond, rows are shuffled to them.
BROADCAST_IDS = 2_000_000
_written: list[list[str]] = []


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written below the shared checkpoint folder and read again: lineage ends here."""
    spark = rows.sparkSession
    path = scratch(spark, name)
    if _written:
        _written[-1].append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def noting_scratch() -> Iterator[list[str]]:
    """The folders that `stored` makes within the block, for `remove` once they are not needed."""
    _written.append([])
    try:
        yield _written[-1]
    finally:
        _written.pop()


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        files.delete(spark, path)


def free_name(columns: list[str], name: str) -> str:
    """A name like `name` that no column has, in any spelling of upper and lower case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(rows: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """The rows whose id is not among the single column of `ids`; a null matches a null.

    Up to `BROADCAST_IDS` of them are sent to the rows; more are met by a shuffle of both.
    """
    ids = stored(ids.toDF(free_name(rows.columns, "gone")), "without-ids")
    name = ids.columns[0]
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return rows.join(ids, rows[f"`{id_col}`"].eqNullSafe(ids[name]), "left_anti")


def partitions(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> list[bytes]:
    """Texts of a batch as UTF-8; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    return utf8(batch.column(batch.schema.get_field_index(name)))


def each_batch(
    rows: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """Apply a function of one record batch to all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield make(batch)

    return rows.mapInArrow(run, schema)


def sized_slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to at most `most`, one item at least."""
    begin = total = 0
    for k, size in enumerate(sizes):
        if k > begin and total + size > most:
            yield begin, k
            begin, total = k, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], most: int
) -> Iterator[tuple[pa.Table, bool]]:
    """Tables of sorted rows in which groups of equal keys are whole, and False; or rows of one
    group that has more than `most` rows, in pieces, and True. Holds one batch and `most` rows.
    """
    held: pa.Table | None = None
    large: tuple | None = None

    def values(table: pa.Table) -> list[np.ndarray]:
        return [table.column(k).to_numpy() for k in keys]

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        held = None
        if large is not None and table.num_rows:
            same = np.logical_and.reduce([v == x for v, x in zip(values(table), large, strict=True)])
            n = table.num_rows if same.all() else int(np.argmin(same))
            if n:
                yield table.slice(0, n), True
            table = table.slice(n).combine_chunks()
            large = large if not table.num_rows else None
        if not table.num_rows:
            continue
        columns = values(table)
        new = np.logical_or.reduce([v[1:] != v[:-1] for v in columns])
        last = int(np.flatnonzero(new)[-1]) + 1 if new.any() else 0
        if last:
            yield table.slice(0, last), False
        held = table.slice(last)
        if held.num_rows > most:
            yield held, True
            large, held = tuple(v[-1] for v in columns), None
    if held is not None and held.num_rows:
        yield held, False


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (multiply and shift, twice)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0x9E3779B97F4A7C15)


def only(rows: DataFrame, *names: str) -> DataFrame:
    """These columns and no other, so that extra columns cannot clash with ours."""
    return rows.select(*[F.col(f"`{n}`") for n in names])
