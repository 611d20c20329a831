"""Mixing sources to target weights by pivotal dependent rounding.

The size of a document is its number of words. Sources, in order of code point with null last, have
the weights 3, 1, 2, repeating, and share `budget` of all sizes; a target stops at `most` times the
source's size and the excess is shared again by weight. Every document of a source is to be taken
target / size times: its whole part for certain, its fraction by pivotal rounding. Two documents
with fractions a and b are paired and mass moves between them at random until one has 0 or 1; the
expectation of each stays as it was, and the sum changes only by the difference of their sizes, so
documents are paired in order of size.

A source's documents are dealt into buckets of about `bucket` by hash, rounded there, and each
bucket leaves one fraction at most; these meet in a reduction tree, `fan` buckets to one, until one
fraction a source is left, which a last draw decides. Draws are hashes of the ids and the seed, so
reruns agree. Null texts have size 0; a null source is a source; a null id is hashed like any other
value; rows that repeat are taken each on its own. Empty table: no rows. Sources are ranked in one
task: rows of that window are distinct sources, not documents.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirefunnel.llm.common import each_batch, free_name, stored, texts_of

# The weights of the sources in turn.
WEIGHTS = (3, 1, 2)


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = 1.5, most: float = 2.0) -> DataFrame:
    """From source, source_size: the same with `target`."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    weighed = stored(
        sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("cap", F.col("source_size") * F.lit(float(most))),
        "mix-sources",
    )
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    # Sources at their cap are set aside and the rest shares what is left, until none is above.
    level, full = 0.0, -1
    while True:
        above = F.col("cap") <= F.col("weight") * F.lit(level)
        held, weight, n = weighed.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)),
            F.sum(F.when(~above, F.col("weight"))),
            F.count(F.when(above, 1)),
        ).first()
        if n == full or not weight:
            level = level if weight else float("inf")
            break
        full, level = n, (budget * total - held) / weight
    share = F.least("cap", F.col("weight") * F.lit(level)) if level != float("inf") else F.col("cap")
    return weighed.select("source", "source_size", share.alias("target"))


def _draw(seed: int, a: int, b: int) -> float:
    return xxhash.xxh64_intdigest(f"{a} {b}", seed) / 2**64


def pivot(fraction: list[float], name: list[int], seed: int) -> tuple[list[float], int]:
    """Round fractions pairwise; gives them and the place of the one that is left, or -1."""
    out, open_at = list(fraction), -1
    for j, b in enumerate(out):
        if b <= 0 or b >= 1:
            continue
        if open_at < 0:
            open_at = j
            continue
        i, a = open_at, out[open_at]
        u, s = _draw(seed, name[i], name[j]), a + b
        if abs(s - 1) < 1e-12:
            out[i], out[j] = (1.0, 0.0) if u * s < a else (0.0, 1.0)
            open_at = -1
        elif s < 1:
            stays, goes = (j, i) if u * s < b else (i, j)
            out[stays], out[goes], open_at = s, 0.0, stays
        else:
            full, rest = (i, j) if u * (2 - s) < 1 - b else (j, i)
            out[full], out[rest], open_at = 1.0, s - 1, rest
    return out, open_at


def _rounded(rows: DataFrame, seed: int) -> DataFrame:
    """Round within each (source, bucket); at most one row of each stays open."""

    def run(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["size", "name", "key"], ascending=[False, True, True])
        table["fraction"], _ = pivot(table["fraction"].tolist(), table["name"].tolist(), seed)
        return table

    return rows.groupBy("source", "bucket").applyInPandas(run, rows.schema)


def mixed(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    key_col: str | None = None,
    bucket: int = 4096,
    fan: int = 64,
    seed: int = 0,
) -> DataFrame:
    """One row per input row: id, key, source, size, source_size, target, copies, taken.

    `key` is `key_col`, or else the id; it only travels along to find the row again.
    """

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes = [len(t.split()) for t in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(sizes, pa.int64())], names=["id", "key", "source", "size"]
        )

    source = rows.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(key_col or id_col).cast("long").alias("key"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    sized = stored(each_batch(source, count, "id long, key long, source string, size long"), "mix-sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    totals = stored(totals, "mix-totals")
    aims = targets(totals.drop("n"))
    aims = aims.join(totals.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s")))
    aims = stored(aims.withColumnRenamed("source", "aim").drop("s"), "mix-targets")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    buckets = F.ceil(F.col("n") / F.lit(bucket))
    # The size is part of the hash, so that null ids do not all meet in one bucket.
    hashed = F.xxhash64("id", "size")
    whole = sized.join(aims, F.col("source").eqNullSafe(F.col("aim"))).drop("aim")
    whole = whole.withColumn("rate", rate).select(
        "id", "key", "source", "size", "source_size", "target",
        F.floor("rate").cast("long").alias("base"),
        (F.col("rate") - F.floor("rate")).alias("fraction"),
        F.pmod(hashed, buckets).alias("bucket"),
        hashed.alias("name"),
    )
    left = ceil((totals.agg(F.max("n")).first()[0] or 0) / bucket)
    done, level = None, 0
    while True:
        rounded = stored(_rounded(whole, seed + level), "mix-level")
        is_open = (F.col("fraction") > 0) & (F.col("fraction") < 1)
        settled = rounded.where(~is_open)
        done = settled if done is None else done.unionByName(settled)
        whole = rounded.where(is_open).withColumn("bucket", F.floor(F.col("bucket") / F.lit(fan)))
        if left <= 1:
            break
        left, level = ceil(left / fan), level + 1
    last = (F.pmod(F.xxhash64("name", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))) < F.col("fraction")
    done = done.unionByName(whole.withColumn("fraction", last.cast("double")))
    copies = F.col("base") + F.round("fraction").cast("long")
    return done.select(
        F.col("id").alias(id_col), "key", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mixed_rows(rows: DataFrame, **columns: str) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns."""
    id_col = columns.get("id_col", "doc_id")
    number = id_col
    if not rows.groupBy(f"`{id_col}`").count().where(f"count > 1 OR `{id_col}` IS NULL").isEmpty():
        # Rows that share an id are told apart by a number that is written down with them.
        number = free_name(rows.columns, "number")
        rows = stored(rows.withColumn(number, F.monotonically_increasing_id()), "mix-rows")
    taken = mixed(rows, key_col=number, **columns).where("copies > 0")
    copies = free_name(rows.columns, "copies")
    taken = taken.select(F.col("key").alias(free_name(rows.columns, "key")), F.col("copies").alias(copies))
    # Nearly every row has a count of copies, so rows and counts meet by a shuffle at any size.
    out = rows.join(taken.hint("merge"), rows[f"`{number}`"] == taken[taken.columns[0]])
    out = out.select(
        *[rows[f"`{c}`"] for c in rows.columns],
        F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))).alias(free_name(rows.columns, "copy")),
    )
    kept = [c for c in rows.columns if c == id_col or c != number]
    return out.select(*[F.col(f"`{c}`") for c in kept])
