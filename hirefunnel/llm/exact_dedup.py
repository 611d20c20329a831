"""Exact dedup by distributed MSD radix partitioning.

Texts are equal when their bytes are, after lower-casing A-Z; a null text is an empty one.

1. Every record batch is split by successive bytes until its groups are single or ended, and
   each group of equal texts is folded into one row. A text that a third of all rows share
   leaves a batch once, so no later group holds more rows than there are batches.
2. The folded texts are dealt out by their leading bytes. A prefix that holds more than
   `limit` bytes or `most` rows is lengthened, level by level and without a last level, until it
   holds less or has one text left. A row is known by the number of its heavy prefix and the next slice of its
   text, so no key repeats the bytes of earlier levels.
3. Heavy prefixes with one text left are folded by their numbers, wherever their rows are. Each
   partition of the others is split by successive bytes again; what stays together to the end of
   the text is equal. No digest decides anything.

Every input row comes back once. Of equal texts one row stays: the one with the largest id, and
of rows that share that id too, one of them. A null id is smaller than any other. An empty table
gives no rows. Other columns are not read. `distinct_rows` takes the copies out of the rows by their ids,
which are fewer than the rows; only where ids repeat are the rows written down with numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import free_name, partitions, stored, texts_of, without

#: Length of the prefixes that texts are dealt out by at first; each level makes them LONGER times as long.
FIRST, LONGER = 8, 4
MOST_BYTES = 2**31 - 1
#: Bytes and rows of text that one prefix brings to a task.
LIMIT, MOST = 32 << 20, 4096
NULL_ID = -(2**63)
BROADCAST_BYTES = 16 << 20


def radix_groups(texts: list[bytes]) -> list[list[int]]:
    """Groups of equal texts, by successive bytes. Steps double while a group stays whole."""
    done: list[list[int]] = []
    todo = [(list(range(len(texts))), 0, 1)] if texts else []
    while todo:
        members, depth, step = todo.pop()
        if len(members) == 1:
            done.append(members)
            continue
        parts: dict[bytes, list[int]] = {}
        for i in members:
            parts.setdefault(texts[i][depth : depth + step], []).append(i)
        whole = len(parts) == 1
        for digits, part in parts.items():
            if len(digits) < step:  # these have ended here, and all their bytes were the same
                done.append(part)
            else:
                todo.append((part, depth + step, min(2 * step, 4096) if whole else 1))
    return done


def exact_groups(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    key_col: str | None = None,
    most: int = MOST,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    With `key_col`, a number that tells rows of one id apart, its value comes back as `key`.
    """
    source = rows.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(key_col or id_col).cast("long").alias("key"),
    )
    folded = source.mapInArrow(
        _fold, "local long, id long, key long, leads boolean, size long, body binary"
    )
    folded = stored(folded, "exact-folded")
    final = _final(folded.where("body IS NOT NULL").drop("leads", "key"), limit, most)
    members = folded.where("body IS NULL").select("local", "id", "key", "leads")
    return members.join(final, "local").select(
        _nullable("id").alias(id_col),
        *(["key"] if key_col else []),
        _nullable("keep_id").alias("keep_id"),
        "group_size",
        (F.col("leads") & (F.col("local") == F.col("keep_local"))).alias("kept"),
        "text_sha256",
    )


def distinct_rows(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    again = rows.groupBy(f"`{id_col}`").count().where("count > 1")
    if again.isEmpty():
        gone = exact_groups(rows, id_col, text_col).where("NOT kept").select(id_col)
        return without(rows, id_col, gone)
    # Rows that share an id are told apart by a number that is written down with them.
    number = free_name(rows.columns, "number")
    numbered = stored(rows.withColumn(number, F.monotonically_increasing_id()), "exact-rows")
    gone = exact_groups(numbered, id_col, text_col, key_col=number).where("NOT kept").select("key")
    return without(numbered, number, gone).drop(number)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row with its text for each group of a batch, and a row without for each member."""
    # Numbers of groups need only be unique: the rows are stored before anyone reads them.
    number = TaskContext.get().partitionId() << 36
    for batch in batches:
        ids = batch.column(0).to_numpy()
        texts = [t.lower() for t in texts_of(batch)]
        groups = radix_groups(texts)
        n, leads, group_of = len(ids), np.zeros(len(ids), bool), np.empty(len(ids), np.int64)
        for k, group in enumerate(groups):
            group_of[group] = k
            leads[max(group, key=ids.__getitem__)] = True
        leaders = np.array([max(g, key=ids.__getitem__) for g in groups], np.int64)
        names = number + np.arange(len(groups))
        number += len(groups)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([names, names[group_of]])),
                pa.array(np.concatenate([ids[leaders], ids])),
                pa.concat_arrays([pa.nulls(len(groups), pa.int64()), batch.column(2)]),
                pa.array(np.concatenate([np.ones(len(groups), bool), leads])),
                pa.array(np.concatenate([[len(g) for g in groups], np.ones(n)]).astype(np.int64)),
                pa.array([texts[g[0]] for g in groups] + [None] * n, pa.binary()),
            ],
            names=["local", "id", "key", "leads", "size", "body"],
        )


def _nullable(name: str) -> Column:
    return F.when(F.col(name) != NULL_ID, F.col(name))


def _final(groups: DataFrame, limit: int, most: int) -> DataFrame:
    """What `_resolved` gives, for every folded text."""
    total = groups.agg(F.sum(F.length("body"))).first()[0] or 0
    dealt, ones = _dealt(groups, limit, most)
    parts = max(partitions(groups), 2 * total // limit)
    rest = _resolved(dealt.where("NOT one").repartition(parts, "level", "path", _slice()))
    if not ones:
        return rest
    # At most total / limit texts and one in `most` rows, with copies in many batches: partial sums fold them in each task.
    copies = dealt.where("one")
    found = copies.groupBy("path").agg(
        F.max(F.struct("id", "local")).alias("best"),
        F.sum("size").alias("group_size"),
        F.max(F.sha2("body", 256)).alias("text_sha256"),
    )
    # One row of about 120 bytes per heavy text; the whole texts stay behind.
    found = stored(found, "exact-ones")
    found = F.broadcast(found) if found.count() * 120 <= BROADCAST_BYTES else found
    folded = copies.select("local", "path").join(found, "path")
    return rest.unionByName(
        folded.select(
            "local",
            F.col("best.id").alias("keep_id"),
            F.col("best.local").alias("keep_local"),
            "group_size",
            "text_sha256",
        )
    )


def _slice() -> Column:
    return F.expr("substring(body, start + 1, width)")


def _dealt(groups: DataFrame, limit: int, most: int) -> tuple[DataFrame, bool]:
    """Folded texts with the prefix that each is dealt out by, and whether any are marked `one`.

    A prefix is the last slice of it and `path`, the number of the heavy prefix of the level before.
    It holds one row, or at most `limit` bytes and `most` rows; or one text in many rows, marked `one`.
    """
    dealt = groups.selectExpr("*", "0L path", "0 level", "0 start", f"{FIRST} width", "false one")
    level, ones = 0, False
    while True:
        size, digest = F.length("body"), F.xxhash64("body")
        held = (
            dealt.where((F.col("level") == level) & ~F.col("one"))
            .groupBy("path", "start", "width", _slice().alias("slice"))
            .agg(
                F.sum(size).alias("bytes"),
                F.count("*").alias("n"),
                F.max(size).alias("longest"),
                (F.min(digest) == F.max(digest)).alias("alike"),
            )
        )
        end = F.col("start").cast("long") + F.col("width")
        # Rows that seem to be equal are compared whole at the next level. `alike` decides no more.
        longer = F.when(F.col("alike"), F.col("longest") - end).otherwise((LONGER - 1) * end)
        too_much = (F.col("bytes") > limit) | (F.col("n") > most)
        heavy = held.where(too_much & (F.col("n") > 1)).select(
            F.col("path").alias("old_path"),
            F.lit(level).alias("old_level"),
            "slice",
            F.monotonically_increasing_id().alias("new_path"),
            (F.col("longest") <= end).alias("ended"),
            F.least(end, F.lit(MOST_BYTES)).cast("int").alias("new_start"),
            F.greatest(F.least(longer, MOST_BYTES - end), F.lit(0)).cast("int").alias("new_width"),
        )
        heavy = stored(heavy, "exact-heavy")
        # At most total / limit prefixes and one in `most` rows; their size decides how they are joined.
        n, size, ended = heavy.agg(F.count("*"), F.sum(F.length("slice")), F.max("ended")).first()
        if not n:
            return dealt, ones
        ones = ones or ended
        heavy = F.broadcast(heavy) if size <= BROADCAST_BYTES else heavy
        same = (F.col("path") == F.col("old_path")) & (F.col("level") == F.col("old_level"))
        dealt = dealt.join(heavy, same & (_slice() == F.col("slice")) & ~F.col("one"), "left").select(
            *groups.columns,
            F.coalesce("new_path", "path").alias("path"),
            F.when(F.col("new_path").isNull(), F.col("level")).otherwise(level + 1).alias("level"),
            F.coalesce("new_start", "start").alias("start"),
            F.coalesce("new_width", "width").alias("width"),
            F.coalesce("ended", "one").alias("one"),
        )
        level += 1


def _resolved(dealt: DataFrame) -> DataFrame:
    schema = "local long, keep_id long, keep_local long, group_size long, text_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b for b in batches if b.num_rows] or [empty])
        local, ids, size = (table.column(c).to_numpy() for c in ("local", "id", "size"))
        texts = table.column("body").to_pylist()
        keep, keep_local, total = (np.empty(len(ids), np.int64) for _ in range(3))
        sha = [""] * len(ids)
        for group in radix_groups(texts):
            best = max(group, key=lambda i: (ids[i], local[i]))
            keep[group], keep_local[group], total[group] = ids[best], local[best], size[group].sum()
            digest = hashlib.sha256(texts[group[0]]).hexdigest()
            for i in group:
                sha[i] = digest
        yield pa.RecordBatch.from_arrays(
            [pa.array(local), pa.array(keep), pa.array(keep_local), pa.array(total), pa.array(sha, pa.string())],
            names=["local", "keep_id", "keep_local", "group_size", "text_sha256"],
        )

    empty = pa.RecordBatch.from_pylist(
        [], pa.schema([("local", "int64"), ("id", "int64"), ("size", "int64"), ("body", "binary")])
    )
    return dealt.select("local", "id", "size", "body").mapInArrow(run, schema)
