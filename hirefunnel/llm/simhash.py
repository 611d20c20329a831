"""SimHash near-dedup: pigeonhole blocks over 64-bit fingerprints, then connected components.

Words are runs of anything but space and U+0009 to U+000D, after lower-casing A-Z; shingles are
`width` consecutive words joined by a space, repeats included (fewer words: the whole sequence).
A bit of the fingerprint is 1 if it is set in over half of the shingles' XXH64 values (seed 42).
A text without words has fingerprint zero and is linked like any other; null texts are empty.

Links: fingerprints that differ in at most `distance` bits. Fingerprints are first made
distinct, so copies cost nothing. The 64 bits are cut into `distance + intact` blocks; two
linked fingerprints share at least `intact` of them, so joining on every choice of `intact`
blocks finds every link. A block value that more than `limit` fingerprints share is cut again:
its members can only differ in the remaining bits, which get blocks of their own, and so on, so
that no group grows without bound and none is dropped. Within a group every pair is verified by
its Hamming distance in the task; only links go out, and of those a spanning forest.

One row per input row; rows that repeat an id come back as often. A null id never is the
smallest of a component unless it has no other. Empty table: no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import each_batch, free_name, stored, texts_of, whole_groups, without
from hirefunnel.llm.components import smallest_reachable

SEED = 42
#: Groups that differ in so many bits only are never cut; distinct fingerprints bound their size.
LAST_BITS = 12
_BIT = np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, width: int = 3) -> int:
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(len(words) - width + 1, 1)
    view, last = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(view, last, strict=True)]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for k in range(0, n, 1 << 14):
        part = values[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.uint64(1) << _BIT[2 * ones > n]).sum(dtype=np.uint64))


def fingerprints(
    rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3
) -> DataFrame:
    """id, fp: the fingerprint as a signed 64-bit number."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, width) for t in texts_of(batch)], np.uint64)
        columns = [batch.column(0), pa.array(values.view(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["id", "fp"])

    source = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    return each_batch(source, make, "id long, fp long")


def blocks(bits: list[int], distance: int, intact: int) -> list[int]:
    """Masks over the given bits: two values at most `distance` apart agree under one of them."""
    parts = [p for p in np.array_split(np.array(bits, np.uint64), distance + intact) if len(p)]
    if len(parts) < distance + intact:
        return [0]
    masks = [int((np.uint64(1) << p).sum(dtype=np.uint64)) for p in parts]
    return [sum(c) for c in combinations(masks, intact)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(values: DataFrame, distance: int = 3, intact: int = 2, limit: int = 4096) -> DataFrame:
    """Links a, b among distinct fingerprints `fp`: enough to connect whatever is linked."""
    masks = blocks(list(range(64)), distance, intact)
    keyed = values.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    found = None
    while True:
        level = stored(_verified(keyed, distance, limit), "simhash-links")
        here = level.where("mask IS NULL").select("a", "b")
        found = here if found is None else found.unionByName(here)
        large = level.where("mask IS NOT NULL").select(F.col("a").alias("fp"), "mask")
        # A few dozen masks at most. Each level fixes more bits, and a group with LAST_BITS left
        # has no more than 4,096 members and is not cut, so this ends.
        seen = [r["mask"] for r in large.select("mask").distinct().collect()]
        if not seen:
            return found.distinct()
        cuts = [F.when(F.col("mask") == m, _cut_again(m, distance, intact)) for m in seen]
        keyed = large.select("fp", F.explode(F.coalesce(*cuts)).alias("mask")).distinct()


def _cut_again(mask: int, distance: int, intact: int) -> Column:
    """Members of a group agree on its mask: the other bits get blocks of their own."""
    fixed = mask & (2**64 - 1)
    free = [b for b in range(64) if not fixed >> b & 1]
    return F.array(*[F.lit(_signed(fixed | m)) for m in blocks(free, distance, intact)])


def _verified(keyed: DataFrame, distance: int, limit: int) -> DataFrame:
    """Links within groups of one block value; members of larger groups return with their mask."""
    order = ["mask", "key", "fp"]
    keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).select(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, large in whole_groups(batches, ["mask", "key"], max(limit, 1 << LAST_BITS)):
            mask, key, fp = (table.column(c).to_numpy() for c in order)
            new = np.ones(len(fp), bool)
            new[1:] = (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])
            group = np.cumsum(new) - 1
            cut = np.full(len(fp), True) if large else np.bincount(group)[group] > limit
            cut &= np.bitwise_count(mask.view(np.uint64)) <= 64 - LAST_BITS
            a, b = _forest(fp, np.where(cut, -1 - np.arange(len(fp)), group), distance)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.minimum(a, b), fp[cut]])),
                    pa.array(np.concatenate([np.maximum(a, b), fp[cut]])),
                    pa.array([None] * len(a) + mask[cut].tolist(), pa.int64()),
                ],
                names=["a", "b", "mask"],
            )

    dealt = keyed.repartition("mask", "key").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, "a long, b long, mask long")


def _forest(fp: np.ndarray, group: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends of links that connect, within each run of one group, what is close enough."""
    label, left, right = np.arange(len(fp)), [], []
    at, step = np.arange(len(fp)), 0
    while len(at):
        step += 1
        at = at[at + step < len(fp)]
        at = at[group[at] == group[at + step]]
        close = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= distance]
        close = close[label[close] != label[close + step]]
        for i in close.tolist():
            j = i + step
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                left.append(i)
                right.append(j)
    return fp[left], fp[right]


def near_groups(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    distance: int = 3,
    limit: int = 4096,
) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id."""
    prints = stored(fingerprints(rows, id_col, text_col, width), "simhash-prints")
    # min() runs before the shuffle, so a fingerprint that a third of the rows share is cheap.
    values = stored(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-values")
    stars = smallest_reachable(links(values, distance, limit=limit))
    rooted = values.join(stars, F.col("fp") == F.col("node"), "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp")).select("fp", "first", "root")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    label = rooted.join(named, "root").select("fp", "component_id")
    out = prints.join(label, "fp")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def representatives(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the row with the smallest id, with all its columns."""
    if rows.groupBy(f"`{id_col}`").count().where("count > 1").isEmpty():
        groups = near_groups(rows, id_col, text_col)
        same = F.col(id_col).eqNullSafe(F.col("component_id"))
        return without(rows, id_col, groups.where(~same).select(id_col))
    # Rows that share an id are told apart by a number that is written down with them.
    number = free_name(rows.columns, "number")
    numbered = stored(rows.withColumn(number, F.monotonically_increasing_id()), "simhash-rows")
    groups = near_groups(numbered, number, text_col).select(F.col(number).alias("n"), "component_id")
    ids = numbered.select(F.col(number).alias("n"), F.col(f"`{id_col}`").alias("id"))
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("n"))
    named = ids.select("n", order.alias("place")).join(groups, "n")
    first = named.groupBy("component_id").agg(F.min("place").alias("place"))
    gone = ids.select("n").join(first.select("place.n"), "n", "left_anti")
    return without(numbered, number, gone).drop(number)
