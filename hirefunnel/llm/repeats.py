"""Where the same window of symbols occurs more than once: the part that two operators share.

A window is `length` consecutive symbols (bytes or words) of one text. Each window is named by one
of its own grams of `gram` symbols, the one with the smallest hash (the first of equals): its
anchor. Equal windows have equal anchors at equal places, and neighbouring windows mostly share
one, so there are about 2 / (length - gram + 2) anchors per symbol instead of one window each.

`repeated_anchors` finds the anchors whose gram hash occurs again. This only narrows the search:
a collision costs work and nothing else. Equal hashes within a record batch are sure to repeat, so
only one row of them is dealt out by its hash and the others by a hash of their place: a gram that
a third of all texts share reaches no task more often than there are batches.

`contexts` brings anchors back to their texts. A context is the text from the first to the last
window of one anchor; windows are compared inside of contexts with equal gram hashes, exactly, by
the operators. A gram that occurs more than `hot` times could still gather too many contexts in one
task (a common passage in ever new surroundings), so its windows are taken one by one instead, each
a context of its own that is dealt out by the hash of the whole window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirefunnel.llm.common import mixed, partitions, sized_slices, stored, texts_of, whole_groups

#: Symbols that are looked at together; longer texts are cut, with overlap.
SLICE = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)
_FACTOR = 0x9E3779B97F4A7C15
BROADCAST_ROWS = 100_000
#: A batch's row is the only one with its gram there, one of several, or not the first of them.
SINGLE, FIRST, OTHER = 0, 1, 2

Symbols = Callable[[bytes], np.ndarray]


def _powers(base: int) -> np.ndarray:
    out = np.full(SLICE + 4096, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = _powers(_FACTOR), _powers(pow(_FACTOR, -1, 1 << 64))


@dataclass(frozen=True)
class Anchors:
    """By anchor: number of the text, place of the gram, first and last window, gram hash."""

    text: np.ndarray
    at: np.ndarray
    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray


def slice_anchors(symbols: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """at, first, last, hash of the anchors of one slice. ends: where each symbol's text ends."""
    n = len(symbols)
    if n < length:
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * _UP[:n], out=total[1:])
    hashes = mixed((total[gram:] - total[:-gram]) * _DOWN[: n - gram + 1])
    # The place in the low bits makes the minimum its own argument, the first of equals.
    low = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    grams, size = length - gram + 1, 1
    while 2 * size <= grams:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < grams:
        low = np.minimum(low[: size - grams], low[grams - size :])
    window = np.flatnonzero(np.arange(length, n + 1) <= ends[: n - length + 1])
    at = (low[window] & _PLACE).astype(np.int64)
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)
    start = np.flatnonzero(new)
    stop = np.append(start[1:], len(window)) - 1 if len(start) else start
    return at[start], window[start], window[stop], hashes[at[start]]


def anchors(texts: list[np.ndarray], length: int, gram: int) -> Anchors:
    """Anchors of a list of texts, each an array of symbols as 64-bit numbers."""
    found: list[tuple[np.ndarray, ...]] = []
    sizes = np.array([len(t) for t in texts], np.int64)
    for a, b in sized_slices(sizes.tolist(), SLICE):
        if b - a == 1:
            for start in range(0, max(int(sizes[a]) - length + 1, 0), SLICE):
                piece = texts[a][start : start + SLICE + length - 1]
                at, first, last, hashes = slice_anchors(piece, np.full(len(piece), len(piece)), length, gram)
                found.append((np.full(len(at), a), at + start, first + start, last + start, hashes))
            continue
        stops = np.cumsum(sizes[a:b])
        starts = stops - sizes[a:b]
        text = np.repeat(np.arange(b - a), sizes[a:b])
        at, first, last, hashes = slice_anchors(np.concatenate(texts[a:b]), stops[text], length, gram)
        own = text[at]
        found.append((own + a, at - starts[own], first - starts[own], last - starts[own], hashes))
    empty = (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    return Anchors(*[np.concatenate(c) for c in zip(*found or [empty], strict=True)])


def packed(at: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Place, windows before it and windows in all, in one number; lengths stay below 256."""
    return (at << 16) | ((at - first) << 8) | (last - first)


def unpacked(place: int) -> tuple[int, int, int]:
    """at, first, last."""
    at = place >> 16
    first = at - ((place >> 8) & 255)
    return at, first, first + (place & 255)


def repeated_anchors(texts: DataFrame, symbols: Symbols, length: int, gram: int) -> DataFrame:
    """From key, text: gram, key, place of every anchor whose gram hash occurs again."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            found = anchors([symbols(t) for t in texts_of(batch)], length, gram)
            _, first, at, count = np.unique(
                found.gram, return_index=True, return_inverse=True, return_counts=True
            )
            kind = np.where(count[at] > 1, OTHER, SINGLE)
            kind[first[count > 1]] = FIRST
            key, place = keys[found.text], packed(found.at, found.first, found.last)
            spread = mixed(key.view(np.uint64) * np.uint64(_FACTOR) + place.view(np.uint64))
            route = np.where(kind == OTHER, spread, found.gram)
            columns = [route.view(np.int64), found.gram.view(np.int64), key, place * 4 + kind]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["route", "gram", "key", "place"]
            )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Any piece of a group shows whether it has a second row: two rows are enough.
        for table, large in whole_groups(batches, ["route"], 1 << 14):
            route, place = table.column("route").to_numpy(), table.column("place").to_numpy()
            kind, again = place & 3, np.full(len(place), large)
            # Rows of another kind may share a route by chance; they only add a candidate.
            same = route[1:] == route[:-1]
            again[1:] |= same
            again[:-1] |= same
            stays = again | (kind != SINGLE)
            out = table.select(["gram", "key"]).append_column("place", pa.array(place >> 2))
            yield from out.filter(pa.array(stays)).to_batches()

    all_found = texts.mapInArrow(find, "route long, gram long, key long, place long")
    dealt = all_found.repartition("route").sortWithinPartitions("route")
    return dealt.mapInArrow(keep, "gram long, key long, place long")


def keyed_texts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, text, and id where it is another than the key. Keys are the ids where these are unique,
    else numbers in their order.

    Texts are joined twice, to their hits and to their removed spans. Both joins see the same
    columns and the same filter, so that Spark deals the texts out by key once and reads that twice.
    """
    source = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    twice = source.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 OR id IS NULL")
    if twice.isEmpty():
        return source.select(F.col("id").alias("key"), "text").where(F.col("key").isNotNull())
    order = F.col("id").asc_nulls_first()
    ordered = source.repartitionByRange(order, F.xxhash64("text")).sortWithinPartitions(order, "text")
    ordered = ordered.select(F.monotonically_increasing_id().alias("key"), "id", "text")
    return stored(ordered, "repeats-keys")


def contexts(texts: DataFrame, found: DataFrame, hot: int) -> DataFrame:
    """key, text, hits (list of place, gram, hot) of the texts that have repeated anchors."""
    many = found.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > hot)
    many = stored(many, "repeats-hot")
    # At most (number of anchors) / hot rows.
    many = F.broadcast(many) if many.count() <= BROADCAST_ROWS else many
    flagged = found.join(many, "gram", "left").select(
        "key", F.struct("place", "gram", F.col("n").isNotNull().alias("hot")).alias("hit")
    )
    # A list is bounded by the length of its text.
    hits = flagged.groupBy("key").agg(F.collect_list("hit").alias("hits"))
    return texts.select("key", "text").join(hits, "key")


def batch_contexts(
    batch: pa.RecordBatch, whole: Callable[[int, int, int], bytes], length: int
) -> Iterator[tuple[int, int, int, int, int, int]]:
    """number of the text in a batch of `contexts`, group, key, first and last window, anchor.

    `whole` gives the symbols [start, stop) of a text as bytes. Windows are compared with those
    of the same group only.
    """
    lists = batch.column(batch.schema.get_field_index("hits"))
    offsets, flat = lists.offsets.to_pylist(), lists.values
    places, grams, hot = (flat.field(k).to_pylist() for k in range(3))
    for k, key in enumerate(batch.column(0).to_pylist()):
        for i in range(offsets[k], offsets[k + 1]):
            at, first, last = unpacked(places[i])
            if not hot[i]:
                yield k, grams[i], key, first, last, at
                continue
            for p in range(first, last + 1):
                group = xxhash.xxh64_intdigest(whole(k, p, p + length), 7) - (1 << 63)
                yield k, group, key, p, p, p


def with_removed(texts: DataFrame, removed: DataFrame) -> DataFrame:
    """id, text and the list of removed [start, stop) of every text; null if there is none."""
    lists = removed.groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("removed"))
    name = "id" if "id" in texts.columns else "key"
    return texts.join(lists, "key", "left").select(F.col(name).alias("id"), "text", "removed")


def merged_spans(removed: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of a text's removed list, null if there is none."""
    return joined((r["start"], r["stop"]) for r in removed or [])


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: overlapping and touching spans made one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def spans_by_key(spans: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """key, start, stop of the maximal runs of every key. Repeats in a copied text overlap from anchor
    to anchor: of a text that is all copy, one row is left."""
    by_key: dict[int, list[tuple[int, int]]] = {}
    for key, start, stop in spans:
        by_key.setdefault(key, []).append((start, stop))
    return [(key, *span) for key, found in by_key.items() for span in joined(found)]


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def exchange_partitions(found: DataFrame, each: int = 100_000) -> int:
    """Tasks that contexts are dealt to, so that each gets about as many."""
    return max(partitions(found), found.count() // each)
