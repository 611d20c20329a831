"""Suffix-array dedup: a common-prefix-aware distributed merge sort of suffixes.

A byte goes if a string of `length` bytes covers it that also starts earlier: in a text with a
smaller id, or before in the same one. Strings are judged on the input, overlaps count, and none
crosses texts.

Sorting every suffix of a corpus would move it a hundredfold, so the suffix array is sparse: it
has the suffixes that start at repeated anchors (see repeats.py), and every string of `length` bytes
that occurs twice holds one, at the same place in both. Each batch sorts its suffixes and writes
them as front-coded runs: length of the prefix shared with the suffix before, and the rest. Runs
are dealt out by ranges of the gram hash that their suffixes begin with (equal beginnings meet, and
no common beginning fills one task) and merged by a loser tree that carries common prefix lengths
along and compares bytes only beyond them. The merge yields the order and the longest common prefix
of neighbours; sorting what precedes the anchors the same way gives that for the left side. A string
at offset a before its anchor is then equal to another one exactly if both are in the same class of
length - a common bytes on the right and a on the left, and the first of a class stays.

Contexts that are equal byte by byte within a batch are folded into the first of them beforehand;
all strings of the others are repeats. What a task finds of one text leaves it as maximal runs.

Null texts are empty. Texts shorter than `length` lose nothing. Rows that share an id are separate
texts, in order of their text; null ids come first. Empty table: no rows. Other columns stay unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from hirefunnel.llm.common import each_batch, stored, texts_of
from hirefunnel.llm.repeats import (
    batch_contexts,
    contexts,
    exchange_partitions,
    keyed_texts,
    merged_spans,
    repeated_anchors,
    spans_by_key,
    with_removed,
)

LENGTH, GRAM = 100, 32
#: Anchors that occur more often are taken window by window.
HOT = 20_000
_SPREAD = np.random.default_rng(2024).integers(0, 1 << 63, 256, np.int64).view(np.uint64)
_END = 1 << 64
Suffix = tuple[int, bytes, bytes, int, int]  # group, from the anchor on, before it reversed, key, at


def byte_symbols(text: bytes) -> np.ndarray:
    return _SPREAD[np.frombuffer(text, np.uint8)]


def common_length(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which `known` bytes need no comparison."""
    most = min(len(a), len(b))
    if a[known:most] == b[known:most]:
        return most
    low, high = known, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Run:
    """Sorted suffixes, front-coded."""

    def __init__(self, suffixes: list[Suffix], shared: list[int]) -> None:
        self.suffixes, self.shared = suffixes, shared

    @classmethod
    def of(cls, suffixes: list[Suffix]) -> Run:
        suffixes.sort()
        shared, before = [], (None, b"")
        for s in suffixes:
            shared.append(common_length(before[1], s[1]) if before[0] == s[0] else 0)
            before = s
        return cls(suffixes, shared)

    def encoded(self) -> bytes:
        columns = zip(*self.suffixes, strict=True)
        group, right, left, key, at = columns
        n = len(group)
        parts = [
            np.array([n], "<i8").tobytes(),
            np.array(group, "<i8").tobytes(),
            np.array(key, "<i8").tobytes(),
            np.array(at, "<i8").tobytes(),
            bytes(self.shared),
            bytes(map(len, right)),
            bytes(map(len, left)),
            b"".join([r[k:] for r, k in zip(right, self.shared, strict=True)]),
            b"".join(left),
        ]
        return zstandard.compress(b"".join(parts), 3)

    @classmethod
    def decoded(cls, data: bytes) -> Run:
        data = zstandard.decompress(data)
        n = int(np.frombuffer(data, "<i8", 1)[0])
        group, key, at = (np.frombuffer(data, "<i8", n, 8 + 8 * n * k).tolist() for k in range(3))
        place = 8 + 24 * n
        shared, right_size, left_size = (list(data[place + n * k : place + n * (k + 1)]) for k in range(3))
        place += 3 * n
        rights, before = [], b""
        for k, size in zip(shared, right_size, strict=True):
            before = before[:k] + data[place : place + size - k]
            place += size - k
            rights.append(before)
        lefts = []
        for size in left_size:
            lefts.append(data[place : place + size])
            place += size
        return cls(list(zip(group, rights, lefts, key, at, strict=True)), shared)


def merge(runs: list[Run]) -> tuple[list[Suffix], list[int]]:
    """All suffixes in order, each with the length of the prefix it shares with the one before.

    A loser tree in which every waiting suffix knows how much it shares with the last one given
    out. Of two in the same group, the one that shares more comes first and nothing is compared; if
    both share as much, comparison starts there, and what is found becomes known to the loser.
    """
    size = 1
    while size < len(runs):
        size *= 2
    group, right, known, place = [_END] * size, [b""] * size, [0] * size, [0] * size
    for r, run in enumerate(runs):
        if run.suffixes:
            group[r], right[r] = run.suffixes[0][:2]
    loser = [0] * size

    def first(a: int, b: int) -> bool:
        """Whether a comes before b; the other one's known prefix is brought up to date."""
        if group[a] != group[b]:
            known[b if group[a] < group[b] else a] = 0
            return group[a] < group[b]
        if known[a] != known[b]:
            return known[a] > known[b]
        x, y = right[a], right[b]
        k = common_length(x, y, known[a])
        before = x[k:] <= y[k:]
        known[b if before else a] = k
        return before

    winners = list(range(size))
    while len(winners) > 1:
        half, level = len(winners) // 2, []
        for i in range(half):
            a, b = winners[2 * i], winners[2 * i + 1]
            a, b = (a, b) if first(a, b) else (b, a)
            loser[half + i] = b
            level.append(a)
        winners = level
    now = winners[0]
    suffixes: list[Suffix] = []
    shared: list[int] = []
    while group[now] != _END:
        run, at = runs[now], place[now]
        suffixes.append(run.suffixes[at])
        shared.append(known[now])
        at += 1
        place[now] = at
        if at < len(run.suffixes):
            group[now], right[now] = run.suffixes[at][:2]
            known[now] = run.shared[at]
        else:
            group[now], known[now] = _END, 0
        node = (now + size) >> 1
        while node:
            other = loser[node]
            if not first(now, other):
                loser[node], now = now, other
            node >>= 1
    return suffixes, shared


def repeats(suffixes: list[Suffix], shared: list[int], length: int) -> Iterator[tuple[int, int, int]]:
    """key, start, stop of what repeats an earlier string, from merged suffixes."""
    group = np.array([s[0] for s in suffixes], np.int64)
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    number = np.cumsum(new) - 1
    keep = np.flatnonzero(np.bincount(number)[number] > 1)  # a group of one repeats nothing
    if not len(keep):
        return
    suffixes = [suffixes[i] for i in keep.tolist()]
    new, number, right = new[keep], number[keep], np.array(shared, np.int64)[keep]
    left_text = [s[2] for s in suffixes]
    groups = number.tolist()
    order = sorted(range(len(suffixes)), key=lambda i: (groups[i], left_text[i]))
    left = np.array(
        [0] + [common_length(left_text[a], left_text[b]) for a, b in zip(order, order[1:], strict=False)]
    )
    order = np.array(order)
    new_left = np.ones(len(order), bool)
    new_left[1:] = number[order][1:] != number[order][:-1]
    key = np.array([s[3] for s in suffixes], np.int64)
    at = np.array([s[4] for s in suffixes], np.int64)
    left_size = np.array([len(x) for x in left_text])
    right_size = np.array([len(s[1]) for s in suffixes])
    by_place = np.lexsort((at, key))
    n = len(suffixes)
    left_class = np.empty(n, np.int64)
    # By suffix and offset, with an empty column on either side: what repeats an earlier string.
    again = np.zeros((n, int(left_size.max()) + 3), np.int8)
    for a in range(int(left_size.max()) + 1):
        has = (left_size >= a) & (right_size >= length - a)
        left_class[order] = np.cumsum(new_left | (left < a))
        both = np.cumsum(new | (right < length - a)) * (n + 1) + left_class
        members = by_place[has[by_place]]
        _, first = np.unique(both[members], return_index=True)
        again[members, a + 1] = 1
        again[members[first], a + 1] = 0
    edge = np.diff(again, axis=1)
    owner, least = np.nonzero(edge == 1)
    _, beyond = np.nonzero(edge == -1)
    start, stop = at[owner] - beyond + 1, at[owner] - least + length
    yield from zip(key[owner].tolist(), start.tolist(), stop.tolist(), strict=True)


def removed_spans(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """id, text, removed: lists of start and stop (bytes), which may overlap; null if none."""
    texts = keyed_texts(rows, id_col, text_col)
    found = stored(repeated_anchors(texts, byte_symbols, length, gram), "suffix-anchors")
    tasks = exchange_partitions(found)
    schema = "part long, run binary, key long, start long, stop long"

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = texts_of(batch)
            folded: dict[tuple[int, bytes, bytes], tuple[int, int]] = {}
            again: list[tuple[int, int, int]] = []
            for k, group, key, first, last, at in batch_contexts(
                batch, lambda k, a, b: body[k][a:b], length
            ):
                text = body[k]
                name = group, text[at : last + length], text[first:at][::-1]
                mine = key, at
                other = folded.get(name)
                if other is None or mine < other:
                    folded[name] = mine
                if other is not None:
                    late = max(mine, other)
                    again.append((late[0], late[1] + first - at, late[1] + last - at + length))
            parts: dict[int, list[Suffix]] = {}
            for name, place in folded.items():
                parts.setdefault(name[0] % (16 * tasks), []).append(name + place)
            runs = [Run.of(p).encoded() for p in parts.values()]
            spans = spans_by_key(again)
            n, m = len(runs), len(spans)
            key, start, stop = zip(*spans, strict=True) if spans else ((), (), ())
            columns = [
                pa.array([*parts, *[k % (16 * tasks) for k in key]], pa.int64()),
                pa.array(runs + [None] * m, pa.binary()),
                *[pa.array([None] * n + list(c), pa.int64()) for c in (key, start, stop)],
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "run", "key", "start", "stop"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs: list[Run] = []
        for batch in batches:
            data = batch.column(1)
            runs += [Run.decoded(x) for x in data.drop_null().to_pylist()]
            yield batch.filter(data.is_null()).select(["key", "start", "stop"])
        merged = spans_by_key(repeats(*merge(runs), length)) if runs else []
        columns = [pa.array(c, pa.int64()) for c in (zip(*merged, strict=True) if merged else ((),) * 3)]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "stop"])

    sorted_runs = contexts(texts, found, hot).mapInArrow(sort, schema).repartition(tasks, "part")
    removed = sorted_runs.mapInArrow(combine, "key long, start long, stop long")
    return with_removed(texts, removed).withColumnRenamed("id", id_col)


def kept(text: bytes, removed: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal removed runs."""
    out, at, runs = [], 0, merged_spans(removed)
    for start, stop in runs:
        out.append(text[at:start])
        at = stop
    return b"".join([*out, text[at:]]), runs


def digests(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256 of every text."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, removed in zip(texts_of(batch), batch.column(2).to_pylist(), strict=True):
            left, runs = kept(text, removed)
            out.append((len(text), len(text) - len(left), len(runs), hashlib.sha256(left).hexdigest()))
        n, gone, count, sha = zip(*out, strict=True)
        columns = [batch.column(0), *[pa.array(c, pa.int64()) for c in (n, gone, count)], pa.array(sha)]
        return pa.RecordBatch.from_arrays(
            columns, names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        )

    spans = removed_spans(rows, id_col, text_col, **options)
    made = each_batch(spans, make, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return made.withColumnRenamed("id", id_col)
