"""Substring dedup with suffix automata of reference shards.

A word goes if a window of `length` words covers it whose words, in their order, also start
anywhere else, in the same text or another: every occurrence goes, not only later ones. Words are
runs of anything but space and U+0009 to U+000D, compared unchanged; windows are judged on the input.

The reference is the corpus itself. One automaton of it all would fit no task and streaming every
text past every shard would square the work, so both are narrowed first: only contexts of repeated
anchors (repeats.py) can hold a repeated window, and equal windows have the same anchor. Contexts are
dealt out by their anchor's gram; each task builds the automata of its shards, of at most
`shard_words` words or one gram, and streams the shard's contexts through them. Matching statistics
say how long the match that ends at each word is, and the state of its last `length` words how often
these occur. What is shipped is a shard with the texts that can match it, in place of a broadcast
whose size would grow with the corpus.

Equal contexts enter an automaton once, with the number of their places as weight, so a passage
that a third of all texts share is streamed once per batch. The automaton of a batch's contexts with
several places judges all their places but the first, which need no exchange; the first goes with
the weight of all to the automaton of its gram. A gram with a single place has nothing to match.

Null texts have no words. Texts shorter than `length` lose nothing. Rows that share an id are separate
texts, and copies of each other if equal; null ids as well. Empty table: no rows. Other columns stay
unread.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

from hirefunnel.llm.common import each_batch, stored, texts_of, whole_groups
from hirefunnel.llm.repeats import (
    batch_contexts,
    contexts,
    exchange_partitions,
    keyed_texts,
    merged_spans,
    repeated_anchors,
    runs,
    spans_by_key,
    with_removed,
)

LENGTH, GRAM = 35, 18
#: Grams that occur more often are taken window by window, so a gram has no more contexts.
HOT = 4096
#: Small automata stay in the processor's cache: 4,000 words take half the time a word of 100,000.
SHARD_WORDS = 4_000
KNOWN_WORDS = 1 << 20


class WordSymbols(dict):
    """A 64-bit number for each word, kept up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def __call__(self, text: bytes) -> np.ndarray:
        return np.array(list(map(self.__getitem__, text.split())), np.uint64)


class Automaton:
    """Suffix automaton of several sequences with the number of places of every state's strings."""

    def __init__(self) -> None:
        self.size, self.link = [0], [-1]
        self.step: list[dict[int, int]] = [{}]
        self.count = [0]

    def add(self, sequence: list[int], weight: int = 1) -> None:
        last = 0
        for symbol in sequence:
            last = self._extended(last, symbol)
            self.count[last] += weight

    def _new(self, size: int, link: int, step: dict[int, int]) -> int:
        self.size.append(size)
        self.link.append(link)
        self.step.append(step)
        self.count.append(0)
        return len(self.size) - 1

    def _extended(self, last: int, symbol: int) -> int:
        size, link, step = self.size, self.link, self.step
        there = step[last].get(symbol)
        if there is not None:  # another sequence went this way
            return there if size[there] == size[last] + 1 else self._cloned(last, symbol, there)
        now = self._new(size[last] + 1, 0, {})
        at = last
        while at >= 0 and symbol not in step[at]:
            step[at][symbol] = now
            at = link[at]
        if at >= 0:
            there = step[at][symbol]
            link[now] = there if size[there] == size[at] + 1 else self._cloned(at, symbol, there)
        return now

    def _cloned(self, at: int, symbol: int, there: int) -> int:
        step = self.step
        clone = self._new(self.size[at] + 1, self.link[there], dict(step[there]))
        self.link[there] = clone
        while at >= 0 and step[at].get(symbol) == there:
            step[at][symbol] = clone
            at = self.link[at]
        return clone

    def counted(self) -> Automaton:
        """Pass counts on to shorter strings; after this nothing may be added."""
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            self.count[self.link[state]] += self.count[state]
        return self

    def matches(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """After each symbol: the state and the length of the longest match that ends there."""
        state = length = 0
        for symbol in sequence:
            while state and symbol not in self.step[state]:
                state = self.link[state]
                length = self.size[state]
            if symbol in self.step[state]:
                state = self.step[state][symbol]
                length += 1
            yield state, length

    def repeated(self, sequence: list[int], length: int) -> np.ndarray:
        """For each window of `length` symbols of a sequence: whether it has two places or more."""
        out = np.zeros(max(len(sequence) - length + 1, 0), bool)
        for end, (state, matched) in enumerate(self.matches(sequence)):
            if matched >= length:
                while self.size[self.link[state]] >= length:
                    state = self.link[state]
                out[end - length + 1] = self.count[state] > 1
        return out


def repeated_runs(
    groups: list[list[tuple[bytes, int]]], length: int, shard_words: int = SHARD_WORDS
) -> Iterator[list[tuple[int, int]]]:
    """First and last window of the repeated runs of each context, in order.

    A group has the contexts that can match each other, each with the number of its places; it is
    never in two shards.
    """
    shard: list[tuple[list[int], int]] = []
    words = 0

    def flush() -> Iterator[list[tuple[int, int]]]:
        automaton = Automaton()
        for sequence, weight in shard:
            automaton.add(sequence, weight)
        automaton.counted()
        for sequence, _ in shard:
            yield runs(automaton.repeated(sequence, length))

    ids: dict[bytes, int] = {}
    for group in groups:
        if words and words + sum(c.count(b" ") + 1 for c, _ in group) > shard_words:
            yield from flush()
            shard, words, ids = [], 0, {}
        for context, weight in group:
            sequence = [ids.setdefault(w, len(ids)) for w in context.split(b" ")]
            shard.append((sequence, weight))
            words += len(sequence)
    yield from flush()


def removed_spans(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    hot: int = HOT,
) -> DataFrame:
    """id, text, removed: lists of start and stop (words), which may overlap; null if none."""
    texts = keyed_texts(rows, id_col, text_col)
    found = stored(repeated_anchors(texts, WordSymbols(), length, gram), "automaton-anchors")
    tasks = exchange_partitions(found)
    schema = "part long, context binary, n long, key long, start long, stop long"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [t.split() for t in texts_of(batch)]
            folded: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
            for k, group, key, first, last, _ in batch_contexts(
                batch, lambda k, a, b: b" ".join(words[k][a:b]), length
            ):
                stop = last + length
                name = group, b" ".join(words[k][first:stop])
                folded.setdefault(name, []).append((key, first, stop))
            several = [(name, places) for name, places in folded.items() if len(places) > 1]
            judged = repeated_runs([[(c, len(places))] for (_, c), places in several], length)
            done = spans_by_key(
                (key, start + a, start + b + length)
                for (_, places), spans in zip(several, judged, strict=True)
                for a, b in spans
                for key, start, _ in places[1:]
            )
            rows = [places[0] for places in folded.values()] + done
            m = len(done)
            columns = [
                pa.array([g for g, _ in folded] + [key for key, _, _ in done], pa.int64()),
                pa.array([c for _, c in folded] + [None] * m, pa.binary()),
                pa.array([len(places) for places in folded.values()] + [0] * m, pa.int64()),
                *[pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ((),) * 3)],
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["part", "context", "n", "key", "start", "stop"]
            )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A gram has at most `hot` contexts, so its rows can wait for each other.
        for table, _ in whole_groups(batches, ["part"], 1 << 40):
            done = pc.is_null(table.column("context"))
            yield from table.filter(done).select(["key", "start", "stop"]).to_batches()
            part, context, n, key, start, _ = (
                c.to_pylist() for c in table.filter(pc.invert(done)).columns
            )
            groups: dict[int, dict[bytes, list[tuple[int, int]]]] = {}
            weights: Counter[tuple[int, bytes]] = Counter()
            for p, c, weight, *place in zip(part, context, n, key, start, strict=True):
                groups.setdefault(p, {}).setdefault(c, []).append(tuple(place))
                weights[p, c] += weight
            shared = {
                p: group
                for p, group in groups.items()
                if len(group) > 1 or any(weights[p, c] > 1 for c in group)
            }
            judged = repeated_runs(
                [[(c, weights[p, c]) for c in group] for p, group in shared.items()], length
            )
            members = (places for group in shared.values() for places in group.values())
            spans = spans_by_key(
                (key, start + a, start + b + length)
                for places, repeated in zip(members, judged, strict=True)
                for a, b in repeated
                for key, start in places
            )
            columns = [pa.array(c, pa.int64()) for c in (zip(*spans, strict=True) if spans else ((),) * 3)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "stop"])

    folded = contexts(texts, found, hot).mapInArrow(fold, schema)
    dealt = folded.repartition(tasks, "part").sortWithinPartitions("part")
    removed = dealt.mapInArrow(match, "key long, start long, stop long")
    return with_removed(texts, removed).withColumnRenamed("id", id_col)


def kept(text: bytes, removed: list[dict] | None) -> tuple[list[bytes], int]:
    """The words that are left, and how many there were."""
    words, out, at = text.split(), [], 0
    for start, stop in merged_spans(removed):
        out += words[at:start]
        at = stop
    return out + words[at:], len(words)


def digests(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of every text; kept words joined by one space."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, removed in zip(texts_of(batch), batch.column(2).to_pylist(), strict=True):
            left, n = kept(text, removed)
            out.append((n, n - len(left), hashlib.sha256(b" ".join(left)).hexdigest()))
        n, gone, sha = zip(*out, strict=True)
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)]
        return pa.RecordBatch.from_arrays(columns, names=["id", "n_words", "n_removed", "kept_sha256"])

    spans = removed_spans(rows, id_col, text_col, **options)
    made = each_batch(spans, make, "id long, n_words long, n_removed long, kept_sha256 string")
    return made.withColumnRenamed("id", id_col)
