"""Ranked lexical search: K2-treaps over grids of terms and documents.

The terms of a block of items are the rows of a grid, documents its columns, and a cell holds the
impact of a term in a document. Documents are dealt into ranges; a task keeps the grid of one range
as a quadtree whose non-empty quadrants alone are stored, level by level: a mask of the four
quadrants, the place of the first child, and the largest impact below. To answer an item, the paths
of its rows descend together, best first: a range of documents is bounded by the sum of its rows'
largest impacts, times their weights; the ranges with the best bounds are halved first, and a range
is given up once its bound cannot beat the k-th best document. A range of one document has its exact
score, so the result is exact, whatever the order. Each range hands on its k best documents per item
and a window keeps the k best of all.

Documents are read twice per block of items: once for the counts of the block's terms, which are
stored, and these once more to be searched, after the totals and document frequencies are known.
Items are taken in blocks of about `block_bytes` of text, so what is sent to the tasks is bounded.
Impacts and scores are 64-bit integers, weights are floored logarithms of doubles.

Odd input: a null or empty text has no term and is never found; it does not count as a document. An
item without terms, or with none that occurs, has no rows. Terms of any length and texts of any
length are taken whole. Every row of documents and of items counts on its own: repeated rows are
ranked one after the other, equal scores by ascending doc_id, a null doc_id last. A repeated item_id
gets one ranking per row. No documents or no items give no rows. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirefunnel.llm.common import each_batch, only, stored, texts_of

# Text of the items that are searched at once.
BLOCK_BYTES = 2 << 20
# Cells and documents of one grid: about 100 MB of tree at the most.
GRID_CELLS = 1 << 20
GRID_DOCS = 1 << 16
# Rows are this many bits apart, so that quadrants of up to 2**ROW_GAP documents hold one term.
ROW_GAP = 6
# Ranges that are halved in one step.
AT_ONCE = 128

# Terms are runs of ASCII letters and digits and of all bytes from 0x80 up; only A-Z is lowered.
_TERM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)
_ONES = np.array([m.bit_count() for m in range(16)], dtype=np.int64)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(tf: np.ndarray, n_terms: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    """Impact of each cell: how often the term occurs, against the length of its document."""
    if int(n_terms.max(initial=0)) * n_docs * 25 < 2**63:
        m = 75 + 25 * n_terms * n_docs // all_terms
    else:
        m = np.array([75 + 25 * int(n) * n_docs // all_terms for n in n_terms], dtype=np.int64)
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _spread(x: np.ndarray) -> np.ndarray:
    """Bits of numbers below 2**32 moved to the even places."""
    x = x.astype(np.uint64)
    # Each step halves the blocks of bits that still stand together.
    for shift in (16, 8, 4, 2, 1):
        ones = (1 << shift) - 1
        mask = sum(ones << (2 * shift * k) for k in range(32 // shift))
        x = (x | (x << np.uint64(shift))) & np.uint64(mask & (2**64 - 1))
    return x


class Treap:
    """The quadtree of one grid. Node 0 stands for every empty quadrant."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray):
        gap = min(ROW_GAP, max(1, int(columns.max()).bit_length()))
        self.gap = gap
        self.levels = max(int(columns.max()).bit_length(), int(rows.max()).bit_length() + gap, 1)
        codes = _spread(rows.astype(np.uint64) << np.uint64(gap)) << np.uint64(1) | _spread(columns)
        order = np.argsort(codes)
        codes, values = codes[order], values[order].astype(np.int32)
        masks, firsts, highest = [np.zeros(1, np.uint8)], [np.zeros(1, np.int32)], [np.zeros(1, np.int32)]
        masks.append(np.zeros(len(codes), np.uint8))
        firsts.append(np.zeros(len(codes), np.int32))
        highest.append(values)
        begin, end = 1, 1 + len(codes)
        for _ in range(self.levels):
            parent = codes >> np.uint64(2)
            starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            quadrant = np.left_shift(1, (codes & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            masks.append(np.bitwise_or.reduceat(quadrant, starts))
            firsts.append((begin + starts).astype(np.int32))
            values = np.maximum.reduceat(values, starts)
            highest.append(values)
            codes = parent[starts]
            begin, end = end, end + len(codes)
        self.mask, self.first, self.highest = map(np.concatenate, (masks, firsts, highest))
        self.root = end - 1

    def search(self, rows: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k columns with the largest sums of weighted impacts over these rows, and the sums;
        larger sums first, then smaller columns; sums above 0 only."""
        rows = rows.astype(np.int64) << self.gap
        node = np.full((1, len(rows)), self.root, dtype=np.int32)
        level, start = np.array([self.levels]), np.array([0])
        bound = (self.highest[node].astype(np.int64) * weights).sum(axis=1)
        best, columns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(bound):
            if len(best) == k:
                open_ = (bound > best[-1]) | ((bound == best[-1]) & (start < columns[-1]))
                if not open_.all():
                    node, level, start, bound = node[open_], level[open_], start[open_], bound[open_]
                    if not len(bound):
                        break
            if len(bound) > AT_ONCE:
                order = np.argpartition(bound, len(bound) - AT_ONCE)
                rest, now = order[:-AT_ONCE], order[-AT_ONCE:]
                kept = node[rest], level[rest], start[rest], bound[rest]
                node, level, start = node[now], level[now], start[now]
            else:
                kept = None
            down = level - 1
            lower = ((rows >> down[:, None]) & 1) << 1
            mask, first = self.mask[node].astype(np.int64), self.first[node].astype(np.int64)
            halves = []
            for half in (0, 1):
                quadrant = lower | half
                child = first + _ONES[mask & ((1 << quadrant) - 1)]
                child = np.where((mask >> quadrant) & 1, child, 0).astype(np.int32)
                total = (self.highest[child].astype(np.int64) * weights).sum(axis=1)
                some = total > 0
                at = start + (half << down)
                halves.append((child[some], down[some], at[some], total[some]))
            node, level, start, bound = (np.concatenate(x) for x in zip(*halves, strict=True))
            done = level == 0
            if done.any():
                best, columns = np.concatenate([best, bound[done]]), np.concatenate([columns, start[done]])
                order = np.lexsort((columns, -best))[:k]
                best, columns = best[order], columns[order]
                open_ = ~done
                node, level, start, bound = node[open_], level[open_], start[open_], bound[open_]
            if kept is not None:
                node, level, start, bound = (
                    np.concatenate(x) for x in zip(kept, (node, level, start, bound), strict=True)
                )
        return columns, best


def counted(docs: DataFrame, rows: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, its number of terms, and how often each known term occurs."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, n, found, tf, ends = [], [], [], [], [0]
        doc_ids = batch.column(0).to_pylist()
        for doc_id, text in zip(doc_ids, texts_of(batch), strict=True):
            words = terms(text)
            if not words:
                continue
            seen = Counter(map(rows.get, words))
            seen.pop(None, None)
            ids.append(doc_id)
            n.append(len(words))
            found.extend(seen.keys())
            tf.extend(seen.values())
            ends.append(len(found))
        ends = pa.array(ends, pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids, pa.int64()),
                pa.array(n, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(found, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64())),
            ],
            ["doc_id", "n", "term", "tf"],
        )

    return each_batch(
        only(docs, "doc_id", "text"), count, "doc_id long, n long, term array<int>, tf array<long>"
    )


def _ranges(batches: Iterator[pa.RecordBatch], cells: int, docs: int) -> Iterator[pa.Table]:
    """Documents in tables of at most `docs` rows and about `cells` counts."""
    held: list[pa.RecordBatch] = []
    size = n = 0
    for batch in batches:
        ends = batch.column(2).offsets.to_numpy()
        at = 0
        while at < batch.num_rows:
            room = min(docs - n, batch.num_rows - at)
            fits = int(np.searchsorted(ends, ends[at] + cells - size, side="right")) - 1 - at
            take = max(min(room, fits), 0 if held else 1)
            if take:
                held.append(batch.slice(at, take))
                n, size = n + take, size + int(ends[at + take] - ends[at])
                at += take
            if at < batch.num_rows or n >= docs or size >= cells:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, n = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _searched(
    table: pa.Table, items: list[tuple], weights: np.ndarray, n_docs: int, all_terms: int, k: int
) -> Iterator[tuple[int, int | None, np.ndarray, np.ndarray]]:
    """Item number, item_id, and ids and scores of its best documents within one range."""
    # Columns in the order that breaks ties: by doc_id, a null last.
    table = table.take(pa.compute.sort_indices(table, sort_keys=[("doc_id", "ascending")], null_placement="at_end"))
    table = table.combine_chunks()
    if not table.num_rows:
        return
    ids = table.column("doc_id").chunk(0)
    term, tf = (pa.compute.list_flatten(table.column(c)).to_numpy() for c in ("term", "tf"))
    if not len(term):
        return
    column = np.repeat(np.arange(table.num_rows), pa.compute.list_value_length(table.column("term")).to_numpy())
    n_terms = table.column("n").to_numpy()
    treap = Treap(term, column, impacts(tf, n_terms[column], n_docs, all_terms))
    here = np.zeros(len(weights), dtype=bool)
    here[term] = True
    for item, item_id, rows, times in items:
        used = here[rows] & (weights[rows] > 0)
        if not used.any():
            continue
        columns, scores = treap.search(rows[used], weights[rows[used]] * times[used], k)
        yield item, item_id, ids.take(pa.array(columns)), scores


def _block(docs: DataFrame, items: list, k: int, grid_cells: int, grid_docs: int) -> DataFrame:
    """The k best documents per range for a block of items: item, item_id, doc_id, score."""
    rows: dict[bytes, int] = {}
    wanted = []
    for item, item_id, text in items:
        times = Counter(terms(text))
        numbers = [rows.setdefault(t, len(rows)) for t in times]
        wanted.append((item, item_id, np.array(numbers, np.int64), np.array(list(times.values()), np.int64)))
    counts = stored(counted(docs, rows), "lexical-counts")
    totals = counts.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    # One row per term of the block.
    frequency = dict(counts.select(F.explode("term").alias("t")).groupBy("t").count().collect())
    weights = np.array([weight(totals.docs, frequency.get(r, 0)) for r in range(len(rows))], dtype=np.int64)
    schema = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _ranges(batches, grid_cells, grid_docs):
            for item, item_id, ids, scores in _searched(table, wanted, weights, totals.docs, totals.terms, k):
                n = len(scores)
                arrays = [pa.array([item] * n, pa.int64()), pa.array([item_id] * n, pa.int64()), ids, pa.array(scores)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    # As few tasks as there are full grids, but one per core: small grids are searched in vain.
    cells = sum(frequency.values())
    tasks = max(-(-cells // grid_cells), counts.sparkSession.sparkContext.defaultParallelism)
    return counts.coalesce(tasks).mapInArrow(search, "item long, item_id long, doc_id long, score long")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    block_bytes: int = BLOCK_BYTES,
    grid_cells: int = GRID_CELLS,
    grid_docs: int = GRID_DOCS,
) -> DataFrame:
    """item_id, rank from 1, doc_id and score of the k best documents for each item."""
    numbered = stored(
        only(items, "item_id", "text").withColumn("item", F.monotonically_increasing_id()), "lexical-items"
    )
    size = numbered.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    n_blocks = max(1, min(-(-size[0] // block_bytes), size[1]))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    found = None
    for b in range(n_blocks):
        # A block is bounded by its bytes; its texts and their terms are what the tasks get.
        chosen = numbered.where(block == b).select("item", "item_id", F.col("text").cast("binary"))
        some = [(r.item, r.item_id, bytes(r.text or b"")) for r in chosen.collect()]
        best = _block(docs, some, k, grid_cells, grid_docs)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("item_id", "rank", "doc_id", "score")
