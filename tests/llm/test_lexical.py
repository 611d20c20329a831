"""Ranked search against the definition, the tree against plain sums, odd documents and items."""

import math
import random
import re

import numpy as np
import pytest

from hirefunnel.llm import lexical
from llm import fixtures as fx

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def plain(docs, items, k=20):
    """item_id, rank, doc_id, score by the definition; docs and items are (id, text) rows."""
    bags = [(i, terms(t)) for i, t in docs if terms(t)]
    n_docs, total = len(bags), sum(len(b) for _, b in bags)
    sets = [set(b) for _, b in bags]
    dfs = {t: sum(t in s for s in sets) for _, text in items for t in terms(text)}
    out = []
    for item_id, text in items:
        found = []
        for doc_id, bag in bags:
            m, score = 100 - 25 + (25 * len(bag) * n_docs) // total, 0
            for term in terms(text):
                df, tf = dfs[term], bag.count(term)
                if tf:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 12 * m))
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item_id, n + 1, d, -s) for n, (s, _, d) in enumerate(found[:k])]
    return sorted(out, key=repr)


def items(spark, rows):
    rows = [(i, t, 1, 2, 3) for i, t in rows]
    return spark.createDataFrame(rows, "item_id long, text string, item long, score long, `a.b` int")


def check(spark, docs, wanted, **options):
    frame = spark.createDataFrame(
        [(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n long, `rank` int"
    )
    got = lexical.ranked(frame, items(spark, wanted), **options)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, wanted, options.get("k", 20))


def test_terms_are_cut_as_defined():
    every = "".join(chr(c) + "x" for c in range(0x250)) + "日本ÀÉ😀 end"
    assert lexical.terms(every.encode()) == [t.encode() for t in terms(every)]


def corpus(n=150, seed=3):
    pick = random.Random(seed)
    return [(i, fx.words(pick.randrange(1, 80), i, 60)) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [250, 1 << 20])
def test_ranking(spark, block_bytes):
    wanted = [(i, fx.words(25, 1000 + i, 70)) for i in range(6)]
    check(spark, corpus(), wanted, block_bytes=block_bytes, k=7)


def test_grids_of_any_size_give_one_result(spark):
    wanted = [(i, fx.words(25, 1000 + i, 70)) for i in range(4)]
    for cells, docs in ((1, 1), (100, 1000), (10**6, 7)):
        check(spark, corpus(60), wanted, k=5, grid_cells=cells, grid_docs=docs)


def test_odd_documents_and_items(spark):
    docs = [(i, t) for i, t in enumerate(fx.odd_texts()) if len(t or "") < 100_000]
    # Copies that tie beyond the k-th place, rows that share an id, ids that are null.
    docs += [(200 - i, "tie breaker w1x") for i in range(40)] + [(3, "one two"), (3, "one two"), (None, "one")]
    wanted = [(0, "one ONE été 日本語"), (1, None), (2, ""), (3, "#$% ..."), (4, "tie w1x"), (4, "tie w1x")]
    wanted += [(5, fx.passage(1)), (6, "absent"), (None, "one"), (7, "endoftext end x")]
    check(spark, docs, wanted)


def test_very_long_text_is_counted_whole(spark):
    long = fx.words(60_000, 9, 300) + " last"
    check(spark, [(1, long), (2, "last word"), (3, "other")], [(1, "last"), (2, "w5x last other")])


def test_empty_tables(spark):
    check(spark, [], [(1, "a")])
    check(spark, [(1, "a")], [])
    check(spark, [(1, None)], [(1, "a")])


@pytest.mark.parametrize("seed", range(8))
def test_tree_equals_plain_sums(seed):
    pick = np.random.default_rng(seed)
    n_rows, n_columns = int(pick.integers(1, 40)), int(pick.integers(1, 3000))
    dense = pick.integers(0, 50, (n_rows, n_columns)) * (pick.random((n_rows, n_columns)) < 0.1)
    dense[0, 0] = 1
    rows, columns = np.nonzero(dense)
    tree = lexical.Treap(rows, columns, dense[rows, columns])
    for _ in range(10):
        wanted = pick.choice(n_rows, int(pick.integers(1, n_rows + 1)), replace=False)
        weights = pick.integers(1, 9, len(wanted))
        sums = weights @ dense[wanted]
        best = sorted((-s, c) for c, s in enumerate(sums.tolist()) if s > 0)[:20]
        got, scores = tree.search(wanted, weights, 20)
        assert list(zip((-scores).tolist(), got.tolist())) == best
