from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from llm.fixtures import empty, odd, repeated_rows, table, words

from hirefunnel.llm import mixing


def wanted(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    target, free, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while free and left > 1e-9:
        share = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += share * weight[s]
        over = {s for s in free if target[s] >= 2 * sizes[s]}
        left = sum(target[s] - 2 * sizes[s] for s in over)
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


@given(st.lists(st.floats(0.001, 0.999), max_size=40), st.integers(0, 99))
def test_pivot_rounds_all_but_one_and_keeps_the_sum(fractions, seed):
    out, left = mixing.pivot(fractions, list(range(len(fractions))), seed)
    assert all(x in (0.0, 1.0) for k, x in enumerate(out) if k != left)
    assert abs(sum(out) - sum(fractions)) < 1e-6


def test_pivot_keeps_expectations():
    fractions, total = [0.1, 0.5, 0.7, 0.7], [0.0] * 4
    for seed in range(4000):
        out, left = mixing.pivot(fractions, [11, 12, 13, 14], seed)
        assert left < 0 or abs(out[left] - round(out[left])) < 1e-9
        total = [t + x for t, x in zip(total, out, strict=True)]
    assert all(abs(t / 4000 - f) < 0.04 for t, f in zip(total, fractions, strict=True))


def checked(rows, near, **options):
    out = mixing.mixed(rows, **options).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken == r.copies * r.size <= 2 * r.size
    assert all(r.source_size == sizes[r.source] for r in out)
    want = wanted(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - target[s]) <= near(s, out)
    again = mixing.mixed(rows.repartition(3), **options).collect()
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, again), key=str)
    return out


def largest(source, out):
    return max(r.size for r in out if r.source == source) + 1


@pytest.mark.parametrize("make", [odd, repeated_rows])
def test_targets(spark, make):
    rows = make(spark)
    assert len(checked(rows, largest)) == rows.count()


def test_reduction_tree(spark):
    rows = table(spark, [words(10 + k % 50, k) for k in range(400)])
    # Five buckets to one: several levels, every one of which may add the error of one pairing.
    checked(rows, lambda s, out: 0.1 * next(r.target for r in out if r.source == s), bucket=8, fan=3)


def test_mixed_rows(spark):
    rows = odd(spark)
    copies = {r.doc_id: r.copies for r in mixing.mixed(rows, key_col=None).collect()}
    out = mixing.mixed_rows(rows)
    assert out.columns == rows.columns
    assert out.count() == sum(copies.values())


def test_empty(spark):
    assert mixing.mixed(empty(spark)).collect() == []
    assert mixing.mixed_rows(empty(spark)).collect() == []
