import random

import pytest
from llm import brute
from llm.fixtures import empty, listed, odd, repeated_rows, words

from hirefunnel.llm import simhash
from hirefunnel.llm.components import smallest_reachable


@pytest.mark.parametrize("text", ["", "a", "a b", "a b c", "A b C d a B c D", "é ü " * 50, words(500, 3)])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def expected(rows):
    prints = {r.doc_id: brute.fingerprint(r.text) for r in rows}
    found = brute.components(prints)
    return sorted((i, f"{prints[i]:016x}", found[i]) for i in prints)


@pytest.mark.parametrize("limit", [4096, 2])
def test_against_brute_force(spark, limit):
    rows = odd(spark)
    assert listed(simhash.near_groups(rows, limit=limit)) == expected(rows.collect())


@pytest.mark.parametrize("limit", [4096, 8])
def test_links_of_close_fingerprints(spark, limit):
    pick = random.Random(5)
    values = set()
    for _ in range(12):  # a dense group around each centre, and chains leading away
        centre = pick.getrandbits(64)
        for _ in range(40):
            value = centre
            for _ in range(pick.randrange(6)):
                value ^= 1 << pick.randrange(64)
            values.add(value)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    frame = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    stars = {r.node: r.root for r in smallest_reachable(simhash.links(frame, limit=limit)).collect()}
    want = brute.components(dict(enumerate(sorted(values))))
    order = [signed[v] for v in sorted(values)]
    groups, mine = {}, {}
    for i, root in want.items():
        groups.setdefault(root, set()).add(order[i])
        mine.setdefault(stars.get(order[i], order[i]), set()).add(order[i])
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, groups.values()))
    assert all(root == min(members) for root, members in mine.items())


def test_repeated_rows_and_null_ids(spark):
    rows = repeated_rows(spark)
    out = simhash.near_groups(rows).collect()
    assert len(out) == rows.count()
    assert all(r.component_id is not None for r in out if r.doc_id is not None)
    left = simhash.representatives(rows)
    assert left.columns == rows.columns
    assert {r.doc_id for r in left.collect()} == {r.component_id for r in out}
    # An id with two texts may name two components: both of them are represented.
    prints = [brute.fingerprint(r.text) for r in rows.collect()]
    assert left.count() == len(set(brute.components(dict(enumerate(prints))).values()))


def test_empty(spark):
    assert simhash.near_groups(empty(spark)).collect() == []
    assert simhash.representatives(empty(spark)).collect() == []
