"""Centroid clustering against the plain algorithm, and its odd inputs."""

import hashlib
import math
import random

import pytest

from hirefunnel.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, v string, cluster int, `a.b` int"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, "v", 5, 6) for i, x in rows], SCHEMA)


def plain(rows, dimensions, k=16, rounds=3):
    """vec_id, cluster, distance, centroid of every usable row, by the definition."""
    kept = [
        (i, [math.floor(64 * c) for c in x])
        for i, x in rows
        if x is not None and len(x) == dimensions and all(c is not None and math.isfinite(c) for c in x)
    ]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    middle = [v for _, v in first[:k]]
    for turn in range(rounds + 1):
        found = []
        for i, v in kept:
            away = [(sum((a - b) ** 2 for a, b in zip(v, m)), n) for n, m in enumerate(middle)]
            found.append((i, v, *min(away)))
        if turn < rounds:
            for n in range(len(middle)):
                mine = [v for _, v, _, c in found if c == n]
                if mine:
                    middle[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, c, d, middle[c]) for i, _, d, c in found]


def check(spark, rows, dimensions, **options):
    got = centroids.clusters(frame(spark, rows), dimensions=dimensions, **options).collect()
    want = plain(rows, dimensions, **options)
    inertia = {c: sum(d for _, k, d, _ in want if k == c) for _, c, _, _ in want}
    shown = [
        (i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, m)).encode()).hexdigest())
        for i, c, d, m in want
    ]
    assert sorted(map(tuple, got)) == sorted(shown)


@pytest.mark.parametrize("spread", [0.02, 1.0, 3000.0, 300_000.0])
def test_equals_the_plain_algorithm_at_every_lane_width(spark, spread):
    pick = random.Random(4)
    rows = [(i, [pick.gauss(0, spread) for _ in range(8)]) for i in range(300)]
    check(spark, rows, 8)


def test_ties_copies_and_rows_that_share_an_id(spark):
    pick = random.Random(5)
    rows = [(i, [float(pick.randrange(-1, 2)) / 64 for _ in range(3)]) for i in range(200)]
    rows += [(7, [1.0, 1.0, 1.0]), (7, [1.0, 1.0, 1.0]), (7, [0.0, 0.0, 0.0])]
    rows += [(300 + i, [0.5, 0.5, 0.5]) for i in range(200)]
    check(spark, rows, 3)


def test_unusable_vectors_have_no_row(spark):
    good = [(i, [i / 7, -i / 3]) for i in range(30)]
    bad = [(90, None), (91, []), (92, [1.0]), (93, [1.0, None]), (94, [math.nan, 0.0])]
    bad += [(95, [math.inf, 0.0]), (96, [0.0, -math.inf]), (97, [1.0, 2.0, 3.0])]
    check(spark, good + bad, 2)


def test_fewer_vectors_than_clusters_and_none(spark):
    check(spark, [(1, [0.0, 1.0]), (2, [3.0, 4.0])], 2)
    assert centroids.clusters(frame(spark, [])).collect() == []
    assert centroids.clusters(frame(spark, [(1, None)])).collect() == []


def test_large_components_and_a_null_id(spark):
    rows = [(None, [1e300, 0.0]), (1, [-1e300, 5e-324]), (2, [0.25, -0.25])]
    got = {r.vec_id: r for r in centroids.clusters(frame(spark, rows), dimensions=2, k=1).collect()}
    assert len(got) == 3 and all(0 <= r.distance < 2**63 for r in got.values())
