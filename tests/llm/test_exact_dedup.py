from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st
from llm import brute
from llm.fixtures import empty, listed, odd, repeated_rows, table
from pyspark.sql import functions as F

from hirefunnel.llm import exact_dedup


@given(st.lists(st.binary(max_size=6)))
def test_radix_groups_are_the_equal_texts(texts):
    want = defaultdict(list)
    for i, t in enumerate(texts):
        want[t].append(i)
    assert sorted(map(sorted, exact_dedup.radix_groups(texts))) == sorted(want.values())


def test_radix_groups_of_long_texts():
    texts = [b"x" * 100_000, b"x" * 99_999 + b"y", b"x" * 100_000, b"x" * 99_999, b""]
    assert sorted(map(sorted, exact_dedup.radix_groups(texts))) == [[0, 2], [1], [3], [4]]


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[brute.lowered(t)].append(i)
    return sorted(
        (i, max(ids), len(ids), i == max(ids), brute.sha(t.encode())) for t, ids in groups.items() for i in ids
    )


def test_against_brute_force(spark):
    rows = odd(spark)
    want = expected([(r.doc_id, r.text) for r in rows.collect()])
    assert listed(exact_dedup.exact_groups(rows)) == want


def test_prefixes_that_hold_too_much_are_lengthened(spark):
    texts = [f"{'same beginning ' * 20}{k % 7}" for k in range(60)] + ["other", "same"]
    rows = table(spark, texts).repartition(5)
    want = expected(list(enumerate(texts)))
    assert listed(exact_dedup.exact_groups(rows, limit=100)) == want


def loads(monkeypatch, rows, limit):
    """What exact_groups gives, and the bytes of text in each task that compares them."""
    held, resolved = [], exact_dedup._resolved

    def spy(dealt):
        parts = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.length("body")).alias("bytes"))
        held.extend(r.bytes for r in parts.collect())
        return resolved(dealt)

    monkeypatch.setattr(exact_dedup, "_resolved", spy)
    return listed(exact_dedup.exact_groups(rows, limit=limit)), max(held, default=0)


def test_no_last_level_of_prefixes(spark, monkeypatch):
    # 60 rows share their first 40,000 bytes, one text ends there, some go on for long.
    begin = "the same template " * 2222 + "abcd"
    texts = [begin, *[f"{begin}{k % 40}{'z' * 1000 * (k % 3)}" for k in range(60)], "other", ""]
    assert len(begin) == 40_000
    out, most = loads(monkeypatch, table(spark, texts).repartition(4), 50_000)
    assert out == expected(list(enumerate(texts)))
    assert most < sum(map(len, texts)) / 4


def test_short_texts_with_one_beginning_are_spread(spark, monkeypatch):
    # Far below the limit of bytes; 50 rows are one text, each in a batch of its own.
    texts = [f"greetings {k}" for k in range(400)] + ["greetings 7"] * 50 + ["greetings"] * 3
    rows = table(spark, texts).repartition(60)
    held, resolved = [], exact_dedup._resolved

    def spy(dealt):
        held.extend(r["count"] for r in dealt.groupBy("level", "path", exact_dedup._slice()).count().collect())
        return resolved(dealt)

    monkeypatch.setattr(exact_dedup, "_resolved", spy)
    assert listed(exact_dedup.exact_groups(rows, most=20)) == expected(list(enumerate(texts)))
    assert 0 < max(held) <= 20


def test_copies_of_one_long_text_do_not_meet_in_a_task(spark, monkeypatch):
    # Each row is a batch of its own, so that copies only meet later.
    texts = ["long text " * 3000] * 40 + ["Long text " * 3000 + "more"] * 10 + ["short"] * 3
    out, most = loads(monkeypatch, table(spark, texts).repartition(len(texts)), 50_000)
    assert out == expected(list(enumerate(texts)))
    assert most < sum(map(len, texts)) / 4


def test_one_of_repeated_rows_stays(spark):
    rows = repeated_rows(spark)
    out = exact_dedup.exact_groups(rows).collect()
    assert len(out) == rows.count()
    assert sum(r.kept for r in out) == len({brute.lowered(r.text) for r in rows.collect()})
    # A null id stays only where its text has no other.
    assert all(r.keep_id is not None or r.doc_id is None for r in out)
    left = exact_dedup.distinct_rows(rows)
    assert left.columns == rows.columns
    texts = [brute.lowered(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == sum(r.kept for r in out)


def test_empty(spark):
    assert exact_dedup.exact_groups(empty(spark)).collect() == []
    assert exact_dedup.distinct_rows(empty(spark)).collect() == []
