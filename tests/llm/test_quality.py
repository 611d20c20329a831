import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm import brute
from llm.fixtures import empty, odd, repeated_rows, table, words

from hirefunnel.llm import quality

CONTRACT = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab \n\t#é|\x85\xa0"), max_size=120))
def test_measures(text):
    assert tuple(quality.measures(text.encode())[:5]) == brute.measures(text)[:5]


@pytest.mark.parametrize("make", [odd, repeated_rows])
def test_against_brute_force(spark, make):
    rows = make(spark)
    got = quality.scored(rows).collect()
    want = [(r.doc_id, *brute.measures(r.text)) for r in rows.collect()]
    assert sorted((tuple(r[c] for c in CONTRACT) for r in got), key=str) == sorted(want, key=str)
    assert not any(r.kept for r in got if r.base_failed)
    assert all(0 <= r.posterior <= 1 for r in got)


def test_em_finds_rules_that_agree():
    # Two rules agree on what is bad; the third votes at random and is trusted less.
    patterns = [((1, 1, 1), 400), ((1, 1, -1), 400), ((-1, -1, 1), 100), ((-1, -1, -1), 100)]
    model = quality.fit(patterns, 3)
    assert model.score((1, 1, -1)) > 0 > model.score((-1, -1, 1))
    assert model.bad[0][-1] > 0.9 and abs(model.bad[2][-1] - 0.5) < 0.1
    assert abs(model.share - 0.8) < 0.05


def test_clean_stays_and_junk_goes(spark):
    clean = [f"the {words(30, k, 3000)} and of {words(40, k + 500, 3000)} is in the end" for k in range(60)]
    junk = ["#$% | " * 60, "BUY NOW " * 40, "line\n" * 50]
    rows = table(spark, clean + junk, extra=True)
    left = quality.filtered(rows)
    assert left.columns == rows.columns
    assert {r.doc_id for r in left.collect()} == set(range(60))


def test_empty(spark):
    assert quality.scored(empty(spark)).collect() == []
    assert quality.filtered(empty(spark)).collect() == []
