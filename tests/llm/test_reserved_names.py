"""Stages that return whole rows leave columns of any name as they are."""

import os

import corpus_pipeline
import pytest
from llm import fixtures as fx

from hirefunnel.llm import common, exact_dedup, mixing, quality, simhash

STAGES = [quality.filtered, exact_dedup.distinct_rows, simhash.representatives, mixing.mixed_rows]


@pytest.mark.parametrize("shared_ids", [False, True])
@pytest.mark.parametrize("stage", STAGES)
def test_columns_of_any_name_come_through(spark, stage, shared_ids):
    plain = fx.repeated_rows(spark) if shared_ids else fx.odd(spark).select("doc_id", "text", "lang", "source", "n_chars")
    rows = fx.reserved(plain)
    out = stage(rows)
    assert out.columns == rows.columns
    got = fx.listed(out)
    assert set(got) <= set(fx.listed(rows))
    key = [c for c in rows.columns if c not in fx.RESERVED]
    want = stage(plain)
    assert fx.listed(out.select(*key)) == fx.listed(want.select(*key))


def test_scratch_is_gone_after_a_run(spark, folder, monkeypatch):
    names = []

    def scratch(_, name):
        names.append(name)
        return f"{folder}/{name}-{len(names)}"

    monkeypatch.setattr(common, "scratch", scratch)
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and len(names) > 10
    assert [p.rsplit("-", 1)[0] for p in os.listdir(folder)] == ["pipeline-mixing"]
