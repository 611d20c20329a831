"""The pipeline's stages against plain versions, each on its own input."""

import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from llm import brute
from llm.fixtures import empty, odd_texts, table, words
from tokenizers import Tokenizer

from hirefunnel.llm import mixing, quality
from hirefunnel.llm.queries import vocabulary


def corpus():
    near = [words(150, 77, 5000) + f" tail{k}" for k in range(4)]
    return odd_texts() + near + near[:1] + [words(60, 300 + k, 900) for k in range(40)]


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def folder_of_tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    table(spark, corpus(), extra=True).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages(spark, folder_of_tables):
    docs = spark.read.parquet(f"{folder_of_tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    kept = stages["quality_rules"](spark, docs, folder_of_tables)
    ids = {r.doc_id for r in quality.scored(docs).collect() if r.kept}
    assert rows_of(kept) == Counter({tuple(r): 1 for r in docs.collect() if r.doc_id in ids})

    single = stages["exact_dedup"](spark, kept, folder_of_tables)
    groups = {}
    for r in kept.collect():
        key = brute.lowered(r.text)
        groups[key] = max(groups.get(key, -1), r.doc_id)
    assert {r.doc_id for r in single.collect()} == set(groups.values())

    apart = stages["simhash_near_dedup"](spark, single, folder_of_tables)
    prints = {r.doc_id: brute.fingerprint(r.text) for r in single.collect()}
    assert {r.doc_id for r in apart.collect()} == set(brute.components(prints).values())

    mix = stages["mixing"](spark, apart, folder_of_tables)
    copies = {r.doc_id: r.copies for r in mixing.mixed(apart).collect()}
    assert sum(copies.values()) == mix.count()
    assert {r.doc_id for r in mix.collect()} <= set(copies)
    assert [s.columns for s in (kept, single, apart, mix)] == [docs.columns] * 4


def test_run_encodes_the_mix(spark, folder_of_tables):
    out = corpus_pipeline.run(spark, folder_of_tables).collect()
    assert out
    library, texts = Tokenizer.from_file(vocabulary()), corpus()
    for r in out:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
