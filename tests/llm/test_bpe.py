import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.fixtures import empty, listed, odd, odd_texts, repeated_rows
from tokenizers import Tokenizer

from hirefunnel.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    with open(PATH, encoding="utf-8") as file:
        return library, bpe.Encoder(file.read())


def reference(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


BLANKS = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0   ​    　﻿"
CHARACTERS = st.characters(exclude_categories=["Cs"]) | st.sampled_from("aZ 'st\n  09.ée日😀" + BLANKS)


@settings(max_examples=400, deadline=None)
@given(text=st.text(CHARACTERS, max_size=60) | st.lists(st.sampled_from(["<|endoftext|>", " ", "'ll", "\n\n", "don't", "x "])).map("".join))
def test_like_the_library(both, text):
    library, own = both
    ids = np.frombuffer(own.encode(text), "<u4")
    assert (ids.tolist(), own.decode(ids)) == reference(library, text)


@pytest.mark.parametrize("text", [t or "" for t in odd_texts()] + ["a" * 20_000, "́ " * 500, " " * 5_000])
def test_long_and_odd_texts(both, text):
    library, own = both
    ids = np.frombuffer(own.encode(text), "<u4")
    assert (ids.tolist(), own.decode(ids)) == reference(library, text)


@pytest.mark.parametrize("make", [odd, repeated_rows])
def test_digests(spark, both, make):
    rows = make(spark)
    want = []
    for r in rows.collect():
        ids, text = reference(both[0], r.text)
        digests = (hashlib.sha256(b).hexdigest() for b in (np.array(ids, "<u4").tobytes(), text.encode()))
        want.append((r.doc_id, len(ids), *digests))
    got = [tuple(r) for r in bpe.encoded_digests(rows, PATH).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty(spark):
    assert listed(bpe.encoded_digests(empty(spark), PATH)) == []
