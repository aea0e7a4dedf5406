import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from offerloom.llm.tokens import PATTERN, Splitter, corpus_ids, read_ranks, vocabulary_path

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(open(vocabulary_path(), "rb").read())


@pytest.fixture(scope="module")
def both(ranks):
    return Splitter(ranks), tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("abQzxß'sltvrme  \n\t 　​\u0085!?.,<|>1239²½éü😀👍🏽中文́‮\x1c﻿"), max_size=40))
def test_equal_to_the_whole_text_at_once(both, text):
    assert both[0].encode(text.encode()) == both[1].encode_ordinary(text)


def test_long_and_special(both):
    for text in ("a" * 20_000, "<|endoftext|> it's 'll x", "wort " * 5000, "", " " * 300 + "x"):
        ids = both[0].encode(text.encode())
        assert ids == both[1].encode_ordinary(text) and both[1].decode(ids) == text


def test_cuts_lie_between_characters(both):
    rng = random.Random(1)
    text = "".join(rng.choice("äöü中😀ab c'") for _ in range(500))
    data = text.encode()
    for c in both[0].cuts(data):
        data[:c].decode(), data[c:].decode()
        assert not data[:c].decode()[-1].isspace() and data[c : c + 1] != b"'"


def test_rows(spark, both):
    texts = ["ein Text", None, "", "ein Text", "Größe: 5 €" * 1000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r["doc_id"]: r["ids"] for r in corpus_ids(df, "doc_id", "text").collect()}
    assert got == {i: both[1].encode_ordinary(t or "") for i, t in enumerate(texts)}
    empty = corpus_ids(df.limit(0), "doc_id", "text")
    assert empty.count() == 0 and dict(empty.dtypes)["ids"] == "array<int>"
