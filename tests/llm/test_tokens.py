"""Ids against the public library, round trips, and very long pre-tokens."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import tokens as T
from tidelog.runtime import scan

tiktoken = pytest.importorskip("tiktoken")
RANKS = T.ranks()
ENCODER = T.Encoder(RANKS)
THEIRS = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=RANKS, special_tokens={})
BYTES = {v: k for k, v in RANKS.items()}


@given(st.text(max_size=300))
@settings(max_examples=200, deadline=None)
def test_any_text(text):
    ids = ENCODER.encode(text)
    assert ids == THEIRS.encode_ordinary(text)
    assert b"".join(BYTES[i] for i in ids).decode() == text


@given(st.text("ab  \n1'", max_size=80))
@settings(max_examples=200, deadline=None)
def test_repetitive_text(text):
    assert ENCODER.encode(text) == THEIRS.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 30000, "<|endoftext|>", "=" * 5000, "é" * 3000, " " * 5000, "\r\n \t", "😀" * 400])
def test_long_pieces(text):
    assert ENCODER.encode(text) == THEIRS.encode_ordinary(text)


def test_length_costs_in_proportion():
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefghij") for _ in range(400_000))
    t = time.process_time()
    short = len(T.Encoder(RANKS).merged(text[:40_000].encode()))
    t1 = time.process_time() - t
    t = time.process_time()
    T.Encoder(RANKS).merged(text.encode())
    assert short and time.process_time() - t < 40 * max(t1, 0.02)


def test_queue():
    q = T.RankQueue(50000)
    for r in (49999, 3, 64, 4096, 3):
        q.push(r, r)
    out = []
    while (r := q.first()) >= 0:
        out.append((r, q.pop(r)))
    assert out == [(3, [3, 3]), (64, [64]), (4096, [4096]), (49999, [49999])]


def test_table(spark, sf):
    docs = scan(spark, sf, "documents")
    want = {r.doc_id: None if r.text is None else THEIRS.encode_ordinary(r.text) for r in docs.collect()}
    assert {r.doc_id: r.ids for r in T.encoded(docs, RANKS).collect()} == want
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "a b", "z")], "doc_id long, text string, ids string")
    assert sorted((r.doc_id, r.ids) for r in T.encoded(odd, RANKS).where("ids is not null").collect()) == [(2, []), (2, ENCODER.encode("a b"))]
    assert T.encoded(odd.limit(0), RANKS).count() == 0
