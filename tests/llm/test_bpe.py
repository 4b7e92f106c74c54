from __future__ import annotations

import base64
import hashlib
import random
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from mailsieve.llm import bpe
from mailsieve.llm.bpe import Coder, decode, encode, round_trip_digest

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@cache
def reference():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@cache
def coder(chunk=1 << 14, overlap=256):
    with open(RANKS, "rb") as file:
        return Coder(file.read(), PATTERN, chunk, overlap)


@cache
def plain(chunk=9, overlap=6):
    """The same pattern, matched by a regular expression engine."""
    with open(RANKS, "rb") as file:
        return Coder(file.read(), PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
                     .replace(r"[^\p{White_Space}", r"[^\p{White_Space}"), chunk, overlap)


def same(text, own):
    ids = own.encode(text)
    assert np.frombuffer(ids, "<u4").tolist() == reference().encode_ordinary(text)
    assert own.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "'s", "'ll", "'r", "e", "l", "\x1c", "\u00b2", "\u0301", "'", " ", "  ", "\n", "7", "é", "漢", "!", " ", "s", "😀"]), max_size=60))
def test_small_chunks_are_stitched(parts):
    same("".join(parts), coder(9, 6))
    same("".join(parts), coder(4, 3))
    assert plain().bounds(["".join(parts)])[0].tolist() == coder().bounds(["".join(parts)])[0].tolist()


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=200))
def test_any_text(text):
    same(text, coder(16, 5))
    same(text, plain())


def test_long_runs():
    rng = random.Random(1)
    for text in ("a" * 5000, " " * 70_000 + "x", "ab" * 20_000, "".join(rng.choices("abcde", k=3000)), "'" * 999 + "s",
                 "".join(rng.choices("ab 1'é\n", k=60_000))):
        same(text, coder())


def test_pieces_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(bpe, "mix", lambda x: x & np.uint64(3))
    same("some words and some more words, again words", coder())


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in round_trip_digest(docs, RANKS, PATTERN).collect())
    expected = []
    for r in docs.collect():
        ids = np.array(reference().encode_ordinary(r.text), "<u4")
        digest = hashlib.sha256(r.text.encode()).hexdigest()
        expected.append((r.doc_id, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), digest))
    assert got == sorted(expected)


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 6), (None, "x <|endoftext|>", 7), (1, "x", None), (1, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = decode(encode(df, RANKS, PATTERN), RANKS, PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    assert [None if r.decoded is None else bytes(r.decoded).decode() for r in out.collect()] == [r[1] for r in rows]
    assert [r.n_tokens for r in round_trip_digest(df, RANKS, PATTERN).collect()][:2] == [0, 0]
    assert encode(df.limit(0), RANKS, PATTERN).collect() == []


def test_unknown_id_is_an_error():
    with pytest.raises(IndexError):
        coder().decode(np.array([60_000], "<u4").tobytes())


def test_one_pass_is_encode_then_decode(spark):
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rows = [(1, "", 1, "x"), (2, None, 2, "y"), (None, "héllo  wörld\n\n", 3, None), (4, "ab " * 300_000, 4, "z"), (4, "again", 4, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, decoded string")
    two = bpe.decode(bpe.encode(df, ranks, pattern).drop("text"), ranks, pattern)
    one = bpe.round_trip(df, ranks, pattern)
    assert one.columns == two.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    assert {None if r.decoded is None else bytes(r.decoded).decode() for r in one.collect()} == {r[1] for r in rows}
    assert bpe.round_trip(df.limit(0), ranks, pattern).collect() == []
