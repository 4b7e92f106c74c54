from __future__ import annotations

import hashlib
from functools import cache

import public_tokenizers
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from mailsieve.llm.bpe import Coder
from mailsieve.llm.chat import CONTROLS, MARKS, assemble, escape, format_digest, format_turns, read_back, unescape

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = [*CONTROLS, "<", "[", "\\", "|turn|>", "/s>", "a", " ", "\n", "é", "<<", "SYS>>"]


@cache
def coder():
    with open(RANKS, "rb") as file:
        return Coder(file.read(), PATTERN)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    """rows (conv, turn, role, text) -> (conv, turns, digest, loss chars, loss digest)."""
    convs = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    out = []
    for conv, own in convs.items():
        loss = "".join(t for r, t in own if r == "assistant")
        out.append((conv, len(own), digest("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), digest(loss)))
    return sorted(out, key=str)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=12))
def test_escape_is_reversible_and_leaves_no_control(parts):
    text = "".join(parts)
    assert unescape(escape(text)) == text
    assert not any(c in escape(text) for c in CONTROLS)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=8), st.sampled_from(["user", "assistant", "<|end|>", ""]))
def test_turns_read_back_from_ids_and_text(parts, role):
    text = "".join(parts)
    said, ids, mask = assemble(coder(), role, text)
    assert list(read_back(coder(), ids, mask)) == [(role, text, text if role == "assistant" else "")]
    assert len(ids) == len(mask) and sum(said.count(m) for m in MARKS) == 3
    inner = said.removeprefix(MARKS[0]).removesuffix(MARKS[2]).split(MARKS[1])
    assert [unescape(x) for x in inner] == [role, text]
    assert sorted(ids[ids >= len(coder().tokens)].tolist()) == [50256, 50257, 50258]


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted((tuple(r)[:5] for r in format_digest(table, RANKS, PATTERN).collect()), key=str)
    assert got == expected([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (2, None, None, "x"), (None, 0, "user", "n"),
            (3, 0, "assistant", "é <|end|> " * 9000), (4, 0, "assistant", "t"), (4, 0, "assistant", "t"), (2, 0, "", "")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows],
                               "conv_id int, turn long, role string, text string, ids int, formatted string")
    got = format_digest(df, RANKS, PATTERN).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == expected(rows)
    turns = format_turns(df, RANKS, PATTERN).collect()
    assert all(len(r.ids) == 4 * len(r.mask) for r in turns)
    assert sum(r.formatted_chars for r in got) == sum(len(r.formatted) for r in turns)
    assert format_digest(df.limit(0), RANKS, PATTERN).collect() == []
