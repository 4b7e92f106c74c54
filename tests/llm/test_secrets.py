from __future__ import annotations

import hashlib
import re

from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from mailsieve.llm.secrets import find_spans, redact, remove_secrets, secret_digest

ORDER = ("assign", "access", "hex")
KEY = "aB3dE5gH7jK9mN1pQ3sT5vW7"


def brute(text):
    """Base spans by trying every start of every kind."""
    out = []
    word = re.compile("(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
                      "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?[ ]*[:=][ ]*[\"']?([A-Za-z0-9+/_.=-]+)")
    for kind, pattern, least in (("assign", word, 6), ("access", re.compile("(AKIA[A-Z0-9]+)"), 20),
                                 ("hex", re.compile("([0-9a-f]+)"), 24)):
        at = 0
        while at < len(text):
            m = pattern.match(text, at)
            if m and len(m[1]) >= least:
                out.append((kind, m.start(), m.end()))
            at = m.end() if m else at + 1
    return sorted(out, key=lambda s: (s[1], ORDER.index(s[0])))


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in secret_digest(docs).collect()}
    for d in docs.collect():
        base = brute(d.text)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = got.pop(d.doc_id)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in base) for k in ORDER]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))
    assert not got


PIECES = ["password", "Token", "api_key", "secret", ":", "= ", "'", "abc", "abcdef", "AKIA", "AKIA" + "Z" * 16, "0" * 24,
          "deadbeef", " ", "\n", "é", "ſecret", KEY, "user: bob", "https://a.example/x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14))
def test_base_spans_and_redaction(parts):
    text = "".join(parts)
    spans = find_spans(text)
    assert [s for s in spans if s[0] in ORDER] == brute(text)
    clean = redact(text)
    assert not find_spans(clean) and (spans or clean == text)


def test_weak_parts_need_complements():
    assert find_spans(f"noise {KEY} noise") == []
    assert [s[0] for s in find_spans(f"user: bobby key {KEY}")] == ["identifier", "key"]
    assert [s[0] for s in find_spans(f"{KEY} https://db.example.com/")] == ["key"]
    assert [s[0] for s in find_spans(f"login=amy {KEY} https://db.example.com/")] == ["identifier", "key", "endpoint"]
    assert find_spans(f"user: bobby\n\n{KEY}") == []
    assert find_spans("user: bobby " + "x " * 200 + KEY) == []
    assert [s[0] for s in find_spans(f"AKIA{'A1' * 8} {KEY}")] == ["access", "key"]
    assert find_spans("user: bobby at https://db.example.com/") == []


def test_odd_rows(spark):
    long = "x " * 200_000 + "token=abcdef"
    rows = [(1, None), (2, ""), (3, long), (None, "token=abcdef é"), (4, "token=abcde"), (4, "token=abcde")]
    df = spark.createDataFrame([(*r, "s", 9) for r in rows], "doc_id long, text string, spans string, n_chars long")
    got = secret_digest(df).collect()
    assert [r.n_assign for r in got] == [0, 0, 1, 1, 0, 0]
    assert got[2].spans == "assign:400000:400012" and got[0].spans == ""
    clean = remove_secrets(df)
    assert clean.columns == df.columns
    assert [(r.text, r.n_chars) for r in clean.collect()][3] == ("<redacted> é", 12)
    assert clean.collect()[0].text is None
    assert secret_digest(df.limit(0)).collect() == [] and remove_secrets(df.limit(0)).collect() == []
