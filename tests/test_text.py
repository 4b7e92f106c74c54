"""Edge cases of text cleaning and chunking."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailsieve.functions import text as X
from mailsieve.functions import udtf  # noqa: F401 - importable without a query
from mailsieve.operators import changes, chunking
from mailsieve.plans import cleaning

DOCS = [(0, None), (1, ""), (2, "x"), (3, "é" * 33000), (4, "One. Two! Three?\n\nFour " * 50), (5, "same"), (6, "same")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def value(spark, fn, *texts):
    row = spark.createDataFrame([texts], ", ".join(f"c{i} string" for i in range(len(texts))))
    return row.select(fn(*[F.col(f"c{i}") for i in range(len(texts))]).alias("v")).first()["v"]


def test_html(spark):
    html = "<p>A &amp; B</p><script>x < y </script><ul><li class='q'>one</li></ul>&lt;b&gt;"
    assert value(spark, X.html_to_text, html) == "A & B\n• one\n<b>"


def test_noise_and_whitespace(spark):
    assert value(spark, X.strip_unicode_noise, "a\u00a0b\u200bc\ufeff") == "a bc"
    assert value(spark, X.normalize_ws, " \t a \t b\n\n\n\nc \n") == "a b\n\nc"
    assert value(spark, X.collapse_ws, " a\n\t b  c ") == "a b c"


def test_quote_forms(spark):
    def cut(t):
        return value(spark, lambda c: X.quote_cut(X.as_lines(c)), t)

    assert cut("hi\n> old") == 1
    assert cut("hi\nOn Monday Bob wrote:\nold") == 1
    assert cut("a\nb\nFrom: x\nDate: y\nSubject: z\nold") == 2
    assert cut("a\nFrom: here to there\nno header follows") is None


def test_signature_window(spark):
    long = "Regards\n" + "line\n" * 60
    assert value(spark, lambda c: X.signature_cut(X.as_lines(c)), long) is None
    assert value(spark, lambda c: X.signature_cut(X.as_lines(c)), "a\n--\nb\nThanks,\nBob") == 3


def test_clean_email_reports_removals(spark):
    body = "Hello there, a question.\n\nMore.\nThanks\nBob\n> old\n"
    d = spark.createDataFrame([(body,)], "body string")
    r = cleaning.clean_email(d).first()
    assert r["cleaned_text"] == "Hello there, a question.\n\nMore."
    assert r["removed_sections_count"] == 2 and r["extracted_query"] == "Hello there, a question."


def test_clean_email_of_blank(spark):
    r = cleaning.clean_email(spark.createDataFrame([(None,), ("",)], "body string")).collect()
    assert all(x["cleaned_text"] == "" and x["reduction_percentage"] == 0.0 and not x["pass_fail"] for x in r)


def test_sanitize_pdf(spark):
    raw = "A word-\nbreak\\nnext ( ) ##Head\x01 end.\n\n\nNew   line\n  - item"
    assert value(spark, X.sanitize_pdf, raw) == "A wordbreak\nnext  ## Head end. New line\n• item"


def test_pii_and_urls(spark):
    assert value(spark, X.mask_pii, "a.b@c.org 555-123-4567") == "[EMAIL] [PHONE]"
    assert value(spark, X.strip_urls, "see https://a.b/c and www.d.e/f now") == "see  and  now"


def test_fixed_chunks_cover_every_document(docs):
    c = chunking.chunk_fixed(docs.withColumn("n", F.length("text")), size=100, overlap=10)
    ends = {r["doc_id"]: r["e"] for r in c.groupBy("doc_id", "n").agg(F.max("end_char").alias("e")).collect()}
    assert ends == {2: 1, 3: 33000, 4: len(DOCS[4][1]), 5: 4, 6: 4}


@pytest.mark.parametrize("make", [
    lambda d: chunking.chunk_smart(d, size=30, overlap=5), lambda d: chunking.chunk_words(d, size=120, overlap_tokens=5)])
def test_boundary_chunks_cover_and_advance(docs, make):
    rows = make(docs).orderBy("doc_id", "chunk_index").collect()
    text = {i: t for i, t in DOCS if t}
    for i, t in text.items():
        mine = [r for r in rows if r["doc_id"] == i]
        assert mine[0]["start_char"] == 0 and mine[-1]["end_char"] == len(t)
        for a, b in zip(mine, mine[1:]):
            assert a["start_char"] < b["start_char"] <= a["end_char"]
        assert all(r["text"] == t[r["start_char"]:r["end_char"]] for r in mine)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n\"'", max_size=300), st.integers(1, 40), st.integers(0, 39), st.booleans(), st.booleans())
def test_boundary_spans_property(text, length, back, sentences, paragraphs):
    spans = list(chunking.boundary_spans(text, length, min(back, length - 1), sentences, paragraphs))
    assert not text or (spans[0][0] == 0 and spans[-1][1] == len(text))
    assert all(a < b <= a + length for a, b in spans)
    assert all(p[0] < q[0] <= p[1] for p, q in zip(spans, spans[1:]))


def test_smart_chunk_prefers_paragraph_then_sentence():
    text = "First one. Second\n\nThird here. Fourth part goes on"
    assert next(chunking.boundary_spans(text, 30, 0, True, True)) == (0, 19)
    assert next(chunking.boundary_spans(text, 30, 0, True, False)) == (0, 11)


def test_diff_sections():
    d = changes.diff_lines("a\nb\nc\nd", "a\nx\nc\nd\ne")
    assert d["added"] == ["b"] and d["removed"] == ["x", "e"] and d["line_change_percentage"] == 60.0
    assert [s["type"] for s in d["sections"]] == ["modified", "removed"]
    assert changes.diff_lines("a\nnew\nb", "a\nb")["sections"][0]["type"] == "added"
    assert changes.diff_lines("", "")["line_change_percentage"] == 0.0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_diff_accounts_for_every_line(cur, prev):
    d = changes.diff_lines("\n".join(cur), "\n".join(prev))
    assert len(d["added"]) - len(d["removed"]) == len(cur) - len(prev)
    assert (not d["sections"]) == (cur == prev)


def test_topics_ties_by_word():
    assert cleaning._topics("Beta alpha beta ALPHA gamma with", 2) == [{"word": "alpha", "n": 2}, {"word": "beta", "n": 2}]


def test_entities_are_decoded_once(spark):
    rows = ["&#8217;&apos;&#x27;&#X41;&lt;&amp;lt;", "&#38;amp; &#0; &#xD800; &#1114112; &# ; &#65", "&#128512;&#233;", "a & b"]
    d = spark.createDataFrame([(r,) for r in rows], "t string")
    got = [r[0] for r in d.select(X.html_to_text(F.col("t"))).collect()]
    assert got == ["\u2019''A<&lt;", "&amp; &#0; &#xD800; &#1114112; &# ; &#65", "\U0001f600é", "a & b"]


def test_token_change_drops_trailing_blanks_only(spark):
    rows = [("a b\n", "a b", 0.0), (" a", "a", 50.0), ("", " ", 0.0), ("a", "b", 100.0)]
    d = spark.createDataFrame(rows, "a string, b string, want double")
    assert all(r[0] == r[1] for r in d.select(X.token_change(F.col("a"), F.col("b")), "want").collect())


def test_smart_changes_look_at_the_texts(spark):
    cur = spark.createDataFrame([(1, "a b\n"), (2, "x\nb\nc"), (3, "same"), (4, "b a")], "k int, text string")
    prev = spark.createDataFrame([(1, "a b"), (2, "b\nd"), (3, "same"), (4, "a b"), (5, "gone")], "k int, text string")
    got = {r.k: r for r in changes.detect_changes(cur, prev, "k", check_type="smart").collect()}
    assert {k: (r.has_changed, r.change_type) for k, r in got.items()} == {
        1: (False, "none"), 2: (True, "smart_changed"), 3: (False, "none"), 4: (True, "smart_changed"), 5: (True, "hash_changed")}
    assert got[2].added_content == ["x", "c"] and got[2].removed_content == ["d"]
    assert [s.type for s in got[2].modified_sections] == ["added", "modified"]
    assert got[4].change_percentage == 0.0 and got[4].modified_sections[0].current_lines == ["b a"]
    content = {r.k: r for r in changes.detect_changes(cur, prev, "k", check_type="content").collect()}
    assert content[1].has_changed and content[1].change_type == "content_changed" and content[1].modified_sections == []


def test_marks_agree_with_a_plain_search():
    for words in ("One two. Three four! Five", "no stops here at all but blanks " * 20, "x" * 900):
        for start, end in chunking.word_spans(words, 40, 5):
            assert 0 < end - start <= 90
    assert [s for s in chunking.word_spans("aa. bb cc", 5, 0)] == [(0, 4), (4, 9)]
