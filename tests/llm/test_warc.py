from __future__ import annotations

from conftest import SF

from mailsieve.llm import warc
from mailsieve.llm.warc import SCHEMA, resolve_revisits


def canonical(spark, *urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    return [r[0] for r in df.select(warc.canonical_url(df.u)).collect()]


def test_canonical_urls(spark):
    assert canonical(spark, "HTTP://www.A.com:80/x/?b=2&a=1#f", "https://u:p@a.com/X//", "a.com", "http://a.com/?", None, "",
                     "http://a.com?q", "http://www2.a.com/b?x#y?z") == [
        "a.com/x?a=1&b=2", "a.com/X", "a.com", "a.com", None, "", "a.com?q", "a.com/b?x"]


def brute(rows):
    """As-of matches by trying every response for every revisit."""
    full = [r for r in rows if r[1] == "response" and r[4] == 200 and r[6] is not None]
    out = {}
    for r in rows:
        if r[1] == "revisit":
            own = [(f[3], f[0]) for f in full if f[2] == r[2] and (f[3], f[0]) < (r[3], r[0])]
            out[r[0]] = max(own)[1] if own else None
    return out


def test_as_of_matches_brute_force_across_buckets(spark):
    rows = []
    for i in range(300):
        kind = "revisit" if i % 3 == 0 else "response"
        at = (i * 7919) % 1000 if i % 50 else 500
        rows.append((i, kind, f"p{(i * i) % 4}.com", at, 304 if kind == "revisit" else (404 if i % 11 == 0 else 200), {},
                     None if i % 13 == 0 else f"body {i}"))
    df = spark.createDataFrame(rows, SCHEMA)
    for bucket in (1, 37, 100_000):
        got = {r.record_id: r.full_id for r in resolve_revisits(df, bucket).collect()}
        assert got == brute(rows)


def test_outcomes_and_headers(spark):
    old = {"ETag": '"1"', "Last-Modified": "mon", "Content-Type": "t", "X": "keep", "x": "kept", "Date": "d0"}
    rows = [(1, "response", "http://a.com/", 10, 200, old, "body")]
    tries = [
        ({"etag": 'W/"1"', "Date": "d1", "Content-Length": "0"}, "resolved"), ({"ETag": '"2"'}, "mismatch"),
        ({"Last-Modified": "mon"}, "resolved"), ({"Last-Modified": "tue"}, "mismatch"), ({}, "unvalidated"),
        (None, "unvalidated"), ({"ETag": '"1"', "Last-Modified": "tue"}, "resolved"), ({"ETag": " "}, "unvalidated"),
    ]
    rows += [(10 + i, "revisit", "https://www.a.com", 20, 304, h, None) for i, (h, _) in enumerate(tries)]
    rows += [(40, "revisit", "a.com", 9, 304, {}, None), (41, "revisit", "b.com", 99, 304, {}, None),
             (42, "revisit", None, 99, 304, {}, None), (None, "revisit", "a.com", 99, 304, {}, None),
             (43, "revisit", "a.com", None, 304, {}, None), (44, None, "a.com", 9, 304, {}, None),
             (41, "revisit", "b.com", 99, 304, {}, None)]
    df = spark.createDataFrame([(*r, 1, "o") for r in rows], SCHEMA + ", full_id int, outcome string")
    got = {r.record_id: r for r in resolve_revisits(df).collect()}
    assert {k: v.outcome for k, v in got.items()} == {
        **{10 + i: o for i, (_, o) in enumerate(tries)}, 40: "orphan", 41: "orphan"}
    assert got[10].headers == {
        "etag": 'W/"1"', "date": "d1", "last-modified": "mon", "content-type": "t", "x": "kept"}
    assert got[10].payload == "body" and got[11].payload is None and got[11].headers is None
    assert len(resolve_revisits(df).collect()) == 10
    assert resolve_revisits(df.limit(0)).collect() == []


def test_pages_give_back_their_text(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    got = resolve_revisits(warc.page_records(pages)).collect()
    assert len(got) == len(html) and {r.outcome for r in got} >= {"resolved", "unvalidated", "mismatch"}
    for r in got:
        assert r.payload == (html[r.full_id // 2] if r.outcome in ("resolved", "unvalidated") else None)
