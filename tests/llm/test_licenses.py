from __future__ import annotations

import random
import re
import time
from itertools import product

from conftest import SF

from mailsieve.llm.licenses import _NAMES, _TEXTS, BASE, detections, find_licenses, rules, scan, uncontained


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in BASE.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = find_licenses(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and bool(r.labels) == (r.score > 0)


def plainly(found):
    kept = []
    for d in sorted(found, key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
        if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
            kept.append(d)
    return kept


def test_uncontained_matches_a_look_at_every_pair():
    rnd = random.Random(7)
    for _ in range(400):
        found = set()
        for _ in range(rnd.randint(0, 40)):
            start = rnd.randrange(30)
            found.add((start, start + rnd.randint(1, 12), rnd.choice("abc"), rnd.choice([40, 60, 90])))
        assert uncontained(found) == plainly(found)


def test_added_labels_match_all_rules_without_gates(spark):
    docs = spark.read.parquet(SF + "/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    every = [rule for own in rules().values() for rule in own]
    seen = set()
    for r in find_licenses(docs).collect():
        line = " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id] or "")))
        line = line.encode()
        found = {(m.start(), m.end(), x.label, x.priority) for x in every for m in x.pattern.finditer(line)}
        base = set(filter(None, brute(texts[r.doc_id])[4].split(",")))
        labels = base | {d[2] for d in plainly(found)}
        assert r.labels == ",".join(sorted(labels))
        seen |= labels - base
    assert seen


def test_repeated_lines_take_linear_time():
    began = time.time()
    found = scan("MIT license " * 80_000)
    assert (found["n_words"], found["n_base"], found["last_word"]) == (160_000, 80_000, 159_998)
    assert time.time() - began < 4


def test_hundreds_of_rules_each_behind_its_keyword():
    assert sum(map(len, rules().values())) > 250


def spelled(parsed):
    """Strings of a parsed pattern: every branch and letter of a class, optional parts left out and taken once."""
    ways = []
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            ways.append([chr(arg)])
        elif kind == "ANY":
            ways.append(["x"])
        elif kind == "IN":
            ways.append([chr(c) for o, a in arg for c in ([a] if str(o) == "LITERAL" else a)])
        elif kind == "BRANCH":
            ways.append([s for branch in arg[1] for s in spelled(branch)])
        elif kind == "SUBPATTERN":
            ways.append(spelled(arg[-1]))
        elif kind in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, part = arg
            ways.append([s * n for n in sorted({least, min(most, least + 1)}) for s in spelled(part)])
        else:
            raise ValueError(kind)
    return ["".join(w) for w in product(*ways)]


def test_every_rule_implies_its_keyword():
    for label, keyword, pattern, *_ in (*_NAMES, *_TEXTS):
        for text in spelled(re._parser.parse(pattern)):
            assert re.fullmatch(pattern, text), (pattern, text)
            assert keyword in text, (label, keyword, text)


def test_alternative_spellings_have_their_own_keyword():
    assert labels("Released under the PSF License, version 2.") == ["python-2.0"]
    assert labels("SPDX license identifier: PSF license") == ["python-2.0"]
    assert labels("the PSF license") == ["python-2.0"]
    assert labels("Unauthorised use of this software is forbidden.") == ["proprietary"]


def labels(text):
    return scan(text)["labels"].split(",")


def test_rules_priorities_and_containment():
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache", "apache-2.0"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by", "cc-by-nc"]
    assert labels("This work is licensed under the GNU General Public License, version 3") == ["gpl", "gpl-3.0"]
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == ["bsd-3-clause"]
    assert labels("Released under the MIT License.") == ["mit"]
    assert labels("GNU Lesser General Public License v2.1") == ["lgpl-2.1"]
    assert labels("submit licensee mitlicense") == [""]
    kept = detections(b"licensed under the terms of the mozilla public license version 2 0")
    assert [d[2:] for d in kept] == [("mpl-2.0", 85)]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "MIT LICENSE mit license"), (None, "É mit license"), (4, "x " * 100_000 + "cc by"),
            (4, "cc.by cc\tby"), (4, "cc.by cc\tby")]
    df = spark.createDataFrame([(*r, "l", 5) for r in rows], "doc_id long, text string, labels string, score int")
    got = [tuple(r) for r in find_licenses(df).collect()]
    assert [r[:6] for r in got] == [(d, *brute(t)) for d, t in rows]
    assert find_licenses(df.limit(0)).collect() == []
