"""Licence detection by ordered signature rules: keyword gates, priorities, containment suppression."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mailsieve.llm.streams import bounded_batches, slices

# Words and base phrases.
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}

#: Licences: label, keyword that a text must hold, name as it reads without punctuation.
_NAMES = (
    ("gpl-1.0", "general public license", r"(?:gnu )?general public license(?: version| v)? ?1(?: 0)?"),
    ("gpl-2.0", "general public license", r"(?:gnu )?general public license(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", "general public license", r"(?:gnu )?general public license(?: version| v)? ?3(?: 0)?"),
    ("gpl-1.0", "gpl", r"(?:gnu )?gpl(?: version| v)? ?1(?: 0)?"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2.0", "library general", r"(?:gnu )?library general public license(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "lesser general", r"(?:gnu )?lesser general public license(?: version| v)? ?2 1"),
    ("lgpl-3.0", "lesser general", r"(?:gnu )?lesser general public license(?: version| v)? ?3(?: 0)?"),
    ("lgpl-2.0", "lgpl", r"(?:gnu )?lgpl(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: version| v)? ?2 1"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl(?: version| v)? ?3(?: 0)?"),
    ("agpl-1.0", "affero", r"affero general public license(?: version| v)? ?1(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: version| v)? ?3(?: 0)?"),
    ("gfdl", "documentation", r"gnu free documentation license(?: version 1 [123])?"),
    ("apache-1.0", "apache", r"apache(?: software)? license(?: version| v)? ?1 0"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: version| v)? ?1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("cc-by-1.0", "cc by", r"cc by 1 0"),
    ("cc-by-2.0", "cc by", r"cc by 2 0"),
    ("cc-by-2.5", "cc by", r"cc by 2 5"),
    ("cc-by-3.0", "cc by", r"cc by 3 0"),
    ("cc-by-4.0", "cc by", r"cc by 4 0"),
    ("cc-by-sa", "cc by sa", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nd", "cc by nd", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-nc", "cc by nc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by", "attribution", r"creative commons attribution(?: license)?(?: [1-4] [05])?"),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike(?: license)?(?: [1-4] [05])?"),
    ("cc-by-sa", "share alike", r"creative commons attribution share alike(?: license)?(?: [1-4] [05])?"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial(?: license)?(?: [1-4] [05])?"),
    ("cc-by-nc", "non commercial", r"creative commons attribution non commercial(?: license)?(?: [1-4] [05])?"),
    ("cc-by-nd", "noderivatives", r"creative commons attribution noderivatives(?: license)?(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "noncommercial", r"creative commons attribution noncommercial share ?alike(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "noncommercial", r"creative commons attribution noncommercial no ?derivatives(?: [1-4] [05])?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "zero", r"creative commons zero(?: 1 0)?"),
    ("mit-0", "attribution", r"mit no attribution(?: license)?"),
    ("mit", "expat", r"expat(?: mit)?(?: license)?"),
    ("mit", "x11", r"x11(?: mit)?(?: style)? license"),
    ("mit", "mit licen", r"mit licen[cs]e"),
    ("mit", "mit style", r"mit style licen[cs]e"),
    ("mit", "mit expat", r"mit expat licen[cs]e"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: license)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd)(?: license)?"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("libpng", "libpng", r"libpng license(?: version 2)?"),
    ("boost-1.0", "boost", r"boost software license(?: version)?(?: 1 0)?"),
    ("mpl-1.0", "mozilla", r"mozilla public license(?: version| v)? ?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl-2.0", "mpl", r"mpl ?2(?: 0)?"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("edl-1.0", "eclipse", r"eclipse distribution license(?: version| v)?(?: 1 0)?"),
    ("cddl-1.0", "common development", r"common development and distribution license(?: version)?(?: 1 0)?"),
    ("cddl-1.0", "cddl", r"cddl(?: version)?(?: 1 0)?"),
    ("cpl-1.0", "common public", r"common public license(?: version)?(?: 1 0)?"),
    ("cpal-1.0", "common public", r"common public attribution license(?: version)?(?: 1 0)?"),
    ("eupl-1.1", "european union", r"european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e(?: version| v)? ?1 2"),
    ("artistic-1.0", "artistic", r"artistic license(?: version)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: version)? ?2(?: 0)?"),
    ("perl", "perl", r"same terms as perl(?: itself)?"),
    ("python-2.0", "python", r"python software foundation license(?: version 2)?"),
    ("python-2.0", "psf", r"psf license(?: version 2)?"),
    ("ruby", "ruby", r"ruby s? ?license"),
    ("php-3.01", "php", r"php license(?: version)? ?3(?: 01)?"),
    ("postgresql", "postgresql", r"postgresql license"),
    ("openssl", "openssl", r"openssl license"),
    ("unlicense", "unlicense", r"the unlicense|unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: version 2)?"),
    ("public-domain", "public domain", r"public domain(?: dedication)?"),
    ("afl-3.0", "academic free", r"academic free license(?: version| v)?(?: 3 0)?"),
    ("osl-3.0", "open software", r"open software license(?: version| v)?(?: 3 0)?"),
    ("ms-pl", "microsoft public", r"microsoft public license"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal license"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? license"),
    ("upl-1.0", "universal permissive", r"universal permissive license(?: version)?(?: 1 0)?"),
    ("ofl-1.1", "open font", r"(?:sil )?open font license(?: version)?(?: 1 [01])?"),
    ("odbl-1.0", "open database", r"open database license(?: version| v)?(?: 1 0)?"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution license(?: version| v)?(?: 1 0)?"),
    ("pddl-1.0", "open data commons", r"open data commons public domain dedication(?: and license)?"),
    ("elastic-2.0", "elastic", r"elastic license(?: version)?(?: 2 0)?"),
    ("sspl-1.0", "server side", r"server side public license(?: version)?(?: 1)?"),
    ("busl-1.1", "business source", r"business source license(?: version)?(?: 1 1)?"),
    ("bsla", "beerware", r"beerware(?: license)?(?: revision 42)?"),
    ("json", "json", r"json license"),
    ("vim", "vim", r"vim license"),
    ("w3c", "w3c", r"w3c software(?: notice and)? license"),
    ("openrail", "openrail", r"(?:bigscience )?openrail(?: m)?(?: license)?"),
    ("proprietary", "proprietary", r"proprietary(?: software)? license"),
)

#: Ways in which a name stands in a text: what surrounds it and the priority.
_FRAMES = (
    (r"spdx license identifier {}(?: only| or later)?", 95),
    (r"(?:licensed|released|distributed|published|available|provided|covered|redistributed?) under(?: the)?"
     r"(?: terms of)?(?: the)? {}(?: only| or later| international| unported| license)*", 85),
    (r"{}(?: only| or later| international| unported)*", 60),
)

#: Sentences that stand in the licence texts themselves: label, keyword, signature, priority.
_TEXTS = (
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this"
     r" software", 90),
    ("mit", "above copyright", r"the above copyright notice and this permission notice shall be included in all"
     r" copies", 80),
    ("isc", "with or without fee", r"permission to use copy modify and or distribute this software for any purpose"
     r" with or without fee is hereby granted", 90),
    ("bsd", "redistribution and use", r"redistribution and use in source and binary forms with or without"
     r" modification are permitted", 75),
    ("bsd-3-clause", "endorse or promote", r"neither the names? of .{1,90}? (?:may|nor the names of its contributors"
     r" may) be used to endorse or promote products", 90),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must"
     r" display", 92),
    ("apache-2.0", "applicable law", r"unless required by applicable law or agreed to in writing software", 88),
    ("apache-2.0", "in compliance", r"you may not use this file except in compliance with the license", 88),
    ("gpl", "free software", r"this program is free software you can redistribute it and or modify it", 80),
    ("gpl", "warranty", r"this program is distributed in the hope that it will be useful but without any warranty",
     80),
    ("lgpl", "library", r"this library is free software you can redistribute it and or modify it", 82),
    ("lgpl", "lesser", r"gnu lesser general public license", 55),
    ("agpl", "affero", r"gnu affero general public license", 55),
    ("gpl", "received a copy", r"you should have received a copy of the gnu general public license", 78),
    ("mpl-2.0", "this source code form", r"this source code form is subject to the terms of the mozilla public"
     r" license", 92),
    ("epl-2.0", "accompanying materials", r"this program and the accompanying materials are made available under the"
     r" terms of the eclipse", 92),
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented", 88),
    ("boost-1.0", "machine executable", r"machine executable object code generated by a source language processor",
     90),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 93),
    ("public-domain", "dedicate", r"dedicates? (?:any and all copyright|this work) .{0,80}?to the public domain", 80),
    ("cc0-1.0", "waived all", r"has waived all copyright and related or neighboring rights", 88),
    ("wtfpl", "do what", r"do what the fuck you want to public license", 93),
    ("ofl-1.1", "font software", r"font software is licensed under the sil open font license", 93),
    ("proprietary", "all rights", r"all rights reserved", 40),
    ("proprietary", "confidential", r"confidential and proprietary", 60),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|use|distribution) of this (?:file|work|software)", 65),
    ("proprietary", "unauthorised", r"unauthorised (?:copying|use|distribution) of this (?:file|work|software)", 65),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}", 30),
)

#: Confidence of a base phrase.
BASE_PRIORITY = 70


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    pattern: re.Pattern
    priority: int


@cache
def rules() -> dict[bytes, list[Rule]]:
    """All rules by keyword, each with its pattern compiled; patterns match whole words."""
    rows = [(label, key, frame.format(f"(?:{name})"), rank) for label, key, name in _NAMES for frame, rank in _FRAMES]
    out: dict[bytes, list[Rule]] = {}
    for label, keyword, text, rank in (*rows, *_TEXTS):
        pattern = re.compile(rf"(?<![^ ])(?:{text})(?![^ ])".encode())
        out.setdefault(keyword.encode(), []).append(Rule(label, keyword.encode(), pattern, rank))
    return out


@cache
def _base() -> list[tuple[bytes, re.Pattern, str]]:
    return [(p.encode(), re.compile(rf"(?<![^ ]){p}(?![^ ])".encode()), label) for p, label in BASE.items()]


def detections(line: bytes) -> list[tuple[int, int, str, int]]:
    """(start, stop, label, priority) in a line of words: by priority, then length, then place, without those
    that lie inside one before them."""
    found: set[tuple[int, int, str, int]] = set()
    for keyword, own in rules().items():
        if keyword in line:
            for rule in own:
                found |= {(m.start(), m.end(), rule.label, rule.priority) for m in rule.pattern.finditer(line)}
    return uncontained(found)


def _furthest(spans: Iterable[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts in order and, for each, the furthest end of a span that starts there or before."""
    ordered = sorted(spans)
    return [s for s, _ in ordered], list(accumulate((e for _, e in ordered), max))


def uncontained(found: set[tuple[int, int, str, int]]) -> list[tuple[int, int, str, int]]:
    """``found`` by priority, then length, then place and label, without those inside one before them.

    What lies inside a dropped one lies inside that one's own container too, so it is enough to look at all before:
    by the furthest end of spans of higher priority, and of longer ones of the same.  Sorting is all it costs.
    """
    kept, above = [], []
    for priority in sorted({d[3] for d in found}, reverse=True):
        own = sorted((d for d in found if d[3] == priority), key=lambda d: (d[0] - d[1], d[0], d[2]))
        spans = {d[:2] for d in own}
        high, high_ends = _furthest(above)
        same, same_ends = _furthest(spans)
        longest = {s: e for s, e in sorted(spans)}
        seen: set[tuple[int, int]] = set()
        for d in own:
            i, j = bisect_right(high, d[0]), bisect_left(same, d[0])
            inside = i and high_ends[i - 1] >= d[1] or j and same_ends[j - 1] >= d[1] or longest[d[0]] > d[1]
            if not inside and d[:2] not in seen:
                kept.append(d)
            seen.add(d[:2])
        above += spans
    return kept


def scan(text: str | None) -> dict:
    """What the operator says of one text."""
    words = _WORD.findall((text or "").encode().lower())
    line = b" ".join(words)
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    places, base = [], set()
    for phrase, pattern, label in _base():
        if phrase in line:
            own = np.searchsorted(blanks, [m.start() for m in pattern.finditer(line)]).tolist()
            places += own
            base |= {label} if own else set()
    kept = detections(line)
    labels = base | {d[2] for d in kept}
    score = max([d[3] for d in kept] + [BASE_PRIORITY] * bool(base), default=0) / 100
    return {
        "n_words": len(words), "n_base": len(places), "first_word": min(places, default=None),
        "last_word": max(places, default=None), "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)), "score": score,
    }


_FIELDS = (
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
)
_SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            made = [scan(t) for t in part.column("text").to_pylist()]
            cols = [pa.array([m[n] for m in made], kind) for n, kind in _FIELDS]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *cols], ["doc_id", *[n for n, _ in _FIELDS]])


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, ...) with its words, base phrases and licence labels.

    Words are runs of digits, letters a-z (A-Z lower-cased) and anything beyond ASCII; rules read them with one
    blank between.  A rule runs only where its keyword occurs; detections inside one of higher priority (or
    of the same and longer) are dropped; base labels stay.  ``score`` is the best priority as a share.
    Null and empty texts have no words and no labels.  Rows never move.  Extra columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    schema = rows.select("doc_id").schema
    for field in _SCHEMA.split(", "):
        schema = schema.add(*field.split(" "))
    return bounded_batches(rows).mapInArrow(_scan_batches, schema)
