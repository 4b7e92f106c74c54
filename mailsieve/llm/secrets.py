"""Secrets in texts: plain patterns, and weak parts that count only beside their complements."""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mailsieve.llm.streams import slices

#: Kinds in the order that breaks ties between spans with the same start.
KINDS = ("assign", "access", "hex", "identifier", "key", "endpoint")
#: Parts of one credential lie in one paragraph, at most so many code points apart.
REACH = 300
#: A weak key has at least so many bits a character.
KEY_BITS = 3.5

# The base patterns.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LEAST = {"assign": 6, "access": 20, "hex": 24}

# The method's own patterns.
_IDENTIFIER = re.compile(
    r"""\b(?:user(?:name)?|login|client[_-]?id|account[_-]?(?:id|name)|access[_-]?key[_-]?id)["']?\x20*[:=]\x20*"""
    r"""["']?([A-Za-z0-9@._-]{3,})""", re.I | re.A)
_KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
_ENDPOINT = re.compile(
    r"""\b(?:https?|ftps?|ssh|amqps?|redis|mongodb|postgres(?:ql)?|mysql)://[^\s"'<>]+"""
    r"""|\b(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9.-]+\.[A-Za-z]{2,}(?::[0-9]+)?)""",
    re.I | re.A)
_PARAGRAPH = re.compile(r"\n[ \t\r]*\n")

_HEX_RUN = bytes(ord("h") if chr(i) in "0123456789abcdef" else 0 for i in range(256))
_KEY_RUN = bytes(ord("k") if i < 128 and (chr(i).isalnum() or chr(i) in "+/_-") else 0 for i in range(256))

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base pattern, without those that are too short."""
    out: list[Span] = []
    small = text.lower()
    if any(word in small for word in ("password", "passwd", "secret", "token", "api")):
        out += [
            ("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _LEAST["assign"]]
    if "AKIA" in text:
        out += [
            ("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= _LEAST["access"]]
    if b"h" * _LEAST["hex"] in text.encode().translate(_HEX_RUN):
        out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text) if len(m[0]) >= _LEAST["hex"]]
    return out


def _bits(word: str) -> float:
    n = len(word)
    return -sum(c / n * math.log2(c / n) for c in Counter(word).values())


def weak_spans(text: str, base: list[Span]) -> list[Span]:
    """Parts that are no secret by themselves and lie outside the base spans."""
    out: list[Span] = []
    small = text.lower()
    if any(word in small for word in ("user", "login", "client", "account", "access")):
        out += [("identifier", *m.span(1)) for m in _IDENTIFIER.finditer(text)]
    if b"k" * 20 in text.encode().translate(_KEY_RUN):
        out += [
            ("key", m.start(), m.end()) for m in _KEY.finditer(text)
            if re.search("[0-9]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0])
            and _bits(m[0]) >= KEY_BITS]
    if "://" in text or any(word in small for word in ("host", "endpoint", "server")):
        out += [("endpoint", *(m.span(1) if m[1] else m.span())) for m in _ENDPOINT.finditer(text)]
    taken = sorted((a, b) for _, a, b in base)
    heads, tops = [a for a, _ in taken], []
    for _, b in taken:
        tops.append(max(b, tops[-1] if tops else 0))
    free = []
    for kind, a, b in out:
        k = bisect_left(heads, b)
        if not k or tops[k - 1] <= a:
            free.append((kind, a, b))
    return free


#: Which parts a span can be, and which must be near for a weak one to count.
_PART = {
    "assign": "secret", "hex": "secret", "key": "secret", "access": "identifier", "identifier": "identifier",
    "endpoint": "endpoint",
}
_NEEDS = {
    "key": (("identifier",), ("endpoint",)), "identifier": (("secret",),), "endpoint": (("identifier", "secret"),)}


def linked_spans(text: str, base: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """The weak spans with their complements in scope: an interval join by paragraph and distance.

    A key needs an identifier or an endpoint, an identifier a secret, an endpoint an identifier and a secret.
    Each part's intervals are sorted once, so a span asks for its neighbour by bisection.
    """
    if not weak:
        return []
    walls = [m.start() for m in _PARAGRAPH.finditer(text)]
    places: dict[tuple[str, int], list[tuple[int, int]]] = {}
    for kind, a, b in [*base, *weak]:
        places.setdefault((_PART[kind], bisect_right(walls, a)), []).append((a, b))
    tops: dict[tuple[str, int], list[int]] = {}
    for key, own in places.items():
        own.sort()
        most, run = 0, []
        for _, b in own:
            most = max(most, b)
            run.append(most)
        tops[key] = run

    def near(part: str, scope: int, a: int, b: int) -> bool:
        own = places.get((part, scope))
        if not own:
            return False
        k = bisect_right(own, (b + reach, math.inf))
        return k > 0 and tops[part, scope][k - 1] >= a - reach

    return [
        (kind, a, b) for kind, a, b in weak
        if any(all(near(p, bisect_right(walls, a), a, b) for p in parts) for parts in _NEEDS[kind])]


def find_spans(text: str, reach: int = REACH) -> list[Span]:
    """All spans by start, then kind as in KINDS, then end; starts and ends in code points, end exclusive."""
    base = base_spans(text)
    out = base + linked_spans(text, base, weak_spans(text, base), reach)
    return sorted(set(out), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redact(text: str, mark: str = "<redacted>") -> str:
    """``text`` with every span replaced by ``mark``, again until none is left."""
    while spans := find_spans(text):
        out, at = [], 0
        for _, a, b in spans:
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        text = "".join(out) + text[at:]
    return text


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))


def _per_row(keep: list[str], target: str, kind: pa.DataType, work: Callable) -> Callable:
    """For each row the columns ``keep`` and ``target``, made of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                made = pa.array([work(x) for x in part.column("text").to_pylist()], kind)
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in keep], made], [*keep, target])

    return run


def _spans_of(text: str | None) -> list[dict]:
    return [{"kind": k, "start": a, "stop": b} for k, a, b in find_spans(text or "")]


def _redact_or_null(text: str | None) -> str | None:
    return None if text is None else redact(text)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) -> (doc_id, spans array<struct<kind, start, stop>>), one row for each row.

    Base kinds are assign, access and hex; identifier, key and endpoint are weak parts of a credential,
    reported only with their complements in the same paragraph and within REACH.  Null and empty texts have no
    spans.  Rows never move, and a text needs memory in proportion to itself.  Extra columns are ignored.
    """
    spans = StructType.fromDDL("spans array<struct<kind: string, start: bigint, stop: bigint>>")
    schema = StructType([*docs.select("doc_id").schema.fields, *spans.fields])
    return docs.select("doc_id", "text").mapInArrow(_per_row(["doc_id"], "spans", _SPANS, _spans_of), schema)


def remove_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced, and ``n_chars``, if there, counted again."""
    names = docs.columns
    rest = [n for n in names if n != "text"]
    schema = docs.select(rest).schema.add("text", "string")
    out = docs.mapInArrow(_per_row(rest, "text", pa.string(), _redact_or_null), schema)
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        changed = F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))
        out = out.withColumn("n_chars", changed)
    return out.select(names)


def secret_digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row of ``docs``."""
    found = find_secrets(docs)
    line = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", line), ",").alias("spans"))
