"""Text functions as column expressions (whole-stage code, no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: patterns that decide what is removed from a message
URL_PATTERN = r"""https?://[^\s<>"'()]+"""
EMAIL_PATTERN = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z|]{2,}\b"
PHONE_PATTERN = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
ACCENT_PATTERN = r"(?iu)[àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ]"
QUOTE_LINE = r"^\s*>|(?i)^On .+ wrote:\s*$|(?i)^-----Original Message-----\s*$"
FROM_LINE = r"(?i)^\s*From:\s.+"
HEADER_LINE = r"(?i)^\s*(Sent|To|Subject):"
SIGNATURE_LINE = (
    r"(?i)^\s*(--\s*$|—\s*$)"
    r"|^\s*(Best regards|Regards|Sincerely|Thanks|Kind regards|Cheers)[,–-]?\s*$"
    r"|^\s*Sent from my"
)
DISCLAIMER_LINE = (
    r"(?i)(confidentiality notice|confidential|privileged|intended only for the (addressee|recipient)"
    r"|unauthorized (review|disclosure))"
    r"|(This (e-)?mail|This message).*(confidential|intended only)"
)
# runs of blanks that are not already one space: single spaces are left alone instead of being rewritten
BLANK_RUNS = r"[ \t]{2,}|\t"
# fixed values: words never reported as a key topic
TOPIC_STOPWORDS = (
    "the", "a", "an", "and", "or", "but", "in", "on", "at", "to", "for", "of", "with", "by", "from", "is", "are",
    "was", "were", "be", "been", "being", "this", "that", "these", "those", "there", "here", "then", "than", "into",
    "out", "over", "under", "after", "before", "about", "as", "it", "its", "it's", "their", "them", "they", "our",
    "we", "you", "your", "he", "she", "his", "her", "him", "not", "will", "would", "can", "could", "should", "may",
    "might", "must", "also", "just", "more", "most", "other", "some", "such",
)


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def strip(c: Column) -> Column:
    """Remove whitespace of every kind at both ends (looks at the ends only, never at the whole text)."""
    return F.btrim(c, F.lit(" \t\n\u000b\f\r"))


# fixed values: named entities of markup
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def decode_entities(s: Column) -> Column:
    """Named and numeric entities, each decoded once; numbers that name no character stay as they are."""
    mark = "\u0001"
    names = "|".join(e[1:-1] for e, _ in ENTITIES)
    entity = rf"(&(?:#[xX][0-9a-fA-F]{{1,6}}|#[0-9]{{1,7}}|{names});)"
    parts = F.split(F.regexp_replace(s, entity, f"{mark}$1{mark}"), mark)

    def decode(p: Column) -> Column:
        inner = F.regexp_extract(p, r"^&#([xX]?[0-9a-fA-F]+);$", 1)
        n = F.when(inner.rlike("^[xX]"), F.conv(F.substring(inner, 2, 8), 16, 10)).otherwise(inner).try_cast("int")
        byte = lambda v: F.lpad(F.hex(v), 2, "0")
        tail = lambda k: F.shiftright(n, k).bitwiseAND(63) + 128
        utf8 = (
            F.when(n < 0x80, byte(n)).when(n < 0x800, F.concat(byte(F.shiftright(n, 6) + 192), byte(tail(0))))
            .when(n < 0x10000, F.concat(byte(F.shiftright(n, 12) + 224), byte(tail(6)), byte(tail(0))))
            .otherwise(F.concat(byte(F.shiftright(n, 18) + 240), byte(tail(12)), byte(tail(6)), byte(tail(0)))))
        out = F.when((n > 0) & (n < 0x110000) & ~n.between(0xD800, 0xDFFF), F.decode(F.unhex(utf8), "UTF-8"))
        for name, char in ENTITIES:
            out = out.when(p == name, char)
        return out.otherwise(p)

    return F.array_join(F.transform(parts, decode), "")


def html_to_text(c: Column) -> Column:
    s = F.regexp_replace(c, r"(?is)<script\b.*?</script>", "")
    s = F.regexp_replace(s, r"(?is)<style\b.*?</style>", "")
    s = F.regexp_replace(s, r"(?i)</(p|div|h\d|li|br|tr)>", "\n")
    s = F.regexp_replace(s, r"(?i)<li[^>]*>", "• ")
    s = F.regexp_replace(s, r"</?[^>]+>", "")
    s = F.when(s.contains("&"), decode_entities(s)).otherwise(s)
    return F.when(strip(blank(c)) == "", blank(c)).otherwise(s)


def strip_unicode_noise(c: Column) -> Column:
    """No-break space becomes a space; zero-width characters go."""
    return F.regexp_replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), "[\u200b-\u200d\ufeff]", "")


def normalize_ws(c: Column) -> Column:
    s = F.regexp_replace(c, BLANK_RUNS, " ")
    return strip(F.regexp_replace(s, r"\n{3,}", "\n\n"))


def collapse_ws(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s{2,}|[^\S ]", " "))


def extract_urls(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(URL_PATTERN), F.lit(0))


def strip_urls(c: Column) -> Column:
    return F.regexp_replace(c, r"https?://\S+|www\.\S+", "")


def mask_pii(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, EMAIL_PATTERN, "[EMAIL]"), PHONE_PATTERN, "[PHONE]")


def extract_query(c: Column) -> Column:
    """First paragraph that is not blank, else the first 200 characters."""
    paragraphs = F.filter(F.split(c, r"\n{2,}"), lambda p: strip(p) != "")
    return F.coalesce(F.try_element_at(paragraphs, F.lit(1)), F.left(c, F.lit(200)))


# --- line-based cuts: each works on an array of lines and returns the number of lines to keep ----------


def as_lines(c: Column) -> Column:
    return F.split(F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"\n$", ""), "\n")


def _positions(lines: Column, test) -> Column:
    """0-based positions of the lines for which ``test(line, position)`` holds."""
    return F.filter(F.transform(lines, lambda l, i: F.when(test(l, i), i)), lambda i: i.isNotNull())


def quote_cut(lines: Column) -> Column:
    """Lines before the first quoted or forwarded block (null: no block)."""

    def starts_block(line: Column, i: Column) -> Column:
        header = line.rlike(FROM_LINE) & F.exists(F.slice(lines, i + 1, 6), lambda h: h.rlike(HEADER_LINE))
        return line.rlike(QUOTE_LINE) | header

    return F.array_min(_positions(lines, starts_block))


def tail_cut(lines: Column, pattern: str, window: int) -> Column:
    """Lines before the last line that matches within the final ``window`` lines (null: none does)."""
    first = F.greatest(F.size(lines) - window, F.lit(0))
    tail = F.slice(lines, first + 1, max(window, 1)) if window > 0 else F.array().cast("array<string>")
    return first + F.array_max(_positions(tail, lambda l, i: l.rlike(pattern)))


def signature_cut(lines: Column, window: int = 40) -> Column:
    return tail_cut(lines, SIGNATURE_LINE, max(window, 0))


def disclaimer_cut(lines: Column, window: int = 80) -> Column:
    return tail_cut(lines, DISCLAIMER_LINE, window)


def drop_quoted_lines(lines: Column) -> Column:
    return F.filter(lines, lambda l: ~F.ltrim(l).startswith(">"))


# --- measures ----------------------------------------------------------------------------------


def est_tokens(c: Column, chars_per_token: float = 4.0) -> Column:
    return F.ceil(F.length(c) / F.lit(float(chars_per_token)))


def word_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"\S+")).cast("long")


def language_flag(c: Column) -> Column:
    return F.when(c.rlike(ACCENT_PATTERN), "non-english").otherwise("english")


def summary(c: Column, n: int = 200) -> Column:
    return F.concat(F.left(c, F.lit(n)), F.when(F.length(c) > n, "...").otherwise(""))


def truncate_chunk(c: Column, n: int = 800) -> Column:
    return F.left(collapse_ws(c), F.lit(n))


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays; 0 when either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def _blank_split(c: Column) -> Column:
    """Parts between blanks: a leading empty part counts, trailing ones don't."""
    ended = F.rtrim(c, F.lit(" \t\n\u000b\f\r"))
    return F.when(ended == "", F.array().cast("array<string>")).otherwise(F.split(ended, r"\s+"))


def token_change(a: Column, b: Column) -> Column:
    """Percentage of distinct whitespace tokens that two texts do not share."""
    ta, tb = _blank_split(a), _blank_split(b)
    union = F.size(F.array_union(ta, tb))
    shared = F.size(F.array_intersect(ta, tb))
    return F.when(union == 0, 0.0).otherwise(F.round((1.0 - shared / union) * 100, 2))


def salience(c: Column, max_chars: int = 500) -> Column:
    """First real sentence of the whole text after subject and greeting, else its head."""
    n = min(max(max_chars, 80), 2000)
    focus = F.regexp_replace(
        c, r"(?i)\A\s*(subject:\s*[^\n]+\n+)?\s*(hi|hello|hey)[^a-z0-9]*\n+", ""
    )
    mark = "\u0001"
    sentences = F.split(F.regexp_replace(focus, r"([.!?])\s+", "$1" + mark), mark)
    good = F.filter(
        sentences, lambda s: (F.length(strip(s)) >= 12) & ~s.rlike(r"(?i)\A(hi|hello|hey)\b")
    )
    return F.left(strip(F.coalesce(F.try_element_at(good, F.lit(1)), F.left(focus, F.lit(n)))), F.lit(n))


# fixed values: repairs of extracted text in the order in which they must be made
PDF_ESCAPES = (
    ("\\\\n", "\n"), ("\\\\t", " "), ("\\\\r", ""), ('\\\\"', '"'), ("\\\\'", "'"), ("\\\\", "\\"),
    ("\\n", "\n"), ("\\t", " "), ("\\r", ""),
)
PDF_RULES = (
    (r"[\x00-\x08\x0b\x0c\x0e-\x1f]", ""),
    (r"(\w)-\n(\w)", "$1$2"),
    (r"\r\n|\r", "\n"),
    (r"\n{3,}", "\n\n"),
    (BLANK_RUNS, " "),
    (r"(?m)^[ \t]+|[ \t]+$", ""),
    (r"##(\w)", "## $1"),
    (r"(?m)\.\.+$", "..."),
    (r"\s*\n\s*-\s*", "\n• "),
    (r"([.!?])\s*\n+([A-Z])", "$1 $2"),
    (r"\[\s*\]", ""),
    (r"\(\s*\)", ""),
)


def sanitize_pdf(c: Column, input_cap: int | None = None, output_cap: int | None = None) -> Column:
    """Repair text extracted from PDF files: escapes, control characters, line layout, bullets, trims.

    Whole texts by default; a cap cuts and marks what is longer.
    """
    marker = "...[truncated]"

    def cap(s: Column, n: int | None) -> Column:
        if n is None:
            return s
        # the cap keeps n + 1 characters
        return F.when(F.length(s) > n, F.concat(F.left(s, F.lit(n + 1)), F.lit(marker))).otherwise(s)

    s = cap(c, input_cap)
    for old, new in PDF_ESCAPES:
        s = F.replace(s, F.lit(old), F.lit(new))
    for pattern, new in PDF_RULES:
        s = F.regexp_replace(s, pattern, new)
    s = F.regexp_replace(strip(s), r"\s+\n", "\n")
    s = F.regexp_replace(s, r"\n\s+", "\n")
    return strip(cap(s, output_cap))
