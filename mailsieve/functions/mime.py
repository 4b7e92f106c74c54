"""Content types and small value helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailsieve.functions.text import blank, strip

# fixed values: textual types outside text/*, export choices per editor type (first is the default), extensions
TEXTUAL_TYPES = (
    "application/json", "application/xml", "application/xhtml+xml", "image/svg+xml", "application/javascript",
    "application/csv", "application/rtf",
)
EDITOR_PREFIX = "application/vnd.google-apps."
_WORD = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
_SHEET = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
EXPORTS = {
    "document": ("text/plain", _WORD, "application/pdf"),
    "spreadsheet": ("text/csv", _SHEET),
    "presentation": ("text/plain", "application/pdf"),
    "drawing": ("image/svg+xml", "image/png"),
}
EXTENSIONS = {
    "text/plain": ".txt", "text/csv": ".csv", "application/pdf": ".pdf", _WORD: ".docx", _SHEET: ".xlsx",
    "image/svg+xml": ".svg", "image/png": ".png",
}


def bare_mime(mime: Column) -> Column:
    """Lower-case type without parameters."""
    return F.lower(strip(F.substring_index(blank(mime), ";", 1)))


def is_textual_mime(mime: Column) -> Column:
    m = bare_mime(mime)
    known = m.startswith("text/") | m.endswith("+json") | m.endswith("+xml") | m.isin(list(TEXTUAL_TYPES))
    return m.contains("/") & known


def is_editor_mime(mime: Column) -> Column:
    return blank(mime).startswith(EDITOR_PREFIX)


def export_mime(mime: Column, preferred: Column) -> Column:
    """Allowed preference of an editor type, else its textual default; other types export as preferred."""
    pref = F.when(strip(blank(preferred)) != "", preferred)
    out = F.coalesce(pref, F.lit("application/octet-stream"))
    for kind, allowed in EXPORTS.items():
        out = F.when(
            mime == EDITOR_PREFIX + kind, F.when(pref.isin(list(allowed)), pref).otherwise(allowed[0])
        ).otherwise(out)
    return out


def ext_for_mime(mime: Column) -> Column:
    out = F.lit(None).cast("string")
    for m, e in EXTENSIONS.items():
        out = F.when(mime == m, e).otherwise(out)
    return out


def extract_resource_id(c: Column) -> Column:
    """Id inside a link, else the trimmed text itself."""
    s = strip(c)
    found = [F.regexp_extract(s, p, 1) for p in (r"/d/([a-zA-Z0-9_-]+)", r"/folders/([a-zA-Z0-9_-]+)", r"[?&]id=([a-zA-Z0-9_-]+)")]
    return F.coalesce(*[F.when(f != "", f) for f in found], F.when(s != "", s))


def norm_prefix(c: Column) -> Column:
    s = blank(c)
    return F.when((s == "") | s.endswith("/"), s).otherwise(F.concat(s, F.lit("/")))


def to_iso_utc(ts: Column) -> Column:
    """ISO-8601 text; the session time zone is UTC."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_int(c: Column) -> Column:
    return F.when(c.cast("string") != "", c.cast("string").try_cast("double").cast("long"))


def clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def csv_field(c: Column) -> Column:
    s = blank(c.cast("string"))
    return F.when(s.rlike("[,\"\n\r]"), F.concat(F.lit('"'), F.replace(s, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(s)


def url_component(c: Column) -> Column:
    """RFC 3986 escaping: Spark escapes for forms, so blanks, asterisks and tildes are put right."""
    s = F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))
    return F.replace(F.replace(s, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def encode_payload(c: Column, encoding: str = "url") -> Column:
    if encoding == "base64":
        return F.regexp_replace(F.base64(F.encode(c, "UTF-8")), r"[\r\n]", "")
    if encoding == "base64url":
        plain = F.regexp_replace(F.base64(F.encode(c, "UTF-8")), r"[\r\n]", "")
        return F.regexp_replace(F.translate(plain, "+/", "-_"), "=+$", "")
    return url_component(c)


def build_url(base: Column, param: str, payload: Column, encoding: str = "url") -> Column:
    sep = F.when(base.contains("?"), "&").otherwise("?")
    name = F.coalesce(F.when(strip(F.lit(param)) != "", url_component(strip(F.lit(param)))), F.lit("prefill"))
    return F.concat(base, sep, name, F.lit("="), encode_payload(payload, encoding))


def layered_payload(
    static: Column, mapped: Column, prefill: Column, entries: Column | None = None, key_template: str = "field_{{i}}",
    index_start: int = 0, include_blank: bool = False, wrapped: bool = False,
) -> Column:
    """Map of the payload: later layers win, blanks are skipped, entries expand ``{{i}}`` and ``{{field}}``."""
    from mailsieve.operators.chunking import merge_maps

    layers = [static, mapped, prefill]
    if entries is not None:
        def keyed(entry: Column, i: Column) -> Column:
            n = (i + index_start).cast("string")
            return F.transform_keys(
                entry, lambda k, v: F.replace(F.replace(F.lit(key_template), F.lit("{{i}}"), n), F.lit("{{field}}"), k)
            )

        empty = F.create_map().cast("map<string,string>")
        layers.append(F.aggregate(F.transform(entries, keyed), empty, lambda a, m: merge_maps(a, m)))

    def present(m: Column) -> Column:
        return m if include_blank else F.map_filter(m, lambda k, v: strip(blank(v)) != "")

    out = merge_maps(*[present(m) for m in layers])
    if wrapped:
        out = F.transform_values(out, lambda k, v: F.struct(v.alias("value"), F.lit(False).alias("disabled")))
    return out


def require(payload: Column, fields) -> Column:
    """Names of required fields the payload lacks."""
    return F.array_compact(F.array(*[F.when(~F.map_contains_key(payload, f), f) for f in fields]).cast("array<string>"))
