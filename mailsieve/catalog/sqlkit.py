"""Small text helpers for oracle SQL (DuckDB dialect)."""

from __future__ import annotations


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(expr: str, pattern: str, new: str = "", flags: str = "g") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(new)}, {q(flags)})"


def chain(expr: str, *rules: tuple[str, str]) -> str:
    for pattern, new in rules:
        expr = sub(expr, pattern, new)
    return expr


def strip(expr: str) -> str:
    return sub(sub(expr, r"^\s+"), r"\s+$")


def norm_ws(expr: str) -> str:
    return strip(sub(sub(expr, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def has(expr: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({expr}, {q(pattern)}" + (f", {q(flags)})" if flags else ")")


def lines(expr: str) -> str:
    return f"string_split({sub(f'replace({expr}, chr(13) || chr(10), chr(10))', chr(92) + 'n$')}, chr(10))"
