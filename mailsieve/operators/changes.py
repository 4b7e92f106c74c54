"""Change detection between two snapshots of a document set."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mailsieve.functions.text import token_change

#: How many lines ahead a line is looked for on the other side.
LOOK_AHEAD = 20
_SECTION = (
    "struct<type:string,current_start:int,current_end:int,previous_start:int,previous_end:int,"
    "current_lines:array<string>,previous_lines:array<string>>"
)
DIFF_DDL = (
    f"added array<string>, removed array<string>, sections array<{_SECTION}>, line_change_percentage double"
)


def _lines(text: str) -> list[str]:
    return text.rstrip("\n").split("\n") if text.rstrip("\n") else []


class _Places:
    """Where each line of a text occurs."""

    def __init__(self, lines: list[str]) -> None:
        self.at: dict[str, list[int]] = {}
        for k, line in enumerate(lines):
            self.at.setdefault(line, []).append(k)

    def soon_after(self, line: str, place: int) -> int | None:
        """First occurrence after ``place`` that is at most LOOK_AHEAD lines away."""
        own = self.at.get(line, ())
        k = bisect_right(own, place)
        return own[k] if k < len(own) and own[k] - place <= LOOK_AHEAD else None


def matched_lines(cur: list[str], prev: list[str]) -> list[tuple[int, int]]:
    """Pairs of places whose lines are taken to be the same line.

    Both sides are walked together.  Where they differ, a line of the previous text that comes up soon in the
    current one is matched there, else a line of the current text that comes up soon in the previous one.
    """
    in_cur, in_prev = _Places(cur), _Places(prev)
    pairs: list[tuple[int, int]] = []
    at = (0, 0)
    while at[0] < len(cur) and at[1] < len(prev):
        i, j = at
        if cur[i] == prev[j]:
            pairs.append(at)
        elif (k := in_cur.soon_after(prev[j], i)) is not None:
            pairs.append((k, j))
        elif (k := in_prev.soon_after(cur[i], j)) is not None:
            pairs.append((i, k))
        last = pairs[-1] if pairs and pairs[-1] >= at else at
        at = (last[0] + 1, last[1] + 1)
    return pairs


def diff_lines(current: str, previous: str) -> dict:
    """Added and removed lines and changed sections, all read off the gaps between matched lines.

    In a gap, lines face each other one by one as modified sections; what is left over on one side is a
    single added or removed section.  Ranges are inclusive; the side without lines gives the line before.
    """
    cur, prev = _lines(current), _lines(previous)
    added: list[str] = []
    removed: list[str] = []
    sections: list[dict] = []
    start = (0, 0)
    for stop in [*matched_lines(cur, prev), (len(cur), len(prev))]:
        facing = min(stop[0] - start[0], stop[1] - start[1])
        blocks = [("modified", start[0] + k, 1, start[1] + k, 1) for k in range(facing)]
        i, j = start[0] + facing, start[1] + facing
        if i < stop[0]:
            blocks.append(("added", i, stop[0] - i, j, 0))
        elif j < stop[1]:
            blocks.append(("removed", i, 0, j, stop[1] - j))
        for kind, a, n, b, m in blocks:
            new, old = cur[a : a + n], prev[b : b + m]
            added += new
            removed += old
            sections.append({
                "type": kind, "current_start": a if n else a - 1, "current_end": a + n - 1,
                "previous_start": b if m else b - 1, "previous_end": b + m - 1, "current_lines": new,
                "previous_lines": old,
            })
        start = (stop[0] + 1, stop[1] + 1)
    most = max(len(cur), len(prev))
    share = float(Decimal((len(added) + len(removed)) / most * 100).quantize(Decimal("0.01"), ROUND_HALF_UP)) if most else 0.0
    return {"added": added, "removed": removed, "sections": sections, "line_change_percentage": share}


def line_diff(
    pairs: DataFrame, key: str, current: str = "cur_text", previous: str = "prev_text",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Line diff of already joined text pairs, per Arrow batch, with the ``carry`` columns of each pair."""
    kept = pairs.select(key, current, previous, *[c.alias(n) for n, c in (carry or {}).items()])
    names = [key, *(carry or {})]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [diff_lines(c or "", p or "") for c, p in zip(pdf[current], pdf[previous], strict=True)]
            if found:
                own = {n: pdf[n].to_numpy() for n in names}
                yield pd.DataFrame(found).assign(**own)[[*names, *found[0]]]

    head = ", ".join(f"{n} {kept.schema[n].dataType.simpleString()}" for n in names)
    return kept.mapInPandas(run, f"{head}, {DIFF_DDL}")


def detect_changes(cur: DataFrame, prev: DataFrame, key: str, text: str = "text", check_type: str = "hash") -> DataFrame:
    """Full comparison of two snapshots.

    Only digests are shuffled for the outer join; texts follow for the documents whose digests differ (equal
    digests cannot differ in lines or tokens).  ``hash`` flags; ``content`` adds the line diff; ``smart`` adds the
    share of tokens not in common and flags only if tokens or lines differ, whatever the digests say.
    """
    c = cur.select(key, F.sha2(text, 256).alias("current_hash"))
    p = prev.select(key, F.sha2(text, 256).alias("previous_hash"))
    differs = ~F.col("current_hash").eqNullSafe(F.col("previous_hash"))
    both = c.join(p, key, "full_outer").select(
        key, differs.alias("__differs"),
        F.when(F.col("previous_hash").isNull(), "added").when(F.col("current_hash").isNull(), "removed")
        .otherwise("kept").alias("status"),
    )
    if check_type == "hash":
        measured = both.select(
            "*", F.lit(0.0).alias("__pct"), *[F.array().cast(f"array<{t}>").alias(n) for n, t in _DIFF_COLUMNS],
            F.col("__differs").alias("has_changed"), F.lit("hash_changed").alias("__kind"))
    else:
        measured = _measured(both, cur, prev, key, text, check_type == "smart")
    kind = F.when(~F.col("has_changed"), "none").otherwise(F.col("__kind"))
    return measured.select(
        key, "status", "has_changed", kind.alias("change_type"), F.col("__pct").alias("change_percentage"),
        F.col("has_changed").alias("requires_reindexing"), *[n for n, _ in _DIFF_COLUMNS],
    )


_DIFF_COLUMNS = (("added_content", "string"), ("removed_content", "string"), ("modified_sections", _SECTION))


def _measured(both: DataFrame, cur: DataFrame, prev: DataFrame, key: str, text: str, smart: bool) -> DataFrame:
    """Documents with their line diff, if both texts are there and differ."""
    pairs = (
        both.where((F.col("status") == "kept") & F.col("__differs")).select(key)
        .join(cur.select(key, F.col(text).alias("cur_text")), key)
        .join(prev.select(key, F.col(text).alias("prev_text")), key)
    )
    diff = line_diff(pairs, key, carry={"__tokens": token_change(F.col("cur_text"), F.col("prev_text"))})
    found = diff.select(
        key, F.lit(True).alias("__met"), F.col("__tokens" if smart else "line_change_percentage").alias("__own"),
        F.col("added").alias("added_content"), F.col("removed").alias("removed_content"),
        F.col("sections").alias("modified_sections"),
        ((F.size("sections") > 0) | (F.col("__tokens") > 0)).alias("__edited"),
    )
    rows = both.join(found, key, "left")
    met = F.col("__met").isNotNull()
    changed = F.when(met, F.col("__edited")).otherwise(F.col("__differs")) if smart else F.col("__differs")
    return rows.select(
        key, "status", changed.alias("has_changed"), F.coalesce("__own", F.lit(0.0)).alias("__pct"),
        F.when(met, "smart_changed" if smart else "content_changed").otherwise("hash_changed").alias("__kind"),
        *[F.coalesce(n, F.array().cast(f"array<{t}>")).alias(n) for n, t in _DIFF_COLUMNS],
    )
