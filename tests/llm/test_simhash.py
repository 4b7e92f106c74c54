from __future__ import annotations

import random
import re

import pytest
import xxhash
from conftest import SF

from mailsieve.llm import simhash

SCHEMA = "doc_id long, text string, lang string, print long, component long, n int"


def shingle_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [shingle_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True))), key=str)


def run(df, **more):
    return sorted((tuple(r) for r in simhash.near_fingerprints(df, **more).collect()), key=str)


def test_whole_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert run(docs) == expected
    assert run(docs, shard=2) == expected


def test_odd_rows(spark):
    long = " ".join(f"v{i % 997}x{i}" for i in range(80_000))
    rows = [(5, None), (2, ""), (9, " \n\x0b"), (4, "a b"), (3, "A  b"), (None, "a B"), (7, long), (8, long.upper()),
            (8, "é ü ß"), (6, "E x y z"), (None, "alone in the world")]
    df = spark.createDataFrame([(*r, None, 1, 2, 3) for r in rows], SCHEMA)
    got = run(df)
    assert got == brute(rows) and (None, f"{shingle_print('a b'):016x}", 3) in got
    assert {r[2] for r in got if r[1] == "0" * 16} == {2}
    assert (None, f"{shingle_print('alone in the world'):016x}", None) in got
    assert run(df.limit(0)) == []


def test_links_through_wide_shards(spark):
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1, 2**63]
    prints = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for c in centres for _ in range(80)}
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "print long")
    pairs = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert len(pairs) > 100
    for shard in (1, 7, 4096):
        shards = {}
        for r in simhash.shard_prints(df, shard).collect():
            shards.setdefault(r.shard, set()).add(r.print)
        assert {(a, b) for s in shards.values() for a in s for b in s if (a, b) in pairs} == pairs


@pytest.mark.parametrize("radius", [0, 3])
def test_tree_finds_all_within_the_radius(radius):
    rnd = random.Random(radius)
    values = list({rnd.getrandbits(12) << 50 | rnd.getrandbits(2) for _ in range(600)})
    tree, seen = simhash.BKTree(), []
    for i, v in enumerate(values):
        assert sorted(tree.add(v, i, radius)) == [j for j, w in enumerate(seen) if (v ^ w).bit_count() <= radius]
        seen.append(v)


def test_masks_cover_all_open_bits():
    for mask in (0, 0xFFFF, 0xFFFF_FFFF_FFFF):
        finer = simhash.finer_masks(mask)
        assert len(finer) == 4 and sum(f & ~mask for f in finer) == 2**64 - 1 - mask
