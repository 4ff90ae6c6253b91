from __future__ import annotations

import random
import re
import sys
from os.path import dirname

import pytest
import xxhash

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import simhash  # noqa: E402


def brute_fingerprint(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(low)) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=3):
    root = {f: f for f in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= distance:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in distinct}


def test_equals_brute_force(spark):
    rows = awkward(41, n=150, vocabulary=6, most=8)
    found = simhash.near_duplicates(documents(spark, rows)).select("doc_id", simhash.fingerprint_hex(simhash.F.col("fp")).alias("h"), "component_id").collect()
    prints = [brute_fingerprint(t) for _, t, *_ in rows]
    roots = brute_components(prints)
    least = {}
    for (i, *_), f in zip(rows, prints):
        if i is not None:
            least[roots[f]] = min(i, least.get(roots[f], i))
    expected = sorted(((i, f"{f:016x}", least.get(roots[f])) for (i, *_), f in zip(rows, prints)), key=str)
    assert sorted((tuple(r) for r in found), key=str) == expected


@pytest.mark.parametrize("bucket", [8, 2048])
def test_links_connect_like_all_pairs(spark, bucket):
    """A crowd around one centre, chains, and far ones; a small bucket makes keys split again and again."""
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)}
    at = rng.getrandbits(64)
    for _ in range(12):
        at ^= sum(1 << b for b in rng.sample(range(64), 3))
        prints.add(at)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp bigint"), 3, bucket)
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    roots = {r.node % (1 << 64): r.root for r in simhash.components(edges).collect()}
    expected, groups = brute_components(prints), {}
    for f in prints:
        groups.setdefault(expected[f], set()).add(roots.get(f, f - (1 << 64) if f >> 63 else f))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_every_close_pair_shares_a_key():
    rng = random.Random(8)
    masks = simhash._pair_masks(list(range(64)), 5)
    for rest in (list(range(64)), list(range(10, 48)), [1, 5, 9, 60], [3, 4, 5, 6, 7]):
        finer = simhash._finer(rest, 3)
        for _ in range(200):
            differing = sum(1 << b for b in rng.sample(rest, min(3, len(rest))))
            assert any(not differing & m for m in finer)
            assert len(rest) < 64 or any(not differing & m for m in masks)


def test_one_per_component(spark):
    rows = [(5, "a b c d"), (3, "A  b c\nd"), (9, "q r s t u"), (9, "q r s t u"), (7, None), (4, ""), (None, "z y x w")]
    df = documents(spark, rows)
    kept = simhash.one_per_component(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 9, 4, None], key=str)


def test_components_with_null_or_shared_ids_keep_a_row_each(spark):
    rows = [(None, "z y x w"), (None, "p q r s"), (None, "p q r s"), (None, "a b c d"), (2, "a b c d"), (5, "k l m n"), (5, "e f g h"), (6, "E f g h")]
    df = documents(spark, rows)
    kept = [(r.doc_id, r.text) for r in simhash.one_per_component(df).collect()]
    expected = [(None, "z y x w"), (None, "p q r s"), (2, "a b c d"), (5, "k l m n"), (5, "e f g h")]
    assert sorted(kept, key=str) == sorted(expected, key=str)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    found = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


def test_no_rows(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_segments_of_long_texts(monkeypatch):
    rng = random.Random(10)
    monkeypatch.setattr(simhash, "SEGMENT", 7)
    for n in (0, 1, 2, 3, 4, 50, 400):
        text = rng.choice(["", " "]) + " ".join("".join(rng.choice("abC") for _ in range(rng.randint(1, 4))) for _ in range(n))
        assert simhash.simhash(text.encode(), 3) % (1 << 64) == brute_fingerprint(text)
