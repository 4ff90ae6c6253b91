from __future__ import annotations

import hashlib
import random
import sys
from os.path import dirname

import numpy as np
import pytest

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import repeats  # noqa: E402


def brute(rows, length):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    order = lambda i, p: (i is not None, i or 0, p)
    for i, body in texts:
        for p in range(len(body) - length + 1):
            here = order(i, p)
            first[body[p : p + length]] = min(first.get(body[p : p + length], here), here)
    found = []
    for i, body in texts:
        gone = np.zeros(len(body), bool)
        for p in range(len(body) - length + 1):
            if first[body[p : p + length]] < order(i, p):
                gone[p : p + length] = True
        edges = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        found.append((i, len(body), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=str)


def ours(df, **options):
    found = repeats.remove_repeats(df, **options)
    return sorted((tuple(r[:5]) for r in found.collect()), key=str)


@pytest.mark.parametrize("hot", [2, 4096])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, hot):
    rows = awkward(seed)
    found = ours(documents(spark, rows), length=12, gram=5, block_bytes=1500, hot=hot)
    assert found == brute([r[:2] for r in rows], 12)


def test_runs_of_one_byte_and_own_overlaps(spark):
    rows = [(1, "a" * 50), (2, "xy" * 30), (3, "b" + "a" * 20 + "c"), (4, "a" * 9)]
    assert ours(documents(spark, rows), length=10, gram=4, block_bytes=40) == brute(rows, 10)


def test_long_texts_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 64)
    rng = random.Random(5)
    text = "".join(rng.choice("ab") for _ in range(700))
    rows = [(1, text), (2, text[100:400] + "c" + text[50:300])]
    assert ours(documents(spark, rows), length=14, gram=6) == brute(rows, 14)


def test_texts_of_one_id_are_told_apart(spark):
    rows = [(1, "abcdefghijklmnop"), (1, "zzabcdefghijklmnop"), (0, "klmnop-------")]
    assert ours(documents(spark, rows), length=6, gram=3) == brute(rows, 6)


def test_spans_and_kept_bytes_rebuild_the_text(spark):
    rows = awkward(7)
    for r in repeats.remove_repeats(documents(spark, rows), length=12, gram=5, keep_text=True).collect():
        body = next((t or "").encode() for i, t, *_ in rows if i == r.doc_id)
        rebuilt, at, kept = b"", 0, bytes(r.kept)
        for span in r.spans:
            n = span.start - len(rebuilt)
            rebuilt += kept[at : at + n] + body[span.start : span.stop]
            at += n
        assert rebuilt + kept[at:] == body and sum(s.stop - s.start for s in r.spans) == r.n_removed


def test_no_rows(spark):
    assert ours(documents(spark, [])) == []


def test_interval_tree_of_sorted_suffixes():
    text = b"banana#ananas"
    data = np.frombuffer(text, np.uint8)
    starts = np.arange(len(text))
    order, lcp = repeats.sorted_suffixes(data, starts, len(text) - starts)
    suffixes = sorted(range(len(text)), key=lambda i: text[i:])
    assert order.tolist() == suffixes
    found = {(text[order[a] : order[a] + d], z - a + 1) for d, a, z in repeats.interval_tree(lcp, 2)}
    assert found == {(b"anana", 2), (b"ana", 4), (b"nana", 2), (b"na", 4)}
