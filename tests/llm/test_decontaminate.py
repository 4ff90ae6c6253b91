from __future__ import annotations

import random
import sys
from os.path import dirname

import numpy as np
import pytest

sys.path.insert(0, dirname(__file__))
from corpus import documents  # noqa: E402

from millwright.llm import decontaminate as d  # noqa: E402

BENCHMARK = "item_id bigint, text string, doc_id bigint, ids string"


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], BENCHMARK)


def corpus(seed=1, n=200):
    """Texts with frequent words and rare ones, items, and documents that hold them."""
    rng = random.Random(seed)
    often = ["the", "of", "and", "to", "a"]
    rare = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    words = lambda k: [rng.choice(often) if rng.random() < 0.4 else rng.choice(rare) for _ in range(k)]
    items = [words(rng.randint(16, 59)) for _ in range(30)]
    rows, held = [], set()
    for i in range(n):
        body = words(rng.randint(0, 400))
        if i % 5 == 0:
            k = rng.randrange(len(items))
            copy = list(items[k])
            if i % 10 == 0:  # a near copy: case, punctuation, one word in ten
                copy = [w.upper() + "," if rng.random() < 0.5 else w for w in copy]
                for at in rng.sample(range(len(copy)), len(copy) // 10):
                    copy[at] = "other"
            at = rng.randint(0, len(body))
            body[at:at] = copy
            held.add((i, k))
        rows.append((i, " ".join(body)))
    return rows, [(k, " ".join(w)) for k, w in enumerate(items)], held


def test_finds_copies_and_leaves_the_rest(spark):
    rows, items, held = corpus()
    found = d.find_leaks(documents(spark, rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == held
    assert all(r.common_words >= 0.75 * r.item_words for r in found if r.kind == "copy")


def test_recall_of_the_retrieval_against_brute_force(spark):
    """Of the pairs that the checks accept anywhere in a document, the latent space finds at least nine tenths."""
    rows, items, _ = corpus(seed=2, n=120)
    checks, accepted = d.Checks(), set()
    vocabulary = {}
    code = lambda text: np.array([vocabulary.setdefault(w, len(vocabulary)) for w in d.words_of(text)], np.int32)
    coded = [(k, code(t)) for k, t in items]
    for i, text in rows:
        ids = code(text)
        for k, item in coded:
            reach = 2 * len(item)
            if any(d.verdict(item, ids[at : at + reach], checks)[0] for at in range(0, max(1, len(ids)), 16)):
                accepted.add((i, k))
    found = {(r.doc_id, r.item_id) for r in d.find_leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    assert len(found & accepted) >= 0.9 * len(accepted) and found <= accepted


def test_recall_with_a_full_block_of_items(spark):
    """Exact copies, and copies without a fifth of their words, the rarest, are found among as many items as a block holds."""
    rng = random.Random(6)
    rare = [f"w{k}" for k in range(4000)]
    often = ["the", "of", "and", "to", "a"]
    words = lambda k: [rng.choice(often) if rng.random() < 0.4 else rng.choice(rare) for _ in range(k)]
    items = [words(rng.randint(20, 50)) for _ in range(1024)]
    texts = [words(300) for _ in range(100)]
    seen = {}
    for text in [*items, *texts]:
        for w in text:
            seen[w] = seen.get(w, 0) + 1
    for item in items:
        changed = list(item)
        for at in sorted(range(len(item)), key=lambda i: seen[item[i]])[: len(item) // 5]:
            changed[at] = "other"
        texts += [item, changed]
    found = d.find_leaks(documents(spark, enumerate(map(" ".join, texts))), benchmark(spark, enumerate(map(" ".join, items))))
    held = {(r.doc_id, r.item_id) for r in found.collect()}
    for copies in (range(100, len(texts), 2), range(101, len(texts), 2)):
        assert sum((i, (i - 100) // 2) in held for i in copies) >= 0.9 * len(items)


def long_items(rng, lengths):
    rare = [f"w{k}" for k in range(6000)]
    often = ["the", "of", "and", "to", "a"]
    words = lambda k: [rng.choice(often) if rng.random() < 0.4 else rng.choice(rare) for _ in range(k)]
    return [words(n) for n in lengths], words


def changed(rng, item, share):
    out = list(item)
    for at in rng.sample(range(len(out)), int(share * len(out))):
        out[at] = "other"
    return out


def test_recall_for_items_of_any_length(spark):
    """Exact copies and copies with a tenth of the words changed, of items of 8 to 5,000 words, with full blocks of passages."""
    rng = random.Random(12)
    items, words = long_items(rng, [8, 20, 59, 64, 96, 97, 130, 200, 400, 900, 1200, 1500, 2500, 5000] * 3)
    texts, expected = [words(500) for _ in range(40)], set()
    for k, item in enumerate(items):
        for body in (item, changed(rng, item, 0.1 if len(item) > 20 else 0)):
            expected.add((len(texts), k))
            texts.append([*words(rng.randint(0, 300)), *body, *words(rng.randint(0, 300))])
    assert sum(len(d.passages_of(len(item))) for item in items) > 1.5 * d.PASSAGES
    found = d.find_leaks(documents(spark, enumerate(map(" ".join, texts))), benchmark(spark, enumerate(map(" ".join, items)))).collect()
    held = {(r.doc_id, r.item_id) for r in found}
    assert len(held) == len(found) and held <= expected
    for n in {len(item) for item in items}:
        own = {(i, k) for i, k in expected if len(items[k]) == n}
        assert len(own & held) >= 0.9 * len(own), n


def test_an_item_larger_than_a_block_is_told_once(spark, monkeypatch):
    monkeypatch.setattr(d, "PASSAGES", 4)
    monkeypatch.setattr(d.blocks_of, "__defaults__", (4,))
    rng = random.Random(3)
    items, words = long_items(rng, [1000, 30, 500])
    moved = [*items[0][:400], *words(90), *items[0][400:950]]
    texts = [words(300), items[0], moved, [*words(50), *items[2], *items[1]], items[0][:300]]
    found = d.find_leaks(documents(spark, enumerate(map(" ".join, texts))), benchmark(spark, enumerate(map(" ".join, items)))).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 0), (2, 0), (3, 1), (3, 2)]
    assert {r.common_words for r in found if r.item_id == 0} == {1000, 950}


def test_what_a_group_wrote_goes_with_it(spark, tmp_path):
    """However many groups there are, one encoded copy of the documents is on disk."""
    import os

    from millwright.workspace import scratch

    rng = random.Random(5)
    items, words = long_items(rng, [30] * 40)
    texts = [[*words(200), *item] for item in items]
    before, d.GROUP = d.GROUP, 10
    try:
        with scratch(spark) as folder:
            found = d.find_leaks(documents(spark, enumerate(map(" ".join, texts))), benchmark(spark, enumerate(map(" ".join, items))))
            assert found.count() == 40
            tables = [t for t in os.listdir(folder.removeprefix("file:"))]
            # The numbered benchmark and what each group found.
            assert len(tables) <= 6
            assert not any("ids" in spark.read.parquet(f"{folder}/{t}").columns for t in tables)
    finally:
        d.GROUP = before


def test_passages_and_stretches():
    for n in (1, 8, 96, 97, 200, 5000):
        parts = d.passages_of(n)
        assert sum(k for _, k in parts) == n and max(k for _, k in parts) <= d.LONGEST and [a for a, _ in parts] == sorted(a for a, _ in parts)
    assert d.stretches([100, 110, 2000], 400, 5000) == [(0, 610), (1888, 2500)]
    assert d.stretches([-30], 400, 300) == [(0, 300)]
    assert d.common_words(np.unique(np.array([1, 1, 2, 5]), return_counts=True), np.array([1, 5, 5, 9, -1])) == 2
    assert d.common_words(np.unique(np.array([1]), return_counts=True), np.array([], np.int32)) == 0


def test_paraphrase_needs_the_answer():
    item = np.arange(40, dtype=np.int32)
    other = np.full(40, -1, np.int32)
    changed = np.where(np.arange(40) % 3 == 1, other, item)
    with_answer = np.concatenate([changed[:32], item[32:]])
    without = np.concatenate([item[:28], other[28:]])
    assert d.verdict(item, with_answer, d.Checks())[0] == "paraphrase"
    assert d.verdict(item, without, d.Checks())[0] is None
    assert d.verdict(item[:3], item[:2], d.Checks())[0] is None and d.verdict(item[:3], item, d.Checks())[0] == "copy"


def test_common_subsequence():
    rng = random.Random(4)
    for _ in range(50):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert d.common_subsequence(d.place_masks(a), len(a), np.array(b)) == table[-1][-1]


def test_latent_space_keeps_the_leading_directions(spark):
    rows, items, _ = corpus(seed=3, n=150)
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, t in items for w in d.words_of(t)}))}
    coded = [np.array([vocabulary[w] for w in d.words_of(t)], np.int32) for _, t in items]
    encoded = d.encode(documents(spark, rows), vocabulary)
    frequencies, passages = d.passage_frequencies(encoded, len(vocabulary))
    weights = d.term_weights(frequencies, passages, coded)
    space = d.latent_space(encoded, coded, weights, passages, rank=40)
    table = []
    for text in (t for _, t in rows):
        words = d.words_of(text)
        for at in range(0, len(words), d.PASSAGE):
            v = np.zeros(len(vocabulary))
            for w in words[at : at + d.PASSAGE]:
                if w in vocabulary:
                    v[vocabulary[w]] += weights[vocabulary[w]]
            table.append(v / max(np.linalg.norm(v), 1e-9))
    extra = [np.bincount(c, weights[c], len(vocabulary)) for c in coded]
    table += [np.sqrt(passages / len(coded)) * v / np.linalg.norm(v) for v in extra]
    table = np.array(table)
    exact = np.linalg.svd(table, compute_uv=False)
    assert (np.linalg.norm(table @ space) ** 2) > 0.85 * (exact[:40] ** 2).sum()
    assert np.allclose(space.T @ space, np.eye(space.shape[1]), atol=1e-3)


@pytest.mark.parametrize("items", [[], [(1, None), (2, ""), (None, "  .")]])
def test_nothing_to_find(spark, items):
    assert d.find_leaks(documents(spark, [(1, "a b c"), (2, None)]), benchmark(spark, items)).collect() == []


def test_awkward_rows(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(1, item), (1, item), (None, f"x {item.upper()}."), (2, None), (3, ""), (4, "one two"), (5, "zzz " * 3000 + item)]
    found = d.find_leaks(documents(spark, rows), benchmark(spark, [(7, item), (7, item), (None, None)])).collect()
    assert sorted(((r.doc_id, r.item_id) for r in found), key=str) == sorted([(1, 7)] * 4 + [(5, 7)] * 2 + [(None, 7)] * 2, key=str)
    clean = d.without_leaks(documents(spark, rows), benchmark(spark, [(7, item)]))
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4] and clean.columns == documents(spark, rows).columns
    assert d.find_leaks(documents(spark, []), benchmark(spark, [(7, item)])).collect() == []


def test_rows_go_by_their_own_text(spark):
    item = "one two three four five six seven eight nine ten"
    rows = [(None, f"x {item}"), (None, "clean"), (None, None), (3, item), (3, "clean too"), (4, ""), (None, "clean")]
    df = documents(spark, rows)
    clean = d.without_leaks(df, benchmark(spark, [(7, item)]))
    assert clean.columns == df.columns
    expected = [r for r in rows if item not in (r[1] or "")]
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted(expected, key=str)
