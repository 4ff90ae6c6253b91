from __future__ import annotations

import math
import random
import re
import sys
from collections import Counter
from os.path import dirname

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import ranking  # noqa: E402

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return TERM.findall((text or "").translate(str.maketrans(upper, lower)))


def brute_search(docs, items, k=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    n_docs = sum(bool(c) for _, c in counted)
    total = sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counted:
            m = 25 + 75 * c.total() * n_docs // total if c else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        for rank, (score, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=repr)


def searched(spark, docs, items, **kwargs):
    table = spark.createDataFrame([(*r, "x", "y") for r in items], "item_id bigint, text string, rank string, score string")
    return sorted((tuple(r) for r in ranking.search(documents(spark, docs), table, **kwargs).collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    docs = awkward(seed) + [(9000 + i, "Ünß x1-x2 the.the THE") for i in range(25)] + [(9100, "...,;"), (9101, "a\x00b\x7fc")]
    texts = [t for _, t, *_ in docs if t]
    items = [(i, rng.choice(texts)[: rng.randint(1, 200)]) for i in range(20)] + [(3, "the the unknown"), (50, None), (51, ""), (None, "x2 b")]
    return [r[:2] for r in docs], items


def test_terms():
    text = "Ab-9é ÀB_c d\x00e\x7ff"
    assert [t.decode() for t in ranking.terms_of(text.encode())] == terms(text)


def test_search_equals_brute_force(spark):
    for seed in range(3):
        docs, items = corpus(seed)
        assert searched(spark, docs, items) == brute_search(docs, items)


def test_small_portions_and_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = corpus(7)
    monkeypatch.setattr(ranking, "DOCS", 7)
    monkeypatch.setattr(ranking, "ITEMS", 6)
    monkeypatch.setattr(ranking, "SEGMENT", 5)
    for k in (1, 3, 10):
        assert searched(spark, docs, items, k=k) == brute_search(docs, items, k)


def test_accumulators_are_limited(spark):
    """A frequent last term opens no accumulators once k documents hold the rare ones."""
    import pyarrow as pa

    docs = [[0, 1] if i < 20 else [1] for i in range(1000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(1000)), pa.array([len(d) for d in docs]), pa.array(docs, pa.list_(pa.int32())), pa.array([[1] * len(d) for d in docs], pa.list_(pa.int32()))],
        ["doc_id", "n_terms", "terms", "tfs"],
    )
    portion = ranking.Portion([batch], 1000, 1020)
    found, scores = portion.scores([(0, 4000), (1, 1)], 10, 0)
    assert sorted(found.tolist()) == list(range(20)) and len(set(scores.tolist())) == 1
    assert not len(portion.scores([(0, 4000), (1, 1)], 10, int(scores[0]) + 1)[0])


def test_empty_tables(spark):
    docs, items = corpus(1)
    assert searched(spark, [], items) == [] == searched(spark, docs, [])
    assert searched(spark, [(1, None), (2, "...")], items) == []
