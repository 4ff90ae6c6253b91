from __future__ import annotations

import hashlib
import random
import sys
import zlib
from os.path import dirname

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import runs  # noqa: E402


def brute_runs(words, least_length=6, least_exponent=4):
    n, found = len(words), []
    for q in range(1, n + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            smallest = all(any(words[k] != words[k + p] for k in range(start, end - p)) for p in range(1, q))
            if smallest and end - start >= max(least_length, least_exponent * q):
                found.append((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def found_runs(words, *limits):
    numbers = runs.number_words([[w.encode() for w in words]])
    return list(zip(*(x.tolist() for x in runs.periodic_runs(numbers, *limits))))


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=70) | st.text("abc", max_size=40), st.sampled_from([(6, 4), (4, 2), (9, 3), (1, 2)]))
def test_runs_equal_brute_force(text, limits):
    assert found_runs(list(text), *limits) == brute_runs(list(text), *limits)


def test_looped_texts_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 90)
        words = [rng.choice("abcde") for _ in range(n)]
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(3, 10)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert found_runs(words, 6, 4) == brute_runs(words)


def test_large_classes_keep_their_order():
    start, length, period = runs.periodic_runs(np.zeros(50_000, np.int64), 6, 4)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [50_000], [1])
    rng, chosen = random.Random(5), runs.Positions(0)
    held = {0}
    for p in rng.sample(range(1, 100_000), 6000):
        below, above = [x for x in held if x < p], [x for x in held if x > p]
        if len(held) % 200 == 0:
            assert chosen.around(p) == (max(below, default=None), min(above, default=None))
        chosen.add(p)
        held.add(p)
    assert list(chosen) == sorted(held) and len(chosen.chunks) > 3


def test_overlap_free_sequence_has_no_run():
    thue_morse = [0]
    while len(thue_morse) < 5000:
        thue_morse += [1 - x for x in thue_morse]
    assert not len(runs.periodic_runs(np.array(thue_morse), 6, 4)[0])


def brute_loops(doc_id, text):
    words = (text or "").replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for part in words for w in part.split("\n") for w in w.split("\t") if w]
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a, c = g % n, 3 + g % 8
        p = 1 + (n - a) // c
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_brute_force_on_awkward_texts(spark):
    rows = [r for seed in range(4) for r in awkward(seed)]
    long_one = " ".join(random.Random(9).choice(["x", "yé"]) for _ in range(40_000))
    rows += [(i, long_one) for i in (5001, 5002)] + [(i, "la la la la la la") for i in range(6000, 6040)]
    given = documents(spark, rows)
    prepared = given.withColumn("text", runs.with_loops(F.col("doc_id"), F.col("text")))
    found = runs.collapse_runs(prepared).withColumn("best", runs.strongest(F.col("runs"))).withColumn("lines", runs.run_lines(F.col("runs")))
    got = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.kept_text, r.best and tuple(r.best), r.lines) for r in found.collect())
    want = []
    for row in rows:
        words = brute_loops(*row[:2])
        own = found_runs(words, 6, 4) if len(words) > 1000 else brute_runs(words)
        dropped = {i for s, n, q in own for i in range(s + q, s + n)}
        best = max(own, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        want.append((
            repr(row[0]), len(words), own, " ".join(w for i, w in enumerate(words) if i not in dropped), best,
            "".join(f"{s},{n},{q}\n" for s, n, q in own),
        ))
    assert got == sorted(want)
    assert any(r[2] for r in got) and runs.collapse_runs(given.limit(0)).count() == 0


def test_registered_query(spark, testdata):
    from millwright.llm.queries import op12_periodic_runs

    rows = {r.doc_id: r for r in op12_periodic_runs(spark, testdata).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{testdata}/documents.parquet").collect()}
    assert set(rows) == set(texts)
    some = False
    for doc_id, text in texts.items():
        words, row = brute_loops(doc_id, text), rows[doc_id]
        if len(words) > 1500:
            continue
        own = brute_runs(words)
        some |= bool(own)
        assert row.n_runs == len(own)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest()
        dropped = {i for s, n, q in own for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        if own:
            s, n, q = max(own, key=lambda r: (r[1] / r[2], -r[0], -r[2]))
            assert (row.start, row.length, row.period, row.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
    assert some
