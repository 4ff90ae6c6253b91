from __future__ import annotations

import re
import sys
from collections import Counter
from os.path import dirname

import pytest

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import quality  # noqa: E402

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, copies = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered), failed


def test_counts_equal_brute_force(spark):
    rows = awkward(51, n=80, vocabulary=5, most=120)
    rows += [(5000, "a b c a b c a b c"), (5001, "#*$ %& |<> x"), (5002, "l 1\nl 1\n\n \nl 2\nl 1"), (5003, "ab " * 4000), (5004, "😀 é x y")]
    found = quality.judge(documents(spark, rows)).collect()
    ours = sorted(((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)) for r in found), key=str)
    assert ours == sorted(((i, brute(t)) for i, t, *_ in rows), key=str)


def test_host_verdicts(spark):
    good = [f"g{i} {j}" for i in range(30) for j in range(1)]
    text = " ".join(good)
    rows = [(i, text, "en", "good") for i in range(40)] + [(100 + i, "bad", "en", "bad") for i in range(40)]
    rows += [(200, text, "en", "bad"), (201, "bad", "en", "small"), (202, text, "en", "small"), (203, text, "en", None)]
    found = {r.doc_id: r for r in quality.judge(documents(spark, rows)).collect()}
    assert not found[200].base_failed and not found[200].kept  # the host is bad, though the document passes
    assert found[202].kept and found[203].kept and found[0].kept and not found[201].kept
    rates = [0.0, 40 / 41, 0.5, 0.0]
    m = sum(rates) / 4
    v = sum((x - m) ** 2 for x in rates) / 4
    s = min(1e6, max(1.0, m * (1 - m) / v - 1))
    assert found[200].host_rate == pytest.approx((40 + m * s) / (41 + s))


def test_one_host_and_no_rows(spark):
    assert quality.judge(documents(spark, [])).collect() == []
    row = quality.judge(documents(spark, [(1, None, None, None)])).collect()[0]
    assert (row.n_words, row.base_failed, row.kept, row.host_rate) == (0, True, False, 1.0)


PAGES = "page_id bigint, url string, host string, doc_id string"


def test_hosts_come_from_pages(spark):
    good, bad = " ".join(f"g{i} {i}" for i in range(40)), "bad"
    rows = [(i, good, "en", "s") for i in range(300)] + [(1000 + i, bad if i % 2 else good, "en", "s") for i in range(200)]
    rows += [(2000, good, "en", "s"), (None, good, "en", "s")]
    pages = [(i, f"https://H{i % 6}.net/{i}", "x", "x") for i in range(300)]
    pages += [(1000 + i, "https://Poor.org/", "x", "x") for i in range(200)] + [(7, "https://zz.net/", "x", "x"), (9, None, "x", "x"), (None, "https://poor.org/", "x", "x"), (2000, "no host", "x", "x")]
    found = {r.doc_id: r for r in quality.judge(documents(spark, rows), spark.createDataFrame(pages, PAGES)).collect()}
    assert found[7].host == "h1.net" and found[2000].host == "s" == found[None].host and found[1000].host == "poor.org"
    # Half of the poor host's documents fail, far above what the other hosts let expect; its others go with them.
    rates = [0.0] * 7 + [0.5]
    m = sum(rates) / 8
    v = sum((r - m) ** 2 for r in rates) / 8
    s = m * (1 - m) / v - 1
    limit = min(0.8, m + 3 * (m * (1 - m) / (s + 1)) ** 0.5)
    assert found[1000].host_rate == pytest.approx((100 + m * s) / (200 + s))
    assert not found[1000].base_failed and found[1000].kept == (found[1000].host_rate <= limit)
    strict = {r.doc_id: r for r in quality.judge(documents(spark, rows), spark.createDataFrame(pages, PAGES), spread=2.0).collect()}
    assert not strict[1000].kept and strict[0].kept and strict[2000].kept
    assert len(found) == len(rows) == len(strict)
    assert quality.judge(documents(spark, rows[:3]), spark.createDataFrame([], PAGES)).count() == 3
