from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from millwright.llm import urls

PAGES = "page_id bigint, url string, html string, verdict string, host string, bad string, key string, tokens string"
LABELS = "doc_id bigint, quality int, toxic int, url string"


def pages(spark, found):
    return spark.createDataFrame([(i, u, "h", "x", "x", "x", "x", "x") for i, u in found], PAGES)


def labels(spark, found):
    return spark.createDataFrame([(*f, "x") for f in found], LABELS)


def judged(spark, found, marks=(), **mining):
    return {r.page_id: r for r in urls.judge_urls(pages(spark, found), labels(spark, list(marks)), **mining).collect()}


def test_parts_and_rules(spark):
    found = judged(spark, [
        (1, "HTTP://A.Example.ORG/es/x?q=1"), (2, "https://example.org/en/12#top"), (3, "https://notexample.org/es/"),
        (4, "x://com/de/y"), (5, "x://m.com?z=/fr/"), (6, "x://a.com/fr/"), (7, None), (8, "example.org/es/"), (9, "x://org#/"),
        (10, ""), (11, "x://ÄB.com/Ä?"), (12, "y://x.org/en/1://z.com/de/"),
    ])
    parts = {i: (r.host, r.path, r.rule, r.verdict) for i, r in found.items()}
    assert parts == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("notexample.org", "/es/", "org/", "allow"), 4: ("com", "/de/y", "com/de/", "block"), 5: ("m.com", "", None, "allow"),
        6: ("a.com", "/fr/", "com/fr/", "allow"), 7: ("", "", None, "allow"), 8: ("", "", None, "allow"), 9: ("org", "", None, "allow"),
        10: ("", "", None, "allow"), 11: ("Äb.com", "/Ä", None, "allow"), 12: ("x.org", "/en/1://z.com/de/", "org/", "allow"),
    }


def test_mined_combinations(spark):
    found = [(i, f"https://{'www.' if i % 2 else ''}site{i % 7}.net/{'casino' if i % 3 == 0 else 'news'}/{i}") for i in range(300)]
    marks = [(i, int(not (i % 3 == 0 and i % 2)), 0) for i in range(240)]
    result = judged(spark, [*found, (None, "https://www.site1.net/casino/1"), found[0]], [*marks, (None, 0, 0), (5, None, None)])
    for i, url in found:
        assert result[i].verdict == ("block" if i % 3 == 0 and i % 2 else "allow"), url
    assert result[None].verdict == "block"


def test_rules_of_four_independent_tokens(spark):
    bit = lambda i, k: i >> k & 1
    found = [
        (i, f"{'https' if bit(i, 0) else 'http'}://{'m' if bit(i, 1) else 'w'}.site{i % 7}.net/{'promo' if bit(i, 2) else 'news'}/x?{'ref' if bit(i, 3) else 'q'}=1")
        for i in range(640)
    ]
    result = judged(spark, found, [(i, int(i % 16 != 15), 0) for i, _ in found])
    assert {i for i, r in result.items() if r.verdict == "block"} == {i for i, _ in found if i % 16 == 15}


def test_rules_need_support_and_confidence(spark):
    found = [(i, f"https://a{i % 2}.net/x{'y' if i < 5 else ''}") for i in range(100)]
    marks = [(i, int(i >= 5), int(i % 2 and i % 4 == 1)) for i in range(100)]
    assert {r.verdict for r in judged(spark, found, marks).values()} == {"allow"}
    assert judged(spark, found, marks, min_pages=4)[1].verdict == "block"


def test_empty_tables(spark):
    assert judged(spark, [], [(1, 0, 0)]) == {}
    assert judged(spark, [(1, "x://a.net/")])[1].verdict == "allow"


def brute_blocks(token_lists, bad, least_pages, least=0.5, lift=1.5, z=2.0):
    """For each page the best confidence of any set of its tokens that passes, over all subsets of all pages."""
    counts = {}
    for tokens, is_bad in zip(token_lists, bad):
        for k in range(1, len(tokens) + 1):
            for some in itertools.combinations(sorted(tokens), k):
                n, m = counts.get(some, (0, 0))
                counts[some] = n + 1, m + is_bad
    base, passing = sum(bad) / len(bad), {}
    for some, (n, m) in counts.items():
        share = m / n
        bound = (share + z * z / (2 * n) - z * math.sqrt(share * (1 - share) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if m >= least_pages and bound > least and bound >= lift * base:
            passing[some] = share
    return passing


def random_pages(seed, n=260):
    """Hosts, nested paths and twin tokens; some combinations are mostly bad."""
    rng = random.Random(seed)
    found, bad = [], []
    for i in range(n):
        host = rng.choice(["a.net", "b.net", "c.b.net"])
        path = "/".join(rng.sample(["p", "q", "r", "s"], rng.randint(0, 3)))
        url = f"{rng.choice(['http', 'https'])}://{host}/{path}" + rng.choice(["", "?k=1", "?k=1&t=2"])
        risk = 0.9 if "r" in path and "k=" in url else 0.7 if host == "c.b.net" and "q" in path else 0.1
        found.append((i, url))
        bad.append(rng.random() < risk)
    return found, bad


@pytest.mark.parametrize("seed, few", [(1, 12), (2, 12), (3, 1), (4, 2), (5, 3)])
def test_verdicts_equal_a_brute_force_miner(spark, monkeypatch, seed, few):
    """With many items a page and with few, all rules are mined and fit the same urls, also unlabelled ones."""
    monkeypatch.setattr(urls, "FEW", few)
    found, bad = random_pages(seed)
    extra = [(1000 + i, u) for i, (_, u) in enumerate(random_pages(seed + 50, 60)[0])]
    tokens = {
        r.page_id: r.t for r in pages(spark, found + extra).select("page_id", urls.url_tokens(F.col("url")).alias("t")).collect()
    }
    passing = brute_blocks([tokens[i] for i, _ in found], bad, 5)
    result = judged(spark, found + extra, [(i, int(not b), 0) for (i, _), b in zip(found, bad)], min_pages=5)
    blocked = 0
    for i, _ in found + extra:
        own = set(tokens[i])
        best = max((c for some, c in passing.items() if own.issuperset(some)), default=None)
        assert result[i].confidence == (None if best is None else pytest.approx(best)), i
        blocked += best is not None
    assert 0 < blocked < len(found) + len(extra)


def test_long_paths_that_occur_together(spark):
    """A crawler trap: pages with one path of 24 segments, and pages at every depth of another."""
    deep = "/".join(f"seg{chr(97 + k)}" for k in range(24))
    found = [(i, f"https://trap.net/{deep}/") for i in range(40)] + [(100 + i, f"https://fine.net/n{chr(97 + i % 20)}") for i in range(200)]
    marks = [(i, 0, 0) for i in range(40)] + [(100 + i, 1, 0) for i in range(200)]
    nested = ["/".join(f"deep{chr(97 + k)}" for k in range(d)) for d in range(1, 17)]
    for d, path in enumerate(nested):
        for i in range(10):
            found.append((1000 + 100 * d + i, f"http://chain.net/{path}?x{'' if i < 5 else 'y'}=1"))
            marks.append((1000 + 100 * d + i, int(d < 8), 0))
    def bound(n, m):
        share = m / n
        return (share + 2 / n - 2 * math.sqrt(share * (1 - share) / n + 1 / n**2)) / (1 + 4 / n)

    # The pages below the 8th level are bad; a level tells once most of what lies below it is bad for certain.
    telling = min(k for k in range(16) if bound(10 * (16 - k), min(80, 10 * (16 - k))) > 0.5)
    assert 0 < telling < 8
    result = judged(spark, found, marks)
    for i, url in found:
        is_bad = i < 40 or i >= 1000 + 100 * telling
        assert result[i].verdict == ("block" if is_bad else "allow"), url
