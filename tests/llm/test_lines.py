from __future__ import annotations

import sys
from os.path import dirname

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import lines  # noqa: E402

SPACES = " \t\n\x0b\x0c\r"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars, min_docs):
    holders = {}
    key = lambda line: line.strip(SPACES).translate(LOW)
    order = lambda i: (i is not None, i or 0)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(order(i))
    dropped = {}
    for i, text, *_ in rows:
        for no, line in enumerate((text or "").split("\n")):
            held = holders.get(key(line), ())
            if len(held) >= min_docs and max(held) != order(i):
                dropped.setdefault(i, set()).add(no)
    found = []
    for i, text, *_ in rows:
        all_lines = (text or "").split("\n")
        kept = [line for no, line in enumerate(all_lines) if no not in dropped.get(i, ())]
        found.append((i, len(all_lines), len(all_lines) - len(kept), "\n".join(kept)))
    return sorted(found, key=str)


def ours(df, **options):
    found = lines.dedup_lines(df, **options)
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in found.collect()), key=str)


def test_equals_brute_force(spark):
    for seed in (3, 4):
        rows = awkward(seed, vocabulary=4, most=6)
        assert ours(documents(spark, rows), min_chars=4, min_docs=3) == brute(rows, 4, 3)


def test_keys_and_edges(spark):
    line = "The Same Line Again And Again"
    rows = [
        (1, f"{line}\nown"), (2, f"  {line.lower()}\t\n\n{line}"), (3, f"x\n{line}\v\ny"), (4, "Éa" * 12), (5, "éa" * 12), (6, "Éa" * 12),
        (7, "short"), (8, "short"), (9, "short"),
    ]
    found = {r[0]: r for r in ours(documents(spark, rows))}
    assert found[1] == (1, 2, 1, "own") and found[2] == (2, 3, 2, "") and found[3][2] == 0
    assert all(found[i][2] == 0 for i in range(4, 10))


def test_no_rows(spark):
    assert ours(documents(spark, [])) == []
