from __future__ import annotations

import sys
from os.path import dirname

import pytest

sys.path.insert(0, dirname(__file__))
from corpus import awkward, documents  # noqa: E402

from millwright.llm import mixing  # noqa: E402


def water_fill(sizes):
    """Targets by resharing the excess until none is above; sizes in the order of places."""
    weight = [(5, 2, 1)[i % 3] for i in range(len(sizes))]
    target, open_, left = [0.0] * len(sizes), set(range(len(sizes))), 1.5 * sum(sizes)
    while open_:
        share = left / sum(weight[i] for i in open_)
        full = {i for i in open_ if share * weight[i] >= 2 * sizes[i]}
        if not full:
            for i in open_:
                target[i] = share * weight[i]
            break
        for i in full:
            target[i] = 2 * sizes[i]
            left -= target[i]
        open_ -= full
    return target


def sainte_lague(targets, limits, seats):
    quotients = sorted(((-t / (2 * j + 1), i, j) for i, t in enumerate(targets) for j in range(limits[i])))
    got = [0] * len(targets)
    for _, i, _ in quotients[:seats]:
        got[i] += 1
    return got


def test_mix(spark):
    rows = awkward(31, n=300)
    found = mixing.mix(documents(spark, rows), blocks=512).collect()
    assert sorted((str(r.doc_id), r["size"]) for r in found) == sorted((str(i), len((t or "").split())) for i, t, *_ in rows)
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None]
    sizes = [sum(len((t or "").split()) for _, t, _, s in rows if s == name) for name in names]
    targets = water_fill(sizes)
    by_size = dict(zip(sizes, targets))
    assert all(r.target == pytest.approx(by_size[r.source_size]) for r in found)
    width = 3 * sum(sizes) // (2 * 512)
    for size, target in zip(sizes, targets):
        taken = sum(r.taken for r in found if r.source_size == size)
        assert abs(taken - target) <= 3 * width
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    again = mixing.mix(documents(spark, rows[::-1]).repartition(5), blocks=512).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)


def test_quotas_are_highest_quotients(spark):
    rows = [(i, "w " * (i % 50 + 1), "en", f"s{i % 7}") for i in range(700)]
    sizes = mixing.document_sizes(documents(spark, rows))
    targets = mixing.source_targets(sizes)
    quotas = mixing.block_quotas(targets, blocks=200, shards=4).collect()
    table = {r.place: r for r in targets.collect()}
    total, width = sum(r.source_size for r in table.values()), quotas[0].width
    limits = [2 * -(-table[p].source_size // width) for p in sorted(table)]
    expected = sainte_lague([table[p].target for p in sorted(table)], limits, (3 * total + width) // (2 * width))
    assert [sum(q.place == p for q in quotas) for p in sorted(table)] == expected
    per_shard = [sum(q.shard == s for q in quotas) for s in range(4)]
    assert max(per_shard) - min(per_shard) <= 1


@pytest.mark.parametrize("huge, small, n_small", [(400_000, 80, 400), (0, 40, 1200)])
def test_small_sources_come_near_their_targets(spark, huge, small, n_small):
    """One huge source beside many, each smaller than a block, and many small ones alone."""
    rows = [(i, "w " * 2000, "en", "huge") for i in range(huge // 2000)]
    rows += [(10_000 + 4 * k + i, "w " * (small // 4), "en", f"s{k:05}") for k in range(n_small) for i in range(4)]
    df = documents(spark, rows, clash=False)
    assert mixing.block_quotas(mixing.source_targets(mixing.document_sizes(df)), blocks=512).filter("seat < 1 or shard not between 0 and 7").count() == 0
    found = mixing.mix(df, blocks=512).collect()
    source = {r[0]: r[3] for r in rows}
    taken, target = {}, {r.doc_id: r.target for r in found}
    for r in found:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    for doc_id, name in source.items():
        assert target[doc_id] > 0 and abs(taken[name] - target[doc_id]) <= max(1, 0.01 * target[doc_id])
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)


def test_sql_knows_small_sources(spark, tmp_path):
    """Thousands of small sources beside a huge one, in the operator and in the SQL."""
    import duckdb

    from millwright.llm.oracles import MIXING

    rows = [(i, "w " * 1500, "en", "huge") for i in range(300)]
    rows += [(10_000 + 3 * k + i, "w " * (20 + k % 90 + i), "en", f"s{k:05}") for k in range(1500) for i in range(3)]
    df = documents(spark, rows, clash=False)
    df.coalesce(1).write.parquet(str(tmp_path / "documents"))
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
        expected = con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({MIXING}) m").fetchall()
    found = mixing.mix(df).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    source = {r[0]: r[3] for r in rows}
    taken, target = {}, {}
    for r in found:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    width = {r.source: r.width for r in mixing.sized_sources(mixing.source_targets(mixing.document_sizes(df))).collect()}
    # At most two blocks off, of which one may be the shorter last one; the huge source is as near.
    assert all(abs(taken[s] - target[s]) <= 2 * width[s] <= max(2, 0.04 * target[s]) for s in target)
    assert sum(taken.values()) == pytest.approx(sum(target.values()), rel=0.01)


def test_rows_that_share_an_id_go_by_themselves(spark):
    """Rows without an id, and with one id, in several sources, and what else each source holds."""
    rows = [(None, f"a{i} " * 7, "en", "abc"[i % 3]) for i in range(240)] + [(5, f"b{i} " * 7, "en", "abc"[i % 3]) for i in range(240)]
    rows += [(100 + i, "w " * 7, "en", "abc"[i % 3]) for i in range(240)]
    df = documents(spark, rows)
    mixed = mixing.mixed_documents(df, blocks=64)
    words = {r.source: 7 * r.n for r in mixed.groupBy("source").count().toDF("source", "n").collect()}
    assert mixed.columns == df.columns
    names = mixing.source_targets(mixing.document_sizes(df)).collect()
    for row in names:
        assert abs(words[row.source] - row.target) <= 0.1 * row.target, row


def test_documents_are_repeated_or_left_out(spark):
    rows = [(i, "w " * 5, "en", "ab"[i % 2]) for i in range(200)]
    df = documents(spark, rows)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert all(counts.get(i, 0) == int(taken[i] / 5 + 0.5) for i in taken)


def test_no_rows_and_no_words(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert mixing.mixed_documents(documents(spark, [])).collect() == []
    empty = mixing.mix(documents(spark, [(1, None), (2, ""), (None, " ", "en", None)])).collect()
    assert {(r["size"], r.target, r.taken) for r in empty} == {(0, 0.0, 0)} and len(empty) == 3
