"""Periodic runs of words, by uniting suffix classes in order of falling common prefixes.

The suffixes of a text are sorted by words, which gives the common prefix of
each neighbouring pair. Pairs are united from the longest common prefix
downwards, as Kruskal's method unites edges; each class keeps its positions in
order. Two positions that become neighbours in a class when `prefix` words are in
common, at a distance of at most `prefix`, begin a stretch whose words repeat at
that distance and which cannot go on to the right. The first such position of
each (distance, end) is where the run begins, so no text is compared again.

A task sorts the suffixes of many texts at once; texts share no word number, so
no class ever holds positions of two of them. Nothing is shuffled. The longest
text sets the memory of a task, at about 200 bytes a word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, compress, count
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_RUN, SPACES

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BATCH_BYTES = 2 << 20  # of texts whose suffixes are sorted together
CHUNK = 1024  # positions of a class kept in one list

FOUND = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, kept_text string"


def number_words(texts: list[list[bytes]]) -> np.ndarray:
    """The words of all texts in a row as numbers; no two texts share one."""
    parts, base = [np.empty(0, np.int64)], 0
    for words in texts:
        known: defaultdict[bytes, int] = defaultdict(count(base).__next__)
        parts.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
        base += len(known)
    return np.concatenate(parts)


def suffix_ranks(numbers: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(h, ranks of all positions by their first h words) for h = 1, 2, 4, ...; the last ranks have no ties.

    A rank is the number of suffixes before the first of its group. Only positions
    that still share their rank are sorted again.
    """
    n = len(numbers)
    sizes = np.bincount(numbers)
    rank = (np.cumsum(sizes) - sizes)[numbers]
    levels = [(1, rank.astype(np.int32))]
    active, h = np.flatnonzero(sizes[numbers] > 1), 1
    while len(active):
        after = active + h
        follows = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[active] * (n + 1) + follows
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        group = rank[active]
        at = np.arange(len(active))
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[active] = group + first - np.maximum.accumulate(np.where(new_group, at, 0))
        h *= 2
        levels.append((h, rank.astype(np.int32)))
        alone = new & np.append(new[1:], True)
        active = active[~alone]
    return levels


def neighbours(levels: list[tuple[int, np.ndarray]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix array, places k, common prefixes) for all k whose suffixes k and k + 1 share `least` words or more."""
    ranks = levels[-1][1]
    order = np.empty(len(ranks), np.int64)
    order[ranks] = np.arange(len(ranks))
    near = max(i for i, (h, _) in enumerate(levels) if h <= least)
    close = levels[near][1][order]
    places = np.flatnonzero(close[1:] == close[:-1])
    a, b = order[places], order[places + 1]
    shared = np.zeros(len(places), np.int64)
    for h, rank in reversed(levels):
        x, y = a + shared, b + shared
        inside = np.maximum(x, y) < len(rank)
        x, y = np.minimum(x, len(rank) - 1), np.minimum(y, len(rank) - 1)
        shared += h * (inside & (rank[x] == rank[y]))
    keep = shared >= least
    return order, places[keep], shared[keep]


class Positions:
    """An ordered set of positions in lists of bounded length, so that a large class takes a new one quickly."""

    __slots__ = ("chunks", "size")

    def __init__(self, position: int) -> None:
        self.chunks, self.size = [[position]], 1

    def __iter__(self) -> Iterator[int]:
        return chain.from_iterable(self.chunks)

    def _chunk(self, position: int) -> int:
        if len(self.chunks) == 1:
            return 0
        return max(0, bisect_left(self.chunks, position, key=itemgetter(0)) - 1)

    def around(self, position: int) -> tuple[int | None, int | None]:
        """The members before and after a position that is none."""
        c = self._chunk(position)
        chunk = self.chunks[c]
        i = bisect_left(chunk, position)
        before = chunk[i - 1] if i else None
        if i < len(chunk):
            return before, chunk[i]
        return before, self.chunks[c + 1][0] if c + 1 < len(self.chunks) else None

    def add(self, position: int) -> None:
        c = self._chunk(position)
        chunk = self.chunks[c]
        chunk.insert(bisect_left(chunk, position), position)
        self.size += 1
        if len(chunk) > CHUNK:
            self.chunks[c : c + 1] = [chunk[: CHUNK // 2], chunk[CHUNK // 2 :]]


def seeds(order: np.ndarray, places: np.ndarray, shared: np.ndarray, ratio: int) -> list[tuple[int, int, int]]:
    """(start, distance, end) of every newly adjacent pair whose distance is at most its common prefix over `ratio`.

    Equal prefixes may come in any order: a pair with no position between them
    becomes adjacent at its own common prefix, whatever else is united there.
    """
    held, back = np.unique(np.concatenate([places, places + 1]), return_inverse=True)
    classes: list[Positions | None] = [Positions(p) for p in order[held].tolist()]
    parent = list(range(len(held)))
    falling = np.argsort(-shared, kind="stable")
    left, right = back[: len(places)][falling].tolist(), back[len(places) :][falling].tolist()
    found: list[tuple[int, int, int]] = []
    for prefix, x, y in zip(shared[falling].tolist(), left, right):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if classes[x].size < classes[y].size:
            x, y = y, x
        large, small = classes[x], classes[y]
        widest, last = prefix // ratio, None
        own = list(small)
        for k, p in enumerate(own):
            before, after = large.around(p)
            # Only pairs across the two classes are new, and only without a position between them.
            if before is not None and p - before <= widest and (last is None or last < before):
                found.append((before, p - before, p + prefix))
            if after is not None and after - p <= widest and (k + 1 == len(own) or own[k + 1] > after):
                found.append((p, after - p, after + prefix))
            last = p
        for p in own:
            large.add(p)
        parent[y], classes[y] = x, None
    return found


def periodic_runs(numbers: np.ndarray, least_length: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all maximal runs of `least_exponent` (2 or more) periods and `least_length` words, by start, then period."""
    none = np.empty(0, np.int64)
    # Two places one period apart in a run share all of it but a period.
    least = min(max(least_length, least_exponent * q) - q for q in range(1, least_length + 2))
    if len(numbers) < least_length:
        return none, none, none
    found = seeds(*neighbours(suffix_ranks(numbers), least), least_exponent - 1)
    if not found:
        return none, none, none
    start, period, end = np.array(found, np.int64).T
    by = np.lexsort((start, period, end))
    start, period, end = start[by], period[by], end[by]
    first = np.concatenate([[True], (period[1:] != period[:-1]) | (end[1:] != end[:-1])])
    start, period, end = start[first], period[first], end[first]
    enough = end - start >= np.maximum(least_length, least_exponent * period)
    start, period, end = start[enough], period[enough], end[enough]
    by = np.lexsort((period, start))
    return start[by], (end - start)[by], period[by]


def outside_later_periods(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """For each of n words, whether no run holds it after the run's first period."""
    covered = np.zeros(n + 1, np.int64)
    np.add.at(covered, start + period, 1)
    np.add.at(covered, start + length, -1)
    return np.cumsum(covered[:-1]) == 0


def _collapsed(texts: list[bytes], least_length: int, least_exponent: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    words = [text.split() for text in texts]  # at [\x20\x09-\x0D]+
    ends = np.cumsum([len(w) for w in words])
    numbers = number_words(words)
    start, length, period = periodic_runs(numbers, least_length, least_exponent)
    keep = outside_later_periods(len(numbers), start, length, period)
    begins = ends - np.array([len(w) for w in words])
    offsets = np.append(np.searchsorted(start, begins), len(start))
    owner = np.searchsorted(ends, start, "right")
    struct = pa.StructArray.from_arrays([pa.array(start - begins[owner]), pa.array(length), pa.array(period)], ["start", "length", "period"])
    kept = []
    for a, z, own, first, after in zip(begins.tolist(), ends.tolist(), words, offsets.tolist(), offsets[1:].tolist()):
        kept.append(b" ".join(own if first == after else compress(own, keep[a:z].tolist())).decode())
    return pa.array(ends - begins), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), struct), pa.array(kept, pa.string())


def _portions(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of portions of a batch; a longer text is a portion of its own."""
    held, size, first = [], 0, 0
    for row, text in enumerate(texts):
        body = (text.as_py() or "").encode()
        if held and size + len(body) > BATCH_BYTES:
            yield first, held
            held, size, first = [], 0, row
        held.append(body)
        size += len(body)
    if held:
        yield first, held


def collapse_runs(documents: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), kept_text, for each row.

    A run is a stretch of words that repeats with its smallest period, has
    `least_exponent` periods and `least_length` words at least, and cannot be
    extended. Words that some run holds after its first period go; the rest is
    joined by single spaces. A null text has no words, no runs and an empty
    kept_text, as an empty one or one of spaces; a very long text is a portion of
    its own. Runs may overlap; ties cannot occur, as no two runs share period and
    end. Null ids and repeated rows are rows like any other; an empty table gives
    no rows. Only doc_id and text are read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _portions(batch.column(1)):
                columns = _collapsed(texts, least_length, least_exponent)
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n_words", "runs", "kept_text"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {FOUND}")


def with_loops(doc_id: Column, text: Column) -> Column:
    """The text, or for every tenth document by crc32 of its id, one whose words go round from some word on.

    Fixed by the contract: h = crc32(id), g = h div 10; if h mod 10 is 0, each word
    i >= a becomes word a + (i - a) mod p, with a = g mod n, p = 1 + (n - a) div (3 + g mod 8).
    A null id counts as empty text.
    """
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10).cast("bigint")
    rounds = (3 + g % 8).cast("int")
    plain = F.btrim(text, F.lit(SPACES))

    def looped(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / rounds)).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(words, a + 1, p), rounds))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(tail, F.lit(1), n - a)), " ")

    # `transform` over one element binds the words once.
    whole = F.element_at(F.transform(F.array(F.split(plain, SPACE_RUN)), looped), 1)
    return F.when((h % 10 == 0) & (F.length(plain) > 0), whole).otherwise(text)


def strongest(runs: Column) -> Column:
    """The run of greatest length over period; ties go to the smallest start, then period. Null without runs."""
    def better(best: Column, run: Column) -> Column:
        ahead = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(ahead, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"), better)


def run_lines(runs: Column) -> Column:
    """`start,length,period` and a line feed for each run."""
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return F.concat(F.array_join(F.transform(runs, line), "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
