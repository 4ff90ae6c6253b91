"""Repeated byte strings across documents, from a suffix array split by anchors.

A string of `length` bytes has a minimizer: the place of the least hash among
its k-grams, which the string alone decides. So equal strings meet under the
hash of the same k-gram, their anchor, and the suffixes that begin at most one
window before an anchor can be sorted apart from all others. In each such bucket
the suffixes are sorted, the common-prefix interval tree is walked with a stack
over neighbours' common prefixes, and intervals whose members are preceded by
different bytes are maximal repeats: all occurrences but the first are removed.

What travels is small: the distinct anchors of each block of documents first,
then only the surroundings of anchors that occur twice. Copies inside a block
are folded before. An anchor met very often is split by the whole string at
each place instead, so it does not end up in one task.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millwright.workspace import stage

from .common import blocked

LENGTH = 100
GRAM = 32
BLOCK_BYTES = 8 << 20
BUCKET_KEYS = 1 << 19  # anchors a bucket
PIECE = 1 << 21  # bytes hashed at once
HOT = 4096  # an anchor with more surroundings is split
NULL_ID = -(1 << 63)

SPAN = "block int, doc_id bigint, row_hash bigint, start bigint, stop bigint"

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3
_BYTES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)


def _window_hash(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` bytes from each place on, by doubling."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    power, done, total = _BYTES[data], 1, None
    taken = 0
    remaining = size
    while remaining:
        if remaining & 1:
            if total is None:
                total, taken = power, done
            else:
                n = len(data) - taken - done + 1
                total = total[:n] * np.uint64(pow(_BASE, done, 1 << 64)) + power[taken : taken + n]
                taken += done
        remaining >>= 1
        if remaining:
            power = power[:-done] * np.uint64(pow(_BASE, done, 1 << 64)) + power[done:]
            done *= 2
    total = total ^ (total >> np.uint64(29))
    total = total * _MIX
    return total ^ (total >> np.uint64(32))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while 2 * done <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, hash): runs of window starts with the same anchor, and the anchor's hash.

    `data` holds texts back to back, ending at `ends`; no window crosses an end.
    """
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, np.empty(0, np.uint64)
    hashes = _window_hash(data, gram)
    places = np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << 22) - 1)
    least = _sliding_min((hashes & ~low) | places, length - gram + 1) & low
    starts = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(len(data) + 1, np.int64)
    whole = ends - starts >= length
    np.add.at(valid, starts[whole], 1)
    np.add.at(valid, ends[whole] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(valid)[: len(least)])
    if not len(at):
        return empty, empty, np.empty(0, np.uint64)
    place = least[at]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    # Minimizers have small hashes; mixed again, they spread evenly over the buckets.
    least_hashes = hashes[place[first].astype(np.int64)] * _MIX
    return at[first], at[last], least_hashes ^ (least_hashes >> np.uint64(32))


class Block:
    """The texts of a block, its rows that are alike folded, in pieces of bounded size."""

    def __init__(self, ids: list, texts: list[bytes | None]) -> None:
        rows = {}
        for doc_id, text in zip(ids, texts):
            body = text or b""
            rows.setdefault((NULL_ID if doc_id is None else doc_id, xxhash.xxh64_intdigest(body) - (1 << 63)), body)
        self.rows = sorted(rows)
        self.bodies = [rows[r] for r in self.rows]

    def pieces(self, length: int) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
        """(data, [(row, offset in the row's text, end in the data)]); long texts go on `length` - 1 bytes back."""
        data, parts, size = [], [], 0
        for row, body in enumerate(self.bodies):
            for at in range(0, max(1, len(body) - length + 1), PIECE):
                part = body[at : at + PIECE + length - 1]
                if size and size + len(part) > PIECE:
                    yield b"".join(data), parts
                    data, parts, size = [], [], 0
                data.append(part)
                size += len(part)
                parts.append((row, at, size))
        if parts:
            yield b"".join(data), parts

    def anchored(self, length: int, gram: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(data, row and text offset of each run's text, first, last, hash) by piece; offset + place = place in the text."""
        for data, parts in self.pieces(length):
            table = np.array(parts, np.int64).reshape(-1, 3)
            ends = table[:, 2]
            first, last, hashes = anchors(np.frombuffer(data, np.uint8), ends, length, gram)
            part = np.searchsorted(ends, first, "right")
            offset = table[:, 1] - np.concatenate([[0], ends[:-1]])
            yield data, table[part, 0], offset[part], first, last, hashes


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets by hash range, so that sorted hashes are in the order of their buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _cuts(sorted_values: np.ndarray) -> list[int]:
    """Where runs of equal values begin, and the end."""
    if not len(sorted_values):
        return [0]
    return [0, *(np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1).tolist(), len(sorted_values)]


def _pack(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), "zstd", asbytes=True) if len(values) else b""


def _unpack(packed: bytes, kind, n: int) -> np.ndarray:
    kind = np.dtype(kind)
    return np.frombuffer(pa.decompress(packed, n * kind.itemsize, "zstd", asbytes=True), kind) if n else np.empty(0, kind)


def _block_rows(table: pa.Table) -> Block:
    return Block(table.column("doc_id").to_pylist(), table.column("text").cast(pa.binary()).to_pylist())


def _distinct_anchors(block: Block, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    found = [x[5] for x in block.anchored(length, gram)]
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def repeated_anchors(table: DataFrame, buckets: int, length: int, gram: int, hot: int) -> DataFrame:
    """block, bucket, flags: for each distinct anchor of a block in order, 0 met once, 1 repeated, 2 very often."""
    def ask(group: pa.Table) -> pa.Table:
        block = group.column("block")[0].as_py()
        hashes, counts = _distinct_anchors(_block_rows(group), length, gram)
        bucket = _bucket_of(hashes, buckets)
        cuts = _cuts(bucket)
        counts = np.minimum(counts, 0xFFFF).astype(np.uint16)  # more than `hot` in any case
        parts = [(block, int(bucket[a]), b - a, hashes[a:b].tobytes(), _pack(counts[a:b])) for a, b in zip(cuts, cuts[1:])]
        columns = list(zip(*parts)) or [[]] * 5
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=["block", "bucket", "n", "hashes", "counts"])

    def answer(group: pa.Table) -> pa.Table:
        sizes = group.column("n").to_pylist()
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in group.column("hashes").to_pylist()])
        counts = np.concatenate([_unpack(x, np.uint16, n) for x, n in zip(group.column("counts").to_pylist(), sizes)])
        _, back = np.unique(hashes, return_inverse=True)
        total = np.bincount(back, counts)
        flags = ((total > 1).astype(np.uint8) + (total > hot))[back].astype(np.uint8)
        packed = [_pack(x) for x in np.split(flags, np.cumsum(sizes)[:-1])]
        return pa.table([group.column("block"), group.column("bucket"), group.column("n"), pa.array(packed, pa.binary())], names=["block", "bucket", "n", "flags"])

    asked = table.groupBy("block").applyInArrow(ask, "block int, bucket bigint, n bigint, hashes binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(answer, "block int, bucket bigint, n bigint, flags binary")


CONTEXTS = (
    "kind int, block int, bucket bigint, n bigint, raw bigint, bytes binary, sizes binary, starts binary, "
    "hashes binary, docs binary, rows binary, places binary"
)


class _Surroundings:
    """Distinct byte strings of a block by bucket, each with its first place; the other places are covered at once."""

    def __init__(self) -> None:
        self.first: dict[tuple[bytes, int, int], list[tuple[int, int, int]]] = {}
        self.covered: list[tuple[int, int, int, int]] = []

    def add(self, body: bytes, n_starts: int, key: int, place: tuple[int, int, int]) -> None:
        """place: (doc_id, start, row hash)."""
        held = self.first.setdefault((body, n_starts, key), [])
        if held and held[0][:2] < place[:2]:
            self.covered.append((*place, len(body)))
        else:
            if held and place[:2] < held[0][:2]:
                self.covered += [(*x, len(body)) for x in held]
                held.clear()
            held.append(place)


def surroundings(table: DataFrame, flags: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Rows of CONTEXTS: kind 1 surroundings of repeated anchors by bucket, kind 0 spans already known as covered."""
    def run(key: tuple, texts: pa.Table, marks: pa.Table) -> pa.Table:
        number = key[0].as_py()
        block = _block_rows(texts)
        order = np.argsort(marks.column("bucket").to_numpy())
        sizes, packed = marks.column("n").to_pylist(), marks.column("flags").to_pylist()
        flag = np.concatenate([np.empty(0, np.uint8), *[_unpack(packed[i], np.uint8, sizes[i]) for i in order.tolist()]])
        pieces = list(block.anchored(length, gram))
        known = np.unique(np.concatenate([p[5] for p in pieces]), return_index=True)[0] if pieces else flag
        found, often = _Surroundings(), set()
        for data, row, offset, first, last, hashes in pieces:
            mark = flag[np.searchsorted(known, hashes)]
            often.update(hashes[mark == 2].tolist())
            chosen = np.flatnonzero(mark)
            for r, o, a, z, h in zip(*(x[chosen].tolist() for x in (row, offset, first, last, hashes))):
                doc, row_hash = block.rows[r]
                found.add(data[a : z + length], z - a + 1, h, (doc, a + o, row_hash))
        # What is left of anchors met very often goes by each whole string instead.
        split, left = _Surroundings(), {}
        for (body, n_starts, h), places in found.first.items():
            if h not in often:
                left[body, n_starts, h] = places
            else:
                for at in range(n_starts):
                    string = body[at : at + length]
                    for doc, start, row_hash in places:
                        split.add(string, 1, xxhash.xxh64_intdigest(string), (doc, start + at, row_hash))
        piles = defaultdict(list)
        for (body, n_starts, h), places in chain(left.items(), split.first.items()):
            piles[(h >> 32) * buckets >> 32] += [(body, n_starts, h, *place) for place in places]
        found.covered += split.covered
        out = []
        for bucket, rows in piles.items():
            bodies, n_starts, hs, docs, places, row_hashes = zip(*rows)
            joined = b"".join(bodies)
            out.append((
                1, number, bucket, len(rows), len(joined), pa.compress(joined, "zstd", asbytes=True),
                _pack(np.array([len(b) for b in bodies], np.int32)), _pack(np.array(n_starts, np.int32)),
                np.array(hs, np.uint64).tobytes(), _pack(np.array(docs, np.int64)), np.array(row_hashes, np.int64).tobytes(),
                _pack(np.array(places, np.int64)),
            ))
        if found.covered:
            doc, start, row_hash, size = np.array(found.covered, np.int64).T
            doc, row_hash, start, stop = merged(doc, row_hash, start, start + size)
            n = len(doc)
            out.append((0, number, 0, n, 0, b"", b"", _pack(start), b"", _pack(doc), row_hash.tobytes(), _pack(stop)))
        columns = list(zip(*out)) or [[]] * 12
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * 7
        names = [x.split()[0] for x in CONTEXTS.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return table.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(run, CONTEXTS)


def merged(doc: np.ndarray, row_hash: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans that touch or overlap in a row's text, made one."""
    if not len(doc):
        return doc, row_hash, start, stop
    order = np.lexsort((start, row_hash, doc))
    doc, row_hash, start, stop = doc[order], row_hash[order], start[order], stop[order]
    other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (row_hash[1:] != row_hash[:-1])])
    # Lift each row's text above the one before, so that one running maximum serves all.
    lift = np.cumsum(other) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + lift)
    new = other.copy()
    new[1:] |= (start + lift)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], row_hash[first], start[first], reach[last] - lift[last]


def interval_tree(lcp: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of neighbours that share at least `least` bytes.

    lcp[i] is shared by suffixes i - 1 and i; a stack holds the open intervals.
    """
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp[1:].tolist(), 0], 1):
        value = value if value >= least else 0
        left = i - 1
        while stack and stack[-1][0] > value:
            depth, left = stack.pop()
            yield depth, left, i - 1
        if value and (not stack or stack[-1][0] < value):
            stack.append((value, left))


def sorted_suffixes(data: np.ndarray, starts: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at `starts` with `room` bytes each, and neighbours' common prefixes in that order."""
    width = -(-int(room.max()) // 8) * 8
    padded = np.concatenate([data, np.zeros(width, np.uint8)])
    table = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    table[np.arange(width) >= room[:, None]] = 0
    words = table.view(">u8").astype(np.uint64)
    order = np.lexsort((room, *words.T[::-1]))
    table, room = table[order], room[order]
    differ = np.concatenate([table[1:] != table[:-1], np.ones((len(order) - 1, 1), bool)], axis=1)
    lcp = np.zeros(len(order), np.int64)
    lcp[1:] = np.minimum(differ.argmax(axis=1), np.minimum(room[1:], room[:-1]))
    return order, lcp


class MaximalRepeats:
    """The maximal repeats among distinct surroundings: sorted suffixes and the intervals of their common prefixes.

    `where` has (doc_id, start, row hash) of each of the surroundings, whose
    first `n_starts` bytes are the suffixes' starts. Only starts whose `length`
    bytes occur twice are sorted.
    """

    def __init__(self, bodies: list[bytes], n_starts: np.ndarray, where: np.ndarray, length: int) -> None:
        self.length = length
        sizes = np.array([len(b) for b in bodies], np.int64)
        data = np.frombuffer(b"".join(bodies), np.uint8)
        base = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(bodies)), n_starts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(n_starts) - n_starts, n_starts)
        _, back, count = np.unique(_window_hash(data, length)[base[owner] + place], return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[back] > 1)
        owner, place = owner[twice], place[twice]
        at = base[owner] + place
        if len(at):
            order, self.lcp = sorted_suffixes(data, at, sizes[owner] - place)
        else:
            order, self.lcp = np.empty(0, np.int64), np.empty(0, np.int64)
        owner, place, at = owner[order], place[order], at[order]
        self.doc, self.row_hash, self.start = where[owner, 0], where[owner, 2], where[owner, 1] + place
        # The order of texts; places that are alike are neither earlier nor later.
        by_place = np.lexsort((self.start, self.doc))
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(self.doc[by_place]) != 0) | (np.diff(self.start[by_place]) != 0)
        self.rank = np.empty(len(at), np.int64)
        self.rank[by_place] = np.cumsum(new)
        # The byte before each suffix; where it is not known it differs from all.
        before = np.where(place > 0, data[at - 1].astype(np.int64), -1 - np.arange(len(at)))
        self.changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])

    def intervals(self) -> Iterator[tuple[int, slice]]:
        """(bytes in common, all occurrences as a run of the sorted suffixes) of each maximal repeat.

        Where the same byte precedes all, the interval is part of a longer repeat
        and found from there.
        """
        for depth, first, last in interval_tree(self.lcp, self.length):
            if self.changes[first] != self.changes[last]:
                yield depth, slice(first, last + 1)

    def covered(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(doc, row hash, start, stop): all occurrences but the first of each repeat.

        A suffix is in several intervals, one inside the other; the deepest in
        which it is not the first says how far it is covered.
        """
        reach = np.zeros(len(self.doc), np.int64)
        for depth, members in self.intervals():
            late = self.rank[members] > self.rank[members].min()
            np.maximum(reach[members], late * depth, out=reach[members])
        late = reach > 0
        return self.doc[late], self.row_hash[late], self.start[late], (self.start + reach)[late]


def covered_in_buckets(contexts: DataFrame, length: int) -> DataFrame:
    """SPAN rows: what the repeats of each bucket cover beyond their first occurrences."""
    def run(group: pa.Table) -> pa.Table:
        found = _Surroundings()
        blocks: dict[tuple[int, int], int] = {}
        for row in group.to_pylist():
            n = row["n"]
            data = pa.decompress(row["bytes"], row["raw"], "zstd", asbytes=True)
            sizes, n_starts = _unpack(row["sizes"], np.int32, n), _unpack(row["starts"], np.int32, n)
            hashes, row_hashes = np.frombuffer(row["hashes"], np.uint64), np.frombuffer(row["rows"], np.int64)
            docs, places = _unpack(row["docs"], np.int64, n), _unpack(row["places"], np.int64, n)
            stops = np.cumsum(sizes)
            for z, size, k, h, d, p, r in zip(*(x.tolist() for x in (stops, sizes, n_starts, hashes, docs, places, row_hashes))):
                found.add(data[z - size : z], k, h, (d, p, r))
                blocks[d, r] = row["block"]
        by_anchor = defaultdict(list)
        for (body, n_starts, h), places in found.first.items():
            by_anchor[h].append((body, n_starts, places))
        doc, start, row_hash, size = np.array(found.covered, np.int64).reshape(-1, 4).T
        spans = [merged(doc, row_hash, start, start + size)]

        def sweep(rows: list[tuple[bytes, int, list]]) -> None:
            flat = [(body, k, place) for body, k, places in rows for place in places]
            where = np.array([place for _, _, place in flat], np.int64)
            n_starts = np.array([k for _, k, _ in flat])
            spans.append(merged(*MaximalRepeats([b for b, _, _ in flat], n_starts, where, length).covered()))

        pile, size = [], 0
        for rows in by_anchor.values():
            if len(rows) > 1 or len(rows[0][2]) > 1:
                pile += rows
                size += sum(k * len(places) for _, k, places in rows)
                if size > 50_000:  # suffixes sorted at once; never less than an anchor's
                    sweep(pile)
                    pile, size = [], 0
        if pile:
            sweep(pile)
        d, r, a, z = merged(*(np.concatenate(x) for x in zip(*spans)))
        number = np.array([blocks[k] for k in zip(d.tolist(), r.tolist())], np.int32)
        return pa.table([pa.array(x) for x in (number, d, r, a, z)], names=["block", "doc_id", "row_hash", "start", "stop"])

    return contexts.filter("kind = 1").groupBy("bucket").applyInArrow(run, SPAN)


def _known_spans(contexts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                columns = [
                    np.full(n, row["block"], np.int32), _unpack(row["docs"], np.int64, n), np.frombuffer(row["rows"], np.int64),
                    _unpack(row["starts"], np.int64, n), _unpack(row["places"], np.int64, n),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["block", "doc_id", "row_hash", "start", "stop"])

    return contexts.filter("kind = 0").mapInArrow(run, SPAN)


def repeated_spans(table: DataFrame, text_bytes: int, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """SPAN rows of all bytes to remove, by block; spans of a row may overlap."""
    buckets = max(1, -(-text_bytes // (BUCKET_KEYS * (length - gram + 2) // 2)))
    flags = repeated_anchors(table, buckets, length, gram, hot)
    contexts = stage(surroundings(table, flags, buckets, length, gram))
    return covered_in_buckets(contexts, length).unionByName(_known_spans(contexts))


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, block_bytes: int = BLOCK_BYTES, hot: int = HOT, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, and kept (the bytes left) if asked for.

    A byte goes if a string of `length` bytes that covers it also starts
    earlier: in a smaller doc_id, or further left in the same. A null text is
    empty; texts shorter than `length` stay whole. A null doc_id is the smallest.
    Rows that share a doc_id share its place in the order, so rows that are
    alike do not remove each other; each gets its own spans and comes back. Empty tables give no
    rows. Only doc_id (an integer) and text are read.
    """
    narrow = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    table, n_blocks = blocked(narrow, block_bytes)
    spans = repeated_spans(table, n_blocks * block_bytes, length, gram, hot)

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        doc, row_hash, start, stop = merged(*(found.column(c).to_numpy() for c in ("doc_id", "row_hash", "start", "stop")))
        held = defaultdict(list)
        for d, r, a, z in zip(doc.tolist(), row_hash.tolist(), start.tolist(), stop.tolist()):
            held[d, r].append((a, z))
        out = []
        for doc_id, text in zip(texts.column("doc_id").to_pylist(), texts.column("text").cast(pa.binary()).to_pylist()):
            body = text or b""
            key = NULL_ID if doc_id is None else doc_id, xxhash.xxh64_intdigest(body) - (1 << 63)
            own = held.get(key, [])
            edges = [0, *(e for span in own for e in span), len(body)]
            kept = b"".join(body[a:z] for a, z in zip(edges[::2], edges[1::2])) if own else body
            row = (doc_id, len(body), len(body) - len(kept), len(own), hashlib.sha256(kept).hexdigest(), [{"start": a, "stop": z} for a, z in own])
            out.append((*row, kept) if keep_text else row)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * len(types), types)], names=names)

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>"
    types = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    if keep_text:
        schema, types, names = f"{schema}, kept binary", [*types, pa.binary()], [*names, "kept"]
    return table.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(run, schema)
