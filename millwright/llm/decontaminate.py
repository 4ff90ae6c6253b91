"""Benchmark passages in documents, by latent semantic retrieval and sequence checks.

A randomised SVD of TF-IDF passages, computed in one distributed pass over the
corpus, gives a latent space. Items are cut into passages too. Windows of every
document are compared there with the items' passages by cosine; where one comes
near, the whole item is checked word by word: longest common subsequence with the
stretch it would take up, and for paraphrases also its answer, taken to be the
item's last words.

The benchmark is the query set. It is worked off in groups: the documents are
encoded with a group's words once, and blocks of passages are searched in that
table, which goes when the group is done; so disk does not grow with the
benchmark, and only a group's words, bounded by it, reach the executors. The
latent space has a direction for each passage of a block at least: with fewer, a
passage would lie mostly outside and not even exact copies would be near it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from millwright.workspace import scratch, stage, stage_path

from .common import row_key, segments, with_keys

PASSAGES = 256  # passages of items searched at once: a block
GROUP = 4096  # passages of items whose words the documents are encoded with at once
LONGEST = 96  # words of an item's passage
RANK = 192  # or as many as the block has distinct passages, if more
EXTRA = 16  # columns of the sketch beyond the rank
PASSAGE = 64  # words of a passage in the SVD
STEP = 16  # words; windows of 2 and 4 steps are searched
MAX_SHARE = 0.01  # terms in more passages than this say too little
KEPT_TERMS = 3  # but the rarest terms of an item always count
FAN_IN = 8  # sketches added up in one task
SEGMENT = 1 << 20  # bytes of a text split into words at once
CHUNK = 2048  # steps compared at once, few enough to stay in the cache

_PLAIN = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))


def _plain(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace").translate(_PLAIN)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    return _plain(text).split()


@dataclass
class Checks:
    cosine: float = 0.25
    copy: float = 0.75  # share of the item's words in order: taken as a copy
    paraphrase: float = 0.6  # or this share, if the answer is there too
    answer: float = 0.8
    answer_words: int = 8
    min_words: int = 8  # items with fewer are taken only if all their words are there in order


def common_subsequence(masks: dict[int, int], length: int, window: np.ndarray) -> int:
    """Length of the longest common subsequence; `masks` has a bit for each place of a word in the item."""
    row = full = (1 << length) - 1
    for word in window.tolist():
        mask = masks.get(word)
        if mask:
            met = row & mask
            row = ((row + met) | (row - met)) & full
    return length - row.bit_count()


def place_masks(ids: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for at, word in enumerate(ids):
        masks[word] = masks.get(word, 0) | 1 << at
    return masks


def verdict(item: np.ndarray, window: np.ndarray, checks: Checks) -> tuple[str | None, int]:
    """copy, paraphrase or None, and the words in common in order."""
    ids = item.tolist()
    common = common_subsequence(place_masks(ids), len(ids), window)
    if len(ids) < checks.min_words:
        return ("copy" if common == len(ids) else None), common
    if common >= checks.copy * len(ids):
        return "copy", common
    if common >= checks.paraphrase * len(ids):
        answer = ids[-min(checks.answer_words, len(ids)) :]
        if common_subsequence(place_masks(answer), len(answer), window) >= checks.answer * len(answer):
            return "paraphrase", common
    return None, common


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All word ids of a batch of documents in a row, and the documents' lengths."""
    lengths = np.array([len(x.as_py() or b"") // 4 for x in column], np.int64)
    joined = b"".join(x.as_py() or b"" for x in column)
    return np.frombuffer(joined, np.int32), lengths


def passages_of(n_words: int) -> list[tuple[int, int]]:
    """(first word, words) of the passages of an item, as equal as can be and at most `LONGEST` words."""
    n = max(1, -(-n_words // LONGEST))
    cuts = [n_words * i // n for i in range(n + 1)]
    return [(a, z - a) for a, z in zip(cuts, cuts[1:])]


def stretches(begins: list[int], item_words: int, doc_words: int) -> list[tuple[int, int]]:
    """(first, stop) of where an item of several passages may lie, from where those that were found put its beginning.

    Beginnings that are near each other are one place with room around it, so
    words that were put in or left out move nothing out of sight.
    """
    room, found = max(PASSAGE, item_words // 4), []
    for begin in sorted(begins):
        if found and begin - found[-1][1] <= room and begin - found[-1][0] <= item_words:
            found[-1][1] = begin
        else:
            found.append([begin, begin])
    return [(max(0, a - room) // STEP * STEP, min(doc_words, z + item_words + room)) for a, z in found]


def common_words(item: tuple[np.ndarray, np.ndarray], window: np.ndarray) -> int:
    """Words in common, however they are ordered; `item` has its distinct words and their counts. No subsequence is longer."""
    words, counts = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(words, item[0]), max(0, len(words) - 1))
    return int(np.minimum(counts[at], item[1])[words[at] == item[0]].sum()) if len(words) else 0


def _distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; much faster than hashing them."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _units(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word, the number of its unit of `size` words; for each document, its first unit."""
    counts = -(-lengths // size)
    first = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(first[:-1], lengths) + at // size, first


def encode(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, ids: the documents as int32 word ids, -1 for words that no item has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = []
            for text in batch.column(1):
                parts = (segment.split() for segment in segments(_plain(text.as_py()), SEGMENT))
                coded.append(b"".join(np.fromiter(map(vocabulary.get, p, repeat(-1)), np.int32, len(p)).tobytes() for p in parts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.binary())], ["doc_id", "ids"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary")


def passage_frequencies(encoded: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """In how many passages of the corpus each term is, and how many passages there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, passages = np.zeros(n_terms, np.int64), 0
        for batch in batches:
            ids, lengths = _flat(batch.column(0))
            units, first = _units(lengths, PASSAGE)
            known = ids >= 0
            pairs = _distinct(units[known] * n_terms + ids[known])
            found += np.bincount(pairs % n_terms, minlength=n_terms)
            passages += int(first[-1])
        terms = np.flatnonzero(found)
        columns = [pa.array(np.append(terms, -1)), pa.array(np.append(found[terms], passages))]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    counted = encoded.select("ids").mapInArrow(run, "term bigint, n bigint")
    rows = counted.groupBy("term").agg(F.sum("n").alias("n")).collect()  # a row per term of the block of items
    frequencies, passages = np.zeros(n_terms, np.int64), 0
    for term, n in rows:
        if term < 0:
            passages = n
        else:
            frequencies[term] = n
    return frequencies, passages


def term_weights(frequencies: np.ndarray, passages: int, items: list[np.ndarray]) -> np.ndarray:
    """Inverse document frequencies; 0 for terms in too many passages, unless an item has nothing rarer."""
    weights = np.log((1 + passages) / (1 + frequencies)) + 1
    informative = frequencies <= MAX_SHARE * passages
    for item in items:
        own = np.unique(item)
        informative[own[np.lexsort((own, frequencies[own]))[:KEPT_TERMS]]] = True
    return np.where(informative, weights, 0).astype(np.float32)


def _rows_sum(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of `values` by `rows` (sorted), as n rows."""
    total = np.zeros((n, values.shape[1]), np.float32)
    if len(rows):
        starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        total[rows[starts]] = np.add.reduceat(values, starts, axis=0)
    return total


def _add_sketch(sketch: np.ndarray, units: np.ndarray, ids: np.ndarray, weights: np.ndarray, omega: np.ndarray, scale: float) -> None:
    """Adds a^T (a omega) for each unit's normalised TF-IDF row a."""
    n_terms = len(weights)
    pairs, tf = np.unique(units * n_terms + ids, return_counts=True)
    rows, terms = pairs // n_terms, pairs % n_terms
    _, rows = np.unique(rows, return_inverse=True)
    value = tf * weights[terms]
    value /= np.sqrt(np.bincount(rows, value**2))[rows]
    value = value.astype(np.float32)
    cuts = [0]
    while cuts[-1] < len(rows):  # whole rows, 32768 entries or so at once
        cuts.append(int(np.searchsorted(rows, rows[min(cuts[-1] + 32768, len(rows) - 1)], "right")))
    for a, b in zip(cuts, cuts[1:]):
        r, t, v = rows[a:b] - rows[a], terms[a:b], value[a:b]
        projected = _rows_sum(v[:, None] * omega[t], r, int(r[-1]) + 1)
        order = np.argsort(t, kind="stable")
        back = v[order, None] * projected[r[order]]
        starts = np.flatnonzero(np.concatenate([[True], t[order][1:] != t[order][:-1]]))
        sketch[t[order][starts]] += scale * np.add.reduceat(back, starts, axis=0)


def latent_space(
    encoded: DataFrame, items: list[np.ndarray], weights: np.ndarray, passages: int, rank: int = RANK, seed: int = 11,
    local: np.ndarray | None = None,
) -> np.ndarray:
    """(terms x rank): leading right singular vectors of the TF-IDF passages.

    `local` gives the encoded words their numbers among the terms, -1 to those that are none.

    One pass: each task sums A^T (A omega) over its passages, in a matrix as wide
    as the sketch whatever it reads; the sums of eight tasks are added up in one,
    and so on until one is left. The
    items are passages too, weighted to count as much as the corpus together.
    """
    n_terms = len(weights)
    width = min(n_terms, rank + EXTRA)
    omega = np.random.default_rng(seed).standard_normal((n_terms, width)).astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, some = np.zeros((n_terms, width)), False
        for batch in batches:
            ids, lengths = _flat(batch.column(0))
            ids = ids if local is None else local[ids]
            units, _ = _units(lengths, PASSAGE)
            known = np.flatnonzero(ids >= 0)
            known = known[weights[ids[known]] > 0]
            if len(known):
                _add_sketch(sketch, units[known], ids[known].astype(np.int64), weights, omega, 1.0)
                some = True
        if some:
            columns = [pa.array([TaskContext.get().partitionId() // FAN_IN]), pa.array([sketch.astype(np.float32).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["pile", "part"])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(n_terms * width)
        for part in group.column("part"):
            total += np.frombuffer(part.as_py(), np.float32)
        pile = group.column("pile")[0].as_py() // FAN_IN
        return pa.table({"pile": [pile], "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    parts = encoded.select("ids").mapInArrow(run, "pile bigint, part binary")
    tasks = encoded.rdd.getNumPartitions()
    while tasks > 1:
        parts = parts.groupBy("pile").applyInArrow(add, "pile bigint, part binary")
        tasks = -(-tasks // FAN_IN)
    sketch = np.zeros((n_terms, width))
    for row in parts.select("part").collect():  # one matrix
        sketch += np.frombuffer(row[0], np.float32).reshape(n_terms, width)
    for item in items:
        own = item[weights[item] > 0].astype(np.int64)
        if len(own):
            _add_sketch(sketch, np.zeros(len(own), np.int64), own, weights, omega, max(1.0, passages / len(items)))
    # Nystrom: with C = A^T A and Y = C omega, C is about Y (omega^T Y)^-1 Y^T.
    core = omega.T.astype(np.float64) @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-6 * max(values.max(), 1e-12)
    root = sketch @ (vectors[:, keep] / np.sqrt(values[keep]))
    left, _, _ = np.linalg.svd(root, full_matrices=False)
    return np.ascontiguousarray(left[:, :rank], np.float32)


def candidate_windows(ids: np.ndarray, lengths: np.ndarray, term_vectors: np.ndarray, latent_items: np.ndarray, cosine: float) -> Iterator[tuple[int, int, int, int, float]]:
    """(document, item, first word, words, cosine) of the windows near an item.

    The last column of `term_vectors` is each term's squared weight. Cosines are
    of latent vectors, with the lengths of the whole TF-IDF vectors: a window
    most of which lies outside the latent space is near nothing.
    """
    counts_for_something = term_vectors.any(axis=1)
    steps, first = _units(lengths, STEP)
    n_steps = int(first[-1])
    owner = np.repeat(np.arange(len(lengths)), np.diff(first))
    known = np.flatnonzero(ids >= 0)
    known = known[counts_for_something[ids[known]]]
    step_of, term = steps[known], ids[known]
    for low in range(0, n_steps, CHUNK):
        high = min(n_steps, low + CHUNK + 3)  # the last windows reach into the next chunk
        a, b = np.searchsorted(step_of, [low, high])
        own = owner[low:high]
        vectors = np.zeros((high - low + 3, term_vectors.shape[1]), np.float32)
        vectors[: high - low] = _rows_sum(term_vectors[term[a:b]], step_of[a:b] - low, high - low)
        own = np.concatenate([own, [-1, -2, -3]])
        for size in (2, 4):
            starts = np.arange(0, min(n_steps - low, CHUNK), size // 2)
            window = vectors[starts]
            for k in range(1, size):  # windows end where the document does
                window += vectors[starts + k] * (own[starts + k] == own[starts])[:, None]
            near = window[:, :-1] @ latent_items.T
            least = cosine * np.sqrt(window[:, -1])
            least[least == 0] = np.inf
            for w, item in zip(*np.nonzero(near >= least[:, None])):
                doc, start = int(own[starts[w]]), low + int(starts[w])
                yield doc, int(item), (start - int(first[doc])) * STEP, size * STEP, float(near[w, item] / least[w] * cosine)


def latent_index(items: list[np.ndarray], weights: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms as latent vectors, with their squared weights in a last column; items as latent vectors over their lengths."""
    term_vectors = np.concatenate([weights[:, None] * space, weights[:, None] ** 2], axis=1)
    summed = np.stack([term_vectors[item].sum(axis=0) for item in items])
    return term_vectors, np.ascontiguousarray(summed[:, :-1] / np.sqrt(np.maximum(summed[:, -1:], 1e-9)))


@dataclass
class Block:
    """Passages searched together: (item, first word, words) of each, and their items' words in the numbers of the group."""

    passages: list[tuple[int, int, int]]
    items: list[np.ndarray]
    terms: np.ndarray  # distinct words of the passages, in the numbers of the group

    def local(self, n_words: int) -> np.ndarray:
        """For each word of the group its number in the block, or -1; one more for words of no item, which are -1 themselves."""
        numbers = np.full(n_words + 1, -1, np.int32)
        numbers[self.terms] = np.arange(len(self.terms), dtype=np.int32)
        return numbers

    def texts(self, local: np.ndarray) -> list[np.ndarray]:
        return [local[self.items[i][a : a + n]] for i, a, n in self.passages]


def blocks_of(items: list[np.ndarray], size: int = PASSAGES) -> list[Block]:
    """The passages of all items in blocks; an item is split over blocks only if it fills one."""
    piles: list[list[tuple[int, int, int]]] = [[]]
    for i, item in enumerate(items):
        own = [(i, a, n) for a, n in passages_of(len(item))]
        if piles[-1] and len(piles[-1]) + len(own) > size:
            piles.append([])
        for at in range(0, len(own), size):
            if at:
                piles.append([])
            piles[-1] += own[at : at + size]
    return [
        Block(pile, items, np.unique(np.concatenate([items[i][a : a + n] for i, a, n in pile])))
        for pile in piles if pile
    ]


_FOUND = "kind string, start_word int, common_words int, item_words int, cosine double"


def _search(encoded: DataFrame, block: Block, weights: np.ndarray, space: np.ndarray, local: np.ndarray, checks: Checks) -> DataFrame:
    """row_no, item (its place in the group), doc_id and what was found, for each document row and item."""
    term_vectors, latent_items = latent_index(block.texts(local), weights, space)
    items, passages = block.items, block.passages
    bags = {i: np.unique(items[i], return_counts=True) for i, _, n in passages if n < len(items[i])}
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def places(ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
        """(document, item, first word, stop, cosine) of every stretch to check."""
        tried, begins = set(), {}
        for doc, passage, start, size, cosine in candidate_windows(local[ids], lengths, term_vectors, latent_items, checks.cosine):
            item, offset, _ = passages[passage]
            if item in bags:
                near = begins.setdefault((doc, item), ([], [0.0]))
                near[0].append(start - offset)
                near[1][0] = max(near[1][0], cosine)
                continue
            # A window of the item's length and half, around the middle of what was found.
            reach = max(size, len(items[item]) * 3 // 2)
            a = max(0, start + size // 2 - reach) // STEP * STEP
            z = min(int(lengths[doc]), start + size // 2 + reach)
            if (doc, item, a, z) not in tried:
                tried.add((doc, item, a, z))
                yield doc, item, a, z, cosine
        for (doc, item), (found, cosine) in begins.items():
            for a, z in stretches(found, len(items[item]), int(lengths[doc])):
                yield doc, item, a, z, cosine[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lengths = _flat(batch.column(2))
            offsets = np.cumsum(lengths) - lengths
            best: dict[tuple[int, int], tuple] = {}
            for doc, item, a, z, cosine in places(ids, lengths):
                window = ids[offsets[doc] + a : offsets[doc] + z]
                if item in bags and common_words(bags[item], window) < checks.paraphrase * len(items[item]):
                    continue
                found, common = verdict(items[item], window, checks)
                if found and (-common, a) < best.get((doc, item), ((1, 0),))[0]:
                    best[doc, item] = ((-common, a), found, common, cosine)
            keys = sorted(best)
            rows = pa.array([d for d, _ in keys], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows), pa.array([i for _, i in keys], pa.int32()), batch.column(1).take(rows),
                    pa.array([best[k][1] for k in keys], pa.string()),
                    pa.array([best[k][0][1] for k in keys], pa.int32()),
                    pa.array([best[k][2] for k in keys], pa.int32()),
                    pa.array([len(items[i]) for _, i in keys], pa.int32()),
                    pa.array([best[k][3] for k in keys], pa.float64()),
                ],
                ["row_no", "item", "doc_id", "kind", "start_word", "common_words", "item_words", "cosine"],
            )

    return encoded.select("row_no", "doc_id", "ids").mapInArrow(run, f"row_no bigint, item int, doc_id {kind}, {_FOUND}")


def _search_group(documents: DataFrame, texts: list[list[bytes]], checks: Checks, rank: int) -> DataFrame:
    """What `_search` finds of all items of a group, once for each document row and item."""
    vocabulary = {w: i for i, w in enumerate(sorted({w for words in texts for w in words}))}
    items = [np.array([vocabulary[w] for w in words], np.int32) for words in texts]
    path = stage_path(documents.sparkSession)
    with scratch(documents.sparkSession):
        encoded = stage(encode(documents, vocabulary).withColumn("row_no", F.monotonically_increasing_id()))
        frequencies, passages = passage_frequencies(encoded, len(vocabulary))
        found, seen, split = [], set(), False
        for block in blocks_of(items):
            local = block.local(len(vocabulary))
            pieces = block.texts(local)
            weights = term_weights(frequencies[block.terms], passages, pieces)
            # A direction for each distinct passage: copies of it then lie in the space with it.
            distinct = len({piece.tobytes() for piece in pieces})
            space = latent_space(encoded, pieces, weights, passages, max(rank, distinct), local=local)
            found.append(_search(encoded, block, weights, space, local, checks))
            own = {i for i, _, _ in block.passages}
            split, seen = split or bool(own & seen), seen | own
        every = reduce(DataFrame.unionByName, found)
        if split:  # parts of one item were searched in several blocks
            columns = every.columns
            first = F.min_by(F.struct(*columns), F.struct(-F.col("common_words"), F.col("start_word"), -F.col("cosine")))
            every = every.groupBy("row_no", "item").agg(first.alias("best")).select("best.*")
        return stage(every, path)


def find_leaks(documents: DataFrame, benchmark: DataFrame, checks: Checks | None = None, rank: int = RANK) -> DataFrame:
    """A row for each document row and item it holds: doc_id, item_id, kind, start_word, common_words, item_words, cosine.

    Items may have any length; those of more than `LONGEST` words are found by their
    passages and checked whole. Items and documents without words hold and are held by
    nothing; null ids are ids like any other. Repeated document rows give repeated
    rows; repeated items are searched as items of their own. Of several places of an
    item in a document the one with most words in common is told, the first if they
    tie. An empty table on either side gives no rows. Only doc_id, item_id and the
    texts are read.
    """
    spark, checks = documents.sparkSession, checks or Checks()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    doc_type = documents.schema["doc_id"].dataType.simpleString()
    numbered = stage(benchmark.select("item_id", "text", F.monotonically_increasing_id().alias("item_no")))
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    n_passages = numbered.agg(F.sum(F.ceil(F.greatest(F.lit(1), words) / LONGEST))).first()[0] or 0
    n_groups = max(1, -(-n_passages // GROUP))
    found = []
    for group in range(n_groups):
        here = F.pmod(F.xxhash64("item_no"), F.lit(n_groups)) == group
        rows = numbered.filter(here).select("item_no", "text").collect()  # GROUP passages or so
        texts = [(number, parts) for number, text in rows if (parts := words_of(text))]
        if not texts:
            continue
        leaks = _search_group(documents, [parts for _, parts in texts], checks, rank)
        numbers = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(texts)], "item int, item_no bigint")
        found.append(leaks.join(numbers, "item"))
    schema = f"doc_id {doc_type}, item_id {item_type}, {_FOUND}"
    if not found:
        return spark.createDataFrame([], schema)
    every = reduce(DataFrame.unionByName, found)
    named = every.join(numbered.select("item_no", "item_id"), "item_no")
    return named.select(*[f.split()[0] for f in schema.split(", ")])


def without_leaks(documents: DataFrame, benchmark: DataFrame, checks: Checks | None = None) -> DataFrame:
    """The rows that hold no benchmark item, each judged by its own text, whatever its doc_id."""
    keyed = documents.select(row_key().alias("doc_id"), "text")
    leaky = find_leaks(keyed, benchmark, checks).select("doc_id").distinct()
    return with_keys(documents, leaky, "left_anti").select(*[f"`{c}`" for c in documents.columns])
