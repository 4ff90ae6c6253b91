"""Ranked lexical search: every document against a set of queries, a term at a time with limited accumulators.

The items are the query set, worked off in blocks; only a block's terms reach
the executors. One pass turns the documents into the terms that the block knows
and how often each occurs; document frequencies come from that table by a
grouping. A second pass builds the postings of some thousand documents at once
and works off each item term by term, the rarest first. A document gets an
accumulator when it is first met, until the terms that remain could not lift a
new one to the k-th best partial score; from then on only those that have one are
updated, so their scores are exact. Each task carries its best documents from
one portion to the next, and their k-th score limits accumulators from the start.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from millwright.workspace import stage

from .common import segments

# Fixed values of the contract: saturation and length normalisation in thousandths.
UNIT = 1_000_000_000
LEAST_LENGTH_PCT, LENGTH_PCT = 25, 75

ITEMS = 512  # items worked off at once
TOP = 10
DOCS = 1 << 14  # documents whose postings are held at once, or
POSTINGS = 1 << 20  # so many postings
SEGMENT = 1 << 20  # bytes of a text split into terms at once
PILES = 64  # a first ranking of each item by shares of the documents

_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of all other characters from U+0080 on, A-Z lower-cased."""
    return text.translate(_TERMS).split()


def encode(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n_terms, terms, tfs: how many terms a document has, which of the known ones, and how often each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, terms, tfs, ends = [], [], [], [0]
            for text in batch.column(1).cast(pa.binary()):
                total, known = 0, Counter()
                for segment in segments(text.as_py() or b"", SEGMENT):
                    words = terms_of(segment)
                    total += len(words)
                    known.update(map(vocabulary.get, words))
                known.pop(None, None)
                totals.append(total)
                terms += known.keys()
                tfs += known.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            columns = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (terms, tfs)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(totals, pa.int64()), *columns], ["doc_id", "n_terms", "terms", "tfs"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_terms bigint, terms array<int>, tfs array<int>")


class Portion:
    """Postings of some documents: for each term the documents that hold it, with their impacts."""

    def __init__(self, batches: list[pa.RecordBatch], n_docs: int, all_terms: int) -> None:
        table = pa.Table.from_batches(batches)
        self.doc_ids = table.column("doc_id").combine_chunks()
        lengths = table.column("n_terms").to_numpy()
        lists = table.column("terms").combine_chunks()
        terms = lists.flatten().to_numpy()
        tfs = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
        docs = np.repeat(np.arange(len(lengths)), pc.list_value_length(lists).to_numpy())
        spread = 8 * (LEAST_LENGTH_PCT + LENGTH_PCT * lengths * n_docs // all_terms)
        order = np.argsort(terms, kind="stable")
        self.terms, first = np.unique(terms[order], return_index=True)
        self.cuts = np.append(first, len(order))
        self.docs, tfs = docs[order], tfs[order]
        self.impacts = UNIT * tfs // (1000 * tfs + spread[self.docs])
        self.most = np.maximum.reduceat(self.impacts, first) if len(first) else first

    def postings(self, query: list[tuple[int, int]]) -> list[tuple[int, slice, int]]:
        """(weight, postings, most that it adds) of the item's terms that are here, in their order."""
        at = np.searchsorted(self.terms, [t for t, _ in query])
        there = [(w, i) for (t, w), i in zip(query, at.tolist()) if i < len(self.terms) and self.terms[i] == t]
        return [(w, slice(self.cuts[i], self.cuts[i + 1]), w * int(self.most[i])) for w, i in there]

    def scores(self, query: list[tuple[int, int]], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of all that may be among the best `k`; `query` has (term, weight), rarest first.

        No document below `floor` is needed.
        """
        lists = self.postings(query)
        remaining = sum(most for *_, most in lists)
        partial, seen = np.zeros(len(self.doc_ids), np.int64), np.zeros(len(self.doc_ids), bool)
        met, done = np.empty(0, np.int64), 0
        for weight, at, most in lists:
            # A tie may still win by its id, so equal scores go on.
            if remaining < floor:
                break
            docs = self.docs[at]
            met = np.concatenate([met, docs[~seen[docs]]])
            seen[docs] = True
            partial[docs] += weight * self.impacts[at]
            remaining -= most
            done += 1
            if len(met) >= k:
                floor = max(floor, int(np.partition(partial[met], len(met) - k)[len(met) - k]))
        survivors = np.sort(met)
        exact = partial[survivors]
        for weight, at, _ in lists[done:]:
            docs = self.docs[at]
            i = np.minimum(np.searchsorted(docs, survivors), len(docs) - 1)
            exact += np.where(docs[i] == survivors, weight * self.impacts[at][i], 0)
        if len(exact) > k:
            floor = max(floor, int(np.partition(exact, len(exact) - k)[len(exact) - k]))
        best = (exact >= floor) & (exact > 0)
        return survivors[best], exact[best]


def _best(found: pa.Table, k: int) -> pa.Table:
    return found.take(pc.sort_indices(found, [("score", "descending"), ("doc_id", "ascending")])[:k])


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, docs, postings = [], 0, 0
    for batch in batches:
        for at in range(0, len(batch), DOCS):
            part = batch.slice(at, DOCS)
            held.append(part)
            docs, postings = docs + len(part), postings + len(part.column(2).flatten())
            if docs >= DOCS or postings >= POSTINGS:
                yield held
                held, docs, postings = [], 0, 0
    if held:
        yield held


def best_of_tasks(encoded: DataFrame, queries: list[tuple[int, list[tuple[int, int]]]], n_docs: int, all_terms: int, k: int) -> DataFrame:
    """item_no, doc_id, score: the best `k` documents of each task for each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, pa.Table] = {}
        for held in _portions(batches):
            portion = Portion(held, n_docs, all_terms)
            for item, query in queries:
                top = tops.get(item)
                floor = top.column("score")[k - 1].as_py() if top is not None and len(top) == k else 0
                docs, scores = portion.scores(query, k, floor)
                if len(docs):
                    new = pa.table({"doc_id": portion.doc_ids.take(pa.array(docs)), "score": scores})
                    tops[item] = _best(new if top is None else pa.concat_tables([top, new]).combine_chunks(), k)
        for item, top in tops.items():
            for batch in top.to_batches():
                numbers = pa.array(np.full(len(batch), item, np.int64))
                yield pa.RecordBatch.from_arrays([numbers, *batch.columns], ["item_no", "doc_id", "score"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "n_terms", "terms", "tfs").mapInArrow(run, f"item_no bigint, doc_id {kind}, score bigint")


def term_weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _search_block(documents: DataFrame, items: list[tuple[int, Counter]], k: int) -> DataFrame | None:
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in items for t in terms}))}
    encoded = stage(encode(documents, vocabulary))
    n_docs, all_terms = encoded.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
    if not n_docs:
        return None
    counted = encoded.select(F.explode("terms").alias("term")).groupBy("term").count()
    frequency = dict(counted.collect())  # a row per term of the block of items
    queries = []
    for item, terms in items:
        met = [(frequency[i], i, times) for t, times in terms.items() if (i := vocabulary[t]) in frequency]
        queries.append((item, [(i, times * term_weight(df, n_docs)) for df, i, times in sorted(met)]))
    return best_of_tasks(encoded, queries, n_docs, all_terms, k)


def search(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the best `k` documents of each row of `items`, scores above 0 only.

    Equal scores go by ascending doc_id, a null id last; rows alike in both are
    ranked in any order, which no column shows. A null or empty text has no terms:
    such an item finds nothing, such a document counts nowhere. Repeated
    documents are documents of their own, repeated items are ranked once each. A
    very long text is split into terms a segment at a time. An empty table on
    either side gives no rows. Only doc_id, item_id and the texts are read.
    """
    spark = documents.sparkSession
    numbered = stage(items.select("item_id", "text", F.monotonically_increasing_id().alias("item_no")))
    n_blocks = max(1, -(-numbered.count() // ITEMS))
    block = F.pmod(F.xxhash64("item_no"), F.lit(n_blocks))
    found = []
    for number in range(n_blocks):
        rows = numbered.filter(block == number).select("item_no", "text").collect()  # ITEMS or so
        block_items = [(i, Counter(terms)) for i, text in rows if (terms := terms_of((text or "").encode()))]
        if block_items:
            found.append(_search_block(documents, block_items, k))
    found = [f for f in found if f is not None]
    if not found:
        kinds = [x.schema[c].dataType.simpleString() for x, c in ((items, "item_id"), (documents, "doc_id"))]
        return spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # Every task sends its best, so the rows of an item grow with the tasks: they are ranked by shares first.
    best = reduce(DataFrame.unionByName, found).withColumn("pile", F.pmod(F.xxhash64("doc_id"), F.lit(PILES)))
    for keys in (["item_no", "pile"], ["item_no"]):
        best = best.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return best.join(numbered.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
