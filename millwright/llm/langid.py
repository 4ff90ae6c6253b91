"""Language identification by rank-order profiles of character n-grams.

Each language's most frequent 1- to 3-grams, ranked, are its profile. A
document's own ranking is held against each profile; the out-of-place distance
adds up how far every n-gram is from its rank there, and the nearest wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import fold

TOP = 300
PIECE = 1 << 20  # code points looked at in one go while counting, and what is left of a run of letters
EDGE = 1  # stands for any run of characters that are no letters


def letter_table() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.strings.isalpha(np.arange(0x110000, dtype=np.uint32).view("U1"))


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 1- to 3-grams of letters as packed numbers, and how often each occurs."""
    return _lowered_counts(text.lower(), letters)


def _lowered_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = letters[points]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.where(letter, points, EDGE)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one edge after each run of letters
    points = np.concatenate([[EDGE], points[keep]])
    if points[-1] != EDGE:
        points = np.append(points, EDGE)
    real = points != EDGE
    two = (points[:-1] << 21) | points[1:]
    three = (two[:-1] << 21) | points[2:]
    # An edge may open or close an n-gram but not stand inside one.
    grams = np.concatenate([points[real], two, three[real[1:-1]]])
    return np.unique(grams, return_counts=True)


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that end behind a character that is no letter, so no n-gram is cut."""
    at = 0
    while at < len(text):
        stop = at + PIECE
        while stop < len(text) and text[stop - 1].isalpha():
            stop += 1
        yield text[at:stop]
        at = stop


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    grams, back = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return grams, np.bincount(back, np.concatenate([p[1] for p in parts])).astype(np.int64)


def top_grams(text: str | None, top: int, letters: np.ndarray) -> np.ndarray:
    """The `top` most frequent n-grams of the whole text, best first; ties by the n-gram."""
    # Lower-cased as a whole: how a letter is lowered may depend on its neighbours.
    parts = [_lowered_counts(piece, letters) for piece in _pieces((text or "").lower())]
    if not parts:
        return np.empty(0, np.int64)
    grams, counts = _summed(parts)
    return grams[np.lexsort((grams, -counts))[:top]]


def learn_profiles(documents: DataFrame, top: int = TOP) -> DataFrame:
    """lang, gram, place (from 0): a ranked profile of `top` n-grams for each non-null lang."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            held: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
            for lang, texts in held.items():
                joined = "\n".join(texts).lower()
                grams, counts = _summed([_lowered_counts(piece, letters) for piece in _pieces(joined)] or [_lowered_counts("", letters)])
                columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    learned = documents.filter("lang is not null and text is not null").select("lang", "text")
    counted = learned.mapInArrow(count, "lang string, gram bigint, n bigint")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")) - 1
    return summed.select("lang", "gram", place.alias("place")).filter(F.col("place") < top)


class Profiles:
    """The learned profiles as arrays: `top` numbers a language."""

    def __init__(self, rows: list[tuple[str, int, int]], top: int) -> None:
        self.top, self.known = top, []
        for lang in sorted({r[0] for r in rows}):
            grams, places = zip(*sorted((r[1], r[2]) for r in rows if r[0] == lang))
            self.known.append((lang, np.array(grams), np.array(places)))

    def predict(self, text: str | None, letters: np.ndarray) -> tuple[str, float]:
        own = top_grams(text, self.top, letters)
        if not len(own) or not self.known:
            return "und", 0.0
        best = None
        for lang, grams, places in self.known:
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            there = grams[at] == own
            distance = np.where(there, np.abs(places[at] - np.arange(len(own))), self.top).sum()
            if best is None or distance < best[1]:
                best = lang, distance
        return best[0], float(1 - best[1] / (self.top * len(own)))


def identify(documents: DataFrame, training: DataFrame, top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score (1: ranks as in the profile, 0: nothing in common) for each row.

    A null text, one without letters, or one met without any profile is `und`
    with score 0. Languages that tie go by name. Rows with a null lang teach
    nothing; a null doc_id or repeated rows are rows like any other. A very long
    text is counted in pieces, with the same counts. An empty
    table gives no rows. Only doc_id and text are read to predict.
    """
    profiles = Profiles([tuple(r) for r in learn_profiles(training, top).collect()], top)  # `top` rows a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            found = [profiles.predict(text, letters) for text in batch.column(1).to_pylist()]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], ["doc_id", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def in_known_language(documents: DataFrame, training: DataFrame, top: int = TOP) -> DataFrame:
    """The documents whose text is in some learned language, that is, not `und`.

    A row without a `lang` gets the prediction, so that later steps know the language of
    every row; all else stays as it is. The prediction runs next to the row it
    decides on, so nothing is joined.
    """
    profiles = Profiles([tuple(r) for r in learn_profiles(training, top).collect()], top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            found = pa.array([profiles.predict(text, letters)[0] for text in texts], pa.string())
            at = batch.schema.get_field_index("lang")
            told = batch.column(at)
            batch = batch.set_column(at, batch.schema.field(at), pc.coalesce(told, found.cast(told.type)))
            yield batch.filter(pc.not_equal(found, "und"))

    return documents.mapInArrow(run, documents.schema)


def training_rows(documents: DataFrame) -> DataFrame:
    """The rows that may be learned from: four fifths by their id, with a lang."""
    return documents.filter((fold(F.col("doc_id")) != 0) & F.col("lang").isNotNull())
