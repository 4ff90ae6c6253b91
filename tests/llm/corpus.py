"""Small awkward corpora for the operators."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use inside, as columns of the input.
CLASHES = [
    "block", "bucket", "size", "fp", "key", "mask", "host", "h1", "line_no", "n", "place", "start", "end", "chunk", "s", "c",
    "copies", "taken_id", "kept_id", "leaky_id", "old_shard", "shard", "component_id", "lossy_id", "words", "copy_no",
]


def documents(spark, rows, clash=True):
    """rows: (doc_id, text[, lang, source])."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src0")), None if r[1] is None else len(r[1])) for r in rows]
    schema, extra = DOCUMENTS, []
    if clash:
        schema += "".join(f", {c} string" for c in CLASHES)
        extra = ["x"] * len(CLASHES)
    return spark.createDataFrame([(*r, *extra) for r in full], schema)


def awkward(seed: int, n: int = 60, vocabulary: int = 12, most: int = 40):
    """Texts over few words, so that everything repeats; nulls, empty texts, copies and repeated rows."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    passage = " ".join(rng.choice(words) for _ in range(25))
    rows = []
    for i in range(n):
        parts = [rng.choice(words) for _ in range(rng.randint(0, most))]
        if rng.random() < 0.3:
            parts.insert(rng.randint(0, len(parts)), passage)
        text = rng.choice([" ", " ", "\n", " \t"]).join(parts)
        rows.append((rng.randrange(3 * n), rng.choice([text, text, text, text.upper()]), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])))
    rows = list({r[0]: r for r in rows}.values())
    copies = [(1000 + k, rows[k][1], "en", "a") for k in range(5)]
    return [*rows, *copies, (2000, None, "en", "a"), (2001, "", None, "b"), (2002, " \n\t", "fr", None), (None, rows[1][1], "en", "c"), rows[2], rows[2]]
