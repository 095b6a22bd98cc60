"""Fixtures shared by the tests of the training-data operators."""

from __future__ import annotations

import random

# Extra columns whose names the operators use inside.
CLASHES = ("doc", "digest", "rank", "row_no", "fp", "u", "skey", "size", "c", "t", "piece", "place", "tie", "items",
           "language", "words", "hashes", "norm", "run", "cut", "pieces", "lines", "copies")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def awkward() -> list[tuple]:
    """NULLs in every column, blank and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    base = prose(rng, 120)
    rows = [
        (1, base, "en", "a", 1), (2, base.replace(" ", "\n\t"), "en", "a", 1), (3, base, "fr", "b", 1),
        (4, None, "en", "a", None), (5, "", "en", None, 0), (6, " \t\n", None, "b", 3), (7, "1234 !! --", "en", "é", 9),
        (None, base, "en", "a", 1), (None, prose(rng, 80), None, None, None), (None, None, None, None, None),
        (8, prose(rng, 60_000, 9000), "de", "b", 1), (9, "solo", "de", "a", 4), (9, "solo", "de", "a", 4),
        (10, "solo other", "de", "a", 4), (10, prose(rng, 90), "de", "z", 4),
        (11, "same same same same same same same " * 30, "en", "a", 1),
        (-12, prose(rng, 40) + " " + base + " " + prose(rng, 40), "en", "a", 1),
        (13, prose(rng, 30) + " " + base[:400], "en", "a", 1),
        (14, "Straße ÀÉ 日本語 😀 ▁x \x00   a\x85b\x1cc", "de", "a", 1),
    ]
    return rows


def documents(spark, rows):
    return spark.createDataFrame([r + ("extra",) * len(CLASHES) for r in rows], SCHEMA)


def as_set(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
