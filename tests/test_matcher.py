"""The dictionary matcher: words read off patterns, candidates, and cost by the size of the dictionary."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from docmart import rules
from docmart.functions import matcher
from docmart.functions import text as X
from pyspark.sql import functions as F


@pytest.mark.parametrize("pattern, words", [
    (r"\bpago\s*facil\b", ["pago", "facil"]), (r"\batm[s]?\b", ["atm"]), (r"cuota?s", ["cuot"]), (r"a+bc\.de", ["bc", "de"]),
    (r"uno|dos", []), (r"(uno)?", []), (r"ab{0,2}", []), (r"[\]ab]cd", ["cd"]), (r"[a[bc]de]", []), (r"\x41bc", []), ("", []),
])
def test_required_words(pattern, words):
    assert matcher.required_words(pattern) == words


_piece = st.sampled_from([r"\b", r"\s*", "pa", "go", "x1", "[ab]", "[ab]?", "c?", "d+", r"\.", "e*", ".", "(f|g)", "|"])


@settings(max_examples=400, deadline=None)
@given(st.lists(_piece, min_size=1, max_size=5).map("".join),
       st.lists(st.sampled_from(["pa", "go", "x1", " ", "a", "b", "c", "d", ".", "e", "f"]), max_size=12).map("".join))
def test_no_match_lacks_its_words(pattern, text):
    """Whatever the pattern, a text that it matches is among its candidates."""
    if re.search(pattern, text):
        assert matcher.finder([("l", pattern)])(text) == [0]


def test_labels_against_plain_regexes(spark):
    rng = random.Random(5)
    words = ["pago", "facil", "rapipago", "visa", "VISA", "revisar", "atm", "atms", "Página", "web", "master", "card", "x", "\n", ""]
    patterns = [*rules.PAYMENT_PATTERNS, ("Otro", r"(banco|caja)\b"), ("Otro", r"caja"), ("Vacío", r"^$")]
    texts = [" ".join(rng.choice(words + ["caja", "banco"]) for _ in range(rng.randrange(8))) for _ in range(300)] + [None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["labels"] for r in df.select("i", X.payment_labels("t", patterns).alias("labels")).collect()}
    from docmart.functions.arrow import fold_one
    for i, t in enumerate(texts):
        assert got[i] == sorted(label for label, p in patterns if re.search(p, fold_one(t)))


def test_cost_does_not_grow_with_the_dictionary(spark):
    """Five thousand labels take less than three times as long as fifteen, over the same texts."""
    docs = spark.range(0, 20_000, 1, 4).select(F.concat(
        F.lit("Se abona con tasa "), F.col("id") % 5000, F.lit(", Rapipago o en el "), F.repeat(F.lit("banco de la zona "), 20)).alias("t"))
    many = [(f"Tasa {k}", rf"\btasa\s*{k}\b") for k in range(5000)]

    def seconds(patterns):
        df = docs.select(F.sum(F.size(X.payment_labels("t", patterns))))
        df.collect()
        best = []
        for _ in range(3):
            start = time.perf_counter()
            df.collect()
            best.append(time.perf_counter() - start)
        return min(best)

    few, all_of_them = seconds(many[:15]), seconds(many)
    assert all_of_them < 3 * few, (few, all_of_them)
