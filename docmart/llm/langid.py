"""Language identification: multinomial naive Bayes over hashed character n-grams.

Text is lower-cased, every run of characters that are not letters becomes one space, and all
n-grams of 1 to 3 code points of the whole text are hashed to ``2 ** DIM_BITS`` features with
vectorised integer arithmetic.

Training counts features per language in Spark (each task pre-aggregates, integers, so reruns
agree) over a documented, bounded sample of the labelled rows: at most about ``per_lang``
documents of each language, chosen by a hash of the id. The counts become a matrix of log
probabilities, languages x features: its size is fixed by ``DIM_BITS`` and ``max_langs``, so it
can be broadcast. Scoring gathers the matrix rows of a whole Arrow batch's n-grams and adds
them up per document (numpy reduceat), in slices of bounded size.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

DIM_BITS = 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"
_SLICE = 1 << 16  # code points scored at a time
_RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


_TABLES: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letters" not in _TABLES:
        _TABLES["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)
    return _TABLES["letters"]


def code_points(text: str | None) -> np.ndarray:
    """Lower-cased code points with runs of non-letters as one space; empty without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return codes[:0]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first character after a letter stands for its run
    return np.concatenate([[32], np.where(letter, codes, 32)[keep], [32]]).astype(np.uint32)


def features(codes: np.ndarray) -> np.ndarray:
    """Feature numbers of all n-grams of ``codes``."""
    out = []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            break
        h = np.full(size, 0x9E3779B1 * n & 0xFFFFFFFF, dtype=np.uint32)
        for i in range(n):
            h = (h ^ codes[i:i + size]) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        out.append((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - DIM_BITS))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    """Languages, log priors, and log probabilities as features x languages."""

    langs: list[str]
    prior: np.ndarray
    logp: np.ndarray

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Most probable language and its posterior; ('und', 0) for a text without a letter."""
        total = np.tile(self.prior, (len(texts), 1))
        known = np.zeros(len(texts), dtype=bool)
        pieces, owners, size = [], [], 0

        def add() -> None:
            if pieces:
                counts = np.fromiter(map(len, pieces), dtype=np.int64)
                at = np.concatenate([[0], np.cumsum(counts)[:-1]])
                rows = self.logp[np.concatenate(pieces)]
                np.add.at(total, owners, np.add.reduceat(rows, at, axis=0, dtype=np.float64))
                pieces.clear()
                owners.clear()

        for k, text in enumerate(texts):
            codes = code_points(text)
            known[k] = bool(len(codes)) and bool(self.langs)
            if not known[k]:
                continue
            step = _SLICE
            for i in range(0, len(codes), step):  # slices overlap so that no n-gram is lost
                own = codes[i:i + step]
                grams = features(own)
                if i:
                    grams = np.concatenate([grams, _across(codes, i)])
                pieces.append(grams)
                owners.append(k)
                size += len(own)
                if size >= step:
                    add()
                    size = 0
        add()
        out = []
        for k in range(len(texts)):
            if not known[k]:
                out.append((UNKNOWN, 0.0))
                continue
            best = int(np.argmax(total[k]))
            out.append((self.langs[best], float(1.0 / np.exp(total[k] - total[k][best]).sum())))
        return out


def _across(codes: np.ndarray, i: int) -> np.ndarray:
    """Features of the n-grams that begin before position i and end at or after it."""
    out = []
    for n in ORDERS[1:]:
        for j in range(max(0, i - n + 1), min(i, len(codes) - n + 1)):
            out.append(features(codes[j:j + n])[-1:])
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)


def held_out() -> Column:
    """Rows never learned from: crc32 of the id as text divisible by 5 (a NULL id as empty text)."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, per_lang: int = 10_000, alpha: float = 0.5, max_langs: int = 256) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the rows of ``docs`` (held-out rows excluded).

    ``per_lang`` bounds the sample of each language (in expectation; chosen by a hash of the id);
    languages with fewer documents are learned from all of them. More than ``max_langs``
    languages raise, since the broadcast matrix is bounded by it.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & ~held_out()).select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
             .orderBy("lang").limit(max_langs + 1).collect()}
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = sorted(sizes)
    dim = 1 << DIM_BITS
    if not langs:
        return Model([], np.zeros(0), np.zeros((dim, 0), dtype=np.float32))
    share = F.element_at(F.create_map(*[x for lang in langs for x in (
        F.lit(lang), F.lit(min(1.0, per_lang / sizes[lang])))]), F.col("lang"))
    uniform = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(uniform < share).select("lang", "text")

    def count(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                codes = code_points(text)
                into = seen.setdefault(lang, np.zeros(dim, dtype=np.int64))
                for i in range(0, len(codes), _SLICE):
                    into += np.bincount(features(codes[i:i + _SLICE]), minlength=dim)
                    if i:
                        into += np.bincount(_across(codes, i), minlength=dim)
        for lang, n in seen.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "f", "n"])

    counted = (sample.mapInArrow(count, "lang string, f long, n long")
               .groupBy("lang", "f").agg(F.sum("n").alias("n")).toPandas())
    n = np.zeros((dim, len(langs)))
    n[counted["f"], counted["lang"].map({x: i for i, x in enumerate(langs)}).astype(int)] = counted["n"]
    logp = np.log((n + alpha) / (n.sum(axis=0) + alpha * dim)).astype(np.float32)
    rows = np.array([sizes[x] for x in langs], dtype=np.float64)
    return Model(langs, np.log(rows / rows.sum()), logp)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` and a struct column ``language`` (lang_pred, score), from ``text`` alone.

    A column ``language`` of the input is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.prior, model.logp))

    @F.arrow_udf(_RESULT)
    def language(text: pa.Array) -> pa.Array:
        return pa.array([{"lang_pred": a, "score": s} for a, s in Model(*shared.value).score(text.to_pylist())],
                        type=pa.struct([("lang_pred", pa.string()), ("score", pa.float64())]))

    return docs.withColumn("language", language("text"))


def label(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per document.

    Texts that are NULL or without a letter are ``und`` with score 0, as is everything if no
    labelled row is there to learn from. Repeated rows each get a row; an empty table gives an
    empty result.
    """
    model = train(docs, **options)
    return (predict(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score"))


def keep_known(docs: DataFrame, min_score: float = 0.5, **options) -> DataFrame:
    """The documents whose language is known with at least ``min_score``, with the input's columns.

    If no labelled row is there to learn from, no language can be told from another: then every
    document with a letter stays.
    """
    from docmart.llm.common import pack_doc, unpack_doc

    model = train(docs, **options)
    if not model.langs:
        return docs.filter(F.coalesce(docs["`text`"], F.lit("")).rlike(r"\p{L}"))
    scored = predict(docs.select(pack_doc(docs), "text"), model)
    return unpack_doc(scored.filter((F.col("language.lang_pred") != UNKNOWN)
                                    & (F.col("language.score") >= min_score)))
