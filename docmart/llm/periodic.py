"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q that is at least ``repeats`` periods and ``least`` words
long and that no neighbouring word extends.

1. Candidates on the harmonic grid. For each period p the words at the multiples of p are compared with
   those one step on: a run of at least four periods holds four grid points in a row, whose words are
   equal. All periods together compare n (1 + 1/2 + 1/3 + ...) words.
2. Recompression. The texts that have candidates become one run-length grammar: block compression
   replaces each maximal block of a symbol by a symbol of its own, pair compression each pair of a left and
   a right symbol, in turn, until every text is one symbol. Equal stretches are cut alike but for
   their ends, so equal symbols stand for equal words.
3. Extensions. How far two places agree, to the right and to the left, is read off the grammar: climb
   while the symbols above are equal, skip blocks as a whole, descend where symbols differ. That takes a number of
   steps in the order of the grammar's height, however long the run, and gives its exact ends.

Shorter periods come first, so a stretch found again under a multiple of its period is known already.
Texts are worked on in blocks of about ``_BLOCK`` words, texts of like lengths together; a very long text is a block of
its own, and needs a few hundred bytes a word. No suffix arrays, no limits on length or period.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import word_count, words

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

_BLOCK = 1 << 17  # words
REPEATS, LEAST = 4, 6
_RESULT = ("struct<n_words: long, runs: array<struct<start: long, length: long, period: long>>, "
           "best: struct<start: long, length: long, period: long>, collapsed: string>")


class Grammar:
    """Run-length grammar of a sequence of symbols by recompression.

    Negative symbols are separators: each occurs once, joins nothing and so agrees with nothing; the sequence
    begins and ends with one. Level 0 is the sequence; ``levels[h]`` has for each symbol of level h its number
    and its parent's place in level h + 1, and for each symbol of level h + 1 where its children begin.
    """

    def __init__(self, symbols: np.ndarray):
        symbols = np.asarray(symbols, np.int64)
        goal = 2 * int((symbols < 0).sum()) - 1  # every text one symbol
        self.levels, fresh, seed = [], int(symbols.max(initial=0)) + 1, 0
        while True:
            for compress in (self._blocks, self._pairs):
                seed += 1
                first, upper, fresh = compress(symbols, fresh, seed)
                if len(first) < len(symbols):
                    self._add(symbols, first)
                    symbols = upper
            if len(symbols) <= goal:
                break
        self._add(symbols, None)

    def _add(self, symbols: np.ndarray, first: np.ndarray | None) -> None:
        if first is None:  # the top has no parents
            self.levels.append((symbols, None, None))
            return
        mark = np.zeros(len(symbols), np.int32)
        mark[first] = 1
        begin = np.append(first, len(symbols)).astype(np.int32)
        self.levels.append((symbols.astype(np.int32), np.cumsum(mark, dtype=np.int32) - 1, begin))

    @staticmethod
    def _named(keys: np.ndarray, fresh: int) -> tuple[np.ndarray, int]:
        """New symbols for equal keys."""
        found, place = np.unique(keys, return_inverse=True)
        return fresh + place, fresh + len(found)

    def _blocks(self, s: np.ndarray, fresh: int, seed: int):
        """Each maximal block of two or more equal symbols becomes one."""
        first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        size = np.diff(first, append=len(s))
        upper, long = s[first], size > 1
        upper[long], fresh = self._named(upper[long] << 32 | size[long], fresh)
        return first, upper, fresh

    def _pairs(self, s: np.ndarray, fresh: int, seed: int):
        """Each left symbol followed by a right symbol becomes one with it; a hash says which are left."""
        mixed = (s * 0x9E3779B1 + seed * 0x85EBCA77) & 0xFFFFFFFF
        left = ((mixed * 0xC2B2AE3D >> 29 ^ mixed) & 1).astype(bool)
        plain = s >= 0
        both = plain[:-1] & plain[1:] & (left[:-1] != left[1:])
        forth, back = both & left[:-1], both & left[1:]
        joined = forth if forth.sum() >= back.sum() else back
        head = np.append(joined, False)
        first = np.flatnonzero(np.concatenate([[True], ~joined]))
        upper, pair = s[first], head[first]
        upper[pair], fresh = self._named(s[first[pair]] << 32 | s[first[pair] + 1], fresh)
        return first, upper, fresh

    def forward(self, x: int, y: int) -> int:
        """How many symbols agree from places x and y on."""
        return self._agree(x, y, True)

    def backward(self, x: int, y: int) -> int:
        """How many symbols agree before places x and y."""
        return self._agree(x - 1, y - 1, False)

    def _agree(self, x: int, y: int, ahead: bool) -> int:
        h, a, b, agreed, levels = 0, x, y, 0, self.levels
        sizes = self.sizes
        while True:
            symbols, parent, begin = levels[h]
            if parent is not None:
                pa_, pb = parent[a], parent[b]
                edge = ((begin[pa_] == a and begin[pb] == b) if ahead
                        else (begin[pa_ + 1] == a + 1 and begin[pb + 1] == b + 1))
                if edge and levels[h + 1][0][pa_] == levels[h + 1][0][pb]:
                    h, a, b = h + 1, pa_, pb
                    continue
            if symbols[a] == symbols[b]:
                # Within blocks the rest of the shorter one agrees; a pair has two different symbols.
                step = 1
                if parent is not None:
                    rest_a = begin[pa_ + 1] - a if ahead else a - begin[pa_] + 1
                    rest_b = begin[pb + 1] - b if ahead else b - begin[pb] + 1
                    rest = int(min(rest_a, rest_b))
                    if rest > 1 and symbols[a] == symbols[a + 1 if ahead else a - 1]:
                        step = rest
                agreed += step * int(sizes[h][a])
                a, b = (a + step, b + step) if ahead else (a - step, b - step)
            elif h == 0:
                return agreed
            else:
                h -= 1
                begin = levels[h][2]
                a, b = (begin[a], begin[b]) if ahead else (begin[a + 1] - 1, begin[b + 1] - 1)

    @property
    def sizes(self) -> list[np.ndarray]:
        """How many symbols of level 0 each symbol of a level stands for."""
        if not hasattr(self, "_sizes"):
            at = np.arange(len(self.levels[0][0]) + 1)
            self._sizes = [np.diff(at)]
            for _, _, begin in self.levels[:-1]:
                at = at[begin]
                self._sizes.append(np.diff(at))
        return self._sizes


def _spans(seq: np.ndarray, longest: int, repeats: int):
    """(p, places): grid places of period p where four grid words in a row are equal, and a few
    words between them also come again a period on."""
    for p in range(1, longest // repeats + 1):
        grid = seq[::p]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
        if len(at):
            at *= p
            for off in {1 % p, p // 2, p - 1, p + p // 3}:
                at = at[seq[at + off] == seq[at + off + p]]
            if len(at):
                yield p, at


def find(texts: list[np.ndarray], repeats: int = REPEATS, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each sequence of word numbers, by start, then period.

    ``repeats`` is four or more: shorter runs need not hold four grid points.
    """
    if repeats < 4:
        raise ValueError("runs of four periods or more are asked for")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    block: list[int] = []
    size = 0
    for i in order:
        if len(texts[i]) < max(least, repeats):
            continue
        if block and size + len(texts[i]) > _BLOCK:
            _find(texts, block, out, repeats, least)
            block, size = [], 0
        block.append(i)
        size += len(texts[i])
    if block:
        _find(texts, block, out, repeats, least)
    return out


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The texts between separators, and where each begins."""
    parts, at, starts = [np.array([-1])], 1, []
    for k, t in enumerate(texts):
        starts.append(at)
        parts += [t, np.array([-2 - k])]
        at += len(t) + 1
    return np.concatenate(parts), np.array(starts)


def _find(texts, block: list[int], out: list, repeats: int, least: int) -> None:
    seq, starts = _joined([texts[i] for i in block])
    found = list(_spans(seq, max(len(texts[i]) for i in block), repeats))
    if not found:
        return
    # The grammar is built over the texts that have candidates.
    owners = [np.searchsorted(starts, at, "right") - 1 for _, at in found]
    having = np.unique(np.concatenate(owners))
    seq, new_starts = _joined([texts[block[k]] for k in having])
    grammar = Grammar(seq)
    place = np.searchsorted(having, np.arange(len(block)))
    known: dict[tuple[int, int], int] = {}
    runs: list[tuple[int, int, int]] = []
    cover = np.full(len(seq), -1, np.int32)  # a run found over each place
    for (p, at), owner in zip(found, owners):
        moved = at - starts[owner] + new_starts[np.minimum(place[owner], len(having) - 1)]
        done = -1
        for i in moved.tolist():
            if i + 3 * p < done:
                continue  # inside the stretch that the last place gave
            r = cover[i]
            if r >= 0 and p % runs[r][2] == 0 and i + 3 * p < runs[r][1]:
                done = runs[r][1]  # a multiple of that run's period
                continue
            start = i - grammar.backward(i, i + p)
            done = end = i + p + grammar.forward(i, i + p)
            if end - start >= max(least, repeats * p) and (start, end) not in known:
                known[start, end] = p
                cover[start:end] = len(runs)
                runs.append((start, end, p))
    for start, end, p in sorted(runs):
        k = int(np.searchsorted(new_starts, start, "right")) - 1
        out[block[having[k]]].append((start - int(new_starts[k]), end - start, p))
    for k in having:
        out[block[k]].sort(key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length / period; ties: the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Word numbers, the same for equal words of all texts."""
    table = dict.fromkeys(w for ws in texts for w in ws)
    for i, w in enumerate(table):
        table[w] = i
    return [np.fromiter(map(table.__getitem__, ws), np.int64, len(ws)) for ws in texts]


def _collapsed(ws: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    if runs:
        keep = np.ones(len(ws), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        ws = [ws[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(ws).decode()


def with_runs(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """``docs`` and a struct column ``periodic``: n_words, runs (start, length, period; words are numbered from 0),
    best (the run of the greatest exponent, NULL without one) and collapsed, the text's words joined by
    one space without those that a run holds behind its first period.

    Words are runs of other characters than the six ASCII spaces. NULL, empty and blank texts have no
    words, no runs and an empty collapsed text. A column ``periodic`` of the input is replaced; repeated
    rows each get theirs; an empty table gives an empty result.
    """
    @F.arrow_udf(_RESULT)
    def periodic(text: pa.Array) -> pa.Array:
        rows, i = [], 0
        while i < len(text):  # texts of about 8 MB are split into words at a time
            j, size = i, 0
            texts = []
            while j < len(text) and (not texts or size < 1 << 23):
                raw = text[j].as_py() or b""
                texts.append(raw.split())  # on exactly the six ASCII spaces
                size += len(raw)
                j += 1
            for ws, runs in zip(texts, find(_numbered(texts), repeats, least)):
                rows.append((len(ws), runs, strongest(runs), _collapsed(ws, runs)))
            i = j
        run = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])
        as_dict = lambda r: r and dict(zip(("start", "length", "period"), r))
        return pa.StructArray.from_arrays([
            pa.array([r[0] for r in rows], pa.int64()), pa.array([[as_dict(x) for x in r[1]] for r in rows], pa.list_(run)),
            pa.array([as_dict(r[2]) for r in rows], run), pa.array([r[3] for r in rows], pa.string()),
        ], ["n_words", "runs", "best", "collapsed"])

    return docs.withColumn("periodic", periodic(F.col("text").cast("binary")))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every text's words, those of documents whose crc32 of the id ends in 0 made periodic
    from a place on: word i >= a becomes word a + (i - a) % p, with h the crc32 of the id as text,
    g = h // 10, a = g % n, p = 1 + (n - a) // (3 + g % 8). Documents without an id stay as they are."""
    h, n = F.crc32(F.col("doc_id").cast("string").cast("binary")), word_count(F.col("text"))
    odd = docs.select("doc_id", "text", F.when(h % 10 == 0, F.floor(h / 10)).alias("g"), n.alias("n"))
    odd = odd.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n")))
    odd = odd.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    ws = F.when(F.col("a").isNotNull(), words(F.col("text")))
    tail = lambda size: F.slice(ws, F.col("a").cast("int") + 1, size.cast("int"))
    count: Column = F.col("n") - F.col("a")
    made = F.concat(F.slice(ws, 1, F.col("a").cast("int")),
                    F.flatten(F.array_repeat(tail(F.col("p")), F.expr("cast((n - a) div p as int)"))), tail(count % F.col("p")))
    return odd.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def profile(docs: DataFrame, repeats: int = REPEATS, least: int = LEAST) -> DataFrame:
    """doc_id, n_runs, start, length, period and exponent_milli of the strongest run (NULL without one), runs_sha256
    and collapsed_sha256: one row per document, with the definitions of ``with_runs``."""
    # The struct is cut into columns here, so that the function is run once a row.
    found = with_runs(docs.select("doc_id", "text"), repeats, least).select("doc_id", "periodic.*")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
