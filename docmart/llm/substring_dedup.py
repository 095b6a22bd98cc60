"""Substring dedup: every window of ``window`` words that also starts in an earlier document goes.

All windows get a Rabin-Karp hash (a polynomial over 64-bit word hashes, rolled over the whole
text with one running sum). To count them without shuffling one row per word, consecutive
windows are counted together wherever that cannot change the result:

* The anchor of a window is the smallest hash of the ``inner``-word windows inside it. Equal
  windows have equal anchors, so a window whose anchor occurs in one document only is unique.
* Neighbouring windows with one anchor form a block, hashed as a whole. Blocks are counted by
  (anchor, block hash). In any document but the first one of a block, all its windows repeat.
* In the first document of a block, windows can still repeat if the anchor also occurs, in
  another block, in an earlier document (at the edges of a passage). Only for such anchors are
  single windows written out and counted, by (anchor, window hash), a 128-bit key.

Repeated blocks and windows of a document then merge into maximal intervals, and the words
outside them are kept. The hash of every block and window is checked against the text again when
it is applied, so rows that share a doc_id cannot cut each other's text.

Counting keeps minima only, combined map-side; a passage that a third of all documents hold
is one group there. Joins back to the blocks read written tables, so that Spark can split hot keys.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.llm.common import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        for name, x in (("up", BASE), ("down", _INVERSE)):
            steps = np.full(size, x, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


class Rolling:
    """Hashes of any spans of a text's words."""

    def __init__(self, text: bytes | None):
        self.words = text.split() if text else []  # splits at exactly the six ASCII spaces
        n = len(self.words)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), dtype=np.uint64, count=n)
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, sizes) -> np.ndarray:
        """Hashes of the spans of ``sizes`` words from ``starts``."""
        x = (self.sums[starts + sizes] - self.sums[starts]) * self.down[starts]
        x = x + np.asarray(sizes, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))

    def blocks(self, window: int, inner: int):
        """(anchor, block hash, start, words) of each block."""
        n = len(self.words) - window + 1
        if n <= 0:
            return None
        low = self.spans(np.arange(len(self.words) - inner + 1), inner)
        width, have = window - inner + 1, 1
        while have * 2 <= width:  # minima over 2, 4, 8, ... neighbours
            low, have = np.minimum(low[:-have], low[have:]), have * 2
        if have < width:
            low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
        starts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
        sizes = np.diff(np.append(starts, n)) + window - 1
        return low[starts], self.spans(starts, sizes), starts, sizes

    def confirmed(self, starts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Which spans are spans of this text."""
        ok = starts + sizes <= len(self.words)
        ok[ok] = self.spans(starts[ok], sizes[ok]).view(np.int64) == hashes[ok]
        return ok


def _identity(docs: DataFrame) -> tuple[Column, Column]:
    """Place in the order of documents (NULL ids last), and what tells rows without an id apart."""
    return (F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("place"),
            F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("long").alias("tie"))


def _columns(parts: list[list[np.ndarray]], kinds: list) -> list[pa.Array]:
    return [pa.array(np.concatenate([np.empty(0, k), *p]).astype(k, copy=False)) for p, k in zip(parts, kinds)]


def _blocks(docs: DataFrame, window: int, inner: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            places, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for k, text in enumerate(batch.column(2).to_pylist()):
                found = Rolling(text).blocks(window, inner)
                if found is None:
                    continue
                anchor, block, starts, sizes = found
                for p, x in zip(parts, (np.full(len(starts), places[k]), np.full(len(starts), ties[k]),
                                        anchor.view(np.int64), block.view(np.int64), starts, sizes)):
                    p.append(x)
            yield pa.RecordBatch.from_arrays(
                _columns(parts, [np.int64] * 4 + [np.int32] * 2), ["place", "tie", "anchor", "hash", "start", "size"])

    return (docs.select(*_identity(docs), F.col("text").cast("binary"))
            .mapInArrow(run, "place long, tie long, anchor long, hash long, start int, size int"))


def _windows(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """Single windows of the blocks in ``items``, which are grouped by document."""

    def run(batches):
        for batch in batches:
            places, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            lists = batch.column(3)
            ends, values = lists.offsets.to_numpy(), lists.values
            field = {n: values.field(n).to_numpy(zero_copy_only=False) for n in ("start", "size", "hash", "anchor", "late")}
            parts: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for k, text in enumerate(batch.column(2).to_pylist()):
                own = {n: x[ends[k]:ends[k + 1]] for n, x in field.items()}
                words = Rolling(text)
                ok = words.confirmed(own["start"].astype(np.int64), own["size"].astype(np.int64), own["hash"])
                for i in np.flatnonzero(ok):
                    starts = np.arange(own["start"][i], own["start"][i] + own["size"][i] - window + 1)
                    hashes = words.spans(starts, window).view(np.int64)
                    n = len(starts)
                    for p, x in zip(parts, (np.full(n, places[k]), np.full(n, ties[k]), np.full(n, own["anchor"][i]),
                                            hashes, starts, np.full(n, own["late"][i]))):
                        p.append(x)
            yield pa.RecordBatch.from_arrays(
                _columns(parts, [np.int64] * 4 + [np.int32, np.bool_]), ["place", "tie", "anchor", "hash", "start", "late"])

    rows = docs.select(*_identity(docs), F.col("text").cast("binary").alias("text"))
    return (rows.join(items, ["place", "tie"]).select("place", "tie", "text", "items")
            .mapInArrow(run, "place long, tie long, anchor long, hash long, start int, late boolean"))


def repeats(docs: DataFrame, window: int = 50, inner: int = 12) -> DataFrame:
    """(place, tie, items): the repeated spans (start, size, hash) of each document that has some."""
    blocks = materialize(_blocks(docs, window, inner), "substring_blocks")
    shared = materialize(blocks.groupBy("anchor").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
                         .filter("lo < hi").select("anchor"), "substring_anchors")
    blocks = materialize(blocks.join(shared, "anchor"), "substring_shared")
    firsts = materialize(blocks.groupBy("anchor", "hash").agg(F.min("place").alias("first")), "substring_firsts")
    disputed = materialize(firsts.groupBy("anchor").agg(F.min("first").alias("anchor_first"), F.max("first").alias("last"))
                           .filter("anchor_first < last").select("anchor", "anchor_first"), "substring_disputed")
    known = materialize(
        blocks.join(firsts, ["anchor", "hash"]).join(disputed, "anchor", "left")
        .filter("place > first or anchor_first is not null"), "substring_known")
    span = F.struct("start", "size", "hash")
    open_items = (known.filter("place = first")
                  .groupBy("place", "tie")
                  .agg(F.collect_list(F.struct("start", "size", "hash", "anchor",
                                               F.expr("place > anchor_first").alias("late"))).alias("items")))
    windows = materialize(_windows(docs, materialize(open_items, "substring_open"), window), "substring_windows")
    earliest = materialize(windows.groupBy("anchor", "hash").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                           .filter("first < last").select("anchor", "hash", "first"), "substring_earliest")
    late = (windows.filter("late").join(earliest, ["anchor", "hash"]).filter("place > first")
            .select("place", "tie", F.struct("start", F.lit(window).alias("size"), "hash").alias("item")))
    whole = known.filter("place > first").select("place", "tie", span.alias("item"))
    return (whole.unionByName(late).groupBy("place", "tie")
            .agg(F.collect_list("item").alias("items")))


_CUT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("kept", T.StringType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])))])


@F.arrow_udf(_CUT)
def _cut(text: pa.Array, items: pa.Array) -> pa.Array:
    ends, values = items.offsets.to_numpy(), items.values
    start, size, hashes = (values.field(n).to_numpy(zero_copy_only=False) for n in ("start", "size", "hash"))
    n_words, n_removed, kept, removed = [], [], [], []
    for k, t in enumerate(text.to_pylist()):
        a, b = ends[k], ends[k + 1]
        gone = []
        if a == b:
            words = t.split() if t else []
        else:
            rolling = Rolling(t)
            words = rolling.words
            at, n = start[a:b].astype(np.int64), size[a:b].astype(np.int64)
            ok = rolling.confirmed(at, n, hashes[a:b])
            steps = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(steps, at[ok], 1)
            np.add.at(steps, at[ok] + n[ok], -1)
            inside = np.concatenate([[0], np.cumsum(steps)[:-1] > 0, [0]]).astype(np.int8)
            turns = np.flatnonzero(np.diff(inside))
            gone = list(zip(turns[::2].tolist(), turns[1::2].tolist()))
        left, last = [], 0
        for x, y in gone:
            left += words[last:x]
            last = y
        left += words[last:]
        n_words.append(len(words))
        n_removed.append(len(words) - len(left))
        kept.append(b" ".join(left).decode())
        removed.append([{"start": x, "stop": y} for x, y in gone])
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string()),
         pa.array(removed, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))],
        ["n_words", "n_removed", "kept", "removed"])


def dedup(docs: DataFrame, window: int = 50, inner: int = 12) -> DataFrame:
    """``docs`` and a struct ``cut``: n_words, n_removed, the kept words joined by one space, and
    the removed intervals (first word, word after the last). A column ``cut`` of the input is replaced.

    Windows are judged on the input texts; a window goes if it also starts in a document with a
    smaller doc_id, so repeats within one document stay. NULL and blank texts have no words.
    Rows without an id come after all others and do not cut each other. Rows that repeat an id
    do not cut each other either. An empty table gives an empty result.
    """
    from docmart.llm.common import pack_doc

    docs = docs.drop("cut")
    items = repeats(docs.select("doc_id", "text"), window, inner)
    place, tie = _identity(docs)
    return (docs.select(pack_doc(docs), place, tie, F.col("text").cast("binary").alias("text"))
            .join(items, ["place", "tie"], "left")
            .select("doc", _cut("text", F.coalesce("items", F.expr(
                "cast(array() as array<struct<start:int,size:int,hash:bigint>>)"))).alias("cut"))
            .select("doc.*", "cut"))
