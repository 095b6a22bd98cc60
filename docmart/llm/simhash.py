"""SimHash near-duplicates by tiled exact comparison.

1. Fingerprints. One Arrow pass over the texts: XXH64 of every word shingle, a bit of the
   fingerprint set if it is set in over half of the hashes (numpy bit counts).
2. Equal fingerprints collapse to one node (smallest doc_id), combined map-side, so a group of
   copies of any size is one node.
3. Tiles. Nodes are grouped by the population counts of the fingerprint's ``parts`` equal
   parts and cut into tiles of about ``tile`` rows. Two fingerprints within ``radius`` bits differ
   by at most ``radius`` in the sum of the parts' population count differences, so a tile meets only
   the tiles within that distance; all others are skipped. This is exact for any ``parts``; more
   parts skip more pairs and ship each tile more often, so the default rises with the number of nodes.
4. Pairs of tiles are compared in numpy: exclusive-or and bit counts over blocks. Each task
   emits a spanning forest of the links it found, at most one row per node and tile pair, never
   all pairs of a group.
5. Components of the links give each document the smallest doc_id it reaches.

Tile pairs grow with the square of the nodes, as the method says; the share that is compared
falls with ``parts``.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.llm.common import keep_rows, materialize, row_hash
from docmart.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

BITS = 64
SEED = 42
_ROWS, _COLS = 8, 4096  # numpy block: 256 KB of exclusive-ors


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """The unsigned fingerprint of one text; 0 if it has no word.

    bytes.split() and bytes.lower() act on exactly the six ASCII spaces and on A-Z.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(joined, SEED)
    # Each word but the last is followed by one space.
    starts = list(itertools.accumulate((len(w) + 1 for w in words), initial=0))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest,
                             [joined[i:j - 1] for i, j in zip(starts, starts[shingle:])],
                             itertools.repeat(SEED)), dtype=np.uint64, count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for k in range(0, n, 4096):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[k:k + 4096].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


@F.arrow_udf(T.LongType())
def _fingerprints(text: pa.Array, shingle: pa.Array) -> pa.Array:
    size = shingle[0].as_py()
    fps = np.fromiter((fingerprint(t, size) for t in text.to_pylist()), dtype=np.uint64, count=len(text))
    return pa.array(fps.view(np.int64))


def with_fingerprint(df: DataFrame, shingle: int = 4) -> DataFrame:
    """``df`` (with a column ``text``) and its fingerprints as signed longs in ``fp``."""
    return df.withColumn("fp", _fingerprints(F.col("text").cast("binary"), F.lit(shingle)))


def forest(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (node, its root) among fingerprints a, or between a and b, at most radius apart.

    Nodes are numbered through a, then b. Labels fall to the smallest number block by block;
    pairs whose ends already share a label are dropped before they are used.
    """
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    label = np.arange(len(a) + (0 if b is None else len(b)))
    xor, count = np.empty((_ROWS, _COLS), np.uint64), np.empty((_ROWS, _COLS), np.uint8)
    for i in range(0, len(a), _ROWS):
        left = a[i:i + _ROWS, None]
        for j in range(i if b is None else 0, len(other), _COLS):
            right = other[None, j:j + _COLS]
            size = len(left), right.shape[1]
            bits = np.bitwise_count(np.bitwise_xor(left, right, out=xor[:size[0], :size[1]]),
                                    out=count[:size[0], :size[1]])
            near = bits <= radius
            if not near.any():
                continue
            x, y = np.nonzero(near)
            x, y = x + i, y + j + shift
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            while len(x):
                low = np.minimum(label[x], label[y])
                high = np.maximum(label[x], label[y])
                np.minimum.at(label, high, low)  # roots hang under smaller roots
                while True:
                    up = label[label]
                    if np.array_equal(up, label):
                        break
                    label = up
                apart = label[x] != label[y]
                x, y = x[apart], y[apart]
    child = np.flatnonzero(label != np.arange(len(label)))
    return child, label[child]


def _deltas(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of part counts within the radius, one of each pair of opposites."""
    out = [()]
    for _ in range(parts):
        out = [(*d, x) for d in out for x in range(-radius, radius + 1)
               if sum(map(abs, d)) + abs(x) <= radius]
    return [d for d in out if _code(d) >= 0]


def _code(counts) -> int:
    return sum(int(c) << (7 * i) for i, c in enumerate(counts))


def links(nodes: DataFrame, radius: int, tile: int = 32768, parts: int | None = None) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that join exactly those
    reachable from each other in steps of at most ``radius`` bits.

    The part counts are packed seven bits each, so a difference of counts is a difference of codes.
    """
    if parts is None:
        n = nodes.count()
        parts = 1 if n < 1 << 19 else 2 if n < 1 << 22 else 4
    width = BITS // parts
    code = F.lit(0).cast("long")
    for i in range(parts):
        mask = ((1 << width) - 1) << (width * i)
        mask -= (1 << BITS) if mask >= 1 << (BITS - 1) else 0
        code = code + F.shiftleft(F.bit_count(F.col("fp").bitwiseAND(F.lit(mask))).cast("long"), 7 * i)
    coded = nodes.select("fp", code.alias("code"))
    # Cells larger than a tile are cut by a hash of the fingerprint. There are at most
    # (width + 1) ** parts cells, 83,521 by default, so their sizes can be broadcast.
    sizes = coded.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).alias("cuts"))
    tiles = materialize(
        coded.join(F.broadcast(sizes), "code")
        .groupBy("code", F.pmod(F.xxhash64("fp"), F.col("cuts")).alias("cut"))
        .agg(F.collect_list("fp").alias("fps")),
        "simhash_tiles")
    deltas = F.array(*[F.lit(_code(d)).cast("long") for d in _deltas(parts, radius)])
    a, b = (tiles.select(*[F.col(c).alias(f"{side}_{c}") for c in tiles.columns]) for side in "ab")
    pairs = (a.select("a_code", "a_cut", F.explode(deltas).alias("d"))
             .join(b.select("b_code", "b_cut"), F.col("b_code") == F.col("a_code") + F.col("d"))
             .filter("d > 0 or a_cut <= b_cut").drop("d"))
    # Each row holds two tiles, a bounded amount; rows are dealt out by tile.
    work = (pairs.join(a, ["a_code", "a_cut"]).join(b, ["b_code", "b_cut"])
            .select(F.expr("a_code = b_code and a_cut = b_cut").alias("same"), "a_fps", "b_fps"))

    def compare(batches):
        for batch in batches:
            ends = [], []
            for k, same in enumerate(batch.column(0).to_pylist()):
                x, y = (np.asarray(batch.column(c)[k].values) for c in (1, 2))
                child, root = forest(x.view(np.uint64), None if same else y.view(np.uint64), radius)
                fps = x if same else np.concatenate([x, y])
                ends[0].append(fps[child])
                ends[1].append(fps[root])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.empty(0, np.int64), *e])) for e in ends], ["a", "b"])

    return work.mapInArrow(compare, "a long, b long")


def groups(prints: DataFrame, radius: int = 4, tile: int = 32768, parts: int | None = None) -> DataFrame:
    """(fp, root): every distinct fingerprint of ``prints`` and its component's smallest one."""
    nodes = materialize(prints.select("fp").distinct(), "simhash_nodes")
    found = components(links(nodes, radius, tile, parts))
    return materialize(
        nodes.join(found, nodes["fp"] == found["node"], "left")
        .select("fp", F.coalesce("component", "fp").alias("root")), "simhash_groups")


def label(docs: DataFrame, shingle: int = 4, radius: int = 4, tile: int = 32768,
          parts: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document.

    component_id is the smallest doc_id reachable over links, itself included. Texts without a
    word (NULL, empty, blank) have fingerprint zero and link like any other. NULL ids count only
    if no id is reachable; component_id is then NULL. Repeated rows each get a row. An empty
    table gives an empty result.
    """
    prints = materialize(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "fp"),
                         "simhash_fp")
    root = groups(prints, radius, tile, parts)
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    ids = smallest.join(root, "fp").groupBy("root").agg(F.min("low").alias("component_id"))
    names = materialize(root.join(ids, "root").select("fp", "component_id"), "simhash_names")
    return prints.join(names, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each component, with the input's columns: that with the smallest doc_id.

    NULL ids stay only in components without an id. Of rows that repeat the smallest id that with the
    smallest row hash stays. Groups and survivors are found on narrow columns.
    """
    rows = materialize(
        with_fingerprint(docs.select("doc_id", row_hash(docs).alias("row_hash"), "text"), shingle)
        .select("doc_id", "row_hash", "fp"), "simhash_rows")
    root = groups(rows, radius)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("keep_id"),
                           F.col("row_hash").alias("keep_hash")))
    by_fp = rows.groupBy("fp").agg(first.alias("best"))
    keep = (by_fp.join(root, "fp").groupBy("root").agg(F.min("best").alias("best"))
            .select("best.keep_id", "best.keep_hash"))
    return keep_rows(docs, rows, keep)
