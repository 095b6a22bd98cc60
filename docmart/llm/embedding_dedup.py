"""Near copies among embeddings: random hyperplanes, exact cosines, connected components.

1. Classes. Equal vectors of one label are one class, counted map-side, so copies of any number are one node.
2. Sign hashing. Random hyperplanes give each class one key a table, the signs on ``width`` of them, and a sketch
   of 256 signs. Two vectors at angle t agree on a sign with probability 1 - t / pi; ``plan`` chooses
   the width by the largest label's classes, so that unlike vectors rarely share a key, and as many tables as
   keep the chance that a pair right at the threshold shares a key at ``recall``.
3. Candidates. Classes that share label, table and key are compared by their sketches (exclusive-or and
   bit counts): pairs further apart than five standard deviations beyond the threshold's angle go. Each task
   emits a spanning forest of what is left, not its pairs; components of that, the candidate groups, hold
   every candidate link. Only keys and sketches are shipped once a table; vectors are not.
4. Verification. The vectors of a candidate group come together and every pair's cosine is taken in double
   precision; pairs next to the threshold are taken again in exact sums. Where the pairs of a group are more
   than those that its buckets hold (groups linked by long chains), its pairs are taken bucket by bucket, a pair
   in the first table that it shares. Tasks emit a count for each class and a spanning forest.
5. Components of the verified links by large-star/small-star rounds.

Units of comparison larger than ``tile`` classes are cut into tiles and compared tile pair by tile pair in
as many tasks, so a bucket, group or label of any size is bounded in memory and nothing is dropped. The pairs
of a dense group are all compared (their number is part of the result) but never written.
"""

from __future__ import annotations

import functools
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.llm.common import buckets_for, materialize
from docmart.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

SKETCH = 256  # bits
SEED = 42
_BUNDLE = 4096  # rows of small units that go to a task's function together
_CLOSE = 1e-9  # of the threshold: the cosine is taken again in exact sums


def plan(classes: int, threshold: float, recall: float, bucket: int = 256) -> tuple[int, int]:
    """(width, tables): buckets of about ``bucket`` unlike classes, and tables enough for the recall."""
    same = 1 - math.acos(threshold) / math.pi
    width = min(24, max(8, math.ceil(math.log2(max(1, classes) / bucket))))
    return width, math.ceil(math.log(1 - recall) / math.log(1 - same ** width))


def radius(threshold: float) -> int:
    """Bits of the sketch in which a pair at the threshold differs, and five standard deviations."""
    q = math.acos(threshold) / math.pi
    return math.ceil(SKETCH * q + 5 * math.sqrt(SKETCH * q * (1 - q)))


# Vectors -------------------------------------------------------------------------------------------

@F.arrow_udf(T.BinaryType())
def _packed(vector: pa.Array) -> pa.Array:
    """The vector's bytes; NULL if it can't link: NULL, empty, zero, or with NULL or non-finite components."""
    out = []
    for x in vector:
        v = x.values
        if v is None or v.null_count or not len(v):
            out.append(None)
            continue
        a = v.to_numpy(zero_copy_only=False)
        out.append(a.tobytes() if np.isfinite(a).all() and a.any() else None)
    return pa.array(out, pa.binary())


def _floats(raw: list[bytes], wide: bool) -> np.ndarray:
    """Vectors of one length as rows of doubles, scaled by powers of two (which is exact) to below one."""
    x = np.frombuffer(b"".join(raw), np.float64 if wide else np.float32).astype(np.float64).reshape(len(raw), -1)
    _, exponent = np.frexp(np.abs(x).max(axis=1))
    return np.ldexp(x, -exponent[:, None])


@functools.lru_cache(maxsize=8)
def _planes(dim: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, bits))


def _signed(classes: DataFrame, wide: bool, width: int, tables: int) -> DataFrame:
    """(node, label, dim, keys, sketch) of every class."""
    def run(batches):
        powers = 1 << np.arange(width, dtype=np.int64)
        for batch in batches:
            raw = batch.column(2).to_pylist()
            size = np.array([len(r) for r in raw], np.int64)
            for n in np.unique(size).tolist():
                at = np.flatnonzero(size == n)
                x = _floats([raw[i] for i in at], wide)
                signs = x @ _planes(x.shape[1], SKETCH + width * tables) > 0
                sketch = np.packbits(signs[:, :SKETCH], axis=1)
                keys = signs[:, SKETCH:].reshape(len(x), tables, width) @ powers
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), pa.array(np.full(len(x), x.shape[1], np.int32)),
                    pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * tables, keys.ravel().astype(np.int32)),
                    pa.array([s.tobytes() for s in sketch], pa.binary())], ["node", "label", "dim", "keys", "sketch"])

    return classes.select("node", "label", "vector").mapInArrow(
        run, "node long, label string, dim int, keys array<int>, sketch binary")


# Comparison within units ---------------------------------------------------------------------------

class Forest:
    """Labels of n places that fall to the smallest place each is linked with."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, x: np.ndarray, y: np.ndarray) -> None:
        label = self.label
        while True:
            apart = label[x] != label[y]
            x, y = x[apart], y[apart]
            if not len(x):
                return
            np.minimum.at(label, np.maximum(label[x], label[y]), np.minimum(label[x], label[y]))
            while not np.array_equal(up := label[label], label):
                label[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        child = np.flatnonzero(self.label != np.arange(len(self.label)))
        return child, self.label[child]


def _tiled(rows: DataFrame, unit: list[str], tile: int, compare, schema: str) -> DataFrame:
    """``compare`` over all pairs of rows that share a unit.

    Units of up to ``tile`` rows come whole, many small ones together; larger ones are cut by a hash of the
    node, and each pair of cuts is a group of its own. Units of one row have no pairs.
    """
    sizes = materialize(rows.groupBy(*unit).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                        .withColumn("cuts", F.ceil(F.col("n") / tile).cast("int")), "embedding_units")
    small = sizes.filter("cuts = 1").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bundles = buckets_for(small, _BUNDLE)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in unit]
    placed = (rows.alias("l").join(sizes.alias("r"), same).select("l.*", "cuts")
              .withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))))
    hashed = F.xxhash64(*unit)
    group: Column = F.when(F.col("cuts") == 1, F.pmod(hashed, F.lit(bundles))).otherwise(hashed)
    return (placed.select("*", group.alias("bundle"), F.least("cut", "other").alias("lo"), F.greatest("cut", "other").alias("hi"))
            .drop("cuts", "other").groupBy("bundle", "lo", "hi").applyInArrow(_by_unit(unit, compare), schema))


def _by_unit(unit: list[str], compare):
    """A function of a group's table that yields what ``compare(rows, x, y)`` gives for each unit:
    rows of the unit, and the places to be compared, x with y (y None: x with itself)."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        lo, hi = key[1].as_py(), key[2].as_py()
        table = table.sort_by([(c, "ascending") for c in (*unit, "node")])
        n = table.num_rows
        new = np.zeros(n, bool)
        new[:1] = True
        for c in unit:
            column = table.column(c).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            new[1:] |= column[1:] != column[:-1]
        at = np.append(np.flatnonzero(new), n)
        cut = table.column("cut").to_numpy()
        parts = []
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            some = table.slice(i, j - i)
            x = np.arange(j - i) if lo == hi else np.flatnonzero(cut[i:j] == lo)
            parts += compare(some, x, None if lo == hi else np.flatnonzero(cut[i:j] == hi))
        a, b, links = (np.concatenate([np.empty(0, np.int64), *c]) for c in (zip(*parts) if parts else ((), (), ())))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(links, pa.int64())})

    return run


def _blocks(x: np.ndarray, y: np.ndarray | None, rows: int = 512):
    """Pairs of places block by block: (left places, right places, mask of pairs to leave out or None)."""
    for i in range(0, len(x), rows):
        left = x[i:i + rows]
        right = x[i:] if y is None else y
        yield left, right, (np.arange(len(left))[:, None] >= np.arange(len(right))[None, :]) if y is None else None


def _near_sketches(limit: int):
    def compare(rows: pa.Table, x: np.ndarray, y: np.ndarray | None):
        words = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint64).reshape(rows.num_rows, -1)
        node, forest = rows.column("node").to_numpy(), Forest(rows.num_rows)
        for left, right, out in _blocks(x, y, 64):
            bits = np.zeros((len(left), len(right)), np.uint16)
            for w in range(words.shape[1]):
                bits += np.bitwise_count(words[left, None, w] ^ words[None, right, w])
            near = bits <= limit
            if out is not None:
                near &= ~out
            p, q = np.nonzero(near)
            forest.link(left[p], right[q])
        child, root = forest.edges()
        yield node[child], node[root], np.zeros(len(child), np.int64)

    return compare


def exact_cosine(x: np.ndarray, y: np.ndarray) -> float:
    """The cosine of two vectors of doubles from exact sums of their products."""
    norms = math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))
    return math.fsum(x * y) / norms


def _linked(threshold: float, wide: bool):
    def compare(rows: pa.Table, x: np.ndarray, y: np.ndarray | None):
        vectors = _floats(rows.column("vector").to_pylist(), wide)
        norm = np.sqrt((vectors * vectors).sum(axis=1))
        node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
        table = rows.column("table")[0].as_py()
        keys = None if table < 0 else np.stack([np.asarray(k.values) for k in rows.column("keys").combine_chunks()])
        links, forest = np.zeros(rows.num_rows, np.int64), Forest(rows.num_rows)
        for left, right, out in _blocks(x, y):
            cosine = (vectors[left] @ vectors[right].T) / (norm[left][:, None] * norm[right][None, :])
            near = cosine >= threshold - _CLOSE
            if out is not None:
                near &= ~out
            p, q = np.nonzero(near)
            for k in np.flatnonzero(cosine[p, q] < threshold + _CLOSE).tolist():
                if exact_cosine(vectors[left[p[k]]], vectors[right[q[k]]]) < threshold:
                    near[p[k], q[k]] = False
            p, q = np.nonzero(near)
            p, q = left[p], right[q]
            if table > 0:  # a pair counts in the first table that it shares
                fresh = np.ones(len(p), bool)
                for k in range(0, len(p), 1 << 16):
                    a, b = p[k:k + (1 << 16)], q[k:k + (1 << 16)]
                    fresh[k:k + (1 << 16)] = (keys[a, :table] != keys[b, :table]).all(axis=1)
                p, q = p[fresh], q[fresh]
            np.add.at(links, p, copies[q])
            np.add.at(links, q, copies[p])
            forest.link(p, q)
        some = np.flatnonzero(links)
        child, root = forest.edges()
        yield node[some], np.full(len(some), -1, np.int64), links[some]
        yield node[child], node[root], np.zeros(len(child), np.int64)

    return compare


# Operator ------------------------------------------------------------------------------------------

_EDGES = "a long, b long, n long"


def links(classes: DataFrame, threshold: float, wide: bool, recall: float = 0.995, tile: int = 2048) -> DataFrame:
    """(a, b, n) over classes (node, label, vector, copies): rows with b = -1 give a count n of vectors linked to
    the class a, to be added up; the others are links that join exactly what links join."""
    largest = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    width, tables = plan(largest, threshold, recall)
    signed = materialize(_signed(classes, wide, width, tables), "embedding_signs")
    spread = signed.select("node", "label", "dim", "sketch", F.posexplode("keys").alias("table", "key"))
    near = _tiled(spread, ["label", "dim", "table", "key"], 4 * tile, _near_sketches(radius(threshold)), _EDGES)
    groups = components(near.select("a", "b")).withColumnRenamed("component", "candidates")
    members = materialize(groups.join(signed.select("node", "keys"), "node")
                          .join(classes.select("node", "vector", "copies"), "node"), "embedding_members")
    # A group is compared as a whole unless its buckets hold fewer pairs.
    held = (members.select("candidates", F.posexplode("keys").alias("table", "key"))
            .groupBy("candidates", "table", "key").agg(F.count(F.lit(1)).cast("double").alias("n"))
            .groupBy("candidates").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")))
    whole = (members.groupBy("candidates").agg(F.count(F.lit(1)).cast("double").alias("n")).join(held, "candidates")
             .select("candidates", ((F.col("n") <= tile) | (F.col("n") * F.col("n") <= F.col("pairs"))).alias("whole")))
    parted = members.join(whole, "candidates")
    at_once = parted.filter("whole").select("node", "candidates", "vector", "copies", "keys",
                                            F.lit(-1).alias("table"), F.lit(0).alias("key"))
    by_bucket = parted.filter(~F.col("whole")).select("node", "candidates", "vector", "copies", "keys",
                                                      F.posexplode("keys").alias("table", "key"))
    return _tiled(at_once.union(by_bucket), ["candidates", "table", "key"], tile, _linked(threshold, wide), _EDGES)


def label(rows: DataFrame, threshold: float = 0.93, recall: float = 0.995, tile: int = 2048) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``rows`` (vec_id, embedding, label).

    Vectors of equal labels and lengths are linked at cosine ``threshold`` or more. n_links counts the other
    rows linked directly, copies each; component_id is the smallest vec_id reachable, itself included; kept
    says whether it is the row's own. Rows whose label is NULL, or whose vector is NULL, empty, zero or holds
    a NULL or non-finite component, link with nothing. NULL ids count only where no id is reachable;
    component_id is then NULL. Repeated rows are vectors of their own and each get a row; other columns
    are not looked at; an empty table gives an empty result.
    """
    wide = "float" not in rows.select("embedding").dtypes[0][1]
    vector = F.col("embedding").cast("array<double>" if wide else "array<float>")
    packed = materialize(
        rows.select("vec_id", F.col("label").cast("string").alias("label"), _packed(vector).alias("vector"))
        .withColumn("class", F.when(F.col("label").isNotNull() & F.col("vector").isNotNull(),
                                    F.sha2(F.concat(F.encode("label", "UTF-8"), F.lit(b"\0"), "vector"), 256))),
        "embedding_rows")
    classes = materialize(
        packed.filter("class is not null").groupBy("label", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"), F.first("class").alias("class"))
        .withColumn("node", F.monotonically_increasing_id()), "embedding_classes")
    found = materialize(links(classes, threshold, wide, recall, tile), "embedding_links")
    counts = found.filter("b = -1").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    joined = components(found.filter("b <> -1").select("a", "b"))
    named = materialize(
        classes.select("node", "class", "copies", "low").join(counts, "node", "left").join(joined, "node", "left")
        .select("class", "low", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("root")), "embedding_named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(named.join(lowest, "root").select("class", "n_links", "component_id"), "embedding_names")
    alone = packed.filter("class is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = (packed.filter("class is not null").select("vec_id", "class").join(named, "class")
           .select("vec_id", "n_links", "component_id").union(alone))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def dedup(rows: DataFrame, **options) -> DataFrame:
    """The rows of ``rows`` that ``label`` keeps, with all their columns; an id that several rows hold keeps them all."""
    kept = label(rows, **options).filter("kept").select(F.col("vec_id").alias("kept_id")).distinct()
    return rows.join(kept, rows["vec_id"].eqNullSafe(F.col("kept_id")), "left_semi")
