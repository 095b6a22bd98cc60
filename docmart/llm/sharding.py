"""Sharding to near-equal bytes by histogram sort.

Rows are ordered by a 128-bit key: the hash of the whole text, then 40 bits of a hash of the document
id and 24 bits of a hash of the row's place in the written key table, so that repeated rows are told apart.
Splitters between shards are found by refinement: each round counts the exact bytes below a
few candidate boundaries per splitter in one aggregate over all partitions (one row per
candidate interval reaches the driver, at most ``probes * (shards - 1) + 1``), and narrows the
splitter's interval to the two candidates around its target. Rounds end when every splitter
is within the tolerance or only one row is left between its bounds. Rows then move once.

Equal texts have equal upper keys, and candidates fall between texts first, so a group of
copies stays in one shard; a group larger than the tolerance allows is cut inside, by id.

Only DataFrame functions; key tables are narrow and texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docmart.llm.common import buckets_for, materialize

_HALF = 1 << 63
_WORD = 1 << 64
_SPACE = 1 << 128
_PLACES = 1 << 24


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the key (k1, k2), written as a narrow table."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return materialize(docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("k1"),
        # Rows that repeat text and id are told apart by their place, so that they can be split too.
        F.xxhash64("doc_id").bitwiseAND(F.lit(-_PLACES))
        .bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(F.lit(_PLACES - 1))).alias("k2"),
    ), "shard_keys")


def _at_least(bound: int) -> Column:
    """Whether the row's key is at or above ``bound`` (0 to 2**128)."""
    if bound >= _SPACE:
        return F.lit(False)
    hi, lo = divmod(bound, _WORD)
    k1, k2 = F.lit(hi - _HALF), F.lit(lo - _HALF)
    if lo == 0:
        return F.col("k1") >= k1
    return (F.col("k1") > k1) | ((F.col("k1") == k1) & (F.col("k2") >= k2))


def _candidates(lo: int, hi: int, probes: int) -> list[int]:
    """Keys strictly between lo and hi, evenly spaced, between two texts where possible."""
    unit = _WORD if hi - lo > _WORD else 1
    a, b = lo // unit, hi // unit
    at = {(a + (b - a) * i // (probes + 1)) * unit for i in range(1, probes + 1)} | {(a + 1) * unit}
    return sorted(x for x in at if lo < x < hi)


def _below(keys: DataFrame, bounds: list[int]) -> dict[int, tuple[int, int]]:
    """Exact (bytes, rows) below each bound, and under ``None`` in all: one aggregate."""
    place = F.lit(0)
    for b in bounds:
        place = place + _at_least(b).cast("int")
    rows = keys.groupBy(place.alias("place")).agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()
    per = {r["place"]: (r["size"], r["n"]) for r in rows}
    out, size, n = {}, 0, 0
    for i in range(len(bounds) + 1):
        s, c = per.get(i, (0, 0))
        size, n = size + s, n + c
        out[bounds[i] if i < len(bounds) else None] = (size, n)
    return out


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.005,
              probes: int = 15) -> tuple[list[int], int]:
    """The ``shards - 1`` boundaries, and the number of rows.

    ``tolerance`` is the allowed distance of a boundary from its target, as a share of an
    even shard.
    """
    known = {0: (0, 0)}
    first = [_SPACE * i // (probes + 1) // _WORD * _WORD for i in range(1, probes + 1)]
    counted = _below(keys, first)
    total, rows = counted.pop(None)
    known |= counted | {_SPACE: (total, rows)}
    targets = [total * i / shards for i in range(1, shards)]
    found: list[int | None] = [None] * len(targets)
    allowed = tolerance * total / shards
    while True:
        ask: set[int] = set()
        order = sorted(known)
        for i, t in enumerate(targets):
            if found[i] is not None:
                continue
            lo = max(b for b in order if known[b][0] <= t)
            above = [b for b in order if b > lo]
            hi = above[0] if above else lo
            near = min((lo, hi), key=lambda b: (abs(known[b][0] - t), b))
            between = _candidates(lo, hi, probes)
            if abs(known[near][0] - t) <= allowed or known[hi][1] - known[lo][1] <= 1 or not between:
                found[i] = near
            else:
                ask |= set(between)
        if not ask:
            return sorted(found), rows
        counted = _below(keys, sorted(ask))
        counted.pop(None)
        known |= counted


def shard(docs: DataFrame, shards: int = 8, tolerance: float = 0.005, probes: int = 15,
          rows_per_task: int = 4096) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per document.

    Law ``bytes``: shard sizes are near equal. Slots count from 0 without gaps in each shard;
    a shard is numbered in parallel pieces of about ``rows_per_task`` rows, whose sizes are
    added up first. NULL texts count as empty (size 1, CRC 0); repeated rows each get a slot;
    an empty table gives an empty result.
    """
    keys = keyed(docs.select("doc_id", "text"))
    bounds, rows = splitters(keys, shards, tolerance, probes)
    pieces = buckets_for(rows, rows_per_task * shards)
    place = F.lit(0)
    for b in bounds:
        place = place + _at_least(b).cast("int")
    placed = keys.select("*", place.alias("shard"),
                         F.pmod(F.xxhash64("k1", "k2"), F.lit(pieces)).alias("piece"))
    counts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("shard").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("shard", "piece",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = W.partitionBy("shard", "piece").orderBy("k1", "k2", "doc_id")
    return (placed.join(offsets, ["shard", "piece"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                    F.col("shard").cast("int").alias("shard"),
                    (F.col("offset") + F.row_number().over(inside) - 1).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
