"""Snapshots compared and put in order: differences of two, and validity intervals over many.

Both compare attributes NULL-safely and whole, so no change is lost to a hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"o.`{k}`").eqNullSafe(F.col(f"n.`{k}`"))
    return cond


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], attrs: Sequence[str] | None = None) -> DataFrame:
    """Rows that lead from ``old`` to ``new``: (op, keys, attrs), op one of insert, update and delete.

    Each side holds a key once; NULL is a key like any other. Inserted and updated rows carry the new attributes,
    deleted ones the old. One full outer hash join on the keys: each side is shuffled once, and unchanged rows end
    there. ``attrs`` defaults to all other columns of ``new``.
    """
    attrs = list(attrs or [c for c in new.columns if c not in keys])
    side = lambda df, name: df.select(*keys, F.struct(*attrs).alias(name), F.lit(True).alias(f"in_{name}"))
    o, n = side(old, "before").alias("o"), side(new, "after").alias("n")
    joined = o.join(n, _same(o, n, keys), "full_outer")
    op = (F.when(F.col("in_before").isNull(), INSERT).when(F.col("in_after").isNull(), DELETE)
          .when(~F.col("before").eqNullSafe(F.col("after")), UPDATE))
    there = F.when(F.col("in_after"), F.col("after")).otherwise(F.col("before"))
    key = [F.when(F.col("in_after"), F.col(f"n.`{k}`")).otherwise(F.col(f"o.`{k}`")).alias(k) for k in keys]
    return joined.select(op.alias("op"), *key, there.alias("_a")).filter(F.col("op").isNotNull()).select("op", *keys, "_a.*")


def apply_diff(old: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with a difference applied: the new snapshot."""
    attrs = [c for c in diff.columns if c not in keys and c != "op"]
    d = diff.select(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & old[k].eqNullSafe(d[f"_{i}"])
    kept = old.select(*keys, *attrs).join(d, cond, "left_anti")
    return kept.unionByName(diff.filter(F.col("op") != DELETE).select(*keys, *attrs))


def validity(snapshots: DataFrame, keys: Sequence[str], at: str, attrs: Sequence[str] | None = None) -> DataFrame:
    """(keys, attrs, valid_from, valid_to): how long each key had which attributes, by gaps and islands.

    ``snapshots`` holds every record of every snapshot, ``at`` naming its time; a key once a snapshot. A record
    that is missing from a snapshot ends there and begins anew when it comes back. ``valid_to`` is the first
    snapshot in which the row no longer holds, NULL while it holds in the newest. Intervals of a key do not overlap.

    The snapshots' times are few (one a landing), so they are numbered on their own and joined. Rows that hold
    what they held in the snapshot before go as soon as they are seen, so only the edges of the islands are
    carried on; a key's rows are bounded by the number of snapshots.
    """
    attrs = list(attrs or [c for c in snapshots.columns if c not in keys and c != at])
    times = snapshots.select(F.col(at).alias("_at")).distinct()
    numbered = times.select("_at", F.row_number().over(W.orderBy("_at")).alias("_no"),
                            F.lead("_at").over(W.orderBy("_at")).alias("_next"))
    rows = (snapshots.select(*keys, F.struct(*attrs).alias("_a"), F.col(at).alias("_at"))
            .join(numbered, "_at"))
    along = W.partitionBy(*keys).orderBy("_no")
    before, behind = F.lag(F.struct("_no", "_a")).over(along), F.lead(F.struct("_no", "_a")).over(along)
    goes_on = lambda near, step: F.coalesce(
        (near["_no"] == F.col("_no") + step) & near["_a"].eqNullSafe(F.col("_a")), F.lit(False))
    edges = rows.select(*keys, "_no", "_at", "_next", "_a", (~goes_on(before, -1)).alias("_first"),
                        (~goes_on(behind, 1)).alias("_last")).filter("_first or _last")
    # Every first edge is followed by its island's last edge, or is that itself.
    ends = F.when(F.col("_last"), F.col("_next")).otherwise(F.lead("_next").over(along))
    out = edges.select(*keys, "_a", F.col("_at").alias("valid_from"), ends.alias("valid_to"), "_first")
    return out.filter("_first").select(*keys, "_a.*", "valid_from", "valid_to")
