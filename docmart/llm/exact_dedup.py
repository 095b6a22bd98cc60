"""Exact deduplication by a tree merge of sorted digest runs.

Every input partition writes a run: its documents' digests in digest order, one narrow row
each. Runs are merged along a binomial tree with fan-in ``2 ** bits``: in round r all runs
whose partition numbers agree above the lowest ``r * bits`` bits exchange their rows by
(tree node, digest) and are merged by a sort aggregate. At every level a digest keeps its
smallest row and its row count, so a group of copies shrinks at each level, never gathers in
one task, and only one row per digest and node moves on. A node's merged run is itself spread
over many tasks by digest.

"Verified": rows meet only if the 256-bit digest, the length and a second, independent 64-bit
hash of the whole normalised text all agree.

Only DataFrame functions; texts are never shuffled to find the groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import keep_rows, materialize, row_hash, spaced

KEY = ["digest", "n_bytes", "check64"]


def digest_runs(docs: DataFrame) -> DataFrame:
    """One row per document, written as one sorted run per input partition.

    ``rank`` orders the rows that may stay: smallest doc_id first, NULL ids last, then the hash
    of the whole row and the row number, so that one row of a set of repeated rows is chosen.
    """
    norm = spaced(F.col("text"))
    base = docs.select(
        F.col("doc_id"),
        norm.alias("norm"),
        row_hash(docs).alias("row_hash"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    runs = base.select(
        "doc_id", "run", "row_no", "row_hash",
        F.unhex(F.sha2("norm", 256)).alias("digest"),
        F.octet_length("norm").alias("n_bytes"),
        F.xxhash64("norm").alias("check64"),
        F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"),
                 F.col("row_hash").alias("row_hash"), F.col("row_no").alias("row_no")).alias("rank"),
    )
    return materialize(runs.sortWithinPartitions("digest"), "digest_runs")


def tree_merge(runs: DataFrame, bits: int = 4) -> DataFrame:
    """One row per distinct text: the key, the smallest ``rank`` and the number of rows.

    The number of rounds follows from the number of runs (one small aggregate); the plan has
    one exchange a round.
    """
    top = runs.agg(F.max("run")).first()[0]
    merged = runs.select(F.col("run").alias("node"), *KEY, "rank", F.lit(1).cast("long").alias("n"))
    level = top or 0
    while True:
        merged = (merged.withColumn("node", F.shiftright("node", bits))
                  .groupBy("node", *KEY)
                  .agg(F.min("rank").alias("rank"), F.sum("n").alias("n")))
        level >>= bits
        if level == 0:
            return materialize(merged.drop("node"), "digest_groups")


def label(docs: DataFrame, bits: int = 4) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document, dropped ones too.

    Rows: NULL text counts as empty; blank texts form their own groups. Of repeated rows with
    equal doc_id and text exactly one is kept. NULL ids lose against any id. Empty tables give
    an empty result.
    """
    runs = digest_runs(docs.select("doc_id", "text"))
    groups = tree_merge(runs, bits)
    return runs.join(groups.withColumnRenamed("rank", "keep"), KEY).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row_no") == F.col("keep.row_no")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def dedup(docs: DataFrame, bits: int = 4) -> DataFrame:
    """The documents that stay, with the input's columns (any extra columns included)."""
    runs = digest_runs(docs)
    groups = tree_merge(runs, bits)
    keep = groups.select(F.col("rank.doc_id").alias("keep_id"), F.col("rank.row_hash").alias("keep_hash"))
    return keep_rows(docs, runs, keep)
