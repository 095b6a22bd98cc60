"""Shared pieces of the operators: the word alphabet, table readers, scratch tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.session import materialize

__all__ = ["SPACE", "WORD", "SPACE_CHARS", "read", "words", "word_count", "spaced",
           "materialize", "pack_doc", "unpack_doc", "row_hash", "keep_rows", "buckets_for"]

# A word is a run of characters other than the six ASCII spaces.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def spaced(text: Column) -> Column:
    """``text`` with every run of spaces replaced by one space; NULL counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def words(text: Column) -> Column:
    """Words of ``text`` in order; NULL and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, as long; NULL counts as empty.

    One pass of the regular expression: a trimmed non-empty text has one word more than
    it has runs of spaces.
    """
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, SPACE))).cast("long")


def pack_doc(docs: DataFrame, name: str = "doc") -> Column:
    """All columns of a document in one struct, so that operator columns cannot clash."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(name)


def unpack_doc(df: DataFrame, name: str = "doc") -> DataFrame:
    return df.select(f"{name}.*")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row (those that hold maps as JSON)."""
    return F.xxhash64(*[F.to_json(docs[f"`{c}`"]) if "map<" in kind else docs[f"`{c}`"] for c, kind in docs.dtypes])


def keep_rows(docs: DataFrame, rows: DataFrame, keep: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``keep`` names, one for each (keep_id, keep_hash).

    ``rows`` is the narrow table (doc_id, row_hash) of all documents. The documents are read again
    and shuffled once; no copy of them is written. Only if the table holds a row twice is one of
    its copies picked.
    """
    packed = docs.select(pack_doc(docs), docs["doc_id"].alias("doc_id"), row_hash(docs).alias("row_hash"))
    named = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("row_hash") == F.col("keep_hash"))
    kept = packed.join(keep, named, "left_semi")
    if not rows.groupBy("doc_id", "row_hash").count().filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "row_hash"])
    return unpack_doc(kept)


def buckets_for(rows: int, per_bucket: int) -> int:
    """How many buckets keep each at about ``per_bucket`` rows (grows with the data)."""
    return max(1, math.ceil(rows / per_bucket))
