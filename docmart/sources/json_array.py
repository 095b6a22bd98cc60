"""Files that hold one JSON array each, read in parallel.

The text source splits a file anywhere and hands out the stretches between two closing braces, so a file on one line
of any length is read by many tasks. Where records end is found by composing what each stretch does:

* an escape pair never spans a brace, so a stretch turns "inside a string" on or off by the parity of its quotes,
  whatever state it begins in; running sums of parities give every stretch's state;
* for either state a stretch has a depth change, counted outside its strings; running sums of those that apply give the depth,
  and a record ends at each brace that closes depth 2 of the file.

Running sums are taken within splits and then over the splits of a file, on narrow rows. Stretches of a record are put
together in one shuffle; a record is bounded by its own text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.session import materialize

BRACE = "}"


def _depth(parts: Column, parity: int) -> Column:
    """Depth change of the parts of a stretch (cut at its quotes) that lie outside strings."""
    outside = F.array_join(F.filter(parts, lambda _, i: i % 2 == parity), "")
    opened, closed = (F.length(F.regexp_replace(outside, x, "")) for x in (r"[^\[{]", r"[^\]]"))
    return opened - closed


def _running(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over all earlier stretches of the file: within splits, then over splits."""
    inside = W.partitionBy("file", "block").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("file", "block").agg(F.sum(value).alias("_sum"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    base = totals.select("file", "block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    return (rows.join(base, ["file", "block"])
            .withColumn(name, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_base"))


def records(spark: SparkSession, root: str) -> DataFrame:
    """(file, place, text) of every element of the arrays under ``root``; ``place`` counts a file's records from 0.
    Dated folders give their partition columns. An element that is no object is part of the text of the
    object behind it, which then does not begin with a brace."""
    lines = spark.read.option("lineSep", BRACE).text(root)
    dated = [c for c in lines.columns if c != "value"]
    parts = F.split(F.regexp_replace("value", r"\\[\s\S]", ""), '"')
    pieces = materialize(lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"), "value", (F.size(parts) - 1).alias("quotes"),
        _depth(parts, 0).alias("outside"), _depth(parts, 1).alias("inside"), *dated), "json_pieces")
    narrow = _running(pieces.select("file", "block", "seq", "quotes", "outside", "inside"), "quotes", "before")
    begins_inside = F.col("before") % 2 == 1
    closes = (F.col("before") + F.col("quotes")) % 2 == 0  # the brace behind the stretch is outside strings
    narrow = narrow.select("file", "block", "seq", closes.alias("closes"),
                           (F.when(begins_inside, F.col("inside")).otherwise(F.col("outside")) - closes.cast("int")).alias("step"))
    narrow = _running(narrow, "step", "depth")
    ends = (F.col("closes") & (F.col("depth") + F.col("step") == 1)).cast("int")
    placed = _running(narrow.select("file", "block", "seq", ends.alias("ends")), "ends", "place")
    # What is left of a file behind its last record is no record.
    whole = pieces.join(placed.select("file", "block", "seq", "place", "ends"), ["file", "block", "seq"])
    return (whole.groupBy("file", "place", *dated)
            .agg(F.max("ends").alias("ended"), F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"))
            .filter("ended = 1")
            .select("file", "place", F.concat(F.array_join(F.transform("parts", lambda p: p["value"]), BRACE), F.lit(BRACE)).alias("text"), *dated)
            .withColumn("text", F.regexp_replace("text", r"^[\s,\[\uFEFF]+", "")))


def read_json_array(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The records of files that hold one JSON array each, parsed with ``schema``, and the folders' dates; as
    ``multiLine`` reads them, but with many tasks a file."""
    found = records(spark, root)
    dated = [c for c in found.columns if c not in ("file", "place", "text")]
    return found.select(F.from_json("text", schema).alias("r"), *dated).select("r.*", *dated)
