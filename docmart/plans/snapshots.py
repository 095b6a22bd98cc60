"""Queries over snapshots: differences, history, quarantine, arrays in one file, versions of several tables.

Each renders its input row by row from the given tables and lands it in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart.operators import history
from docmart.plans.queries import RUN_TS, query, table
from docmart.session import shared_dir
from docmart.sources import json_array, quarantine, versions

#: A bucket of this many customers is one JSON array.
ARRAY_ROWS = 500


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")


def _order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two snapshots: the second lacks some orders, has some more, and changes attributes to and from NULL."""
    o = _orders(spark, sf_dir)
    key = F.col("o_orderkey")
    old = o.filter(key % 7 != 0).withColumn("o_totalprice", F.when(key % 5 != 0, F.col("o_totalprice")))
    new = o.filter(key % 11 != 0).withColumn("o_orderpriority", F.when(key % 13 != 0, F.col("o_orderpriority")))
    return old, new


@query
def snapshot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the inserts, updates and deletes between two snapshots of the orders."""
    return history.snapshot_diff(*_order_snapshots(spark, sf_dir), ["o_orderkey"])


@query
def snapshot_difference_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the first snapshot with its difference applied, which is the second."""
    old, new = _order_snapshots(spark, sf_dir)
    return history.apply_diff(old, history.snapshot_diff(old, new, ["o_orderkey"]), ["o_orderkey"])


HISTORY_DAYS = 4


@query
def record_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 + M1: customers over four daily snapshots as validity intervals. By customer, nothing changes, an attribute
    changes and changes back, or the record is missing from a snapshot."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    days = c.select("*", F.explode(F.sequence(F.lit(1), F.lit(HISTORY_DAYS))).alias("day"))
    kind = F.col("c_custkey") % 4
    seen = days.filter(~((kind == 1) & (F.col("day") == 3)) & ~((kind == 3) & (F.col("day") > 2)))
    seen = seen.withColumn("segment", F.when((kind == 2) & F.col("day").isin(2, 3), F.lit(None)).otherwise(F.col("c_mktsegment")))
    return history.validity(seen.select("c_custkey", "segment", "day"), ["c_custkey"], "day")


_LINES = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("fields", T.StructType([
        T.StructField("price", T.StringType()), T.StructField("tags", T.ArrayType(T.StructType([T.StructField("name", T.StringType())])))]))])


@query
def quarantined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON lines, one in ten cut off, one in ten with an object where an array is due, one in ten with a list
    where an object is due; every record comes back, good or with its reason."""
    o = _orders(spark, sf_dir)
    tags = F.array(F.struct(F.col("o_orderpriority").alias("name")))
    good = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("id"),
                              F.struct(F.col("o_totalprice").cast("string").alias("price"), tags.alias("tags")).alias("fields")))
    turn = F.col("o_orderkey") % 10
    line = (F.when(turn == 0, F.expr("substr(line, 1, length(line) - 4)"))
            .when(turn == 1, F.regexp_replace("line", r"\[(.*)\]", "$1"))
            .when(turn == 2, F.regexp_replace("line", r'"tags":\[.*\]', '"tags":[[]]')).otherwise(F.col("line")))
    root = shared_dir(spark, "quarantine")
    o.select(good.alias("line"), "o_orderkey").select(line.alias("value")).write.text(root)
    kept, bad = quarantine.split(spark, root, _LINES)
    name = lambda c: F.regexp_extract(c, r'"id":"(\d+)"', 1)
    return kept.select("id", F.lit("good").alias("state"), F.col("fields.tags")[0]["name"].alias("detail")).unionByName(
        bad.select(name("raw").alias("id"), F.lit("quarantined").alias("state"), F.array_join("reasons", "; ").alias("detail")))


@query
def json_array_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in files of one JSON array each, on one line, with quotes, braces and backslashes in their texts,
    read in parallel."""
    c = table(spark, sf_dir, "customer")
    text = F.concat(F.lit('a "quoted" {brace} [list] \\ and ñ '), F.col("c_name"))
    record = F.to_json(F.struct(F.col("c_custkey").alias("id"), text.alias("note"),
                                F.array(F.struct(F.col("c_mktsegment").alias("s")), F.struct(F.lit("}").alias("s"))).alias("inner")))
    root = shared_dir(spark, "arrays")
    (c.select(F.floor(F.col("c_custkey") / ARRAY_ROWS).alias("part"), record.alias("r")).groupBy("part")
     .agg(F.concat(F.lit("["), F.array_join(F.collect_list("r"), ", "), F.lit("]")).alias("value"))
     .write.partitionBy("part").text(root))
    back = json_array.read_json_array(spark, root, T.StructType([
        T.StructField("id", T.LongType()), T.StructField("note", T.StringType()),
        T.StructField("inner", T.ArrayType(T.StructType([T.StructField("s", T.StringType())])))]))
    return back.select("id", "note", F.array_join(F.transform("inner", lambda x: x["s"]), ",").alias("inner"))


@query
def versioned_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 (S5-S7): nations and regions published as one version, then a publish that fails at its second table: readers
    still see the first version of both."""
    nation, region = (table(spark, sf_dir, n) for n in ("nation", "region"))
    root = shared_dir(spark, "versions")
    versions.publish_all(spark, {"nation": nation, "region": region}, root, RUN_TS)

    def refuse(name: str, df: DataFrame) -> None:
        if name == "region":
            raise ValueError("refused")

    try:
        versions.publish_all(spark, {"nation": nation.limit(0), "region": region}, root, RUN_TS, check=refuse)
    except ValueError:
        pass
    seen = versions.published(spark, root)
    return seen["nation"].join(seen["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "r_name", seen["nation"]["insert_into_dl_timestamp"])
