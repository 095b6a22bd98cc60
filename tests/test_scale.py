"""What must not grow faster than the input: partitions, sorts of wide rows, Python objects, bytes shuffled."""

import os

import pyarrow as pa
from pyspark.sql import functions as F

from docmart.functions import arrow, dom, matcher
from docmart.operators import html_rel, html_tree, star
from docmart.plans import medallion, procedures, queries
from docmart.session import spread
from docmart.sources import landing


def _geo(spark, folder):
    """A table of pages and two small dimensions, as files."""
    spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 5).alias("n")).write.parquet(f"{folder}/pages")
    for name in ("n", "r"):
        spark.range(5).select(F.col("id").alias(name), F.concat(F.lit(name), F.col("id")).alias(f"{name}_name"),
                              F.repeat(F.lit("x"), 3000).alias(f"{name}_pad")).coalesce(1).write.parquet(f"{folder}/{name}")
    read = lambda x: spark.read.parquet(f"{folder}/{x}")
    joined = read("pages").join(read("n"), "n", "left").join(read("r"), F.col("n") == F.col("r"), "left")
    return joined.select("k", F.concat(F.lit("<h2>A</h2><p>"), "n_name", "r_name", F.substring("n_pad", 1, 1), F.substring("r_pad", 1, 1),
                                       F.lit("</p>")).alias("html"))


def test_a_join_with_small_tables_takes_no_more_partitions(spark, tmp_path):
    """the planner's size of a join without statistics is the product of its sides."""
    docs = _geo(spark, str(tmp_path))
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > html_rel.HTML_PER_TASK * least
    assert html_rel._partitions(docs) == least
    sections = html_rel.heading_sections(html_rel.elements(html_rel.html_tokens(docs, "k", "html"), "k"), "k")
    assert sections.count() == 600
    assert html_tree._spread(docs).rdd.getNumPartitions() == least


def test_records_are_rendered_by_many_tasks_and_not_sorted(spark, tmp_path):
    """a source in one file is dealt out before its rows become wide; the newest versions are found
    without a sort of them."""
    spark.range(50).select(F.col("id").alias("c_custkey"), (F.col("id") % 3).cast("int").alias("c_nationkey"), F.lit(1.5).alias("c_acctbal"),
                           F.lit("A").alias("c_mktsegment")).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    rows = procedures.customer_records(spark, str(tmp_path)).withColumn("changed", F.lit("1"))
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and rows.count() == 50
    root = str(tmp_path / "raw")
    landing.land_json(rows, root, "2024-01-01 00:00:00")
    landing.land_json(rows.filter("false"), root, "2024-01-02 00:00:00")
    landing.land_json(rows.filter("false"), root, "2025-01-02 00:00:00")
    assert os.listdir(f"{root}/year=2024/month=01") == ["day=01"] and not os.path.exists(f"{root}/year=2025")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    newest = star.latest_rows(medallion.read_raw(spark, root).withColumn("row", F.monotonically_increasing_id()), ["id"], ["created"], "row")
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and newest.count() == 50
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_spread_keeps_null_and_repeated_keys_apart(spark):
    rows = spark.range(1000).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    dealt = spread(rows).groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) == int(spark.conf.get("spark.sql.shuffle.partitions")) and sum(r["count"] for r in dealt) == 1000


def test_few_documents_are_python_objects_at_once():
    """a batch of any length is worked off in slices of bounded rows and bytes."""
    seen = []

    def fn(a):
        seen.append(len(a))
        return arrow.fold_values(a)

    texts = pa.array([f"Á {i}" if i % 3 else None for i in range(5000)])
    assert arrow.in_slices(texts, fn).equals(arrow.fold_values(texts)) and max(seen) <= arrow.SLICE_ROWS
    seen.clear()
    long = pa.array(["x" * (1 << 20)] * 20)
    assert arrow.in_slices(long, fn).equals(long) and max(seen) * (1 << 20) <= arrow.SLICE_BYTES
    assert arrow.in_slices(pa.array([], pa.string()), fn).equals(pa.array([], pa.string()))


def test_slices_give_the_same_trees_and_labels(monkeypatch):
    pages = pa.array([None if i % 7 == 0 else f"<ul><li>visa {i}<li><a href=/{i}>x</a></ul>" for i in range(1500)])
    calls = []
    parse, fold = dom.parse, matcher.fold_values
    monkeypatch.setattr(matcher, "fold_values", lambda a: calls.append(len(a)) or fold(a))
    assert dom.tree.func(pages).to_pylist() == dom._trees(pages).to_pylist()
    found = matcher._find_udf([("Visa", "visa")]).func(pages).to_pylist()
    assert max(calls) <= arrow.SLICE_ROWS and len(found) == 1500
    assert [bool(x["hits"]) for x in found] == [i % 7 != 0 for i in range(1500)] and parse is dom.parse


def test_the_search_text_is_made_once(spark, tmp_path):
    """the whole record as JSON is read by several expressions and written by one."""
    base = str(tmp_path)
    spark.range(5).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
                          F.lit(2.0).alias("o_totalprice"), F.lit("2024-01-01").cast("date").alias("o_orderdate"),
                          F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{base}/orders.parquet")
    landing.land_json(queries.order_records(spark, base), f"{base}/raw", "2024-01-01 00:00:00")
    found = medallion.staging_of(medallion.read_raw(spark, f"{base}/raw"))["tramites_base"]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("structstojson") == 1
    assert [r["NIVEL_MIBA"] for r in found.collect()] == [2] * 5


def test_bridge_keys_travel_packed(spark):
    """F8: hex keys cross the exchanges as bytes and the test of the two sides sorts nothing; any other key stays as it is."""
    md5 = lambda c: F.md5(c.cast("string"))
    rows = spark.range(40).select((F.col("id") % 7).alias("g"), F.when(F.col("id") % 2 == 0, md5(F.col("id"))).alias("l"),
                                  F.when(F.col("id") % 3 == 0, F.when(F.col("id") > 20, F.upper(md5(F.col("id")))).otherwise(F.lit("d"))).alias("r"))
    one = star.build_bridge_from(rows, ["g"], F.col("l"), F.col("r"))
    two = star.build_bridge(rows.filter("l is not null"), rows.filter("r is not null"), ["g"], "l", "r")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) and one.schema["MEMBER_KEY"].dataType.simpleString() == "string"
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "unhex" in plan
    numbers = star.build_bridge_from(rows.select("g", F.col("g").alias("n")), ["g"], F.col("n"), F.col("n"))
    assert numbers.schema["MEMBER_KEY"].dataType.simpleString() == "bigint" and numbers.count() == 14
