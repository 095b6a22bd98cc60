"""Bucketed staging tables: the main table plans without an exchange and equals that of unbucketed tables."""

import os

import pytest

from docmart.plans import copartition, medallion
from docmart.session import shared_dir
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_exchange_above_the_scans(spark, no_broadcast):
    plan = _plan(copartition.bucketed_main_table(spark, SF))
    assert plan.count("Bucketed: true") == 4 and "Exchange" not in plan and plan.count("SortMergeJoin") == 3
    plain = copartition.staging_tables(spark, SF)
    assert _plan(medallion.main_table(*(plain[name] for name in medallion.MAIN_KEYS))).count("Exchange") >= 4


def test_equal_to_unbucketed_tables(spark):
    plain = copartition.staging_tables(spark, SF)
    want = medallion.main_table(*(plain[name] for name in medallion.MAIN_KEYS))
    got = copartition.bucketed_main_table(spark, SF)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_null_and_hot_keys(spark):
    """A record with a third of all items, items without a record, a table without rows."""
    base = spark.range(30).select(F.col("id").cast("string").alias("CODIGO_TRAMITE"), F.lit("n").alias("NOMBRE"), F.lit("1").alias("created"),
                                  F.lit("2").alias("changed"), F.lit(None).cast("string").alias("FINALIDAD"),
                                  F.lit(None).cast("string").alias("ID_DEPENDENCIA"), F.lit("1").alias("ID_TIPO_TRAMITE"),
                                  F.lit(1).alias("NIVEL_MIBA")).unionByName(
        spark.range(2).select(F.lit(None).cast("string").alias("CODIGO_TRAMITE")), allowMissingColumns=True)
    key = F.when(F.col("id") % 3 == 0, "7").when(F.col("id") % 3 == 1, (F.col("id") % 30).cast("string"))
    costs = spark.range(900).select(key.alias("ID_TRAMITE"), F.lit("c").alias("CONCEPTO"), F.lit("$2.50").alias("PRECIO_STR"))
    norms = spark.createDataFrame([], "ID_TRAMITE string, BODY_CLEAN string")
    steps = spark.createDataFrame([("7", 2, "b"), ("7", 1, "a"), (None, 1, "x")], "ID_TRAMITE string, ORDEN_PASO int, CANAL_TURNO string")
    root = shared_dir(spark, "bucketed")
    out = medallion.bucket_staging(spark, {"tramites_base": base, "costos": costs, "marco_normativo": norms, "pasos": steps},
                                   root, "docmart_" + root.rsplit("-", 1)[1], 4)
    rows = medallion.main_table(*(out[name] for name in medallion.MAIN_KEYS)).collect()
    assert len(rows) == 32
    hot = [r for r in rows if r["CODIGO_TRAMITE"] == "7"][0]
    own = sum(1 for i in range(900) if i % 3 == 0 or (i % 3 == 1 and i % 30 == 7))
    assert len(hot["MONTO_COSTO"]) == own and hot["CANAL_TURNO"] == "a"
    assert all(r["MONTO_COSTO"] is None for r in rows if r["CODIGO_TRAMITE"] is None)
