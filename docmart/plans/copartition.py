"""The main table over staging tables that are bucketed on the record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docmart.plans import medallion
from docmart.plans.queries import price_text, query, table, text_of
from docmart.session import shared_dir

BUCKETS = 16


def staging_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Customers as records, their orders as cost items, norms and steps; some customers have no orders, some items no concept,
    some orders neither norm nor channel."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    record = F.col("o_custkey").cast("string").alias("ID_TRAMITE")
    k = F.col("o_orderkey")
    base = c.select(
        F.col("c_custkey").cast("string").alias("CODIGO_TRAMITE"), F.col("c_name").alias("NOMBRE"),
        F.lit("1700000000").alias("created"), F.lit("no date").alias("changed"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("FINALIDAD"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey").cast("string")).alias("ID_DEPENDENCIA"),
        F.lit("1").alias("ID_TIPO_TRAMITE"), F.lit(None).cast("int").alias("NIVEL_MIBA"))
    return {
        "tramites_base": base,
        "costos": o.select(record, F.when(k % 5 != 0, F.col("o_orderpriority")).alias("CONCEPTO"),
                           F.when(k % 7 != 0, price_text(F.col("o_totalprice"))).alias("PRECIO_STR")),
        "marco_normativo": o.filter(k % 2 == 0).select(record, text_of("Ley {}", F.when(k % 6 == 0, "Tarifaria").otherwise("Orgánica"))
                                                       .alias("BODY_CLEAN")),
        "pasos": o.select(record, k.cast("int").alias("ORDEN_PASO"),
                          F.when(k % 3 == 0, text_of("https://turnos.example/{}", k.cast("string"))).alias("CANAL_TURNO"))}


def bucketed_main_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "bucketed")
    # Each run has a database of its own: a bucketed table is never replaced under a reader.
    staging = medallion.bucket_staging(spark, staging_tables(spark, sf_dir), root, "docmart_" + root.rsplit("-", 1)[1], BUCKETS)
    return medallion.main_table(*(staging[name] for name in medallion.MAIN_KEYS))


@query
def copartitioned_main_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main table from four bucketed staging tables, joined and aggregated without an exchange."""
    main = bucketed_main_table(spark, sf_dir)
    return main.select("CODIGO_TRAMITE", F.date_format("FECHA_ALTA_TRAMITE", "yyyy-MM-dd HH:mm:ss").alias("FECHA_ALTA_TRAMITE"),
                       F.col("FECHA_ULT_MODIFICACION_TRAMITE").isNull().alias("SIN_MODIFICACION"), "NOMBRE", "FINALIDAD", "ID_DEPENDENCIA",
                       F.array_join(F.transform("MONTO_COSTO", lambda x: x.cast("string")), "|").alias("MONTO_COSTO"),
                       F.array_join("CONCEPTO_PAGO", "|").alias("CONCEPTO_PAGO"), "REQUIERE_PAGO", "MARCO_NORMATIVO", "CANAL_TURNO")
