"""The two jobs over what is new only.

A file stream hands each batch of newly landed records to ``foreachBatch``. Per batch:

1. the batch's newest version of each record is compared with the ``records`` table, which holds the newest version of
   every record; only records that are new or newer go on (a batch that is delivered again changes nothing);
2. they replace their rows in ``records``, and only they are mined; the result replaces their rows in the staging
   tables.

All these tables are partitioned by a hash of the record (``bucket``) and overwritten dynamically, so buckets without a
changed record are neither read for writing nor rewritten. The consume tables are derived from the staging tables as
they stand, without mining anything again. A batch is replay-safe: its changed records are written under its
number first, so a batch that fails half-way is done again with the same records, and one that is finished is passed over.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docmart import schema
from docmart.operators import star
from docmart.plans import medallion
from docmart.session import materialize, scratch
from docmart.sources import landing
from docmart.streaming.incremental import MAX_FILE_AGE

ORDER = ["snapshot", "landed", "_changed", "_hash"]
KEY = {"tramites_base": "CODIGO_TRAMITE", "tipo_tramite": "ID_TIPO_TRAMITE"}


def bucket(key: Column, buckets: int, batch_id: int) -> Column:
    """The record's bucket. Records without an id are never replaced: each batch has a bucket of its own for them."""
    return (F.when(key.isNull(), F.lit(-1 - batch_id))
            .otherwise(F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int"))).alias("bucket")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # not written yet
        return None


def _whole(spark: SparkSession, path: str) -> DataFrame | None:
    """A table whose write was committed."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    there = mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)
    return spark.read.parquet(path) if there else None


def _replace(spark: SparkSession, path: str, rows: DataFrame, key: str, changed: DataFrame, place: Column) -> None:
    """Replace the rows of changed records (``changed``: id, bucket) in the table at ``path``, bucket by bucket.

    The affected buckets are read back pruned, written once beside the table and moved in by a dynamic overwrite.
    Doing it again gives the same table.
    """
    touched = [r["bucket"] for r in changed.select("bucket").distinct().collect()]  # at most ``buckets``
    new = rows.withColumn("bucket", place)
    old = _read(spark, path)
    if old is not None:
        kept = (old.filter(F.col("bucket").isin(touched) & (F.col("bucket") >= 0))
                .join(changed.select(F.col("id").alias("_id")), F.col(key) == F.col("_id"), "left_anti"))
        new = kept.unionByName(new, allowMissingColumns=True)
    new = materialize(new, "upsert")
    # A bucket that lost its last row must not keep its old files: dynamic overwrite touches only buckets it writes.
    if old is not None:
        full = {r["bucket"] for r in new.select("bucket").distinct().collect()}
        for b in set(touched) - full:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={b}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    (new.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))


class Upsert:
    """Incremental runs of ``raw_to_staging`` over a landing folder."""

    def __init__(self, spark: SparkSession, raw_root: str, root: str, buckets: int = 256):
        self.spark, self.raw_root, self.root, self.buckets = spark, raw_root, root.rstrip("/"), buckets

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def run(self, max_files_per_trigger: int = 1000) -> None:
        """Take in everything that has landed since the last run, in batches, and stop."""
        dated = [T.StructField(x, T.IntegerType()) for x in ("year", "month", "day")] + [T.StructField("time", T.StringType())]
        stream = (self.spark.readStream.schema(T.StructType([*schema.RAW_SCHEMA.fields, *dated]))
                  .option("maxFilesPerTrigger", max_files_per_trigger).option("maxFileAge", MAX_FILE_AGE)
                  .option("timestampFormat", landing.TS_FORMAT).json(self.raw_root))
        (stream.writeStream.foreachBatch(self.take).option("checkpointLocation", self.path("_checkpoint"))
         .trigger(availableNow=True).start().awaitTermination())

    def take(self, batch: DataFrame, batch_id: int) -> None:
        """One batch: replace the rows of its new and newer records in every table. Its intermediate tables are removed."""
        spark, log = batch.sparkSession, self.path(f"_batches/{batch_id}")
        if _whole(spark, f"{log}/done") is not None:
            return
        with scratch(spark):
            self._take(batch, batch_id, log)
        spark.range(1).write.mode("overwrite").parquet(f"{log}/done")

    def _take(self, batch: DataFrame, batch_id: int, log: str) -> None:
        spark = batch.sparkSession
        changed = _whole(spark, f"{log}/changed")
        if changed is None:
            self._newer(spark, batch, batch_id).write.mode("overwrite").parquet(f"{log}/changed")
            changed = spark.read.parquet(f"{log}/changed")
        if not changed.isEmpty():
            ids = changed.select("id", "bucket")
            staging = medallion.staging_of(changed.drop(*ORDER[1:], "bucket"), organisations=False)
            for name in schema.STAGING_TABLES:
                key = KEY.get(name, "ID_TRAMITE")
                if name != "dependencias":
                    # A table that never had a row has no file that would tell its columns.
                    if _whole(spark, self.path(f"_schemas/{name}")) is None:
                        spark.createDataFrame([], staging[name].schema).write.mode("overwrite").parquet(self.path(f"_schemas/{name}"))
                    _replace(spark, self.path(name), staging[name], key, ids, bucket(F.col(key), self.buckets, batch_id))
            # Last: from now on the batch's records are the newest known.
            _replace(spark, self.path("records"), changed.drop("bucket"), "id", ids, bucket(F.col("id"), self.buckets, batch_id))

    def _newer(self, spark: SparkSession, batch: DataFrame, batch_id: int) -> DataFrame:
        """The newest version of each record of the batch, if newer than the one known. Records without an id
        can't replace another; a hash of their content names them, so a second delivery adds none."""
        raw = batch.withColumn("snapshot", landing.snapshot_date(batch)).withColumn("landed", landing.snapshot_time(batch))
        raw = raw.drop("year", "month", "day", "time").withColumns({
            "_changed": F.col("changed").try_cast("bigint"),
            "_hash": F.xxhash64(F.to_json(F.struct(*schema.RAW_SCHEMA.names))), "_row": F.monotonically_increasing_id()})
        raw = materialize(raw, "batch")
        newest = star.latest_rows(raw.filter("id is not null"), ["id"], ORDER, "_row")
        unnamed = star.latest_rows(raw.filter("id is null"), ["_hash"], ORDER, "_row")
        newest = newest.unionByName(unnamed).drop("_row").withColumn("bucket", bucket(F.col("id"), self.buckets, batch_id))
        known = _read(spark, self.path("records"))
        if known is None:
            return newest
        seen = known.select(F.col("id").alias("_id"), F.struct(*ORDER).alias("_seen"),
                            F.when(F.col("id").isNull(), F.col("_hash")).alias("_own"))
        same = F.col("id").eqNullSafe(F.col("_id")) & F.when(F.col("id").isNull(), F.col("_hash")).eqNullSafe(F.col("_own"))
        return (newest.join(seen, same, "left")
                .filter(F.col("_seen").isNull() | (F.col("id").isNotNull() & (F.struct(*ORDER) > F.col("_seen"))))
                .drop("_id", "_seen", "_own"))

    def staging(self) -> dict[str, DataFrame]:
        """The nine staging tables as they stand. Organisations belong to many records: they are derived from the
        newest version of every record."""
        columns = lambda n: self.spark.read.parquet(self.path(f"_schemas/{n}")).schema
        out = {n: self.spark.read.schema(columns(n)).parquet(self.path(n)).drop("bucket")
               for n in schema.STAGING_TABLES if n != "dependencias"}
        records = self.spark.read.parquet(self.path("records"))
        return out | {"dependencias": medallion.organisations_of(records)}

    def consume(self) -> dict[str, DataFrame]:
        """The sixteen consume tables over the staging tables as they stand."""
        return medallion.staging_to_consume(self.spark, self.staging())
