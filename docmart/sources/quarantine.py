"""Malformed and mis-shaped records (S2): nothing is turned into NULL without a trace.

Every line is parsed with the fixed schema and checked against its own text: a line that is no JSON, or a field
that holds another shape than the schema's (an object where an array is due, or the reverse), sends the record to
quarantine with its text, its file and the reasons. Good and quarantined records together are the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MALFORMED, NO_OBJECT = "malformed", "no object"


def _none() -> Column:
    return F.array().cast("array<string>")


def shape_errors(text: Column, kind: T.DataType, path: str = "") -> Column:
    """Paths in a JSON text whose value has another shape than ``kind``; the text is taken apart level by level,
    children as text. Scalars fit any scalar type of the schema; numbers and strings are told apart by casting only."""
    where = path or "record"
    if isinstance(kind, T.StructType):
        flat = T.StructType([T.StructField(f.name, T.StringType()) for f in kind.fields])
        parts = F.from_json(text, flat)
        inner = [shape_errors(parts[f"`{f.name}`"] if "." in f.name else parts[f.name], f.dataType, f"{path}.{f.name}".lstrip("."))
                 for f in kind.fields if isinstance(f.dataType, (T.StructType, T.ArrayType))]
        fits, below = F.ltrim(text).startswith("{"), F.concat(*inner) if inner else _none()
    elif isinstance(kind, T.ArrayType):
        deep = isinstance(kind.elementType, (T.StructType, T.ArrayType))
        parts = F.from_json(text, T.ArrayType(T.StringType()))
        inner = F.flatten(F.transform(parts, lambda x: shape_errors(x, kind.elementType, path + "[]"))) if deep else _none()
        fits, below = F.ltrim(text).startswith("["), inner
    else:
        return _none()
    return (F.when(text.isNull(), _none()).when(~fits, F.array(F.lit(f"{where}: {kind.typeName()} expected")))
            .otherwise(F.coalesce(below, _none())))


def checked(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Every line under ``root``: ``record`` (parsed), ``reasons`` (empty: good), ``raw`` and ``file``; dated folders
    give their partition columns. Blank lines are no records."""
    lines = spark.read.text(root).filter(F.trim("value") != "")
    dated = [c for c in lines.columns if c != "value"]
    raw = F.col("value")
    # parse_json rejects what from_json would read in part.
    broken = F.try_parse_json(raw).isNull()
    reasons = (F.when(broken, F.array(F.lit(MALFORMED)))
               .when(~F.ltrim(raw).startswith("{"), F.array(F.lit(NO_OBJECT)))
               .otherwise(F.array_distinct(shape_errors(raw, schema))))
    return lines.select(F.from_json(raw, schema).alias("record"), reasons.alias("reasons"), raw.alias("raw"),
                        F.col("_metadata.file_path").alias("file"), *dated)


def split(spark: SparkSession, root: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): the records that fit, with the schema's columns and the folders' dates, and the others
    as (raw, reasons, file, dates)."""
    every = checked(spark, root, schema)
    dated = [c for c in every.columns if c not in ("record", "reasons", "raw", "file")]
    good = every.filter(F.size("reasons") == 0).select("record.*", *dated)
    return good, every.filter(F.size("reasons") > 0).select("raw", "reasons", "file", *dated)


def counts(quarantined: DataFrame) -> DataFrame:
    """(reason, records): how many records each reason holds back."""
    return quarantined.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("records"))
