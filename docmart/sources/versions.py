"""Several tables published as one.

A publish writes every table under a new version folder, reads each back, and only then commits the version by one
small file whose number is the next in the log. Readers take the newest committed version, so they see all tables of the former
version or all of the new one. A publish that fails leaves a folder that no manifest names. The file is created under
its final name by a rename that fails if another publish was first.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from docmart.sources import landing

LOG = "_manifests"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, path = _fs(spark, f"{root}/{LOG}/*.json")
    return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.globStatus(path) or ())


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """The newest committed manifest (or that of a number): version folder and rows of each table."""
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    if not numbers:
        return None
    path = f"{root}/{LOG}/{numbers[-1] if number is None else number:010d}.json"
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))


def _commit(spark: SparkSession, root: str, number: int, content: dict) -> None:
    fs, temp = _fs(spark, f"{root}/{LOG}/.{uuid.uuid4().hex}.tmp")
    _, final = _fs(spark, f"{root}/{LOG}/{number:010d}.json")
    out = fs.create(temp)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if fs.exists(final) or not fs.rename(temp, final):
        fs.delete(temp, False)
        raise RuntimeError(f"version {number} was committed by another publish")


def publish_all(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_ts: str | None = None,
                check=None) -> dict:
    """Publish ``tables`` with their audit column as one version; returns its manifest.

    ``check(name, df)`` sees each table as written and may raise; then nothing is committed.
    """
    root = root.rstrip("/")
    numbers = _numbers(spark, root)
    number = numbers[-1] + 1 if numbers else 0
    folder = f"{root}/v{number:010d}-{uuid.uuid4().hex[:8]}"
    rows = {}
    for name, df in tables.items():
        landing.audit(df, run_ts).write.parquet(f"{folder}/{name}")
        written = spark.read.parquet(f"{folder}/{name}")
        rows[name] = written.count()  # from the footers
        if check:
            check(name, written)
    content = {"number": number, "folder": folder, "rows": rows}
    _commit(spark, root, number, content)
    return content


def published(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """All tables of the newest committed version (or of a number); {} before the first."""
    found = manifest(spark, root, number)
    return {n: spark.read.parquet(f"{found['folder']}/{n}") for n in found["rows"]} if found else {}


def register(spark: SparkSession, root: str, database: str) -> None:
    """Point the catalog's external tables at the newest committed version. Safe to repeat: a run that stops half-way
    is finished by the next."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    found = manifest(spark, root)
    for name in found["rows"] if found else ():
        path = f"{found['folder']}/{name}"
        if spark.catalog.tableExists(f"{database}.{name}"):
            spark.sql(f"ALTER TABLE {database}.{name} SET LOCATION '{path}'")
            spark.sql(f"REFRESH TABLE {database}.{name}")
        else:
            spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{path}'")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Remove the folders of all but the newest ``keep`` versions, and of publishes that never were committed."""
    root = root.rstrip("/")
    kept = {manifest(spark, root, n)["folder"].rsplit("/", 1)[1] for n in _numbers(spark, root)[-keep:]}
    fs, path = _fs(spark, f"{root}/v*")
    gone = [s.getPath() for s in fs.globStatus(path) or () if s.getPath().getName() not in kept]
    for p in gone:
        fs.delete(p, True)
    for n in _numbers(spark, root)[:-keep]:
        fs.delete(_fs(spark, f"{root}/{LOG}/{n:010d}.json")[1], False)
    return sorted(p.getName() for p in gone)
