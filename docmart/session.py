"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job needs regardless of cluster size.
REQUIRED_CONF = {
    # Epoch seconds -> timestamp and dated landing paths are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A struct field holding an array (or the reverse) must null that field only,
    # not the whole multi-line record.
    "spark.sql.json.enablePartialResults": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "docmart", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings in REQUIRED_CONF.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (builder.master(master).config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false"))
    for k, v in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime-settable part of REQUIRED_CONF on an existing session."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only a local master may leave it unset (tests, single machine): then
    a local folder is created and registered. On a cluster executors would each write to
    their own disk and later reads would miss rows, so an unset folder raises there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        cur = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = cur.get() if cur.isDefined() else None
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="docmart-")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(base)
    return base


#: From here on a size estimate says that the planner knows nothing.
UNKNOWN_BYTES = 1 << 60


def input_bytes(df: DataFrame) -> int | None:
    """The planner's estimate of a frame's size, None if it has none.

    Without statistics the estimate of a join is the product of its sides, millions of times too large for a table
    with a small dimension; such a plan counts as much as the tables it reads together.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    size, leaves = int(plan.stats().sizeInBytes()), plan.collectLeaves()
    if leaves.size() > 1:
        size = min(size, sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())))
    return size if size < UNKNOWN_BYTES else None


SOURCE_PER_TASK = 2 << 20


def spread(df: DataFrame) -> DataFrame:
    """Narrow rows that are to be rendered as wide records, dealt to tasks of ``SOURCE_PER_TASK`` bytes, at least one for
    each shuffle partition: a source in one file or row group would be rendered by one task. Dealt by a hash of the row,
    which sorts nothing and keeps rows with a NULL or repeated key apart."""
    n, size = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), input_bytes(df)
    return df.repartition(n if size is None else max(n, -(-size // SOURCE_PER_TASK)), F.xxhash64(*df.columns))


_open = threading.local()


def _scopes() -> list[list[str]]:
    """The scratch scopes that this thread has open, innermost last."""
    if not hasattr(_open, "scopes"):
        _open.scopes = []
    return _open.scopes


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the folders made inside (``shared_dir``, ``materialize``) when the block ends, also if it fails.

    Whatever reads them must run inside: results leave the block as written tables or collected rows.
    Outside any scope the folders stay, since a lazy result may still read them. Scopes nest; each
    thread has its own.
    """
    made: list[str] = []
    _scopes().append(made)
    try:
        yield
    finally:
        _scopes().pop()
        for folder in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder; it goes with the innermost open ``scratch``."""
    path = checkpoint_base(spark).rstrip("/") + "/" + name + "-" + uuid.uuid4().hex[:12]
    if _scopes():
        _scopes()[-1].append(path)
    return path


def materialize(df: DataFrame, name: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and
    read it back.

    Cuts the lineage of an intermediate that several branches read, so it is
    computed once (one job, columnar and compressed, no cache held) and a lost
    executor only re-reads files. Inside ``scratch`` the table goes with the block. ``compression``
    is the session's, if not given.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)
