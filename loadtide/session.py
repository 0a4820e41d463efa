"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "loadtide", **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; keyword names use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All instants are shown and truncated in UTC, whatever the machine's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_made: list[str] = []
_local: list[str] = []


def _local_root() -> str:
    """One folder per process for local sessions, removed when the process ends."""
    if not _local:
        _local.append(tempfile.mkdtemp(prefix="run-"))
        atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
    return _local[0]


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage folders that this process has made; their number. Tables read from them are gone."""
    conf, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    dropped = 0
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's ``spark.checkpoint.dir``.

    A local session without that setting gets a folder under the machine's temp
    directory; a cluster session without it is refused, since executors could not
    see such a folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_root()
    path = os.path.join(root, f"{name}-{uuid.uuid4().hex}")
    _made.append(path)
    return path


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    ``drop_stages`` deletes such folders when a run has ended.
    Several consumers then scan a table instead of recomputing the plan, and a lost
    executor costs a re-read rather than a re-run of the lineage.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoints(spark: SparkSession) -> None:
    """Give iterative jobs a place to cut their lineage if the cluster has named none."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
