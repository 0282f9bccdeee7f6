"""Session settings and the shared folders jobs may write to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lakegate", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with the settings every operator here is written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Return the folder all executors can reach: the cluster's own setting, or a local one in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="lakegate-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """Return a fresh path below the shared folder, inside one folder per application that can be removed after it."""
    path = f"{shared_dir(spark)}/lakegate-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of a job's own, if it is there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch paths asked for inside are removed at the end: for work that comes again and again, and keeps nothing."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)
        for path in paths:
            remove_path(spark, path)


def materialised(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Lineage ends there: later reads see one fixed result even after lost executors, and each reads only its columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions_for(df: DataFrame, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Partitions for a full sort of ``df``: the session's shuffle setting, or more where the estimated size asks for it.

    The estimate is the optimizer's own; a frame too large for the configured number of partitions still gets
    partitions that fit into memory.
    """
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    try:
        estimated = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except AttributeError:  # a session without plans of its own (Spark Connect)
        return configured
    return configured if estimated > 1 << 60 else max(configured, -(-estimated // target_bytes))
