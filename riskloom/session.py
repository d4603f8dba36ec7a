"""Session defaults and the shared folders a job writes intermediate data to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job relies on; `conf` adds or replaces any."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # call sites of single expressions are not needed, and cost a call each
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # the JVM never compiles methods above 8000 bytes of bytecode; wide rows reach that
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    A temporary folder is used only in local mode with the setting absent; on a
    cluster every executor must see the folder, so its absence is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        configured = sc.getCheckpointDir()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="riskloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/riskloom/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize `df` in the reliable checkpoint folder, so lost executors do not replay its history."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark removes the shuffle files of a query as soon as it has ended.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_go(spark: SparkSession):
    """Within, shuffle files of a written table go once it is written, so that the steps of a job don't add up on the disks."""
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again; unlike a checkpoint, its size is known to joins."""
    path = work_dir(df.sparkSession, name)
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
