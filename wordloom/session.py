"""Session defaults and the shared folder that cut lineage and stage tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "wordloom", **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; `conf` overrides them."""
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_JOB_FOLDER: ContextVar[str | None] = ContextVar("job_folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, where every executor can read and write.

    Only a local session may go without the setting; it then gets a temporary folder. Elsewhere a
    `file:` path is refused, as each machine would write to its own disk, unless
    `spark.wordloom.sharedMount` is true: the path then is a mount that all machines share.
    """
    if _JOB_FOLDER.get():
        return _JOB_FOLDER.get()
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master.startswith("local")
    if folder is None:
        if not local:
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="wordloom-")
    mounted = spark.conf.get("spark.wordloom.sharedMount", "false").lower() == "true"
    if folder.startswith("file:") and not local and not mounted:
        raise ValueError(f"{folder} is on each machine's own disk; name a shared folder")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """`df` computed once and read back from the shared folder, so lost executors cost nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[str]:
    """Tables from `new_folder` and checkpoints made inside are deleted at the end.

    For jobs that leave their results elsewhere: a table made inside cannot be read afterwards.
    """
    context = spark.sparkContext
    folder, before = new_folder(spark, "job"), context.getCheckpointDir()
    context.setCheckpointDir(folder)
    token = _JOB_FOLDER.set(folder)
    try:
        yield folder
    finally:
        _JOB_FOLDER.reset(token)
        context.setCheckpointDir(before)
        delete_folder(spark, folder)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder in whatever store its path names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
