"""Session defaults, the shared folder and the scratch folders of runs."""

from __future__ import annotations

import logging
import tempfile
import time
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def local_session(cores: str = "8", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("triagelake")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


RUN_PREFIX = "run-"
_log = logging.getLogger(__name__)
_own: dict[str, str] = {}  # folders of local sessions without a shared one, by application
_run: ContextVar[str | None] = ContextVar("triagelake_run", default=None)


def _files(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session without one gets its own, which goes when its JVM ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _own_folder(spark)


def _own_folder(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _own:
        folder = f"file:{tempfile.gettempdir()}/triagelake-{app}-{uuid.uuid4().hex[:12]}"
        files, path = _files(spark, folder)
        files.mkdirs(path)
        files.deleteOnExit(path)
        _own[app] = folder
    return _own[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder of the run, or below the shared folder outside of one."""
    return f"{(_run.get() or shared_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def run_folder(spark: SparkSession, name: str = "job"):
    """Scratch tables of the block lie in one folder, which is deleted when the block ends, also by an error.

    Frames that read these tables must be written or collected inside the block.  A run within a run lies in the outer
    one's folder.  What a lost driver leaves behind is found by ``sweep_runs``.
    """
    path = scratch_path(spark, f"{RUN_PREFIX}{spark.sparkContext.applicationId}-{name}")
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        try:
            files, at = _files(spark, path)
            files.delete(at, True)
        except Exception:  # the run's own result or error counts; sweep_runs comes back to the folder
            _log.warning("scratch folder %s could not be deleted", path, exc_info=True)


def sweep_runs(spark: SparkSession, idle_days: float = 7) -> list[str]:
    """Delete the run folders of other applications that nothing was added to for idle_days; returns their names.

    Folders of this application and all that ``run_folder`` did not make stay.
    """
    files, root = _files(spark, shared_folder(spark))
    oldest, own, gone = (time.time() - idle_days * 86400) * 1000, f"{RUN_PREFIX}{spark.sparkContext.applicationId}-", []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(RUN_PREFIX) and not name.startswith(own) and status.getModificationTime() <= oldest:
            files.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


def cut_lineage(df, name: str):
    """Write the table to the shared folder and read it back.

    A written table survives the loss of executors, unlike a cached one.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
