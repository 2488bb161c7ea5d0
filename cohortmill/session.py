"""Session settings every job of the package relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Result = TypeVar("Result")

# Runtime settings. Warehouse DATETIME values carry no zone, so the session zone is pinned
# to UTC. Timestamps are written as INT64 micros: with the INT96 default, Parquet keeps no
# usable statistics and a "later than the mark" filter cannot skip a single row group.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Session windows are merged in the reading task before they are shuffled.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortmill")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", conf.pop("driver_memory", "8g"))
        # Recording the Python line of every column costs more than the column itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session that was built elsewhere."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own; on a cluster a
    machine-local folder would lose data with the machine, so a missing setting is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="cohortmill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/cohortmill/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    context = spark.sparkContext
    location = context._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(context._jsc.hadoopConfiguration()), location


@contextmanager
def written_once(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder, deleted on exit.

    For data that several jobs read: each reads what was computed once, a lost executor
    costs a reread, and a source that keeps changing cannot show two faces.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    files, location = hadoop_path(spark, path)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        files.delete(location, True)


def run_together(spark: SparkSession, tasks: Sequence[Callable[[], Result]], width: int) -> list[Result]:
    """Results of driver functions that each submit jobs, at most ``width`` at a time.

    Every task is wrapped on its own: a wrapper holds one set of job properties, and two
    threads sharing a set would mix up their executions.
    """
    if width <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    wrapped = [inheritable_thread_target(spark)(task) for task in tasks]
    with ThreadPool(min(width, len(tasks))) as pool:
        return pool.map(lambda task: task(), wrapped, chunksize=1)
