"""The folder all executors share, and how a session is opened."""

from __future__ import annotations

import atexit
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import TypeVar

from pyspark import SparkContext, inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def open_session(app_name: str = "millwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# All tasks run in the driver's own process; `local-cluster[...]` is a cluster.
_ONE_PROCESS = re.compile(r"local(\[.*\])?")


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`; a temporary folder only in local mode.

    Whether a folder named there is shared cannot be seen from its name (a
    `file:` path may be mounted everywhere), so it is taken at its word.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not _ONE_PROCESS.fullmatch(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="millwright-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


_LEFT: set[str] = set()


def _remove(context: SparkContext, folder: str) -> None:
    path = context._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _remove_left_folders() -> None:
    """Run folders that no `scratch` block has removed go when the program ends, if Spark still runs."""
    context = SparkContext._active_spark_context
    if context is not None and context._jsc is not None:
        for folder in _LEFT:
            _remove(context, folder)


def run_folder(spark: SparkSession) -> str:
    """A fresh sub-folder of the shared folder for tables written and read back in one run.

    Lazy results may read from it, so it stays until the program ends.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    _LEFT.add(folder)
    return folder


_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A run folder for everything staged inside the block; it is removed at the end."""
    folder = run_folder(spark)
    token = _SCRATCH.set(folder)
    try:
        yield folder
    finally:
        _SCRATCH.reset(token)
        _LEFT.discard(folder)
        _remove(spark.sparkContext, folder)


def stage_path(spark: SparkSession) -> str:
    """Where the next staged table would go: below the enclosing `scratch` block, or a fresh run folder."""
    return f"{_SCRATCH.get() or run_folder(spark)}/{uuid.uuid4().hex}"


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Evaluate `df` once into a table of the shared folder and read that.

    The files survive a lost executor, later jobs read only the columns they
    need, and nobody repeats the joins and aggregations behind the frame. They
    stay until the enclosing `scratch` block ends, or else until the program does;
    a `path` taken before an inner block began outlives that one.
    """
    spark = df.sparkSession
    path = path or stage_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """`stage`, with the number of rows counted while they are written."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return staged, seen.get["rows"]


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of jobs that have ended removed from the executors' disks.

    Spark removes them when the driver's JVM collects the garbage of their plans, which it
    puts off while it has memory: between the steps of a long run all would add up.
    What the first collection finds is let go of by Spark's cleaner, and only then the second finds the rest.
    """
    for pause in (0.1, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(pause)


_Result = TypeVar("_Result")


def concurrently(spark: SparkSession, jobs: Sequence[Callable[[], _Result]]) -> list[_Result]:
    """Run independent jobs side by side, so that one job's last tasks do not idle the cluster.

    Results come in the order of the jobs. All jobs end before a failure is raised.
    Shuffle files of a job that has ended do not wait for the others.
    """
    def start(job: Callable[[], _Result]) -> Callable[[], _Result]:
        context = copy_context()

        def run() -> _Result:
            try:
                return context.run(job)
            finally:
                release_shuffles(spark)

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_workers=max(1, len(jobs))) as pool:
        running = [pool.submit(start(job)) for job in jobs]
    return [job.result() for job in running]
