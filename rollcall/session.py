"""Session settings for running locally (on a cluster the session is given), and the folder that all machines share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(name: str = "rollcall", cpus: int | str | None = None, memory: str = "8g") -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_own: dict[str, str] = {}
_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by the session in spark.checkpoint.dir. Where it names none, a
    temporary folder stands in for it if all of Spark runs in this process, as in tests; on a cluster that is an error,
    because each machine would write its own part and reads would miss the rest."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = context.applicationId
        folder = _own.get(app) or _own.setdefault(app, f"file://{tempfile.mkdtemp(prefix='rollcall-')}")
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder. What is written there goes when the driver ends, or with `dropping_tables`."""
    path = f"{shared_folder(spark)}/stages/{name}-{uuid.uuid4().hex}"
    hadoop_path, system = _system(spark, path)
    system.deleteOnExit(hadoop_path)
    _made.append(path)
    return path


@contextmanager
def dropping_tables(spark: SparkSession) -> Iterator[None]:
    """Drop all tables that are written to new paths in this block when it ends. Results that are still read from them must
    have been written elsewhere by then."""
    before = len(_made)
    try:
        yield
    finally:
        for path in _made[before:]:
            hadoop_path, system = _system(spark, path)
            system.delete(hadoop_path, True)
        del _made[before:]


def _system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
