"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "ledgermill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# setting -> Spark's default, the value a lake's session gets. The JVM never compiles a method beyond 8000 bytes,
# an eighth of Spark's own limit; shuffle files are read by the one execution that wrote them
TUNED = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": ("false", "true"),
}
# codec of tables: two thirds of the size that snappy gives, in the same time
CODEC = "zstd"


def tune(spark: SparkSession) -> None:
    """Wide rows run in code that the JVM compiles, and shuffle files go when their execution ends.

    A stage over many columns becomes one method too large to be compiled, and every row would be
    interpreted. Such a stage then runs operator by operator, each in small methods. A run of many steps
    would else keep the shuffle files of all of them. What a session was given stays.
    """
    for name, (default, value) in TUNED.items():
        if spark.conf.get(name, default) == default:
            spark.conf.set(name, value)


_own_folders: dict[str, str] = {}
_open_scopes = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can read: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own; on a cluster
    the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="ledgermill-")
    return _own_folders[application]


def write_shared(df: DataFrame, name: str, codec: str | None = None) -> str:
    """Write a table of its own to the shared folder and return its path.

    The tables of an application share one folder, which may be removed when the application
    has ended.
    """
    spark = df.sparkSession
    table = f"{name}-{uuid.uuid4().hex}"
    path = os.path.join(shared_folder(spark), "tables", spark.sparkContext.applicationId, table)
    df.write.parquet(path, compression=codec)
    return path


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """An intermediate table, written to the shared folder and read back.

    The result survives the loss of executors, has a short lineage, and readers prune its
    columns. Inside :func:`scratch` it lasts as long as the scope.
    """
    path = write_shared(df, name, codec)
    scopes = getattr(_open_scopes, "stack", None)
    if scopes:
        scopes[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables, wherever it lies."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that this thread writes inside are removed at the end, also on failure."""
    if not hasattr(_open_scopes, "stack"):
        _open_scopes.stack = []
    paths: list[str] = []
    _open_scopes.stack.append(paths)
    try:
        yield
    finally:
        _open_scopes.stack.pop()
        for path in paths:
            remove(spark, path)
