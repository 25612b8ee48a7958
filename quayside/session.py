"""Session defaults and the shared folder for materialized intermediates."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.cbo.enabled": "true",
}


def get_spark(app: str = "quayside", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; cluster sizing stays with the caller."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    system, folder = _file_system(spark, path)
    return system.exists(folder)


def shared_dir(spark: SparkSession) -> str:
    """Folder of this application that every executor can reach.

    Below ``spark.checkpoint.dir``, or the context's own checkpoint folder; where neither is set,
    below the warehouse, which is shared as well. It is deleted when the session's JVM ends.
    """
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or spark.sparkContext.getCheckpointDir()
        or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    )
    folder = f"{root.rstrip('/')}/quayside-{spark.sparkContext.applicationId}"
    system, path = _file_system(spark, folder)
    if not system.exists(path):
        system.mkdirs(path)
        system.deleteOnExit(path)
    return folder


_records: list[list[str]] = []


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    for record in _records:
        record.append(path)
    return path


@contextmanager
def recorded_paths() -> Iterator[list[str]]:
    """The paths that ``new_path`` gives out meanwhile, for whoever wants to drop them when they are read no more."""
    paths: list[str] = []
    _records.append(paths)
    try:
        yield paths
    finally:
        _records.remove(paths)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder made by ``new_path`` once no plan reads it any more."""
    system, folder = _file_system(spark, path)
    system.delete(folder, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that later passes see the same rows even when executors are lost, and
    gives the optimizer real sizes.
    """
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Deletes the folder that a frame made by ``materialize`` reads, once no plan reads it any more."""
    spark = df.sparkSession
    shared = _file_system(spark, shared_dir(spark))[1].toUri().getPath()
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        if f"{shared}/" in folder:
            drop_path(spark, folder)


#: Runtime setting: shuffle files go when their execution ends, and not only when the driver's JVM collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_freeing: dict[SparkSession, list] = {}


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Frames made and written meanwhile leave no shuffle files behind. Run again, one makes its files again."""
    with _lock:
        held = _freeing.setdefault(spark, [0, spark.conf.get(_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _freeing[spark]
                if held[1] is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, held[1])
