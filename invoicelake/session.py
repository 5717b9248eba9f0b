"""Session defaults and hand-over tables in the cluster's shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)   # paths staged in the open block


def local_session(app: str = "invoicelake", cores: str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    settings = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.memory": "8g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or one beside the tables of the warehouse."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_handover"
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def cache_memory(spark: SparkSession) -> int:
    """Bytes that the executors have for cached data and running jobs together; the driver's where it runs the tasks."""
    sc = spark.sparkContext
    status = sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().getExecutorMemoryStatus())
    driver = sc._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    most = {at: status[at]._1() for at in status}
    return sum(size for at, size in most.items() if at != driver or len(most) == 1)


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's own folder, which is deleted when the application ends."""
    sc = spark.sparkContext
    folder = f"{shared_folder(spark)}/staged/{sc.applicationId}"
    target = sc._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(sc._jsc.hadoopConfiguration())
    files.mkdirs(target)
    files.deleteOnExit(target)
    return f"{folder}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session (``__`` for a dot) for the jobs that run meanwhile; what was set comes back afterwards."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """The tables staged meanwhile are deleted at the end, but for those staged with ``keep``: no frame that is used
    later may read them."""
    paths: list[str] = []
    token = _PASSING.set(paths)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in paths:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, name: str, partition_by: str | None = None, keep: bool = False) -> DataFrame:
    """Write once, read back: cuts the lineage and survives the loss of executors.

    Parquet rather than ``checkpoint()``, so that later passes read only the columns they use
    and push their filters into the scan. The shuffles of the write are not needed after it: their files go with its end,
    not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    if _PASSING.get() is not None and not keep:
        _PASSING.get().append(path)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    with settings(spark, **{SHUFFLE_CLEANUP: "true"}):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
