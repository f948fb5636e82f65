"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "daygrain", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library is tested under.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit;
    adaptive execution then merges small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # The game plans generate some 200 classes; the default cache of 100 would compile them all again each time.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    if master:
        # In local mode the driver is the only executor, and 1 GB, its default, mostly collects garbage.
        local = {"spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.driver.memory": "8g"}
        builder = builder.master(master).config(map=local)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context, so that batch functions import there."""
    context = spark.sparkContext
    if getattr(context, "_daygrain_sent", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="daygrain-"), "daygrain")
    context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
    context._daygrain_sent = True


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """What is run inside hands Python at most ``rows`` rows at a time, or the session's own number if that is less.

    Spark's default of 10,000 rows of whole texts is tens of megabytes, held several times over: in the
    task, on its way and in the Python worker. It holds for what is stored or collected inside.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    own = int(before)
    # Zero and below mean no limit.
    spark.conf.set(key, str(min(own, rows) if own > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


_handed_out: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="daygrain-"))
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder. ``temporary`` removes it after use."""
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    for open_scope in _handed_out:
        open_scope.append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Store an intermediate result once, so that its readers do not recompute it.

    A Parquet table in the shared folder: it outlives lost executors, and each reader
    takes only the columns and rows it needs.
    """
    path = fresh_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._is_stored = True
    return stored


def once(df: DataFrame) -> DataFrame:
    """``df`` for more than one reader: stored, unless it is a stored table already."""
    return df if getattr(df, "_is_stored", False) else cut(df)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Remove the folders handed out inside, once the result has been written."""
    paths: list[str] = []
    _handed_out.append(paths)
    try:
        yield
    finally:
        _handed_out[:] = [scope for scope in _handed_out if scope is not paths]
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
