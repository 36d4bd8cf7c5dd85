"""Spark session factory and shared settings.

Everything in the library takes a ``SparkSession`` argument; this module only
builds one for tests, the bench and the smoke entry.  On a cluster the caller
brings its own session and the library reads its settings (checkpoint
directory, shuffle partitions) instead of overriding them.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "nextbuy") -> SparkSession:
    """Local session with the settings the library is written for.

    ANSI mode stays on (Spark 4 default): every division and cast in the
    library is ``try_``-guarded so bad input yields NULL instead of an error.
    """
    master = master or os.environ.get("NEXTBUY_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("NEXTBUY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...);
    the library never replaces it.  Tests and the bench run without one in local
    mode, so a fresh scratch folder is created for them; elsewhere a folder of the
    driver's machine would lose data, so an unset setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if current:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if sc_dir:
        spark.conf.set("spark.checkpoint.dir", sc_dir)
        return sc_dir
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="nextbuy-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint directory for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


#: Spark drops the shuffle files of a finished write when this is on, instead of when the driver next collects garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` under the shared checkpoint directory and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the plan) and lets later filters prune Parquet partitions.  The shuffle
    files of the write go as soon as the table is complete.
    """
    import uuid

    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with settings(spark, {SHUFFLE_CLEANUP: "true", OPEN_FILES: MOST_OPEN_FILES}):
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A write by partition keeps this many files open in a task instead of sorting the task's rows; with more partitions Spark sorts the rest.
OPEN_FILES, MOST_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters", "64"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the length of a block, as they were afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Rows that one task of an exchange by key sorts or joins; its memory then stays the same on any input.
ROWS_PER_TASK = 1 << 19


def spread(df, *keys: str, rows: int | None = None, per_task: int = ROWS_PER_TASK):
    """``df`` dealt out by ``keys`` in tasks of about ``per_task`` rows.

    Adaptive execution joins small partitions by their compressed size, which
    says little about rows that later steps make wide; a number given here
    stays.  ``rows``, if not known, is counted.
    """
    rows = df.count() if rows is None else rows
    return df.repartition(max(1, -(-rows // per_task), _least_tasks(df.sparkSession, rows)), *keys)


def _least_tasks(spark: SparkSession, rows: int) -> int:
    """As many tasks as the cluster runs at once, as long as each has some thousand rows."""
    return min(spark.sparkContext.defaultParallelism, rows >> 13)


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop, whatever file system holds it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Intermediate tables of one job that can be dropped as soon as their last reader is done.

    ``write`` materialises a frame; ``drop`` deletes the files behind frames
    that ``write`` returned.  A table that a lazy result still reads must not
    be dropped.
    """

    def __init__(self, spark: SparkSession, prefix: str):
        self.spark, self.prefix = spark, prefix
        self._tables: list[tuple[object, str]] = []

    def write(self, df, name: str, partition_by: list[str] | None = None):
        import uuid

        folder = f"{self.prefix}-{name}-{uuid.uuid4().hex[:8]}"
        out = materialize(df, f"{folder}/t", partition_by)
        self._tables.append((out, scratch_path(self.spark, folder)))
        return out

    def drop(self, *frames) -> None:
        gone = [x for x in self._tables if any(x[0] is f for f in frames)]
        self._tables = [x for x in self._tables if not any(x[0] is f for f in frames)]
        for _, path in gone:
            remove_tree(self.spark, path)
