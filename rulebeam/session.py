"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "rulebeam") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Uses the context's checkpoint dir, else ``spark.checkpoint.dir`` from the
    session. Only a local-mode session (tests) without either gets a folder
    of its own; a cluster session without one is an error, because a
    machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rulebeam-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) before mining")
    return sc.getCheckpointDir()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Actions begun in this block remove their shuffle files when they end. Spark otherwise keeps
    them until the driver happens to collect its garbage, so the disk needed grows with the number of steps."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str = "table", partition_by: tuple[str, ...] = (),
                base: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet under the shared checkpoint
    folder and reading it back: one job, one pass over the input, and a lost
    executor re-reads the files instead of re-running the upstream scan.
    Readers also get file statistics for join planning. ``partition_by``
    writes one folder per value, so a filter on that column reads only its
    folder. The shuffle files behind the table go as soon as it is written."""
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/{name}-{os.urandom(6).hex()}" if base else scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_removed(spark):
        w.parquet(path)
    # The schema is known: reading with it skips the footer-inference job.
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", f"{name}-{os.urandom(6).hex()}")


def _file_system(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern (any Hadoop file system)."""
    fs, hpath = _file_system(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(hpath) or [])]


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _file_system(spark, path)
    return bool(fs.exists(hpath))


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hpath = _file_system(spark, path)
    fs.mkdirs(hpath)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder or file to a path that does not exist yet."""
    fs, hpath = _file_system(spark, source)
    if path_exists(spark, target) or not fs.rename(hpath, _file_system(spark, target)[1]):
        raise FileExistsError(f"could not move {source} to {target}")


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A whole file at once: written beside ``path`` and then moved there."""
    beside = f"{path}.{os.urandom(4).hex()}.tmp"
    fs, hpath = _file_system(spark, beside)
    out = fs.create(hpath, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename_path(spark, beside, path)


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this library wrote (any Hadoop file system: HDFS, S3,
    local). Returns whether something was deleted."""
    fs, hpath = _file_system(spark, path)
    return bool(fs.delete(hpath, True))
