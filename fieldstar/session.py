"""Session settings and staging of intermediate tables."""

from __future__ import annotations

import pathlib
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime re-planning does the skew splitting and the size-checked broadcasts.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "fieldstar", **extra: str) -> SparkSession:
    """Build (or fetch) a session with the settings the library is tuned for."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_dir(spark: SparkSession) -> str:
    """The shared folder for staged tables: the cluster's own setting, if any.

    Only a local session may fall back to a temporary folder; on a cluster a
    machine-local folder would vanish with its machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="fieldstar-stage-")
    spark.conf.set(CHECKPOINT_DIR, folder)
    return folder


_staged: list[str] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder."""
    path = f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.append(path)
    return path


@contextmanager
def released_staging(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside the block when it ends, also on failure.

    Frames that read staged tables are of no use afterwards.
    """
    mark = len(_staged)
    try:
        yield
    finally:
        for path in _staged[mark:]:
            delete_path(spark, path)
        del _staged[mark:]


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame once and read it back: cuts lineage and fixes its values.

    Used where several outputs share one expensive input, and where generated
    ids must not change if a task is run again after an executor is lost.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, on whatever file system the path names."""
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with its contents, if it is there."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; its new parent is made if needed."""
    fs, old = _file_system(spark, source)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that appears at once: beside, then renamed."""
    beside = f"{path}.{uuid.uuid4().hex}"
    fs, target = _file_system(spark, beside)
    fs.mkdirs(target.getParent())
    out = fs.create(target, True)
    out.write(bytearray(text.encode()))
    out.close()
    delete_path(spark, path)
    move_path(spark, beside, path)


def read_note(spark: SparkSession, path: str) -> str | None:
    """Text of a small file; None if it is not there."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def list_paths(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    fs, target = _file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def file_states(spark: SparkSession, paths: Iterable[str]) -> Iterator[tuple[str, int, int]]:
    """(path, length, time of change) of files: metadata only, no content is read."""
    for path in paths:
        fs, target = _file_system(spark, path)
        status = fs.getFileStatus(target)
        yield path, status.getLen(), status.getModificationTime()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per application: whatever runs Python in tasks needs it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).parent
    archive = f"{tempfile.mkdtemp(prefix='fieldstar-package-')}/{package.name}"
    context.addPyFile(shutil.make_archive(archive, "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
