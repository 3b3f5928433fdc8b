"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders chosen for local sessions that name none, by application.
_chosen: dict[str, str] = {}
#: Folders made below each open ``scratch``.
_scratch: list[list[str]] = []


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Small local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("isopleth")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a fresh temporary folder, the same one for
    its whole life; the setting itself is static and stays unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _chosen:
        _chosen[context.applicationId] = tempfile.mkdtemp(prefix="isopleth-")
    return _chosen[context.applicationId]


def new_dir(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scratch:
        _scratch[-1].append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def ship_package(spark: SparkSession, root: str) -> None:
    """Let the Python workers of this session import what lies in ``root``, from whatever folder it was started.

    For workers that see the driver's files (local sessions, shared installations); elsewhere give
    the package to Spark with ``--py-files`` or install it on the executors.
    """
    own = spark.sparkContext.environment
    paths = [p for p in own.get("PYTHONPATH", "").split(":") if p]
    if root not in paths and root not in os.environ.get("PYTHONPATH", "").split(":"):
        own["PYTHONPATH"] = ":".join([root, *paths])


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return bool(files.exists(where))


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediates; one that is gone already does no harm."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediates stored inside the block are deleted at its end.

    Frames that read them cannot be used after it: write what is to stay to a folder that was
    named outside the block.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove_dir(spark, path)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    For results that several jobs use, and for the presumably small side of a join
    with a whole field.  The stored table survives the loss of executors, no later
    job repeats the work behind it, and the optimiser knows its size: if it is small
    the field is joined where it lies, if not both sides are shuffled as usual.  (An
    aggregate that is not stored counts as large as its input, so the field would be
    shuffled before its true size came to light.)
    """
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
