"""Files wherever they lie: the driver's own disk, or any file system that
Spark reaches, through Hadoop's interface."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


def local_path(path: str) -> str | None:
    """The plain path of a local file or folder; None for one elsewhere."""
    parts = urlsplit(path)
    if parts.scheme == "file":
        return parts.path
    return path if len(parts.scheme) < 2 else None


class Disk:
    """The driver's disk."""

    def make(self, path: str) -> None:
        os.makedirs(path, exist_ok=True)

    def exists(self, path: str) -> bool:
        return os.path.lexists(path)

    def move(self, source: str, target: str) -> None:
        os.replace(source, target)

    def remove(self, path: str) -> None:
        shutil.rmtree(path, ignore_errors=True)

    def settle(self, path: str) -> None:
        handle = os.open(path, os.O_RDONLY)
        try:
            os.fsync(handle)
        finally:
            os.close(handle)


class Remote:
    """A file system by way of Hadoop."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def make(self, path: str) -> None:
        self.fs.mkdirs(self.path(path))

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def move(self, source: str, target: str) -> None:
        if not self.fs.rename(self.path(source), self.path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def settle(self, path: str) -> None:
        pass

    def put(self, own: str, path: str) -> None:
        self.fs.moveFromLocalFile(self.path(own), self.path(path))


def _spark(spark: SparkSession | None, path: str) -> SparkSession:
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise ValueError(f"{path}: a session is needed for files that aren't local")
    return spark


def disk_of(path: str, spark: SparkSession | None = None) -> Disk | Remote:
    return Disk() if local_path(path) is not None else Remote(_spark(spark, path), path)


def list_files(spark: SparkSession, directory: str) -> list[str]:
    """The files of a directory, not below it, by path; links to files count."""
    own = local_path(directory)
    if own is not None:
        return sorted(e.path for e in os.scandir(own) if e.is_file())
    remote = Remote(spark, directory)
    return sorted(s.getPath().toString() for s in remote.fs.listStatus(remote.path(directory)) if s.isFile())


def is_directory(spark: SparkSession, path: str) -> bool:
    own = local_path(path)
    if own is not None:
        return os.path.isdir(own)
    remote = Remote(spark, path)
    return remote.exists(path) and remote.fs.getFileStatus(remote.path(path)).isDirectory()


def exists(spark: SparkSession, path: str) -> bool:
    return disk_of(path, spark).exists(local_path(path) or path)


@contextmanager
def output_file(path: str, spark: SparkSession | None = None):
    """A binary file to write, which is in place once it is closed."""
    own = local_path(path)
    if own is not None:
        with open(own, "wb") as f:
            yield f
        return
    handle, held = tempfile.mkstemp()
    try:
        with os.fdopen(handle, "wb") as f:
            yield f
        Remote(_spark(spark, path), path).put(held, path)
    finally:
        if os.path.exists(held):
            os.remove(held)


@contextmanager
def input_text(path: str, spark: SparkSession | None = None):
    """A UTF-8 text file to read; one from elsewhere is fetched first."""
    own = local_path(path)
    if own is not None:
        with open(own, encoding="utf-8") as f:
            yield f
        return
    folder = tempfile.mkdtemp()
    try:
        remote = Remote(_spark(spark, path), path)
        remote.fs.copyToLocalFile(remote.path(path), remote.path(f"file://{folder}/held"))
        with open(f"{folder}/held", encoding="utf-8") as f:
            yield f
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def join_files(spark: SparkSession, parts: list[str], target: str, head: bytes = b"") -> None:
    """``head``, then the bytes of ``parts`` in that order, as one file. They are
    copied inside the JVM, a buffer at a time."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    remote = Remote(spark, target)
    if local_path(target) is not None and hasattr(remote.fs, "getRawFileSystem"):
        remote.fs = remote.fs.getRawFileSystem()  # no file of check sums beside it
    out = remote.fs.create(remote.path(target), True)
    try:
        out.write(bytearray(head))
        for part in parts:
            source = Remote(spark, part)
            stream = source.fs.open(source.path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()


def reach_workers(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, too."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in known:
        env["PYTHONPATH"] = os.pathsep.join([home, *known])


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder for intermediate tables, which the driver and all
    executors share: below ``spark.checkpoint.dir``, or, where that is unset
    and driver and executors are one process, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="strandlake-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{own}")
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/strandlake/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to a fresh folder and read back: made once, whatever is
    made of it, and no loss of an executor takes it away."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._strandlake_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing reads it any more."""
    if path := getattr(df, "_strandlake_path", None):
        Remote(df.sparkSession, path).remove(path)
