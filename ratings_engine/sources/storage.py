"""Paths: shared scratch space, existence, size and removal through the Hadoop file system."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Codec of all Parquet files: hex digests and numbers take about half of what Spark's default leaves.
CODEC = "zstd"

_local_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the folder the cluster shares (spark.checkpoint.dir).

    Only a local session without that setting gets a temporary folder of its own."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder every executor can reach")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="ratings-engine-")
        shared = _local_scratch[context.applicationId]
    return f"{shared.rstrip('/')}/ratings_engine/{label}-{uuid.uuid4().hex}"


_FREE_AT_ONCE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: WeakKeyDictionary[SparkSession, tuple[int, str | None]] = WeakKeyDictionary()
_freeing_lock = threading.Lock()


@contextmanager
def freeing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs begun inside remove their shuffle files as they end.

    Else these stay until the driver happens to collect its garbage, so a flow of many steps needs the disk of
    all of them at once. May be nested, and entered by several threads."""
    with _freeing_lock:
        depth, before = _freeing.get(spark, (0, None))
        if not depth:
            before = spark.conf.get(_FREE_AT_ONCE, None)
            spark.conf.set(_FREE_AT_ONCE, "true")
        _freeing[spark] = depth + 1, before
    try:
        yield
    finally:
        with _freeing_lock:
            depth, before = _freeing[spark]
            _freeing[spark] = depth - 1, before
            if depth == 1:
                spark.conf.unset(_FREE_AT_ONCE) if before is None else spark.conf.set(_FREE_AT_ONCE, before)


def stage(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write df once to shared scratch and read it back.

    Cuts the lineage, survives lost executors and, being columnar, makes the later
    key-only and partition-only passes cheap. The caller removes the returned path."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with freeing_shuffles(spark):
        df.write.option("compression", CODEC).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything but marker and hidden files."""
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path) and any(
        status.getPath().getName()[:1] not in ("_", ".") for status in fs.listStatus(hadoop_path))


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def delete_all(spark: SparkSession, root: str, names: list[str]) -> None:
    """Remove files or folders below root, many at a time: requests of which each waits for the store."""
    with ThreadPoolExecutor(32) as pool:
        for _ in pool.map(lambda name: delete(spark, f"{root}/{name}"), names):
            pass


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files below a folder, relative to it, without marker and hidden files."""
    fs, hadoop_path = _filesystem(spark, path)
    if not fs.exists(hadoop_path):
        return []
    root = fs.makeQualified(hadoop_path).toString().rstrip("/")
    listed, names = fs.listFiles(hadoop_path, True), []
    while listed.hasNext():
        name = listed.next().getPath().toString()[len(root) + 1:]
        if name.rsplit("/", 1)[-1][:1] not in ("_", "."):
            names.append(name)
    return names


def subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    fs, hadoop_path = _filesystem(spark, path)
    return [status.getPath().toString() for status in fs.listStatus(hadoop_path)
            if status.isDirectory() and status.getPath().getName().startswith(prefix)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Store a small text: written under another name first, so it is there whole or not at all."""
    fs, hadoop_path = _filesystem(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.rename(draft, hadoop_path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _filesystem(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
