"""Small file-system helpers on any path that Spark can open (Hadoop file systems)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted; empty when nothing does."""
    fs, path = _open(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(path) or [])


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.mkdirs(hadoop_path)


def modified(spark: SparkSession, path: str) -> float:
    """When a path was last changed, in seconds; 0 when there is none."""
    fs, hadoop_path = _open(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime() / 1000 if fs.exists(hadoop_path) else 0.0


def newest(spark: SparkSession, path: str) -> float:
    """When anything under a path was last changed, in seconds."""
    fs, hadoop_path = _open(spark, path)
    last = modified(spark, path)
    found = fs.listFiles(hadoop_path, True)
    while found.hasNext():
        last = max(last, found.next().getModificationTime() / 1000)
    return last


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, hadoop_path = _open(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open(spark, path)
    size = fs.getFileStatus(hadoop_path).getLen()
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()
