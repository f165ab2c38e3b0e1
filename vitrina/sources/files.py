"""Driver-side file-system metadata calls through the Hadoop FileSystem API.

Only names, renames and removals go through here (no data), so the same
code works on a local disk, HDFS or an object store the cluster mounts.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, directory: str) -> list[str]:
    fs, p = _fs(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(str(st.getPath().getName()) for st in fs.listStatus(p))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength())


def mkdirs(spark: SparkSession, directory: str) -> None:
    fs, p = _fs(spark, directory)
    fs.mkdirs(p)


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    """Atomic rename (a file becomes visible to a file stream in one step)."""
    fs, p = _fs(spark, src)
    jvm = spark._jvm
    return bool(fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)))


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder."""
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))
