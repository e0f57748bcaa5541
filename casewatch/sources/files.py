"""Listing and deleting through the file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`, sorted; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at `path`; one that is there stays."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    fs.createNewFile(p)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already. Of several callers one succeeds."""
    from py4j.protocol import Py4JJavaError
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    try:
        fs.create(p, False).close()
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    return True


def age_seconds(spark: SparkSession, path: str) -> float:
    """Since the file was written, by this machine's clock."""
    import time
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def fingerprint(spark: SparkSession, path: str) -> str:
    """Paths, sizes and modification times of the files below `path`, as one string."""
    fs, p = _fs(spark, path)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        s = it.next()
        found.append(f"{s.getPath()}|{s.getLen()}|{s.getModificationTime()}")
    return "\n".join(sorted(found))
