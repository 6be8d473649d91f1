"""Questions to the file system, whichever one the path is on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _matches(spark: SparkSession, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(files.globStatus(path) or [])


def holds_file(spark: SparkSession, root: str, ending: str) -> bool:
    """Whether any file below ``root`` has this ending; files are listed up to the first one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return False
    files = system.listFiles(path, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(ending):
            return True
    return False


def size(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files below the matching paths."""
    files = spark._jvm.org.apache.hadoop.fs.Path(pattern).getFileSystem(spark._jsc.hadoopConfiguration())
    return sum(files.getContentSummary(m.getPath()).getLength() for m in _matches(spark, pattern))


def fingerprint(spark: SparkSession, pattern: str) -> str:
    """Changes whenever a matching file is added, removed or rewritten, but not when it is read.

    Made of path, length and modification time; a file's status also has the time of the last access.
    """
    return "\n".join(sorted(f"{m.getPath()} {m.getLen()} {m.getModificationTime()}" for m in _matches(spark, pattern)))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, True).close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the matching files and folders, sorted."""
    return sorted(m.getPath().getName() for m in _matches(spark, pattern))
