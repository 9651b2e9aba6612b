"""Immutable numbered output directories on whatever file system the session uses."""

from __future__ import annotations

import re

from pyspark.sql import DataFrameWriter, SparkSession

_VERSION = re.compile(r"^v(\d{6,})(?:-b(\d+))?$")


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified(spark: SparkSession, path: str) -> str:
    return file_system(spark, path).makeQualified(hadoop_path(spark, path)).toString()


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    fs, where = file_system(spark, path), hadoop_path(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Spark writes the marker only after every task's output is in place."""
    return file_system(spark, path).exists(hadoop_path(spark, f"{path}/_SUCCESS"))


def size_in_bytes(spark: SparkSession, path: str) -> int:
    return file_system(spark, path).getContentSummary(hadoop_path(spark, path)).getLength()


def modified_at(spark: SparkSession, path: str) -> float:
    """Seconds since 1970."""
    return file_system(spark, path).getFileStatus(hadoop_path(spark, path)).getModificationTime() / 1000


def set_modified_at(spark: SparkSession, path: str, seconds: float) -> None:
    file_system(spark, path).setTimes(hadoop_path(spark, path), int(seconds * 1000), -1)


def marked(writer: DataFrameWriter) -> DataFrameWriter:
    """Make sure the writer leaves the marker, also where the cluster turned it off."""
    return writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")


class Versions:
    """Numbered directories ``v000001``, ``v000002``, … below one root.

    A version is written once into a directory of its own and counts from its
    marker on. Readers thus see the old version or the new one, whole, and a job
    that dies half-way leaves nothing but an unused directory.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def listed(self) -> list[tuple[int, str]]:
        found = [(m, name) for name in subdirectories(self.spark, self.root) if (m := _VERSION.match(name))]
        return sorted((int(m.group(1)), name) for m, name in found)

    def latest(self) -> str | None:
        for _, name in reversed(self.listed()):
            if is_complete(self.spark, f"{self.root}/{name}"):
                return f"{self.root}/{name}"
        return None

    def next(self, buckets: int | None = None) -> str:
        taken = self.listed()
        number = taken[-1][0] + 1 if taken else 1
        return f"{self.root}/v{number:06d}" + (f"-b{buckets:05d}" if buckets else "")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all but the newest complete versions (and whatever is newer than them)."""
        complete = [n for n, name in self.listed() if is_complete(self.spark, f"{self.root}/{name}")]
        if len(complete) <= keep:
            return []
        gone = [f"{self.root}/{name}" for n, name in self.listed() if n < complete[-keep]]
        for path in gone:
            file_system(self.spark, path).delete(hadoop_path(self.spark, path), True)
        return gone


def bucket_count(path: str) -> int | None:
    """The bucket count is part of the directory name: a wrong one would give wrong joins."""
    buckets = _VERSION.match(path.rsplit("/", 1)[-1]).group(2)
    return int(buckets) if buckets else None
