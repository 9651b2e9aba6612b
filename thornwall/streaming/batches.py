"""Rows of micro-batches, stored by day, replay-safe, compacted and expired by day.

::

    <root>/day=2024-01-02/<tag>/        the rows of one micro-batch
    <root>/day=2024-01-02/all-<name>/   a closed day in one set ...
    <root>/held/day=2024-01-02/all-<name>/  ... and the tags it holds

A batch is written whole under its tag; written again, after a crash, it replaces
itself. A folder counts from its marker on. A closed day's sets are read until
the one that holds them all is complete, and deleted after that.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession

from thornwall.sources.files import file_system, hadoop_path, is_complete, marked, qualified, subdirectories

_DAY = "day="


def batch_tag(spark: SparkSession, batch_id: int) -> str:
    """The name of a micro-batch. Checkpoints number theirs from 0; the query id tells them apart."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id:09d}"


class Batches:
    """``schema``: DDL of the rows. The day of a batch must follow from its rows, so that a replay finds it again."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, qualified(spark, root), schema

    def add(self, rows: DataFrame, tag: str, day: datetime.date) -> str:
        """Store the rows of a batch; one that a compacted day holds already is not stored again."""
        path = f"{self.root}/{_DAY}{day.isoformat()}/{tag}"
        if not self.holds(tag, day):
            marked(rows.write.mode("overwrite")).parquet(path)
        return path

    def holds(self, tag: str, day: datetime.date) -> bool:
        """Whether a compacted set has the batch."""
        return tag in self._held(day.isoformat())

    def days(self) -> list[str]:
        return [name[len(_DAY) :] for name in subdirectories(self.spark, self.root) if name.startswith(_DAY)]

    def sets(self, day: str) -> list[str]:
        """The complete sets of a day, without those that a compacted one holds."""
        where = f"{self.root}/{_DAY}{day}"
        complete = [name for name in subdirectories(self.spark, where) if is_complete(self.spark, f"{where}/{name}")]
        held = self._held(day)
        return [f"{where}/{name}" for name in complete if name not in held]

    def read(self, first: datetime.date | None = None, last: datetime.date | None = None) -> DataFrame:
        """All rows, or those of the days from ``first`` to ``last``; other days are not even listed."""
        days = [d for d in self.days() if (first is None or d >= first.isoformat()) and (last is None or d <= last.isoformat())]
        paths = [path for day in days for path in self.sets(day)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def compact(self, before: datetime.date, files: int = 1) -> list[str]:
        """Bring every day before the given one into one set of ``files`` files; returns the days."""
        done = []
        for day in self.days():
            sets = self.sets(day) if day < before.isoformat() else []
            if len(sets) > 1:
                name = f"all-{uuid.uuid4().hex}"
                tags = {path.rsplit("/", 1)[-1] for path in sets}
                held = self.spark.createDataFrame([(tag,) for tag in sorted(tags | self._held(day))], "tag string").coalesce(1)
                marked(held.write).text(f"{self.root}/held/{_DAY}{day}/{name}")
                rows = self.spark.read.schema(self.schema).parquet(*sets)
                marked(rows.coalesce(files).write).parquet(f"{self.root}/{_DAY}{day}/{name}")
                for path in sets:
                    self._delete(path)
                done.append(day)
        return done

    def expire(self, before: datetime.date) -> list[str]:
        """Delete the days before the given one; returns them."""
        gone = [day for day in self.days() if day < before.isoformat()]
        for day in gone:
            self._delete(f"{self.root}/{_DAY}{day}")
            self._delete(f"{self.root}/held/{_DAY}{day}")
        return gone

    def _held(self, day: str) -> set[str]:
        """The tags in the compacted set of a day; its list counts once the set itself is complete."""
        lists = f"{self.root}/held/{_DAY}{day}"
        names = [name for name in subdirectories(self.spark, lists) if is_complete(self.spark, f"{self.root}/{_DAY}{day}/{name}")]
        return {r[0] for name in names for r in self.spark.read.text(f"{lists}/{name}").collect()}

    def _delete(self, path: str) -> None:
        file_system(self.spark, path).delete(hadoop_path(self.spark, path), True)
