"""What the operators share: working tables, ranks, running totals, names that do not clash."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thornwall.session import workdir
from thornwall.sources.files import file_system, hadoop_path

#: ASCII white space, as in ``[\x20\x09-\x0D]``.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"

_BUCKET_ROWS = 16_384


_collectors: list[list[Scratch]] = []


class Scratch:
    """Working tables of one call, below the folder that all executors share.

    A table written here cuts the lineage: a lost executor costs the running
    stage, never the work before it, and a rerun reads the same rows.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{workdir(spark)}/llm-{uuid.uuid4().hex[:12]}"
        self._paths: dict[int, str] = {}
        self._tables = 0
        for collector in _collectors:
            collector.append(self)

    def keep(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self._tables}"
        self._tables += 1
        df.write.parquet(path)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = path
        return stored

    def keep_only(self, build: Callable[[], DataFrame]) -> DataFrame:
        """Store what ``build`` returns, and delete the working tables it made on the way."""
        made: list[Scratch] = []
        _collectors.append(made)
        try:
            stored = self.keep(build())
        finally:
            _collectors.remove(made)
        for scratch in made:
            scratch.remove()
        return stored

    def remove(self) -> None:
        """Delete all tables; nothing may read them any more."""
        file_system(self.spark, self.root).delete(hadoop_path(self.spark, self.root), True)

    def drop(self, stored: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        path = self._paths.pop(id(stored))
        file_system(self.spark, path).delete(hadoop_path(self.spark, path), True)


def small_batches(df: DataFrame) -> None:
    """Python workers get about 8 MB at a time in this session, rather than 64: texts can be long, and a worker's memory is not Spark's."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def named(column: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever the case."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def row_key(id_col: Column, digest: Column) -> Column:
    """One string for an id and a digest of the text; a null id has a key of its own."""
    return F.concat(F.coalesce(F.concat(F.lit("v"), id_col.cast("string")), F.lit("n")), F.lit(":"), F.coalesce(digest, F.lit("")))


def keep_one(docs: DataFrame, key: Column, keepers: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is in ``keepers.key``; of rows with one key the first by all columns."""
    k, n = fresh(docs, "key", "n")
    order = [named(c) for c, kind in docs.dtypes if not kind.startswith(("map", "variant"))]
    first = (
        docs.withColumn(k, key)
        .withColumn(n, F.row_number().over(Window.partitionBy(named(k)).orderBy(*order)))
        .filter(named(n) == 1)
    )
    return first.join(keepers.select(F.col("key").alias(k)), k, "left_semi").select(*map(named, docs.columns))


def measured(df: DataFrame, most_bytes: int = 16 << 20) -> DataFrame:
    """``df``, to be broadcast if a count of its rows and bytes proves it small; else Spark chooses when it runs."""
    size = F.count("*") * 16 * len(df.columns)
    for column, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.sum(F.octet_length(named(column))), F.lit(0))
    return F.broadcast(df) if df.agg(size).first()[0] <= most_bytes else df


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as ``times`` says; no array grows beyond 65,536 elements."""
    step = 65_536
    block, i = fresh(df, "block", "i")
    t = named(times)
    blocks = df.filter(t > 0).withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((t - 1) / step))))
    return blocks.withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(step), t - named(block) * step)))).drop(block, i)


def ranked(scratch: Scratch, df: DataFrame, *order: str | Column) -> DataFrame:
    """``df``, stored, with ``rank`` 0, 1, 2, ... in the given order, which must leave no ties.

    The sort is Spark's own distributed one; what meets in one place is a row
    per partition of it.
    """
    placed = scratch.keep(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned(F.col("_place"), 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    return (
        placed.withColumn("_part", part)
        .join(starts, "_part")
        .withColumn("rank", F.col("_start") + inside)
        .drop("_part", "_place", "_start")
    )


def running(df: DataFrame, value: str, out: str, rank: str = "rank") -> DataFrame:
    """``df`` with the sum of ``value`` over all rows of a smaller rank.

    Dense ranks make blocks of equal size; only block totals are added up in one place.
    """
    block = F.floor(F.col(rank) / _BUCKET_ROWS)
    inside = Window.partitionBy("_block").orderBy(rank).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(block.alias("_block")).agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_block", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    return (
        df.withColumn("_block", block)
        .withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, "_block")
        .withColumn(out, (F.col("_start") + F.col("_inside")).cast("long"))
        .drop("_block", "_inside", "_start")
    )
