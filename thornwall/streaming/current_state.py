"""The current-state (SCD type 1) dataset behind the streaming upsert.

Plain Parquet cannot be updated in place: overwriting the directories that are
being read loses rows when the job dies between deleting and renaming. So
nothing is overwritten here::

    <root>/base/v000007-b00064/                 one row per key, bucketed by it
    <root>/folded/v000007-b00064                the change sets that base has taken in
    <root>/changes/<query>-<batch>/             one row per key of that batch
    <root>/merged/<name>/, <root>/sources/<name>  several change sets in one, and which

A micro-batch costs what it holds: it is reduced to one row per key and written
beside the base. Readers put the newer rows over the base. Many small change
sets are merged among themselves; only once their volume is a share of the
base's are they folded into the next base. Both go through a join in which only
the changes are shuffled; the base is read bucket by bucket, as it lies.

A change set belongs to no version: the newest base says which sets it holds,
and every other set is read beside it. So a batch stored while another process
folds is neither lost nor read too late, and a reader settles on one base first. Folds themselves are assumed to run one at a time.

The merge takes the highest sequence, so it may see a batch twice or in any
order: a replayed batch, or one that was already folded, changes nothing.
"""

from __future__ import annotations

import hashlib
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thornwall.operators.upsert import latest_by_key, merge_newest
from thornwall.session import settings
from thornwall.sources.files import (
    Versions,
    bucket_count,
    file_system,
    hadoop_path,
    is_complete,
    marked,
    qualified,
    size_in_bytes,
    subdirectories,
)

BUCKET_BYTES = 512 << 20
# Change sets beyond this many are merged into one.
MANY_SETS = 200
FOLD_RATIO = 0.25
# Changes of one bucket up to this size (compressed) are hashed in memory; larger ones are sorted, which can spill.
HASHED_BYTES = 16 << 20


class CurrentState:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: str,
        key: str,
        order: list[str],
        bucket_bytes: int = BUCKET_BYTES,
        min_buckets: int = 8,
    ):
        self.spark, self.schema, self.key, self.order = spark, schema, key, order
        self.root = qualified(spark, root)
        self.base = Versions(spark, f"{self.root}/base")
        self.bucket_bytes, self.min_buckets = bucket_bytes, min_buckets

    # --- writing ---------------------------------------------------------------

    def add_changes(self, rows: DataFrame, tag: str, order: list[str] | None = None) -> None:
        """Store the newest row per key of one batch. The same tag again replaces the batch's rows."""
        self.add_reduced(latest_by_key(rows, self.key, order or self.order), tag)

    def add_reduced(self, rows: DataFrame, tag: str) -> None:
        """``add_changes`` of rows that hold each key once.

        If the base holds a set of this tag already, the rows are kept beside it
        under another name: a replay changes nothing, and nothing is lost.
        """
        if tag in self._folded(self.base.latest()):
            tag = f"{tag}-again-{uuid.uuid4().hex[:8]}"
        kept = rows.select(*T.StructType.fromDDL(self.schema).names)
        marked(kept.write.mode("overwrite")).parquet(f"{self.root}/changes/{tag}")

    def fold(self) -> str | None:
        """Write the next base from the last one and the changes; returns its path."""
        base = self.base.latest()
        sets = self._change_sets(base)
        if not sets:
            return base
        volume = sum(size_in_bytes(self.spark, p) for p in sets) + (size_in_bytes(self.spark, base) if base else 0)
        buckets = bucket_count(base) if base else None
        wanted = 1 << math.ceil(math.log2(max(1, volume / self.bucket_bytes)))
        wanted = max(self.min_buckets, wanted)
        merged = self._merged(base, sets, buckets or wanted)
        if buckets and wanted >= 2 * buckets:
            # The dataset has outgrown its buckets; this one fold moves it all.
            buckets, merged = wanted, merged.repartition(wanted, self.key)
        # A task holds the rows of one bucket and so needs one open file. Without this
        # setting Spark sorts all rows by bucket before it writes them.
        limit = max(100_000, buckets or wanted)
        path = self.base.next(buckets or wanted)
        # Before the base counts: it must never be read without the list of what it holds.
        self._write_list(f"{self.root}/folded/{path.rsplit('/', 1)[-1]}", self._folded(base) | self._tags(sets))
        with settings(self.spark, {"spark.sql.maxConcurrentOutputFileWriters": 8, "spark.sql.sources.bucketing.maxBuckets": limit}):
            (
                marked(merged.write.format("parquet").bucketBy(buckets or wanted, self.key))
                .option("path", path)
                .saveAsTable(self._table_name(path))
            )
        return path

    def merge_changes(self) -> str | None:
        """Write the pending change sets as one; the base is left alone. Returns its path.

        The sets it came from are named beside it and read no more.
        """
        sets = self._change_sets(self.base.latest())
        if len(sets) < 2:
            return None
        volume = sum(size_in_bytes(self.spark, p) for p in sets)
        name = f"merged-{uuid.uuid4().hex}"
        self._write_list(f"{self.root}/sources/{name}", self._tags(sets))
        rows = self._merged(None, sets, max(1, math.ceil(volume / self.bucket_bytes)))
        marked(rows.write).parquet(f"{self.root}/merged/{name}")
        return f"{self.root}/merged/{name}"

    def fold_if_due(self, ratio: float = FOLD_RATIO, max_sets: int = MANY_SETS) -> str | None:
        """Fold once the changes reach a share of the base; merge them into one set if there are many.

        Growing by that share from fold to fold, a row of the base is rewritten about 1 / ratio times.
        """
        base = self.base.latest()
        sets = self._change_sets(base)
        pending = sum(size_in_bytes(self.spark, p) for p in sets)
        if sets and (base is None or pending >= ratio * size_in_bytes(self.spark, base)):
            return self.fold()
        if len(sets) >= max_sets:
            self.merge_changes()
        return base

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove superseded bases down to the newest ``keep``, and the change sets that all of those hold."""
        gone = self.base.vacuum(keep)
        for path in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._table_name(path)}")
            self._delete(f"{self.root}/folded/{path.rsplit('/', 1)[-1]}")
        bases = [f"{self.base.root}/{name}" for _, name in self.base.listed() if is_complete(self.spark, f"{self.base.root}/{name}")]
        if gone and bases:
            held = set.intersection(*(self._folded(path) for path in bases))
            for tag in held:
                for folder in ("changes", "merged"):
                    self._delete(f"{self.root}/{folder}/{tag}")
        return gone

    # --- reading ---------------------------------------------------------------

    def read(self) -> DataFrame:
        """One row per key, as of now."""
        base = self.base.latest()
        sets = self._change_sets(base)
        if sets:
            volume = sum(size_in_bytes(self.spark, p) for p in sets)
            fresh = max(self.min_buckets, math.ceil(volume / self.bucket_bytes))
            return self._merged(base, sets, bucket_count(base) if base else fresh)
        if base:
            return self.spark.read.schema(self.schema).parquet(base)
        return self.spark.createDataFrame([], self.schema)

    def pending(self) -> bool:
        """Whether there are changes that the base does not hold."""
        return bool(self._change_sets(self.base.latest()))

    def view_sql(self) -> str:
        """The dataset as one SELECT on its base table and pending change sets, for a view that outlives the session.

        The base is a bucketed table, so only the changes are shuffled. Later
        changes are not in it; a fold leaves it right, as its files stay until
        they are vacuumed.
        """
        base, columns = self.base.latest(), T.StructType.fromDDL(self.schema).names
        sets = self._change_sets(base)
        shown = ", ".join(columns)
        order = ", ".join(f"{o} AS _order{i}" for i, o in enumerate(self.order))
        if base:
            self._bucketed(base)
        current = self.spark.catalog.currentDatabase()
        table = f"{current}.{self._table_name(base)}" if base else None
        if not sets:
            nothing = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in T.StructType.fromDDL(self.schema))
            return f"SELECT {shown} FROM {table}" if base else f"SELECT {nothing} WHERE false"
        changes = " UNION ALL ".join(f"SELECT {shown} FROM parquet.`{path}`" for path in sets)
        newest = (
            f"SELECT {self.key}, max(struct({order}, struct({shown}) AS _row)) AS r "
            f"FROM ({changes}) WHERE {self.key} IS NOT NULL GROUP BY {self.key}"
        )
        if not base:
            return "SELECT " + ", ".join(f"r._row.{c} AS {c}" for c in columns) + f" FROM ({newest})"
        sequence = lambda side: "struct(" + ", ".join(f"{side}._order{i}" for i in range(len(self.order))) + ")"
        taken = f"n.{self.key} IS NOT NULL AND (b.{self.key} IS NULL OR {sequence('n.r')} > {sequence('b')})"
        picked = ", ".join(f"CASE WHEN {taken} THEN n.r._row.{c} ELSE b.{c} END AS {c}" for c in columns)
        return f"SELECT {picked} FROM (SELECT {shown}, {order} FROM {table}) b FULL OUTER JOIN ({newest}) n ON b.{self.key} = n.{self.key}"

    # --- parts -----------------------------------------------------------------

    def _write_list(self, path: str, names: set[str]) -> None:
        rows = self.spark.createDataFrame([(name,) for name in sorted(names)], "name string").coalesce(1)
        marked(rows.write.mode("overwrite")).text(path)

    def _read_list(self, path: str) -> set[str]:
        return {r[0] for r in self.spark.read.text(path).collect()} if is_complete(self.spark, path) else set()

    def _delete(self, path: str) -> None:
        file_system(self.spark, path).delete(hadoop_path(self.spark, path), True)

    def _folded(self, base: str | None) -> set[str]:
        """The tags of the change sets in a base."""
        return self._read_list(f"{self.root}/folded/{base.rsplit('/', 1)[-1]}") if base else set()

    def _sources(self, merged: str) -> set[str]:
        return self._read_list(f"{self.root}/sources/{merged}")

    def _tags(self, sets: list[str]) -> set[str]:
        """The names of the sets and of all that merged ones came from."""
        names = {p.rsplit("/", 1)[-1] for p in sets}
        return names.union(*(self._sources(n) for n in names if n.startswith("merged-")))

    def _change_sets(self, base: str | None) -> list[str]:
        """The complete sets that neither the base nor a merged set holds.

        Sets are listed before merged ones: a set that is merged in between is
        then read twice, which changes nothing, rather than not at all.
        """
        held = self._folded(base)
        found = [p for n in subdirectories(self.spark, f"{self.root}/changes") if n not in held and is_complete(self.spark, p := f"{self.root}/changes/{n}")]
        merged = [p for n in subdirectories(self.spark, f"{self.root}/merged") if n not in held and is_complete(self.spark, p := f"{self.root}/merged/{n}")]
        inside = set().union(*(self._sources(p.rsplit("/", 1)[-1]) for p in merged))
        return [p for p in found + merged if p.rsplit("/", 1)[-1] not in inside]

    def _merged(self, base: str | None, sets: list[str], buckets: int) -> DataFrame:
        # Hashed once into the base's buckets; reducing them and joining the base need no further shuffle.
        changes = self.spark.read.schema(self.schema).parquet(*sets).repartition(buckets, F.col(self.key))
        changes = latest_by_key(changes, self.key, self.order)
        if base is None:
            return changes
        volume = sum(size_in_bytes(self.spark, p) for p in sets)
        return merge_newest(
            self._bucketed(base), changes, self.key, self.order, hash_changes=volume <= buckets * HASHED_BYTES
        )

    def _table_name(self, path: str) -> str:
        return f"thornwall_state_{hashlib.md5(path.encode()).hexdigest()}"

    def _bucketed(self, path: str) -> DataFrame:
        """The base as a bucketed table; only a table can tell Spark how its files are hashed."""
        name, location = self._table_name(path), path.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({self.schema}) USING parquet "
            f"CLUSTERED BY ({self.key}) INTO {bucket_count(path)} BUCKETS LOCATION '{location}'"
        )
        return self.spark.table(name)
