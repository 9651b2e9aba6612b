"""Latest version per key, in any order of arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from thornwall.operators.quality import all_hold, holds


def _ordering(df: DataFrame, order: list[str], prefix: str = "") -> list[Column]:
    """The parts of an order, each a column or an SQL expression on columns, under names of their own."""
    return [F.col(o).alias(f"{prefix}{o}") if o in df.columns else F.expr(o).alias(f"{prefix}_order{i}") for i, o in enumerate(order)]


def latest_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key: the one with the highest ``order``, ties broken by the other columns.

    ``order`` names columns, or SQL expressions on them.

    A plain maximum over the row, sequence first. Each task thus reduces its rows
    to one per key before the shuffle, so a key that holds a third of all rows
    sends one row per task. NULL keys form no group.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    newest = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*_ordering(df, order), *rest)).alias("_row"))
    return newest.select(*(F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns))


def latest_valid_by_key(df: DataFrame, key: str, order: list[str], rules: dict[str, str], counts: Observation) -> DataFrame:
    """``latest_by_key`` of the rows that meet all rules, with ``counts`` of all records and of failures per rule.

    Rows that fail travel as counters only. The counters are added up after the
    shuffle, in the stage that delivers the result: there Spark takes each task's
    contribution once, also when an executor is lost and tasks run again.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    row = F.when(all_hold(rules) & F.col(key).isNotNull(), F.struct(*_ordering(df, order), *rest))
    grouped = df.groupBy(key).agg(
        F.max(row).alias("_row"),
        F.count(F.lit(1)).alias("_records"),
        *(F.count_if(~holds(predicate)).alias(f"_failed_{name}") for name, predicate in rules.items()),
    )
    counted = grouped.observe(
        counts, F.sum("_records").alias("records"), *(F.sum(f"_failed_{name}").alias(name) for name in rules)
    )
    kept = counted.where(F.col("_row").isNotNull())
    return kept.select(*(F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns))


def merge_newest(current: DataFrame, changes: DataFrame, key: str, order: list[str], hash_changes: bool) -> DataFrame:
    """``current`` with every newer row of ``changes`` put in. Both hold one row per key.

    A full outer join: with both sides hashed alike on the key it moves nothing,
    and with ``hash_changes`` the changes of a partition are held in memory so
    that the much larger current side is not even sorted. At equal order the
    current row stays. Columns are picked one by one, so that a query on few
    columns reads few.
    """
    columns = current.columns
    computed = [o for o in order if o not in columns]
    new = changes.select(*(F.col(c).alias(f"_new_{c}") for c in columns), *_ordering(changes, computed, "_new"))
    newest = [f"_new_{o}" if o in columns else f"_new_order{computed.index(o)}" for o in order]
    if hash_changes:
        new = new.hint("shuffle_hash")
    joined = current.join(new, F.col(key) == F.col(f"_new_{key}"), "full_outer")
    newer = F.col(key).isNull() | (F.struct(*newest) > F.struct(*_ordering(current, order)))
    take_new = F.col(f"_new_{key}").isNotNull() & newer
    return joined.select(*(F.when(take_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns))
