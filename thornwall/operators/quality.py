"""Named row expectations: drop, count, quarantine."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


def holds(predicate: str) -> Column:
    """True only when the predicate is true; NULL counts as failed."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def all_hold(rules: dict[str, str]) -> Column:
    return reduce(and_, (holds(p) for p in rules.values()))


def expect_all_or_drop(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    return df.where(all_hold(rules))


def quarantine(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """The rows ``expect_all_or_drop`` removes, with the names of the rules they failed."""
    failed = F.array_compact(F.array(*(F.when(~holds(p), F.lit(name)) for name, p in rules.items())))
    return df.withColumn("failed_rules", failed).where(F.array_size("failed_rules") > 0)


def _failures(rules: dict[str, str]) -> dict[str, Column]:
    return {name: F.count_if(~holds(p)) for name, p in rules.items()}


def rule_counts(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """(expectation, passed_records, failed_records) for all rules from one pass over the rows."""
    failures = _failures(rules)
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), *(c.alias(name) for name, c in failures.items()))
    rows = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(name).alias("expectation"),
                    (F.col("_rows") - F.col(name)).alias("passed_records"),
                    F.col(name).alias("failed_records"),
                )
                for name in failures
            )
        )
    )
    return totals.select(rows.alias("r")).select("r.*")


def observed(df: DataFrame, name: str | Observation, rules: dict[str, str]) -> DataFrame:
    """Count rows and failures on the way through, without a pass of its own.

    With a string name the counts appear in a streaming query's progress. Tasks
    in front of a shuffle that run again, after an executor is lost, count again.
    """
    return df.observe(name, F.count(F.lit(1)).alias("records"), *(c.alias(n) for n, c in _failures(rules).items()))


def rate_changes(df: DataFrame, rules: dict[str, str], day: str, days: int = 7) -> DataFrame:
    """(day, expectation, records, failed, rate, trailing_rate, change): failures of a day against those of the ``days`` before it.

    ``trailing_rate`` is over the days among them that have rows; null without
    any. Rows are counted per day before anything is ordered.
    """
    counts = df.groupBy(F.to_date(day).alias("day")).agg(F.count(F.lit(1)).alias("records"), *(c.alias(f"_{name}") for name, c in _failures(rules).items()))
    per_rule = F.explode(F.array(*(F.struct(F.lit(name).alias("expectation"), F.col(f"_{name}").alias("failed")) for name in rules)))
    daily = counts.where("day is not null").select("day", "records", per_rule.alias("r")).select("day", "r.expectation", "records", "r.failed")
    number = F.unix_date("day")
    before = Window.partitionBy("expectation").orderBy(number).rangeBetween(-days, -1)
    trailing = F.sum("failed").over(before) / F.sum("records").over(before)
    rated = daily.withColumn("rate", F.col("failed") / F.col("records")).withColumn("trailing_rate", trailing)
    return rated.withColumn("change", F.col("rate") - F.col("trailing_rate"))
