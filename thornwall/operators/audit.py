"""Is what landed complete? Audits over page index rows, request windows and occurrences.

Page index rows have ``run_ts, chunk_start, chunk_end, page, total, records``,
one per landed page file.
"""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from thornwall.functions.cve import iso_z

CHUNK = ["run_ts", "chunk_start", "chunk_end"]

# Limits of the feed.
PAGE_SIZE = 2000
MAX_CHUNK_DAYS = 120
BACKFILL_DAYS = 365
INCREMENTAL_HOURS = 24

DAY_MICROS = 86_400_000_000


def instant(as_of: datetime.datetime | str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")


def ingest_summary(index: DataFrame, by: list[str] = CHUNK) -> DataFrame:
    """Files written and records taken in, per request window (or per run, with ``by=["run_ts"]``)."""
    return index.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.sum("records").alias("records"))


def page_completeness(index: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Request windows with pages or records missing, against the total the feed announced.

    A window of which no page says the total (all are cut short) is shown too.
    """
    per_chunk = index.groupBy(*CHUNK).agg(
        F.count(F.lit(1)).alias("pages"),
        F.max("total").alias("total"),
        F.sum("records").alias("records"),
        F.count_if(F.col("records") == 0).alias("empty_pages"),
    )
    expected = F.ceil(F.col("total") / F.lit(page_size)).cast("bigint")
    return per_chunk.withColumn("expected_pages", expected).where(
        (F.col("pages") < F.col("expected_pages")) | (F.col("records") < F.col("total")) | F.col("total").isNull()
    )


def window_gaps(index: DataFrame, across_runs: bool = False) -> DataFrame:
    """Stretches between request windows that no window covers, per run or over all runs.

    Windows may overlap or lie inside each other, so each start is compared with
    the latest end before it. File names give dates: after the first aggregation
    there is at most one row per run and calendar day, however many pages
    landed, and only those rows are put in order.
    """
    run = [] if across_runs else ["run_ts"]
    days = index.groupBy(*run, F.col("chunk_start").cast("date").alias("chunk_start")).agg(
        F.max(F.col("chunk_end").cast("date")).alias("chunk_end")
    )
    before = Window.partitionBy(*run).orderBy("chunk_start").rowsBetween(Window.unboundedPreceding, -1)
    return (
        days.withColumn("gap_start", F.max("chunk_end").over(before))
        .where(F.col("gap_start") < F.col("chunk_start"))
        .select(
            *run,
            "gap_start",
            F.col("chunk_start").alias("gap_end"),
            F.date_diff("chunk_start", "gap_start").alias("gap_days"),
        )
    )


def incremental_window(
    df: DataFrame, hours: int = INCREMENTAL_HOURS, as_of: datetime.datetime | str | None = None, ts: str = "modified_at"
) -> DataFrame:
    """Rows of the trailing hours, both ends included."""
    end = instant(as_of)
    return df.where(F.col(ts).between(end - F.make_dt_interval(hours=F.lit(hours)), end))


def backfill_window(
    df: DataFrame, days: int = BACKFILL_DAYS, as_of: datetime.datetime | str | None = None, ts: str = "modified_at"
) -> DataFrame:
    """Rows of the trailing days, both ends included."""
    return incremental_window(df, 24 * days, as_of, ts)


def request_windows(
    spark: SparkSession, start: datetime.datetime, end: datetime.datetime, max_days: int = MAX_CHUNK_DAYS
) -> DataFrame:
    """The windows a run has to ask the feed for, with their bounds in request format."""
    windows = math.ceil((end - start) / datetime.timedelta(days=max_days))
    begins, ends = _bounds(F.col("chunk"), instant(start), instant(end), max_days)
    return (
        spark.range(windows)
        .withColumnRenamed("id", "chunk")
        .withColumns({"chunk_start": begins, "chunk_end": ends})
        .withColumns({"request_start": iso_z(F.col("chunk_start")), "request_end": iso_z(F.col("chunk_end"))})
    )


def _bounds(chunk: Column, first: Column, last: Column, max_days: int) -> tuple[Column, Column]:
    """Window number ``chunk`` of a range; the last one ends with the range."""

    def cut(number: Column) -> Column:
        return F.timestamp_micros(F.unix_micros(first) + number * F.lit(max_days * DAY_MICROS))

    return cut(chunk), F.least(cut(chunk + 1), last)


def chunk_assign(
    df: DataFrame,
    start: datetime.datetime | str,
    end: datetime.datetime | str,
    max_days: int = MAX_CHUNK_DAYS,
    ts: str = "modified_at",
) -> DataFrame:
    """Each row with the request window(s) it falls into: ``chunk, chunk_start, chunk_end``.

    The range is cut every ``max_days``, the last window ends with the range.
    Neighbouring windows share their boundary instant, so a row on it belongs to
    both, once each.
    """
    first, last = instant(start), instant(end)
    width = max_days * DAY_MICROS
    into = F.unix_micros(F.col(ts)) - F.unix_micros(first)
    number = F.floor(into / F.lit(width)).cast("bigint")
    on_boundary = (into % F.lit(width) == 0) & (number > 0)
    chunks = (
        F.when(on_boundary & (F.col(ts) == last), F.array(number - 1))
        .when(on_boundary, F.array(number - 1, number))
        .otherwise(F.array(number))
    )
    begins, ends = _bounds(F.col("chunk"), first, last, max_days)
    return (
        df.where(F.col(ts).between(first, last))
        .withColumn("chunk", F.explode(chunks))
        .withColumns({"chunk_start": begins, "chunk_end": ends})
    )


def chunk_counts(df: DataFrame, start, end, max_days: int = MAX_CHUNK_DAYS, ts: str = "modified_at") -> DataFrame:
    """Rows per request window, with the first and last instant found."""
    return (
        chunk_assign(df, start, end, max_days, ts)
        .groupBy("chunk", "chunk_start", "chunk_end")
        .agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))
    )


def duplicate_versions(occurrence_rows: DataFrame) -> DataFrame:
    """CVE versions that landed more than once, and in how many files.

    Counted by (version, file) first: a version that makes up a third of all
    rows is spread over the files it came in, and no list of files is built.
    """
    per_file = occurrence_rows.groupBy("cve_id", "modified_at", "_ingest_file").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_file.groupBy("cve_id", "modified_at")
        .agg(
            F.sum("n").alias("occurrences"),
            F.count(F.lit(1)).alias("files"),
            F.min("_ingest_file").alias("first_file"),
            F.max("_ingest_file").alias("last_file"),
        )
        .where(F.col("occurrences") > 1)
    )
