"""Trending CVEs: days on which a CVE is touched more than it lately was."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trending_cves(occurrence_rows: DataFrame, days: int = 7, ts: str = "modified_at") -> DataFrame:
    """Occurrences per CVE and day, set against the mean of the preceding ``days``.

    ``trailing_mean`` divides by all those days, active or not; a CVE trends on a
    day with more occurrences than that. The count comes first, so that a CVE
    brings at most one row per calendar day to the window.
    """
    daily = (
        occurrence_rows.groupBy("cve_id", F.to_date(ts).alias("day"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .withColumn("_day", F.unix_date("day"))
    )
    trailing = Window.partitionBy("cve_id").orderBy("_day").rangeBetween(-days, -1)
    before = F.coalesce(F.sum("occurrences").over(trailing), F.lit(0))
    return (
        daily.withColumn("trailing_mean", before / F.lit(days))
        .where(F.col("occurrences") > F.col("trailing_mean"))
        .select("cve_id", "day", "occurrences", "trailing_mean")
    )
