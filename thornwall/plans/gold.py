"""Reporting tables, recomputed from the current CVEs."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thornwall.functions.cve import cvss_best as best_metric
from thornwall.functions.cve import score_any, severity_any

# Fixed values of the reporting tables.
UNKNOWN = "UNKNOWN"
RECENT_DAYS = 90
SHORT_TEXT = 280
CWE_ID = r"^CWE-\d+$"


def today(as_of: datetime.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def severity_daily(cves: DataFrame) -> DataFrame:
    """CVEs per publication day (UTC) and severity."""
    return (
        cves.groupBy(
            F.to_date("published_at").alias("day"),
            F.coalesce(severity_any(), F.lit(UNKNOWN)).alias("severity"),
        )
        .agg(F.count(F.lit(1)).alias("cve_count"))
        .orderBy(F.desc("day"), "severity")
    )


def recent_critical(cves: DataFrame, as_of: datetime.date | str | None = None, days: int = RECENT_DAYS) -> DataFrame:
    """Critical CVEs published since midnight ``days`` before ``as_of`` (default: today).

    The id ends the sort order: it makes the order total, and lets the range
    partitioning of the sort split a publication instant many CVEs share. A sort
    samples its input first; the few rows left are shuffled before it, so that
    the sample is taken from those and the table is not scanned twice.
    """
    return (
        cves.where(F.col("published_at") >= F.date_sub(today(as_of), days))
        .where(severity_any() == "CRITICAL")
        .select(
            "cve_id",
            "published_at",
            "modified_at",
            score_any().alias("cvss_score"),
            severity_any().alias("cvss_severity"),
            F.col("cvss_v31_vector").alias("cvss_vector"),
            F.substring("description_en", 1, SHORT_TEXT).alias("description_short"),
            "cwe_ids",
            F.array_size("reference_urls").alias("reference_count"),
            "vuln_status",
        )
        .hint("rebalance")
        .orderBy(F.desc("published_at"), F.desc("cvss_score"), "cve_id")
    )


def cwe_top(cves: DataFrame, k: int | None = None) -> DataFrame:
    """Weakness categories by number of CVEs, all of them or the first ``k``."""
    ranked = (
        cves.select(F.explode("cwe_ids").alias("cwe_id"))
        .where(F.col("cwe_id").rlike(CWE_ID))
        .groupBy("cwe_id")
        .agg(F.count(F.lit(1)).alias("cve_count"))
        .orderBy(F.desc("cve_count"), "cwe_id")
    )
    return ranked if k is None else ranked.limit(k)


def cvss_best(cves: DataFrame) -> DataFrame:
    """The metric of the newest CVSS version each CVE has, all fields from that version."""
    return cves.select("cve_id", best_metric().alias("m")).select(
        "cve_id",
        F.col("m.version").alias("cvss_version"),
        F.col("m.score").alias("cvss_score"),
        F.col("m.severity").alias("cvss_severity"),
        F.col("m.vector").alias("cvss_vector"),
    )


def top_sources(cves: DataFrame, k: int | None = None) -> DataFrame:
    """Reporting organisations by number of CVEs: the nearest there is to affected vendors."""
    ranked = (
        cves.groupBy("source_identifier")
        .agg(F.count(F.lit(1)).alias("cve_count"), F.count_if(severity_any() == "CRITICAL").alias("critical_count"))
        .orderBy(F.desc("cve_count"), "source_identifier")
    )
    return ranked if k is None else ranked.limit(k)


def top_vendors(records: DataFrame, k: int = 20) -> DataFrame:
    """The k vendors with most CVEs, from rows (cve_id, vendors) that hold each CVE once. Ties go to the smaller name."""
    counts = records.select("cve_id", F.explode(F.array_distinct("vendors")).alias("vendor")).groupBy("vendor").agg(F.count(F.lit(1)).alias("cve_count"))
    return counts.orderBy(F.desc("cve_count"), "vendor").limit(k)
