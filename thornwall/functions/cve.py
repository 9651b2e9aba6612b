"""Column expressions over CVE records. All tolerate missing data, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first(items: Column) -> Column:
    """Element 0, NULL for an empty array (a plain subscript raises there in ANSI mode)."""
    return F.get(items, F.lit(0))


def english(texts: Column) -> Column:
    """The value of the first entry in English."""
    return first(F.filter(texts, lambda text: text["lang"] == "en"))["value"]


def weakness_ids(weaknesses: Column) -> Column:
    """One id per weakness, each kept once. A weakness without English text leaves a NULL."""
    return F.array_distinct(F.transform(weaknesses, lambda weakness: english(weakness["description"])))


def metric(metrics: Column, version: str) -> Column:
    """The first entry listed for a CVSS version, whoever supplied it."""
    return first(metrics[f"cvssMetric{version}"])


def score(metric_entry: Column) -> Column:
    return metric_entry["cvssData"]["baseScore"].try_cast("double")


def parsed_time(text: Column) -> Column:
    """Text without a zone is UTC; unreadable text becomes NULL and is left to the expectations."""
    return F.try_to_timestamp(text)


def iso_z(ts: Column) -> Column:
    """Request timestamp format: UTC, fractions cut to a literal ``.000``."""
    return F.date_format(F.date_trunc("second", ts), "yyyy-MM-dd'T'HH:mm:ss.SSS")


# Best-known CVSS version first.
SEVERITY_COLUMNS = ("cvss_v31_severity", "cvss_v30_severity", "cvss_v2_severity")
SCORE_COLUMNS = ("cvss_v31_score", "cvss_v30_score", "cvss_v2_score")


def severity_any() -> Column:
    return F.coalesce(*SEVERITY_COLUMNS)


def score_any() -> Column:
    return F.coalesce(*SCORE_COLUMNS)


def cvss_best() -> Column:
    """Score, severity and vector of one and the same CVSS version.

    ``severity_any`` and ``score_any`` pick independently and may mix versions.
    A version counts when it has a score or a severity.
    """

    def of(version: str, score_col: str, severity_col: str, vector: Column) -> Column:
        found = F.col(score_col).isNotNull() | F.col(severity_col).isNotNull()
        return F.when(
            found,
            F.struct(
                F.lit(version).alias("version"),
                F.col(score_col).alias("score"),
                F.col(severity_col).alias("severity"),
                vector.alias("vector"),
            ),
        )

    no_vector = F.lit(None).cast("string")
    return F.coalesce(
        of("3.1", SCORE_COLUMNS[0], SEVERITY_COLUMNS[0], F.col("cvss_v31_vector")),
        of("3.0", SCORE_COLUMNS[1], SEVERITY_COLUMNS[1], no_vector),
        of("2.0", SCORE_COLUMNS[2], SEVERITY_COLUMNS[2], no_vector),
    )
