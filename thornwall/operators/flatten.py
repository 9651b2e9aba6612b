"""Pages -> occurrences -> the flat columns of the current-state table. Narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thornwall.functions import cve as fx
from thornwall.schema import POSITION


def occurrences(pages: DataFrame) -> DataFrame:
    """One row per CVE in a page; pages without any yield none. The place in the page is kept to break ties."""
    return pages.select(F.posexplode("vulnerabilities").alias(POSITION, "v"), "_ingest_ts", "_ingest_file").select(
        POSITION, F.col("v.cve").alias("cve"), "_ingest_ts", "_ingest_file"
    )


def _columns() -> dict[str, Column]:
    record = F.col("cve")
    v31, v30, v2 = (fx.metric(record["metrics"], version) for version in ("V31", "V30", "V2"))
    return {
        "cve_id": record["id"],
        "published_at": fx.parsed_time(record["published"]),
        "modified_at": fx.parsed_time(record["lastModified"]),
        "vuln_status": record["vulnStatus"],
        "source_identifier": record["sourceIdentifier"],
        "description_en": fx.english(record["descriptions"]),
        "cvss_v31_score": fx.score(v31),
        "cvss_v31_severity": v31["cvssData"]["baseSeverity"],
        "cvss_v31_vector": v31["cvssData"]["vectorString"],
        "cvss_v30_score": fx.score(v30),
        "cvss_v30_severity": v30["cvssData"]["baseSeverity"],
        "cvss_v2_score": fx.score(v2),
        # Version 2 entries carry their severity beside the data block, not in it.
        "cvss_v2_severity": v2["baseSeverity"],
        "cwe_ids": fx.weakness_ids(record["weaknesses"]),
        "reference_urls": F.transform(record["references"], lambda reference: reference["url"]),
    }


def flatten(occurrence_rows: DataFrame, *names: str, position: bool = False, **more: Column) -> DataFrame:
    """The 15 record columns (or those named), ``more`` of the record, and the ingest columns; works on batches and streams."""
    columns = _columns()
    picked = [columns[name].alias(name) for name in (names or columns)] + [column.alias(name) for name, column in more.items()]
    return occurrence_rows.select(*picked, "_ingest_ts", "_ingest_file", *([POSITION] if position else []))
