"""Names, types and labels shared by all layers."""

from __future__ import annotations

# Fields of one CVE record in a landed page, as far as they are read.
CVE_FIELDS = {
    "id": "string",
    "published": "string",
    "lastModified": "string",
    "vulnStatus": "string",
    "sourceIdentifier": "string",
    "descriptions": "array<struct<lang:string,value:string>>",
    "metrics": (
        "struct<"
        "cvssMetricV31:array<struct<cvssData:struct<baseScore:double,baseSeverity:string,vectorString:string>>>,"
        "cvssMetricV30:array<struct<cvssData:struct<baseScore:double,baseSeverity:string>>>,"
        "cvssMetricV2:array<struct<baseSeverity:string,cvssData:struct<baseScore:double>>>>"
    ),
    "weaknesses": "array<struct<description:array<struct<lang:string,value:string>>>>",
    "references": "array<struct<url:string>>",
}

PAGE_COUNTERS = "resultsPerPage bigint, startIndex bigint, totalResults bigint"
CORRUPT = "_corrupt_record"
INGEST_COLUMNS = "_ingest_ts timestamp, _ingest_file string"

KEY = "cve_id"
#: The run a page belongs to, as its file name says.
RUN = "regexp_extract(_ingest_file, '_p[0-9]{3,}_([A-Za-z0-9_]+)[.]json$', 1)"
SEQUENCE = ["modified_at", RUN, "_ingest_file"]
POSITION = "_position"

SILVER_SCHEMA = (
    "cve_id string, published_at timestamp, modified_at timestamp, vuln_status string, source_identifier string, "
    "description_en string, cvss_v31_score double, cvss_v31_severity string, cvss_v31_vector string, "
    "cvss_v30_score double, cvss_v30_severity string, cvss_v2_score double, cvss_v2_severity string, "
    "cwe_ids array<string>, reference_urls array<string>, _ingest_ts timestamp, _ingest_file string"
)

# Rows that fail any of these never reach the current-state table.
EXPECTATIONS = {
    "valid_cve_id": "cve_id IS NOT NULL",
    "valid_published": "published_at IS NOT NULL",
    "valid_modified": "modified_at IS NOT NULL",
}

# Dataset names, with the layer and the text shown in a catalog.
DATASETS = {
    "nvd_cves_raw": ("bronze", "Landed CVE pages as read, one row per page file"),
    "cves_exploded": ("silver", "One row per CVE occurrence that meets the expectations; a view, not stored"),
    "cves": ("silver", "Current version of each CVE"),
    "cve_severity_daily": ("gold", "CVEs per publication day and severity"),
    "cve_recent_critical": ("gold", "Critical CVEs of the trailing window"),
    "cve_cwe_top": ("gold", "Weakness categories by number of CVEs"),
    "alerts": ("gold", "Rows that match a detection rule, counted per rule, asset and day"),
    "alerts_triaged": ("gold", "Alerts with CVE and technique context, calibrated severity and confidence"),
}


def page_schema(*fields: str) -> str:
    """DDL of a page that holds only the given CVE fields (all, if none is given).

    Spark does not prune the fields of an exploded struct once two of them are
    used, so a query that needs few of them says so in its read schema.
    """
    record = ",".join(f"`{name}`:{CVE_FIELDS[name]}" for name in (fields or CVE_FIELDS))
    return f"{PAGE_COUNTERS}, vulnerabilities array<struct<cve:struct<{record}>>>, {CORRUPT} string"
