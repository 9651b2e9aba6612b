import datetime

import pytest

from thornwall.plans import gold
from thornwall.schema import SILVER_SCHEMA

AS_OF = "2024-04-30"


@pytest.fixture
def cves(spark):
    fields = [f.name for f in spark.createDataFrame([], SILVER_SCHEMA).schema]

    def build(*rows):
        published = datetime.datetime(2024, 4, 1, tzinfo=datetime.timezone.utc)
        filled = [{"published_at": published, "modified_at": published} | row for row in rows]
        return spark.createDataFrame([tuple(r.get(f) for f in fields) for r in filled], SILVER_SCHEMA)

    return build


def utc(*parts):
    return datetime.datetime(*parts, tzinfo=datetime.timezone.utc)


def test_daily_counts(cves):
    rows = gold.severity_daily(
        cves(
            {"cve_id": "a", "cvss_v31_severity": "HIGH", "cvss_v2_severity": "LOW"},
            {"cve_id": "b", "cvss_v30_severity": "HIGH"},
            {"cve_id": "c", "cvss_v2_severity": "LOW"},
            {"cve_id": "d"},
            {"cve_id": "e", "published_at": utc(2024, 4, 2, 23, 59, 59)},
        )
    ).collect()
    assert [tuple(r) for r in rows] == [
        (datetime.date(2024, 4, 2), "UNKNOWN", 1),
        (datetime.date(2024, 4, 1), "HIGH", 2),
        (datetime.date(2024, 4, 1), "LOW", 1),
        (datetime.date(2024, 4, 1), "UNKNOWN", 1),
    ]


def test_recent_critical(cves):
    edge = utc(2024, 1, 31)
    rows = gold.recent_critical(
        cves(
            {"cve_id": "v30", "cvss_v30_severity": "CRITICAL", "cvss_v30_score": 9.1, "description_en": "x" * 500},
            {"cve_id": "mixed", "cvss_v31_severity": "CRITICAL", "cvss_v2_score": 5.0, "cvss_v31_vector": "V"},
            {"cve_id": "noscore", "cvss_v31_severity": "CRITICAL", "reference_urls": ["u", "u"], "cwe_ids": ["CWE-1", None]},
            {"cve_id": "edge", "cvss_v31_severity": "CRITICAL", "published_at": edge},
            {"cve_id": "late", "cvss_v31_severity": "CRITICAL", "published_at": edge - datetime.timedelta(microseconds=1)},
            {"cve_id": "none"},
            {"cve_id": "high", "cvss_v31_severity": "HIGH"},
        ),
        AS_OF,
    ).collect()
    # newest first, then highest score, a missing score last
    assert [r["cve_id"] for r in rows] == ["v30", "mixed", "noscore", "edge"]
    v30, mixed, noscore, _ = rows
    assert len(v30["description_short"]) == 280 and v30["cvss_vector"] is None and v30["reference_count"] is None
    assert (mixed["cvss_score"], mixed["cvss_severity"]) == (5.0, "CRITICAL")
    assert noscore["reference_count"] == 2 and noscore["cwe_ids"] == ["CWE-1", None] and noscore["cvss_score"] is None


def test_recent_critical_counts_from_today_by_default(cves):
    now = datetime.datetime.now(datetime.timezone.utc)
    rows = gold.recent_critical(
        cves(
            {"cve_id": "new", "cvss_v31_severity": "CRITICAL", "published_at": now - datetime.timedelta(days=80)},
            {"cve_id": "old", "cvss_v31_severity": "CRITICAL", "published_at": now - datetime.timedelta(days=92)},
        )
    ).collect()
    assert [r["cve_id"] for r in rows] == ["new"]


def test_weakness_ranking(cves):
    df = cves(
        {"cve_id": "a", "cwe_ids": ["CWE-79", "NVD-CWE-noinfo", None]},
        {"cve_id": "b", "cwe_ids": ["CWE-79", "CWE-20"]},
        {"cve_id": "c", "cwe_ids": []},
        {"cve_id": "d"},
        {"cve_id": "e", "cwe_ids": ["xCWE-1", "CWE-1x", "CWE-"]},
    )
    assert [tuple(r) for r in gold.cwe_top(df).collect()] == [("CWE-79", 2), ("CWE-20", 1)]
    assert [tuple(r) for r in gold.cwe_top(df, 1).collect()] == [("CWE-79", 2)]


def test_best_metric_is_of_one_version(cves):
    rows = gold.cvss_best(
        cves(
            {"cve_id": "a", "cvss_v31_severity": "HIGH", "cvss_v2_score": 5.0, "cvss_v31_vector": "V"},
            {"cve_id": "b", "cvss_v2_score": 5.0, "cvss_v2_severity": "MEDIUM"},
            {"cve_id": "c"},
        )
    ).collect()
    assert sorted(tuple(r) for r in rows if r["cve_id"] != "c") == [
        ("a", "3.1", None, "HIGH", "V"),
        ("b", "2.0", 5.0, "MEDIUM", None),
    ]
    assert [tuple(r) for r in rows if r["cve_id"] == "c"] == [("c", None, None, None, None)]


def test_date_bound_reaches_the_scan(spark, cves, tmp_path):
    cves({"cve_id": "a"}).write.parquet(str(tmp_path / "cves"))
    plan = gold.recent_critical(spark.read.parquet(str(tmp_path / "cves")), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(published_at" in plan
