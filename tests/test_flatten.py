"""Reading and flattening pages: missing, malformed and repeated data."""

import json

import pytest
from feed import NAME, cve, page, text, v2, v3, weakness

from thornwall.operators.flatten import flatten, occurrences
from thornwall.operators.quality import expect_all_or_drop, quarantine, rule_counts
from thornwall.schema import EXPECTATIONS, SILVER_SCHEMA, page_schema
from thornwall.sources.landing import corrupt_pages, read_pages


@pytest.fixture
def flat(spark, tmp_path):
    def run(*cves, **fields):
        page(tmp_path, 0, *(cves or [cve(**fields)]))
        return flatten(occurrences(read_pages(spark, str(tmp_path)))).collect()

    return run


def test_silver_has_17_columns_of_the_declared_types(spark, tmp_path):
    page(tmp_path, 0, cve())
    df = flatten(occurrences(read_pages(spark, str(tmp_path))))
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in spark.createDataFrame([], SILVER_SCHEMA).schema
    ]
    assert len(df.columns) == 17


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_missing_data_is_null_in_either_mode(spark, flat, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = flat(metrics={"cvssMetricV31": [], "cvssMetricV2": []}, descriptions=[text("hola", "es")], published="nope")[0]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert row["cvss_v31_score"] is None and row["cvss_v2_severity"] is None and row["cvss_v30_score"] is None
    assert row["description_en"] is None
    assert row["published_at"] is None
    assert row["cwe_ids"] is None and row["reference_urls"] is None


def test_zone_suffix_is_honoured(spark, flat):
    flat(published="2024-01-02T03:04:05.678+02:00")
    rows = flat(cve(published="2024-01-02T03:04:05.678+02:00"), cve(published="2024-01-02T03:04:05Z"), cve())
    # Collected timestamps are in the zone of this process; compare as text of the session.
    shown = spark.createDataFrame(rows, SILVER_SCHEMA).selectExpr("cast(published_at as string) as p").collect()
    assert [r["p"] for r in shown] == ["2024-01-02 01:04:05.678", "2024-01-02 03:04:05", "2024-01-02 03:04:05.678"]


def test_first_metric_and_first_english_text(flat):
    row = flat(
        metrics={"cvssMetricV31": [v3(6.0, "MEDIUM", "a"), v3(9.8, "CRITICAL", "b")], "cvssMetricV2": [v2(5.0)]},
        descriptions=[text("uno", "es"), text("one"), text("two")],
    )[0]
    assert (row["cvss_v31_score"], row["cvss_v31_severity"], row["cvss_v31_vector"]) == (6.0, "MEDIUM", "a")
    assert (row["cvss_v2_score"], row["cvss_v2_severity"]) == (5.0, "MEDIUM")
    assert row["description_en"] == "one"


def test_weaknesses_keep_order_and_one_null(flat):
    row = flat(
        weaknesses=[
            weakness(text("CWE-79"), text("CWE-80")),
            weakness(text("otro", "es")),
            weakness(text("CWE-20")),
            weakness(text("CWE-79")),
            weakness(text("otro", "es")),
        ]
    )[0]
    assert row["cwe_ids"] == ["CWE-79", None, "CWE-20"]


def test_references(flat):
    assert flat(references=[{"url": "u1"}, {"url": "u2"}, {"url": "u1"}])[0]["reference_urls"] == ["u1", "u2", "u1"]
    assert flat(references=[])[0]["reference_urls"] == []


def test_pages_without_cves_yield_nothing(spark, tmp_path):
    page(tmp_path, 0)
    page(tmp_path, 1, vulnerabilities=None)
    pages = read_pages(spark, str(tmp_path))
    assert pages.count() == 2
    assert occurrences(pages).count() == 0
    assert corrupt_pages(pages).collect() == []


def test_only_page_files_are_read(spark, tmp_path):
    page(tmp_path, 0, cve("CVE-1"))
    page(tmp_path / "_tmp", 1, cve("CVE-2"))
    page(tmp_path / "deeper", 2, cve("CVE-3"))
    (tmp_path / "other.json").write_text('{"vulnerabilities": [{"cve": {"id": "CVE-4"}}]}')
    rows = flatten(occurrences(read_pages(spark, str(tmp_path))), "cve_id").collect()
    assert sorted(r["cve_id"] for r in rows) == ["CVE-1", "CVE-3"]
    assert all(r["_ingest_file"].startswith("file:") and r["_ingest_ts"] for r in rows)


def test_truncated_page_is_kept_apart(spark, tmp_path):
    page(tmp_path, 0, cve("CVE-1"))
    broken = page(tmp_path, 1, cve("CVE-2"))
    broken.write_text(broken.read_text()[:60])
    pages = read_pages(spark, str(tmp_path))
    assert [r["cve_id"] for r in flatten(occurrences(pages), "cve_id").collect()] == ["CVE-1"]
    lost = corrupt_pages(pages).collect()
    assert len(lost) == 1 and lost[0]["lost"] and lost[0]["_ingest_file"].endswith(NAME.format(page=1))


def test_one_bad_value_costs_that_value_only(spark, tmp_path):
    page(tmp_path, 0, cve("CVE-1", metrics={"cvssMetricV31": [v3("high")]}), cve("CVE-2"))
    pages = read_pages(spark, str(tmp_path))
    rows = {r["cve_id"]: r for r in flatten(occurrences(pages)).collect()}
    assert set(rows) == {"CVE-1", "CVE-2"}
    assert rows["CVE-1"]["cvss_v31_score"] is None and rows["CVE-1"]["cvss_v31_severity"] == "HIGH"
    found = corrupt_pages(pages).collect()
    assert len(found) == 1 and not found[0]["lost"]


def test_page_without_a_whole_metric_family(spark, tmp_path):
    (tmp_path / NAME.format(page=0)).write_text(json.dumps({"vulnerabilities": [{"cve": {"id": "CVE-1"}}]}))
    row = flatten(occurrences(read_pages(spark, str(tmp_path)))).first()
    assert row["cve_id"] == "CVE-1" and row["cvss_v2_score"] is None


def test_narrow_schema_reads_only_what_it_names(spark, tmp_path):
    page(tmp_path / "in", 0, cve(descriptions=[text("x")]))
    read_pages(spark, str(tmp_path / "in")).write.parquet(str(tmp_path / "raw"))
    narrow = spark.read.schema(f"{page_schema('id', 'references')}, _ingest_ts timestamp, _ingest_file string").parquet(
        str(tmp_path / "raw")
    )
    plan = flatten(occurrences(narrow), "cve_id", "reference_urls")._jdf.queryExecution().executedPlan().toString()
    assert "references" in plan and "descriptions" not in plan and "cvssMetric" not in plan


def test_expectations(spark, tmp_path):
    page(
        tmp_path,
        0,
        cve("CVE-1"),
        cve(None),
        cve("CVE-2", published="nope"),
        cve("CVE-3", published=None, modified=None),
        cve(None, published=None, modified="x"),
    )
    flat = flatten(occurrences(read_pages(spark, str(tmp_path))))
    assert [r["cve_id"] for r in expect_all_or_drop(flat, EXPECTATIONS).collect()] == ["CVE-1"]
    counts = {r["expectation"]: (r["passed_records"], r["failed_records"]) for r in rule_counts(flat, EXPECTATIONS).collect()}
    assert counts == {"valid_cve_id": (3, 2), "valid_published": (2, 3), "valid_modified": (3, 2)}
    dropped = {tuple(r["failed_rules"]) for r in quarantine(flat, EXPECTATIONS).collect()}
    assert dropped == {
        ("valid_cve_id",),
        ("valid_published",),
        ("valid_published", "valid_modified"),
        ("valid_cve_id", "valid_published", "valid_modified"),
    }


def test_null_predicate_counts_as_failed(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    rules = {"positive": "x > 0"}
    assert expect_all_or_drop(df, rules).count() == 1
    assert quarantine(df, rules).count() == 2
    assert rule_counts(df, rules).first()["failed_records"] == 2
