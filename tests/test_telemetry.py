import json

import pytest
from pyspark.sql import functions as F

from thornwall.operators import conform, detect, govern, trends, triage
from thornwall.operators.detect import Rule
from thornwall.session import settings
from thornwall.sources import records, telemetry

ZEEK = """#separator \\x09
#set_separator\t,
#empty_field\t(empty)
#unset_field\t-
#path\tconn
#fields\tts\tuid\tid.orig_h\tid.orig_p\tid.resp_h\tid.resp_p\tproto\tservice\tduration\torig_bytes\tresp_bytes\tconn_state
#types\ttime\tstring\taddr\tport\taddr\tport\tenum\tstring\tinterval\tcount\tcount\tstring
1704164645.123457\tC1\t10.0.0.1\t40000\t192.0.2.1\t22\ttcp\tssh\t-\t-\t-\tREJ
1704164646.000000\tC2\t10.0.0.2\t40001\t192.0.2.2\t443\ttcp\t(empty)\t1.5\t10\t20\tSF
#close\t2024-01-02-04-00-00
"""

SYSMON = """<Events>
<Event xmlns="http://schemas.microsoft.com/win/2004/08/events/event"><System><EventID>8</EventID>
<TimeCreated SystemTime="2024-01-02T03:04:05.678Z"/><Computer>HOST-1</Computer></System>
<EventData><Data Name="Image">C:\\bin\\x.exe</Data><Data Name="User">bob</Data></EventData></Event>
<Event><System><EventID>11</EventID><TimeCreated SystemTime="2024-01-02T03:04:06.000Z"/><Computer>HOST-2</Computer></System>
<EventData><Data Name="TargetFilename">C:\\tmp\\y</Data></EventData></Event>
</Events>
"""

STIX = {
    "type": "bundle",
    "objects": [
        {
            "type": "attack-pattern",
            "id": "attack-pattern--1",
            "name": "Phishing",
            "external_references": [
                {"source_name": "other", "external_id": "X"},
                {"source_name": "mitre-attack", "external_id": "T1566"},
            ],
            "kill_chain_phases": [{"kill_chain_name": "mitre-attack", "phase_name": "initial-access"}],
        },
        {"type": "attack-pattern", "id": "attack-pattern--2", "name": "Gone", "revoked": True},
        {"type": "attack-pattern", "id": "attack-pattern--3", "name": "Old", "x_mitre_deprecated": True},
        {"type": "malware", "id": "malware--1", "name": "Bad"},
    ],
}


def test_zeek(spark, tmp_path):
    (tmp_path / "conn.log").write_text(ZEEK)
    df = telemetry.read_zeek(spark, str(tmp_path))
    rows = {r["uid"]: r for r in df.collect()}
    assert set(rows) == {"C1", "C2"} and rows["C1"]["duration"] is None and rows["C2"]["service"] == ""
    shaped = conform.conform(df, "zeek").withColumn("timestamp", F.col("timestamp").cast("string")).orderBy("asset").collect()
    assert tuple(shaped[0])[:5] == ("2024-01-02 03:04:05.123457", "zeek", "10.0.0.1", "192.0.2.1:22", "MEDIUM")
    assert json.loads(shaped[0]["raw"])["uid"] == "C1"


def test_zeek_fields_without_a_column(spark, tmp_path):
    (tmp_path / "conn.log").write_text("1.5\tC1\t10.0.0.1\tno\t-\n\n2.5\tC2" + "\t-" * 10 + "\tT\t-\tShADad\n")
    rows = {r["uid"]: r for r in telemetry.read_zeek(spark, str(tmp_path)).collect()}
    assert rows["C1"]["id.orig_p"] is None and rows["C1"]["proto"] is None and rows["C1"]["more"] is None
    assert rows["C2"]["conn_state"] is None and rows["C2"]["more"] == ["T", "-", "ShADad"]


def test_raw_holds_every_item(spark, tmp_path):
    (tmp_path / "e.xml").write_text(SYSMON.replace("</EventData>", '<Data Name="CommandLine">a -b</Data></EventData>'))
    (tmp_path / "e.json").write_text('{"EventID": 1, "Computer": "H", "UtcTime": "2024-01-02 03:04:07", "Odd": {"a": 1}}\n{broken\n')
    xml = conform.conform(telemetry.read_sysmon(spark, str(tmp_path / "e.xml")), "sysmon").orderBy("asset").collect()
    items = [{d["name"]: d["value"] for d in json.loads(r["raw"])["data"]} for r in xml]
    assert items[0] == {"Image": "C:\\bin\\x.exe", "User": "bob", "CommandLine": "a -b"} and items[1]["CommandLine"] == "a -b"
    lines = conform.conform(telemetry.read_sysmon(spark, str(tmp_path / "e.json"), "json"), "sysmon").collect()
    assert [{d["name"]: d["value"] for d in json.loads(r["raw"])["data"]}["Odd"] for r in lines] == ['{"a":1}']


def test_techniques_of_rules(spark):
    rules = [Rule("R1", "HIGH", "events", "true", "T1"), Rule("R2", "LOW", "events", "true", "T9"), Rule("R3", "LOW", "events", "true")]
    catalogue = spark.createDataFrame(
        [("T1", "Phishing", ["a"]), ("T1", "Phishing", ["a"]), ("T2", "Other", ["b"]), (None, "x", None)],
        "technique_id string, name string, tactics array<string>",
    )
    found = triage.rule_techniques(spark, rules, catalogue).select("rule_id", "technique", "technique_name", "tactics")
    assert sorted(tuple(r) for r in found.collect()) == [
        ("R1", "T1", "Phishing", ["a"]),
        ("R2", "T9", None, None),
        ("R3", None, None, None),
    ]


def test_telemetry_as_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.log").write_text(ZEEK)
    (tmp_path / "in" / "b.log").write_text(ZEEK)
    rows = conform.deduplicated(conform.conform(telemetry.read_zeek(spark, str(tmp_path / "in"), stream=True), "zeek"))
    query = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_sysmon_xml_and_json(spark, tmp_path):
    (tmp_path / "e.xml").write_text(SYSMON)
    (tmp_path / "e.json").write_text(
        json.dumps({"EventID": 1, "Computer": "HOST-3", "UtcTime": "2024-01-02 03:04:07", "Image": "z.exe", "User": "eve"})
    )
    rows = telemetry.read_sysmon(spark, str(tmp_path / "e.xml")).orderBy("computer").collect()
    assert [(r["event_id"], r["computer"], r["image"], r["target"], r["user"]) for r in rows] == [
        (8, "HOST-1", "C:\\bin\\x.exe", None, "bob"),
        (11, "HOST-2", None, "C:\\tmp\\y", None),
    ]
    both = conform.conform_all({"sysmon": telemetry.read_sysmon(spark, str(tmp_path / "e.xml"))}).unionByName(
        conform.conform(telemetry.read_sysmon(spark, str(tmp_path / "e.json"), "json"), "sysmon")
    )
    shaped = both.select(F.col("timestamp").cast("string"), "asset", "indicator", "severity").orderBy("asset").collect()
    assert [tuple(r) for r in shaped] == [
        ("2024-01-02 03:04:05.678", "HOST-1", "C:\\bin\\x.exe", "HIGH"),
        ("2024-01-02 03:04:06", "HOST-2", "C:\\tmp\\y", "LOW"),
        ("2024-01-02 03:04:07", "HOST-3", "z.exe", "MEDIUM"),
    ]


def test_techniques(spark, tmp_path):
    (tmp_path / "enterprise.json").write_text(json.dumps(STIX, indent=1))
    rows = telemetry.read_techniques(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in rows] == [("T1566", "Phishing", ["initial-access"], "attack-pattern--1")]


def test_required_fields(spark):
    df = spark.sql(
        "select * from values (timestamp_ntz'2024-01-01 00:00:00', 1L, 'click', 5d, '{\"k\": 3}'), "
        "(null, 1L, 'click', 5d, '{}'), (timestamp_ntz'2024-01-01 00:00:00', null, 'click', 5d, '{}') "
        "t(ts, user_id, event_type, value, props)"
    )
    rows = conform.conform(df, "events").collect()
    assert len(rows) == 1 and rows[0]["indicator"] == "click:3" and rows[0]["severity"] == "LOW"


CONFORMED = "timestamp timestamp, source string, asset string, indicator string, severity string, raw string"


def test_deduplication_of_batch_and_stream(spark, tmp_path):
    rows = spark.sql(
        "select timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 5) timestamp, 's' source, "
        "cast(id % 5 as string) asset, 'i' indicator, 'LOW' severity, 'r' raw from range(20)"
    )
    assert conform.deduplicated(rows).count() == 5
    for part in range(2):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(CONFORMED).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (
        conform.deduplicated(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_microseconds_apart_are_no_duplicates(spark):
    rows = spark.sql(
        "select timestamp_micros(id) timestamp, 's' source, 'a' asset, 'i' indicator, 'LOW' severity, 'r' raw from range(3)"
    )
    assert conform.deduplicated(rows).count() == 3


# --- rules: each with a row that matches and one that does not -----------------

EVENT = "event_type string, value double, indicator string, asset string, ts timestamp"
CASES = {
    "R1": (("error", 50.0, "error:1"), ("error", 49.9, "error:1")),
    "R2": (("click", 100.0, "click:1"), ("click", 99.9, "click:1")),
    "R3": (("click", 1.0, "click:13"), ("click", 1.0, "click:14")),
    "R4": (("click", -0.1, "click:1"), ("click", 0.0, "click:1")),
}
CVE_CASES = {
    "C1": ({"cvss_v30_score": 9.0}, {"cvss_v31_score": 8.9, "cvss_v30_score": 9.5}),
    "C2": (
        {"vuln_status": "Awaiting Analysis", "cvss_v31_severity": "HIGH"},
        {"vuln_status": "Analyzed", "cvss_v31_severity": "HIGH"},
    ),
    "C3": ({"reference_urls": []}, {"reference_urls": None}),
}


def test_every_rule_has_its_cases():
    assert set(CASES) == {r.rule_id for r in detect.EVENT_RULES}
    assert set(CVE_CASES) == {r.rule_id for r in detect.CVE_RULES}


def test_rules_from_files(spark, tmp_path):
    (tmp_path / "r2.json").write_text(json.dumps({"rule_id": "R2", "severity": "LOW", "source": "events", "predicate": "value > 1"}))
    (tmp_path / "r1.json").write_text(
        json.dumps([{"rule_id": "R1", "severity": "HIGH", "source": "cves", "predicate": "true", "technique": "T1"}], indent=1)
    )
    assert detect.read_rules(spark, str(tmp_path)) == [
        Rule("R1", "HIGH", "cves", "true", "T1"),
        Rule("R2", "LOW", "events", "value > 1"),
    ]


@pytest.mark.parametrize("rule", detect.EVENT_RULES, ids=lambda r: r.rule_id)
def test_event_rule(spark, rule):
    rows = [(*case, str(i), None) for i, case in enumerate(CASES[rule.rule_id])]
    found = detect.matches(spark.createDataFrame(rows, EVENT), [rule], "events").collect()
    assert [(r["asset"], r["rule_id"], r["rule_severity"]) for r in found] == [("0", rule.rule_id, rule.severity)]


@pytest.mark.parametrize("rule", detect.CVE_RULES, ids=lambda r: r.rule_id)
def test_cve_rule(spark, rule):
    schema = (
        "id int, cvss_v31_score double, cvss_v30_score double, cvss_v2_score double, vuln_status string, "
        "cvss_v31_severity string, reference_urls array<string>"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    rows = [tuple(({"id": i} | case).get(n) for n in names) for i, case in enumerate(CVE_CASES[rule.rule_id])]
    found = detect.matches(spark.createDataFrame(rows, schema), [rule], "cves").collect()
    assert [r["id"] for r in found] == [0]


def test_all_rules_take_one_scan(spark, tmp_path):
    spark.createDataFrame([("error", 500.0, "x", "a", None)], EVENT).write.parquet(str(tmp_path / "e"))
    hits = detect.matches(spark.read.parquet(str(tmp_path / "e")), detect.EVENT_RULES, "events")
    assert hits._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(r["rule_id"] for r in hits.collect()) == ["R1", "R2"]


def test_alerts_are_stable(spark):
    df = spark.sql(
        "select 'error' event_type, 60d value, 'x' indicator, 'a' asset, "
        "timestamp'2024-01-01 23:00:00' + make_dt_interval(0, id) ts from range(3)"
    )
    found = detect.alerts(df, detect.EVENT_RULES, "events", "asset", "ts").orderBy("day").collect()
    assert [(str(r["day"]), r["matched_rows"]) for r in found] == [("2024-01-01", 1), ("2024-01-02", 2)]
    again = detect.alerts(df, detect.EVENT_RULES, "events", "asset", "ts").orderBy("day").collect()
    assert [r["alert_id"] for r in found] == [r["alert_id"] for r in again]


def test_triage(spark):
    alerts = spark.createDataFrame(
        [("i1", "R1", "HIGH", "a", 1), ("i2", "R1", "CRITICAL", "a", 9), ("i3", "R2", "LOW", "b", 2), ("i4", "R2", "LOW", "c", 1)],
        "alert_id string, rule_id string, severity string, asset string, matched_rows bigint",
    ).withColumn("day", F.lit("2024-01-01").cast("date"))
    cves = spark.createDataFrame(
        [("CVE-1", "a", 9.5, "CRITICAL"), ("CVE-2", "a", 9.5, "CRITICAL"), ("CVE-3", "b", 3.0, "LOW")],
        "cve_id string, source_identifier string, cvss_v31_score double, cvss_v31_severity string",
    ).selectExpr(
        "*", "null cvss_v30_score", "null cvss_v2_score", "cast(null as string) cvss_v30_severity", "cast(null as string) cvss_v2_severity"
    )
    rules = [Rule("R1", "HIGH", "events", "true", "T1"), Rule("R2", "LOW", "events", "true")]
    rows = {r["alert_id"]: r for r in triage.triage(alerts, triage.cve_context(cves), F.col("asset"), rules).collect()}
    assert len(rows) == 4
    assert (rows["i1"]["severity_calibrated"], rows["i1"]["recommended_action"], rows["i1"]["confidence"]) == ("CRITICAL", "isolate", 0.7)
    assert rows["i1"]["worst_cve"] == "CVE-2" and rows["i1"]["technique"] == "T1"
    assert (rows["i2"]["severity_calibrated"], rows["i2"]["confidence"]) == ("CRITICAL", 0.9)
    assert (rows["i3"]["severity_calibrated"], rows["i3"]["related_cves"]) == ("LOW", 1)
    assert (rows["i4"]["related_cves"], rows["i4"]["worst_cve"], rows["i4"]["summary"]) == (
        0,
        None,
        "R2 on c (1 rows); 0 related CVEs, 0 critical",
    )


def test_trending(spark):
    days = [0] * 2 + [3] + [9] * 3 + [30]
    df = spark.createDataFrame([("c", d) for d in days], "cve_id string, d int").selectExpr(
        "cve_id", "timestamp'2024-01-01 10:00:00' + make_dt_interval(d) modified_at"
    )
    rows = {str(r["day"]): (r["occurrences"], r["trailing_mean"]) for r in trends.trending_cves(df).collect()}
    assert rows == {
        "2024-01-01": (2, 0.0),
        "2024-01-04": (1, 2 / 7),
        "2024-01-10": (3, 1 / 7),
        "2024-01-31": (1, 0.0),
    }


def test_retention_and_masking(spark, tmp_path):
    df = spark.sql(
        "select timestamp'2024-01-31 00:00:00' - make_dt_interval(id) _ingest_ts, cast(id as string) who, 1 secret, 'p' shown from range(120)"
    )
    assert govern.retained(df, "2024-01-31").count() == 91
    shown = govern.masked_view(df, {"who": "pii", "shown": "public", "secret": "sensitive"}, "who = '3'", salt="t")
    row = shown.first()
    assert shown.count() == 1 and row["secret"] is None and row["shown"] == "p" and len(row["who"]) == 64
    salted = govern.masked_view(df, {"who": "pii"}, "who = '3'", salt="s").first()["who"]
    assert salted != row["who"] and len(salted) == 64
    # an untagged column is not shown
    assert row["_ingest_ts"] is None
    assert [f.dataType for f in shown.schema][0] == df.schema["_ingest_ts"].dataType
    with pytest.raises(ValueError):
        govern.masked_view(df, {"who": "secret"}, salt="t")
    with pytest.raises(ValueError):
        govern.masked_view(df, {"who": "pii"}, salt="")


def test_stored_days_expire_whole(spark, tmp_path):
    path = str(tmp_path / "days")
    # two thirds of the rows on one day
    df = spark.sql(
        "select timestamp'2024-01-10 00:00:00' + make_dt_interval(if(id % 3 = 0, id % 10, 0)) timestamp, id from range(3000)"
    ).repartition(6)
    govern.store_by_day(df, path)
    govern.store_by_day(df.limit(0), path)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "days").glob("day=*")}
    assert len(files) == 10 and set(files.values()) == {1}
    assert govern.drop_expired(spark, path, "2024-02-01", 20) == ["day=2024-01-10", "day=2024-01-11"]
    left = spark.read.parquet(path)
    assert left.count() == df.where("timestamp >= timestamp'2024-01-12'").count()
    assert govern.drop_expired(spark, path, "2024-02-01", 20) == []


def test_large_day_is_split_over_files(spark, tmp_path):
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 200_000}):
        df = spark.sql(
            "select timestamp'2024-01-10 00:00:00' + make_dt_interval(if(id % 3 = 0, 1 + id % 5, 0)) timestamp, uuid() raw "
            "from range(0, 60000, 1, 8)"
        )
        govern.store_by_day(df, str(tmp_path / "days"))
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "days").glob("day=*")}
    assert len(files) == 6 and files["day=2024-01-10"] > 3
    assert spark.read.parquet(str(tmp_path / "days")).count() == 60_000


def test_each_kind_of_files_is_taken_in_on_its_own(spark, tmp_path):
    """A query on the logs of one kind does not wait for the others."""
    spark.range(600).selectExpr("id event_id", "timestamp_ntz'2024-01-01 00:00:00' ts", "id % 9 user_id", "'click' event_type", "1.5D value", "'{}' props").write.parquet(str(tmp_path / "events.parquet"))
    from thornwall.plans import queries, workspace

    assert queries.zeek_by_header(spark, str(tmp_path)).count() > 600
    tables = workspace.Telemetry(spark, workspace.folder(spark, str(tmp_path), "telemetry/tables"))
    assert tables.counts("zeek").count() == 1 and tables.counts("sysmon_xml").count() == 0
    counts = {r["source"]: r["records"] for r in queries.telemetry_counts(spark, str(tmp_path)).collect()}
    assert set(counts) == {"zeek", "sysmon_json", "sysmon_xml", "attack"} and counts["sysmon_json"] == 600


def test_events_of_one_row_group_are_read_by_many_tasks(spark, tmp_path):
    spark.range(600).coalesce(1).selectExpr("id event_id", "timestamp_ntz'2024-01-01 00:00:00' ts", "id % 9 user_id", "'click' event_type", "1.5D value", "'{}' props").write.parquet(str(tmp_path / "events.parquet"))
    from thornwall.plans import queries

    read = queries._sysmon(spark, str(tmp_path))
    assert read.count() == 600 and len(read.inputFiles()) > 8


def test_zeek_values_are_json_whatever_they_hold(spark, tmp_path):
    """Texts that need escapes, other separators, types that are missing; the lines are not sorted to meet their header."""
    head = "#separator \\x{code}\n#set_separator{s};\n#path{s}x\n#fields{s}a{s}b\"c{s}n{s}v\n#types{s}string{s}string{s}double{s}set[string]\n"
    for name, s in (("t", "\t"), ("c", ","), ("p", "|")):
        text = head.format(code=f"{ord(s):02x}", s=s) + s.join(['q"\\', "ü", "1.5", "(empty)"]) + "\n" + s.join(["(empty)", "-", "NaN", "y"]) + "\n"
        (tmp_path / f"{name}.log").write_text(text)
    parsed = records.zeek_parsed(records.raw_records(spark, str(tmp_path), "zeek"))
    found = [(json.loads(r["raw"]), r["fields"]) for r in parsed.where("fault is null").collect()]
    assert len(found) == 6
    one = {"a": 'q"\\', 'b"c': "ü", "n": 1.5, "v": []}
    other = {"a": "", 'b"c': None, "n": "NaN", "v": ["y"]}
    assert sorted(str(raw) for raw, _ in found) == sorted([str(one)] * 3 + [str(other)] * 3)
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
