"""Telemetry files taken in record by record: headers, faults, quarantine, replays, days."""

import datetime
import json

from pyspark.sql import functions as F

from thornwall.operators import conform
from thornwall.sources import records
from thornwall.streaming.batches import Batches
from thornwall.streaming.telemetry import Telemetry

HEAD = "#separator \\x09\n#set_separator\t,\n#empty_field\t(empty)\n#unset_field\t-\n#path\tconn\n"


def parsed(spark, path, source):
    return records.PARSERS[source](records.raw_records(spark, str(path), source))


def test_zeek_by_its_header(spark, tmp_path):
    (tmp_path / "a.log").write_text(HEAD + "#fields\tts\tid.orig_h\tn\tok\ttags\tnote\n#types\ttime\taddr\tcount\tbool\tset[string]\tstring\n1.5\th\t7\tT\ta,b\t(empty)\n2.5\th\tx\t-\t(empty)\t\"q\\\n#close\tx\n\n")
    (tmp_path / "b.log").write_text("#separator \\x7c\n#unset_field|NA\n#path|dns\n#fields|note|ts\nNA|3.5\n")
    rows = sorted(parsed(spark, tmp_path, "zeek").collect(), key=lambda r: r["value"])
    assert [r["fault"] for r in rows] == [None] * 3 and [r["path"] for r in rows] == ["conn", "conn", "dns"]
    assert json.loads(rows[0]["raw"]) == {"ts": 1.5, "id.orig_h": "h", "n": 7, "ok": True, "tags": ["a", "b"], "note": ""}
    assert json.loads(rows[1]["raw"]) == {"ts": 2.5, "id.orig_h": "h", "n": "x", "ok": None, "tags": [], "note": '"q\\'}
    assert rows[2]["fields"] == {"note": None, "ts": "3.5"}


def test_zeek_faults(spark, tmp_path):
    (tmp_path / "none.log").write_text("1\t2\n")
    (tmp_path / "two.log").write_text(HEAD + "#fields\tts\tx\n1\t2\n#fields\tx\tts\n2\t1\n")
    (tmp_path / "same.log").write_text(HEAD + "#fields\tts\tts\n1\t2\n")
    (tmp_path / "cut.log").write_text(HEAD + "#fields\tts\tx\n1\n1\t2\t3\n1\t2\n")
    found = {}
    for r in parsed(spark, tmp_path, "zeek").collect():
        found.setdefault(r["_ingest_file"].rsplit("/", 1)[-1], []).append((r["value"], r["fault"]))
    assert {k: sorted(v) for k, v in found.items()} == {
        "none.log": [("1\t2", "no_header")], "two.log": [("1\t2", "several_headers"), ("2\t1", "several_headers")],
        "same.log": [("1\t2", "repeated_field")], "cut.log": [("1", "field_count"), ("1\t2", None), ("1\t2\t3", "field_count")],
    }


def test_endpoint_faults(spark, tmp_path):
    event = "<Event><System><EventID>8</EventID><TimeCreated SystemTime=\"2024-01-02T03:04:05.678Z\"/><Computer>H</Computer></System><EventData><Data Name=\"Image\">x</Data></EventData></Event>"
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "e.xml").write_text(f"\ufeff<?xml version='1.0'?>\n<Events x='1'>{event}\n stray {event}<Event><System></Event>{event}</Events>\n<Event><System><Even")
    rows = parsed(spark, tmp_path / "x", "sysmon_xml").collect()
    assert sorted((r["fault"] or "", r["raw"] is None) for r in rows) == [("", False)] * 3 + [("malformed", True)] * 2 + [("outside_events", True)]
    assert [r["value"] for r in rows if r["fault"] == "outside_events"] == ["stray"]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "e.json").write_text('{"EventID": 8, "Computer": "H", "UtcTime": "2024-01-02 03:04:05"}\n{"EventID": \n\n[1]\n{"EventID": 1}\n')
    judged = conform.judged(parsed(spark, tmp_path / "j", "sysmon_json"), "sysmon_json").collect()
    assert sorted((r["value"] or "", r["failed_rules"]) for r in judged) == [
        ("", []), ("[1]", ["not_an_object"]), ('{"EventID": ', ["malformed"]), ('{"EventID": 1}', ["valid_timestamp", "valid_asset"]),
    ]
    (tmp_path / "a").mkdir()
    for name, text in (("good", '{"objects": [{"type": "x"}, {"type": "y"}]}'), ("empty", '{"objects": []}'), ("bad", '{"objects": [{'), ("other", "[1]")):
        (tmp_path / "a" / name).write_text(text)
    found = sorted(((r["value"] or ""), r["raw"] or "") for r in parsed(spark, tmp_path / "a", "attack").collect())
    assert found == [("", '{"type":"x"}'), ("", '{"type":"y"}'), ("[1]", ""), ('{"objects": [{', "")]


def test_files_are_taken_in_once_with_all_their_records(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    text = HEAD + "#fields\tts\tid.orig_h\tid.resp_h\tid.resp_p\tconn_state\n1704164645.5\t10.0.0.1\t192.0.2.1\t22\tREJ\n-\t10.0.0.1\t192.0.2.1\t22\tSF\nbroken\n"
    (logs / "a.log").write_text(text)
    t = Telemetry(spark, str(tmp_path / "t"))
    for _ in range(2):
        t.start("zeek", str(logs)).awaitTermination()
    (logs / "b.log").write_text(text)
    t.start("zeek", str(logs)).awaitTermination()
    assert t.raw("zeek").count() == 2 * len(text.splitlines())
    assert [r["severity"] for r in t.conformed("zeek").collect()] == ["MEDIUM"] * 2
    assert sorted((r["value"].split("\t")[0], r["failed_rules"]) for r in t.quarantine("zeek").collect()) == [("-", ["valid_timestamp"])] * 2 + [("broken", ["field_count"])] * 2
    assert [(r["records"], r["conformed"], r["quarantined"]) for r in t.counts("zeek").collect()] == [(3, 1, 2)] * 2
    # The second batch again, as after a crash before its commit.
    last = max((tmp_path / "t" / "checkpoints" / "zeek" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink()
    t.start("zeek", str(logs)).awaitTermination()
    assert t.conformed("zeek").count() == 2 and t.counts("zeek").count() == 2 and t.raw("zeek").count() == 2 * len(text.splitlines())


def test_batches_by_day(spark, tmp_path):
    days = [datetime.date(2024, 1, d) for d in (1, 2, 3)]
    b = Batches(spark, str(tmp_path / "b"), "n int")
    assert b.read().count() == 0
    for k, day in enumerate(days):
        for n in range(4):
            b.add(spark.range(1).select(F.lit(10 * k + n).alias("n")), f"q-{n}", day)
    rows = lambda **between: sorted(r["n"] for r in b.read(**between).collect())
    everything = [0, 1, 2, 3, 10, 11, 12, 13, 20, 21, 22, 23]
    assert rows() == everything and rows(first=days[1], last=days[1]) == [10, 11, 12, 13]
    assert b.compact(days[2]) == ["2024-01-01", "2024-01-02"] and [len(b.sets(d)) for d in b.days()] == [1, 1, 4]
    assert rows() == everything and len(list((tmp_path / "b" / "day=2024-01-01").glob("*/part-*.parquet"))) == 1
    # A batch of a compacted day again changes nothing; a late one joins and is compacted with the rest.
    b.add(spark.range(1).select(F.lit(0).alias("n")), "q-0", days[0])
    assert rows() == everything and b.holds("q-0", days[0])
    b.add(spark.range(1).select(F.lit(5).alias("n")), "q-9", days[0])
    assert rows() == sorted([*everything, 5]) and b.compact(days[1]) == ["2024-01-01"]
    b.add(spark.range(1).select(F.lit(0).alias("n")), "q-1", days[0])
    assert rows() == sorted([*everything, 5])
    # A compaction that died half-way leaves the sets as they were.
    (tmp_path / "b" / "day=2024-01-03" / "all-x").mkdir()
    assert rows() == sorted([*everything, 5])
    assert b.expire(days[1]) == ["2024-01-01"] and rows() == [10, 11, 12, 13, 20, 21, 22, 23]
    assert not (tmp_path / "b" / "day=2024-01-01").exists()


def test_objects_do_not_carry_their_bundle(spark):
    """A sound bundle's text would be copied for each of its objects."""
    sound = '{"objects": [' + ", ".join('{"id": "a%d"}' % i for i in range(50)) + "]}"
    raw = spark.createDataFrame([(sound, None, "f1"), ('{"objects": [', None, "f2"), ('{"objects": []}', None, "f3")], records.RAW_SCHEMA)
    rows = records.attack_parsed(raw)
    found = [tuple(r) for r in rows.select("raw", "fault", "value", "_ingest_file").collect()]
    assert len(found) == 51 and (None, "malformed", '{"objects": [', "f2") in found and ('{"id":"a7"}', None, None, "f1") in found
    node = rows._jdf.queryExecution().optimizedPlan().toString().split("Generate explode")[1].split("\n")[1]
    assert "CASE WHEN isnull(objects" in node and " value#" not in node.split("AS value#")[0].replace("THEN value#", "")
