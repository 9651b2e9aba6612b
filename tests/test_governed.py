"""Product names, views by entitlement, cases of rules, rates, ids of alerts, publishing with changes pending."""

import datetime
import getpass
import json

from pyspark.sql import functions as F

from feed import cve, page
from thornwall.functions import cpe
from thornwall.operators import detect, govern, quality
from thornwall.operators.detect import Rule
from thornwall.plans.medallion import Medallion


def test_product_names(spark):
    names = [
        "cpe:2.3:a:ven\\:dor:pro\\*duct:1.0\\\\:*:*:en:*:*:*:x", "cpe:2.3:o:*:-:*:*:*:*:*:*:*:*", "cpe:2.3:a:short", "cpe:/a:old:uri", None, "",
        "cpe:2.3:h:a:b:\\-:\\*:*:*:*:*:*:*",
    ]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(cpe.cpe(F.col("n")).alias("c")).collect()
    found = [r["c"] and r["c"].asDict() for r in rows]
    assert [f and (f["part"], f["vendor"], f["product"], f["version"]) for f in found] == [("a", "ven:dor", "pro*duct", "1.0\\"), ("o", None, None, None), None, None, None, None, ("h", "a", "b", "-")]
    assert found[0]["language"] == "en" and found[0]["other"] == "x" and found[6]["update"] == "*" and found[6]["edition"] is None


def test_affected_products_of_a_tree(spark):
    match = lambda name, vulnerable=True: {"vulnerable": vulnerable, "criteria": f"cpe:2.3:a:{name}:p:*:*:*:*:*:*:*:*"}
    tree = [
        {"operator": "AND", "nodes": [
            {"operator": "OR", "negate": False, "cpeMatch": [match("one"), match("one"), match("platform", False), match("*")], "children": [{"cpeMatch": [match("below")]}, {"negate": True, "cpeMatch": [match("no")]}]},
            {"operator": "OR", "negate": True, "cpeMatch": [match("no")], "children": [{"cpeMatch": [match("no")]}]},
            {"operator": "OR"},
        ]},
        {"negate": True, "nodes": [{"cpeMatch": [match("no")]}]},
        {},
    ]
    rows = spark.createDataFrame([(json.dumps(tree),), (None,), ("[]",)], "j string").select(cpe.vendors(F.from_json("j", cpe.CONFIGURATIONS)).alias("v")).collect()
    assert [r["v"] for r in rows] == [["one", "below"], None, []]


def test_a_view_shows_each_user_their_rows(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS governed LOCATION '{tmp_path}'")
    rows = spark.createDataFrame([(1, "red", "bob", "x"), (2, "blue", "eve", "y"), (3, None, "joe", "z")], "id int, team string, `who is` string, secret string")
    govern.tagged(rows, {"id": "public", "team": "public", "who is": "pii"}).write.mode("overwrite").saveAsTable("governed.rows")
    me = spark.sql("SELECT current_user()").first()[0]
    assert me == getpass.getuser()
    rights = [(me, "red"), (me, "red"), ("ann", "blue"), ("ann", "red"), ("ann", None), (None, "blue")]
    spark.createDataFrame(rights, "user_name string, scope string").write.mode("overwrite").saveAsTable("governed.rights")
    govern.secured_view(spark, "governed.shown", "governed.rows", "governed.rights", "team", "it's")
    mine = spark.table("governed.shown").collect()
    assert [(r["id"], r["secret"]) for r in mine] == [(1, None)] and len(mine[0]["who is"]) == 64 and mine[0]["who is"] != "bob"
    hers = spark.sql(govern.secured_sql(spark, "governed.rows", "governed.rights", "team", "it's", "ann")).collect()
    assert sorted(r["id"] for r in hers) == [1, 2] and {r["who is"] for r in hers} >= {mine[0]["who is"]}
    nobody = spark.sql(govern.secured_sql(spark, "governed.rows", "governed.rights", "team", "it's", "x' OR '1' = '1"))
    assert nobody.count() == 0


def test_rules_are_tried_on_their_cases(spark, tmp_path):
    rules = [Rule("A", "LOW", "t", "v > 1"), Rule("B", "LOW", "t", "v < 0"), Rule("C", "LOW", "t", "true")]
    cases = [("A", "a1", True, {"v": 2}), ("A", "a2", False, {"v": None}), ("A", "a3", False, {"v": 5}), ("B", "b1", True, {"v": -1}), ("X", "x", True, {"v": 1})]
    (tmp_path / "c.json").write_text("\n".join(json.dumps({"rule_id": r, "case": c, "expected": e, "row": row}) for r, c, e, row in cases))
    found = detect.tried(detect.read_cases(spark, str(tmp_path)), rules, "v int").collect()
    assert {(r["rule_id"], r["case"]): (r["found"], r["passed"]) for r in found} == {
        ("A", "a1"): (True, True), ("A", "a2"): (False, True), ("A", "a3"): (True, False), ("B", "b1"): (True, True), ("B", "no negative case"): (None, False),
        ("C", "no positive case"): (None, False), ("C", "no negative case"): (None, False), ("X", "x"): (None, False),
    }


def test_alert_ids_are_told_apart(spark):
    rules = [Rule("R", "LOW", "t", "true"), Rule("R|a", "LOW", "t", "true")]
    rows = spark.createDataFrame([("a|b", "2024-01-01"), ("b", "2024-01-01"), (None, "2024-01-01"), ("a", None), ("", "2024-01-01")], "asset string, ts string")
    found = detect.alerts(rows, rules, "t", "asset", "ts").collect()
    assert len(found) == 10 and len({r["alert_id"] for r in found}) == 10 and all(r["alert_id"] for r in found)


def test_rates_against_the_week_before(spark):
    rows = [(f"2024-01-{d:02d}", v) for d, values in {1: [1, 1, 0, 0], 2: [1, 0], 9: [1], 10: []}.items() for v in values] + [(None, 1)]
    found = quality.rate_changes(spark.createDataFrame(rows, "d string, v int"), {"zero": "v = 0"}, "d").orderBy("day").collect()
    shown = [(r["day"], r["records"], r["failed"], r["rate"], r["trailing_rate"], r["change"]) for r in found]
    day = datetime.date
    assert shown == [(day(2024, 1, 1), 4, 2, 0.5, None, None), (day(2024, 1, 2), 2, 1, 0.5, 0.5, 0.0), (day(2024, 1, 9), 1, 1, 1.0, 0.5, 0.5)]


def test_publishing_pending_changes_writes_no_row(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1"), cve("CVE-2"))
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run("2024-01-31")
    m.state.fold()
    page(landing, 1, cve("CVE-1", modified="2025-01-01T00:00:00"), cve("CVE-3"))
    m.ingest().awaitTermination()
    m.upsert().awaitTermination()
    files = lambda: {str(p) for p in (tmp_path / "root").rglob("*.parquet")}
    before = files()
    m.publish("merged_on_read")
    assert files() == before and m.state.pending()
    view = spark.table("merged_on_read.cves")
    assert sorted(map(str, view.collect())) == sorted(map(str, m.table("cves").collect())) and view.count() == 3
    assert "Exchange" not in view.select("cve_id")._jdf.queryExecution().optimizedPlan().toString()
    assert spark.catalog.getTable("merged_on_read.cves").tableType == "VIEW"
    m.state.fold()
    assert sorted(map(str, view.collect())) == sorted(map(str, m.table("cves").collect()))


def test_the_log_of_a_closed_day_is_one_file(spark, tmp_path):
    landing = tmp_path / "landing"
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    for n in range(4):
        page(landing, n, cve(f"CVE-{n}"), cve(None))
        m.ingest().awaitTermination()
        m.upsert().awaitTermination()
    before = sorted(map(str, m.expectation_log().collect()))
    assert len(before) == 12 and len(m.log.sets(m.log.days()[0])) == 4
    m.log.compact(datetime.date(2100, 1, 1))
    assert sorted(map(str, m.expectation_log().collect())) == before and len(m.log.sets(m.log.days()[0])) == 1


def test_top_indicators_of_a_range_are_exact(spark):
    import random
    from collections import Counter

    dice = random.Random(4)
    seen = [(f"2024-01-{dice.randint(1, 9):02d} 12:00:00", f"i{min(dice.randint(0, 40), dice.randint(0, 40))}") for _ in range(3000)] + [(None, "i0"), ("2024-01-02 00:00:00", None)]
    rows = spark.createDataFrame(seen, "t string, indicator string").select(F.col("t").cast("timestamp").alias("timestamp"), "indicator")
    for m in (1, 5, 12, 100):
        state = detect.daily_top(rows, m).cache()
        for first, last in ((1, 9), (3, 5), (7, 7), (20, 21)):
            found = detect.top_iocs_between(rows, state, f"2024-01-{first:02d}", f"2024-01-{last:02d}", 4).collect()
            counts = Counter(i for t, i in seen if t and i and first <= int(t[8:10]) <= last)
            assert [(r["indicator"], r["sightings"]) for r in found] == sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:4]


def test_working_folder_can_be_cleared(spark, tmp_path):
    from thornwall import session

    path = session.workdir(spark)
    spark.range(3).write.mode("overwrite").parquet(f"{path}/thing")
    try:
        session.clear(spark)
        assert not spark._jvm.java.io.File(path.removeprefix("file:")).exists()
    finally:
        with session._lock:
            session._workdirs[spark.sparkContext.applicationId] = path


def test_related_cves_are_exact(spark):
    import random
    import re
    from collections import Counter

    from thornwall.operators import related

    dice = random.Random(9)
    words = ["the"] * 30 + ["remote", "Code", "Überlauf"] * 4 + [f"w{i}" for i in range(40)]
    cves = [(f"CVE-{i:04d}", " ".join(dice.choices(words, k=dice.randint(0, 6))) if i % 17 else None) for i in range(400)] + [(None, "remote")]
    cves += [(f"CVE-9{i:03d}", "the remote, the CODE") for i in range(100)]
    alerts = [(f"a{i}", " ".join(dice.choices(words + ["unknown"], k=dice.randint(0, 5)))) for i in range(60)] + [("n", None), ("t", "the"), ("t", "the"), ("u", "nothing known")]
    split = lambda text: set(re.findall(r"\w+", (text or "").lower()))
    sound = [(c, split(t)) for c, t in cves if c]
    frequency = Counter(w for _, t in sound for w in t)
    expected = Counter()
    for key, text in alerts:
        scores = [(-sum(len(sound) // frequency[w] for w in split(text) & t), c) for c, t in sound if split(text) & t]
        for place, (score, c) in enumerate(sorted(scores)[:5], 1):
            expected[key, c, -score, place] += 1
    index = related.TermIndex(spark.createDataFrame(cves, "cve_id string, description_en string"), 5)
    found = related.related(spark.createDataFrame(alerts, "alert_id string, text string"), index, F.col("text")).collect()
    assert Counter((r["alert_id"], r["cve_id"], r["score"], r["place"]) for r in found) == expected and len(expected) > 150
