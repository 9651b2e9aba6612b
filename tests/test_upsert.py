"""Newest version per key: in batches, in micro-batches, through crashes and replays."""

import json
import os
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Observation
from feed import cve, page, v3

from thornwall.operators import audit
from thornwall.operators.flatten import flatten, occurrences
from thornwall.operators.quality import expect_all_or_drop, observed
from thornwall.operators.upsert import latest_by_key, latest_valid_by_key
from thornwall.plans.medallion import Medallion
from thornwall.schema import EXPECTATIONS, KEY, SEQUENCE, SILVER_SCHEMA
from thornwall.sources.files import file_system, hadoop_path
from thornwall.sources.landing import corrupt_pages, infer_pages, merged_type, read_pages, shown_type
from thornwall.streaming.batches import Batches
from thornwall.streaming.current_state import CurrentState
from thornwall.streaming import ingest
from thornwall.streaming.ingest import BATCH_SEQUENCE, start_upsert

SCHEMA = "k string, m int, f string, v int"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def versions(rng, keys, n):
    return [(rng.choice(keys), rng.randint(0, 5), rng.choice("abc"), i) for i in range(n)]


def expected(rows):
    best = {}
    for r in rows:
        if r[0] is not None and (r[0] not in best or r[1:] > best[r[0]][1:]):
            best[r[0]] = r
    return sorted(best.values())


@pytest.fixture
def state(spark, tmp_path):
    return CurrentState(spark, str(tmp_path / "state"), SCHEMA, "k", ["m", "f", "v"])


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("seed", range(3))
def test_batch_keeps_the_highest_sequence(spark, seed):
    rows = versions(random.Random(seed), ["x", "y", "z", None], 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(latest_by_key(df, "k", ["m", "f", "v"])) == expected(rows)


@pytest.mark.parametrize("seed", range(3))
def test_valid_rows_and_counts_in_one_pass(spark, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([m, None]), f, v) for k, m, f, v in versions(rng, ["x", "y", None], 50)]
    rules = {"has_key": "k IS NOT NULL", "has_m": "m IS NOT NULL", "small": "v < 40"}
    counts = Observation()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = rows_of(latest_valid_by_key(df, "k", ["m", "f", "v"], rules, counts))
    assert found == expected([r for r in rows if r[1] is not None and r[3] < 40])
    assert counts.get == {
        "records": 50,
        "has_key": sum(r[0] is None for r in rows),
        "has_m": sum(r[1] is None for r in rows),
        "small": sum(r[3] >= 40 for r in rows),
    }


def test_counts_are_taken_after_the_shuffle(spark):
    df = spark.range(10).selectExpr("cast(id as string) k", "1 m", "'a' f", "0 v")
    plan = latest_valid_by_key(df, "k", ["m"], {"r": "v = 0"}, Observation())._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange")


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 90_000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 50)) k", "cast(id as int) m", "'f' f", "cast(id as int) v"
    )
    latest = latest_by_key(df, "k", ["m"])
    plan = executed(latest)
    assert plan.index("partial_max") > plan.index("Exchange")
    # 8 tasks with 51 keys each at most
    stage = latest._jdf.queryExecution().executedPlan()
    assert latest.count() == 51 and "partial_max" in stage.toString()


@pytest.mark.parametrize("seed", range(3))
def test_state_equals_batch_in_any_order_with_replays(spark, state, seed):
    rng = random.Random(seed)
    rows = versions(rng, [f"k{i}" for i in range(12)], 120)
    batches = [rows[i : i + 30] for i in range(0, 120, 30)]
    order = batches + [rng.choice(batches) for _ in range(2)]
    rng.shuffle(order)
    order += batches
    for i, batch in enumerate(order):
        state.add_changes(spark.createDataFrame(batch, SCHEMA), f"q-{i}")
        if i % 3 == 1:
            state.fold()
    assert rows_of(state.read()) == expected(rows)
    state.fold()
    assert rows_of(state.read()) == expected(rows)


def test_nothing_yet(state):
    assert state.read().collect() == [] and state.read().columns == ["k", "m", "f", "v"]
    assert state.fold() is None


def test_late_older_version_is_ignored(spark, state):
    state.add_changes(spark.createDataFrame([("x", 5, "a", 1)], SCHEMA), "1")
    state.fold()
    state.add_changes(spark.createDataFrame([("x", 3, "z", 2), ("y", 1, "a", 3)], SCHEMA), "2")
    assert rows_of(state.read()) == [("x", 5, "a", 1), ("y", 1, "a", 3)]
    assert rows_of(state.read().where("k = 'x'").select("v")) == [(1,)]


def test_replayed_batch_replaces_its_rows(spark, state):
    state.add_changes(spark.createDataFrame([("x", 5, "a", 1)], SCHEMA), "1")
    state.add_changes(spark.createDataFrame([("x", 5, "a", 1)], SCHEMA), "1")
    assert len(state._change_sets(state.base.latest())) == 1
    state.fold()
    state.add_changes(spark.createDataFrame([("x", 7, "a", 7)], SCHEMA), "1")
    assert rows_of(state.read()) == [("x", 7, "a", 7)]


@pytest.mark.parametrize("hashed", [True, False])
def test_base_is_not_shuffled(spark, state, monkeypatch, hashed):
    if not hashed:
        monkeypatch.setattr("thornwall.streaming.current_state.HASHED_BYTES", 0)
    first = spark.range(2000).selectExpr("concat('k', id) k", "1 m", "'a' f", "cast(id as int) v")
    state.add_changes(first, "1")
    state.fold()
    state.add_changes(spark.createDataFrame([("k7", 2, "a", -1), ("new", 1, "a", -2)], SCHEMA), "2")
    plan = executed(state.read())
    assert plan.count("Exchange ") == 1 and "REPARTITION_BY_NUM" in plan
    assert "Bucketed: true" in plan
    assert ("ShuffledHashJoin" in plan) == hashed
    result = {r["k"]: r["v"] for r in state.read().collect()}
    assert len(result) == 2001 and result["k7"] == -1 and result["new"] == -2 and result["k8"] == 8


def test_one_file_per_bucket(spark, state):
    for i in range(2):
        state.add_changes(spark.range(500).selectExpr("concat('k', id) k", f"{i} m", "'a' f", "0 v"), str(i))
        path = state.fold()
        files = [f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]
        assert len(files) == 8


def test_grows_into_more_buckets(spark, tmp_path):
    state = CurrentState(spark, str(tmp_path / "s"), SCHEMA, "k", ["m"], bucket_bytes=2000, min_buckets=2)
    df = spark.range(10).selectExpr("concat('k', id) k", "1 m", "'a' f", "0 v")
    state.add_changes(df, "1")
    few = state.fold()
    state.add_changes(spark.range(5000).selectExpr("uuid() k", "1 m", "'a' f", "0 v"), "2")
    many = state.fold()
    assert few.endswith("-b00002") and int(many.rsplit("-b", 1)[1]) > 8
    state.add_changes(spark.createDataFrame([("k3", 9, "a", 9)], SCHEMA), "3")
    assert state.read().count() == 5010 and state.read().where("k = 'k3'").first()["v"] == 9


def test_unfinished_output_is_ignored(spark, state):
    df = spark.createDataFrame([("x", 5, "a", 1)], SCHEMA)
    state.add_changes(df, "1")
    base = state.fold()
    state.add_changes(spark.createDataFrame([("x", 9, "a", 9)], SCHEMA), "dead")
    dead = state._change_sets(state.base.latest())[0]
    file_system(spark, dead).delete(hadoop_path(spark, f"{dead}/_SUCCESS"), False)
    spark.createDataFrame([("x", 8, "a", 8)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(state.base.next(8))
    assert state.base.latest() == base
    assert rows_of(state.read()) == [("x", 5, "a", 1)]
    # the next fold takes a number of its own
    state.add_changes(spark.createDataFrame([("y", 1, "a", 1)], SCHEMA), "2")
    assert state.fold() > state.base.root + "/v000002"
    assert rows_of(state.read()) == [("x", 5, "a", 1), ("y", 1, "a", 1)]


def test_vacuum_keeps_the_newest(spark, state):
    for i in range(4):
        state.add_changes(spark.createDataFrame([(f"k{i}", i, "a", i)], SCHEMA), str(i))
        state.fold()
    assert len(state.vacuum(keep=2)) == 2
    assert state.vacuum(keep=2) == []
    assert len(rows_of(state.read())) == 4
    assert sorted(os.listdir(f"{state.root}/changes".removeprefix("file:"))) == ["3"]
    assert len(os.listdir(f"{state.root}/folded".removeprefix("file:"))) == 2


def test_a_batch_stored_during_a_fold_is_kept(spark, state, monkeypatch):
    state.add_changes(spark.createDataFrame([("a", 1, "f", 1)], SCHEMA), "1")
    state.fold()
    state.add_changes(spark.createDataFrame([("b", 1, "f", 2)], SCHEMA), "2")
    merged = state._merged

    def meanwhile(base, sets, buckets):
        found = merged(base, sets, buckets)
        state.add_changes(spark.createDataFrame([("c", 1, "f", 3)], SCHEMA), "3")
        return found

    monkeypatch.setattr(state, "_merged", meanwhile)
    state.fold()
    monkeypatch.undo()
    assert [r[0] for r in rows_of(state.read())] == ["a", "b", "c"]
    state.fold()
    assert [r[0] for r in rows_of(state.read())] == ["a", "b", "c"]


def test_a_reader_settles_on_one_base(spark, state, monkeypatch):
    state.add_changes(spark.createDataFrame([("a", 1, "f", 1)], SCHEMA), "1")
    state.fold()
    state.add_changes(spark.createDataFrame([("b", 1, "f", 2)], SCHEMA), "2")
    listed = state._change_sets

    def after_a_fold(base):
        monkeypatch.undo()
        state.fold()
        return listed(base)

    monkeypatch.setattr(state, "_change_sets", after_a_fold)
    assert [r[0] for r in rows_of(state.read())] == ["a", "b"]


def test_many_small_batches_leave_the_base_alone(spark, state):
    state.add_changes(spark.range(3000).selectExpr("uuid() k", "1 m", "'a' f", "0 v"), "first")
    base = state.fold()
    for i in range(25):
        state.add_changes(spark.createDataFrame([("k", i, "a", i), (f"k{i}", 1, "a", i)], SCHEMA), f"s{i:02d}")
        state.fold_if_due(max_sets=10)
    assert state.base.latest() == base and len(state._change_sets(base)) < 10
    assert state.read().count() == 3026 and state.read().where("k = 'k'").first()["v"] == 24
    assert state.fold() != base and state.read().count() == 3026
    assert state._change_sets(state.base.latest()) == []


# --- through the stream --------------------------------------------------------


def landing_of(tmp_path, seed=0, files=8):
    rng = random.Random(seed)
    directory = tmp_path / "landing"
    for number in range(files):
        cves = []
        for _ in range(15):
            day, valid = rng.randint(1, 9), rng.random() > 0.15
            cves.append(
                cve(
                    f"CVE-{rng.randint(1, 20)}" if rng.random() > 0.05 else None,
                    published="2024-01-01T00:00:00" if valid else "nope",
                    modified=f"2024-01-0{day}T00:00:00",
                    metrics={"cvssMetricV31": [v3(rng.randint(0, 100) / 10)]},
                )
            )
        page(directory, number, *cves)
    return directory


def comparable(df):
    return sorted(json.dumps([str(v) for v in r]) for r in df.drop("_ingest_ts").collect())


def batch_result(spark, landing):
    flat = flatten(occurrences(read_pages(spark, str(landing))), position=True)
    return latest_by_key(expect_all_or_drop(flat, EXPECTATIONS), KEY, BATCH_SEQUENCE).drop("_position")


def log_of(spark, root):
    return Batches(spark, str(root / "log"), ingest.LOG_SCHEMA)


@pytest.mark.parametrize("seed", range(2))
def test_stream_equals_batch_shuffled_and_replayed(spark, tmp_path, seed):
    landing = landing_of(tmp_path, seed)
    files = sorted(landing.iterdir())
    random.Random(seed).shuffle(files)
    for i, path in enumerate(files):
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    state = CurrentState(spark, str(tmp_path / "cves"), SILVER_SCHEMA, KEY, SEQUENCE)
    for checkpoint in ("first", "second"):
        pages = read_pages(spark, str(landing), stream=True, maxFilesPerTrigger=3)
        query = start_upsert(pages, state, log_of(spark, tmp_path), str(tmp_path / checkpoint), fold_ratio=0.5)
        query.awaitTermination()
        assert comparable(state.read()) == comparable(batch_result(spark, landing))


def test_crash_after_the_rows_were_stored(spark, tmp_path, monkeypatch):
    """The batch was written but not committed: it runs again, under the same tag, and nothing is doubled or lost."""
    landing = landing_of(tmp_path, 9)
    state = CurrentState(spark, str(tmp_path / "cves"), SILVER_SCHEMA, KEY, SEQUENCE)
    calls, real = [], ingest._counted

    def dies_on_the_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        return real(*args)

    monkeypatch.setattr(ingest, "_counted", dies_on_the_second)

    def run():
        pages = read_pages(spark, str(landing), stream=True, maxFilesPerTrigger=3)
        start_upsert(pages, state, log_of(spark, tmp_path), str(tmp_path / "cp")).awaitTermination()

    with pytest.raises(StreamingQueryException):
        run()
    assert len(state._change_sets(state.base.latest())) == 2
    run()
    assert len(state._change_sets(state.base.latest())) == 3
    assert comparable(state.read()) == comparable(batch_result(spark, landing))
    log = log_of(spark, tmp_path).read()
    assert log.where("expectation = 'valid_cve_id'").selectExpr("sum(passed_records + failed_records)").first()[0] == 120


def test_equal_sequence_goes_to_the_later_file_and_place(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1", vulnStatus="f0"), cve("CVE-2", vulnStatus="p0"), cve("CVE-2", vulnStatus="p1"))
    page(landing, 1, cve("CVE-1", vulnStatus="f1"))
    rows = {r["cve_id"]: r["vuln_status"] for r in batch_result(spark, landing).collect()}
    assert rows == {"CVE-1": "f1", "CVE-2": "p1"}


def test_equal_sequence_goes_to_the_later_run(spark, tmp_path):
    """Whatever the window in front of it says, and also where one version lies in the base and one beside it."""
    for early_first in (True, False):
        root = tmp_path / str(early_first)
        runs = {"cves_20240301_20240302_p000_20240302T000000Z.json": "early", "cves_20240101_20240102_p000_20240501T000000Z.json": "late"}
        state = CurrentState(spark, str(root / "cves"), SILVER_SCHEMA, KEY, SEQUENCE)
        for i, (name, status) in enumerate(sorted(runs.items(), reverse=early_first)):
            (root / f"landing{i}").mkdir(parents=True)
            (root / f"landing{i}" / name).write_text(json.dumps({"vulnerabilities": [cve("CVE-1", vulnStatus=status)]}))
            pages = read_pages(spark, str(root / f"landing{i}"), stream=True)
            start_upsert(pages, state, log_of(spark, root), str(root / f"cp{i}")).awaitTermination()
            if i == 0:
                state.fold()
        assert [r["vuln_status"] for r in state.read().collect()] == ["late"]
        state.fold()
        assert [r["vuln_status"] for r in state.read().collect()] == ["late"]
        both = read_pages(spark, f"{root}/landing*")
        assert [r["vuln_status"] for r in latest_by_key(flatten(occurrences(both), position=True), KEY, BATCH_SEQUENCE).collect()] == ["late"]


def test_invalid_newest_version_leaves_the_last_valid_one(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1", modified="2024-01-01T00:00:00"))
    page(landing, 1, cve("CVE-1", modified="2024-01-02T00:00:00", published=None))
    row = batch_result(spark, landing).collect()
    assert len(row) == 1 and row[0]["_ingest_file"].endswith("p000_20240131T000000Z.json")


def test_medallion_end_to_end(spark, tmp_path):
    landing = landing_of(tmp_path, 5)
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run(as_of="2024-01-31")
    raw = m.table("nvd_cves_raw")
    assert raw.count() == 8
    assert comparable(m.table("cves")) == comparable(batch_result(spark, landing))
    before = m.table("cve_severity_daily").collect()
    logged = m.expectation_log().where("expectation = 'valid_published'").first()
    assert logged["passed_records"] + logged["failed_records"] == 120 and logged["failed_records"] > 0

    # nothing new: nothing changes; files already taken in are not taken again
    m.run(as_of="2024-01-31")
    assert m.table("nvd_cves_raw").count() == 8 and m.table("cve_severity_daily").collect() == before

    # a re-run of the downloader lands the same content under new names
    for path in list(landing.iterdir()):
        (landing / path.name.replace("20240131T", "20240201T")).write_text(path.read_text())
    m.run(as_of="2024-01-31")
    assert m.table("nvd_cves_raw").count() == 16
    assert m.table("cve_severity_daily").collect() == before

    m.register_views()
    assert spark.sql("select count(*) n from cves_exploded").first()["n"] > spark.table("cves").count()
    m.publish("reports")
    detail = {r["col_name"]: r["data_type"] for r in spark.sql("describe extended reports.cve_cwe_top").collect()}
    assert "quality=gold" in detail["Table Properties"] and detail["Comment"]
    assert spark.table("reports.cves").count() == m.table("cves").count()
    assert spark.table("reports.nvd_cves_raw").count() == 16
    layers = {
        name: spark.sql(f"show tblproperties reports.{name} ('quality')").first()["value"]
        for name in ("nvd_cves_raw", "cves", "cve_severity_daily")
    }
    assert layers == {"nvd_cves_raw": "bronze", "cves": "silver", "cve_severity_daily": "gold"}
    page(landing, 99, cve("CVE-999", published="2024-01-05T00:00:00"), **{"feed-note": "new"})
    m.run(as_of="2024-01-31")
    m.publish("reports")
    assert spark.sql("select max(`feed-note`) n from reports.nvd_cves_raw").first()["n"] == "new"
    assert spark.table("reports.nvd_cves_raw").count() == 17
    assert spark.table("reports.cves").where("cve_id = 'CVE-999'").count() == 1
    total = spark.sql("select sum(cve_count) n from reports.cve_severity_daily").first()["n"]
    assert total == m.table("cves").count()


def test_pending_changes_are_published(spark, tmp_path):
    landing = landing_of(tmp_path, 2)
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run(as_of="2024-01-31")
    m.state.fold()
    base, key = m.state.base.latest(), m.table("cves").select("cve_id").first()["cve_id"]
    m.publish("pending_reports")
    assert spark.table("pending_reports.cves").count() == m.table("cves").count()
    for k, found in enumerate((cve("CVE-999"), cve(key, modified="2030-01-01T00:00:00"))):
        page(landing, 90 + k, found)
        m.ingest().awaitTermination()
        m.upsert().awaitTermination()
        m.refresh_gold("2024-01-31")
        m.publish("pending_reports")
        published = spark.table("pending_reports.cves")
        assert sorted(map(str, published.collect())) == sorted(map(str, m.table("cves").collect()))
        assert m.state.pending() and m.state.base.latest() == base
        assert published.count() == spark.sql("select sum(cve_count) n from pending_reports.cve_severity_daily").first()["n"]
    assert spark.table("pending_reports.cves").where("year(modified_at) = 2030").count() == 1
    m.vacuum(keep=1)
    assert spark.table("pending_reports.cves").where("cve_id = 'CVE-999'").count() == 1
    m.state.fold()
    m.publish("pending_reports")
    assert not m.state.pending() and spark.table("pending_reports.cves").where("cve_id = 'CVE-999'").count() == 1


def test_flattening_a_stream_counts_in_its_progress(spark, tmp_path):
    landing = landing_of(tmp_path, 3)
    stream = flatten(occurrences(read_pages(spark, str(landing), stream=True, maxFilesPerTrigger=3)))
    query = (
        expect_all_or_drop(observed(stream, "expectations", EXPECTATIONS), EXPECTATIONS)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    seen = [p["observedMetrics"]["expectations"] for p in query.recentProgress if p["numInputRows"]]
    assert len(seen) == 3 and sum(m["records"] for m in seen) == 120
    flat = flatten(occurrences(read_pages(spark, str(landing))))
    assert sum(m["valid_published"] for m in seen) == flat.where("published_at is null").count() > 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == expect_all_or_drop(flat, EXPECTATIONS).count()


def test_audit_and_vacuum_of_the_stored_layers(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1"), cve("CVE-2"), total=5)
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run(as_of="2024-01-31")
    incomplete = audit.page_completeness(m.page_index(), 2).collect()
    assert [(r["pages"], r["expected_pages"], r["records"], r["total"]) for r in incomplete] == [(1, 3, 2, 5)]
    for n in range(1, 4):
        page(landing, n, cve(f"CVE-{n + 2}"))
        m.run(as_of="2024-01-31")
    m.vacuum()
    assert len(m._versions("cve_cwe_top").listed()) == 2
    assert m.table("cves").count() == 5 and m.table("cve_severity_daily").first()["cve_count"] == 5


def test_page_with_an_old_file_time_is_not_skipped(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1"))
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run(as_of="2024-01-31")
    page(landing, 1, cve("CVE-2"))
    m.run(as_of="2024-01-31")
    old = page(landing, 2, cve("CVE-3"))
    os.utime(old, (1_600_000_000, 1_600_000_000))
    m.run(as_of="2024-01-31")
    assert m.table("cves").count() == 3


def test_batch_without_any_valid_cve(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0)
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run(as_of="2024-01-31")
    page(landing, 1, cve(None))
    m.run(as_of="2024-01-31")
    assert m.table("cves").count() == 0 and m.table("cve_severity_daily").count() == 0
    failed = m.expectation_log().where("failed_records > 0").collect()
    assert [(r["expectation"], r["failed_records"]) for r in failed] == [("valid_cve_id", 1)]
    page(landing, 2, cve("CVE-1"))
    m.run(as_of="2024-01-31")
    assert m.table("cves").count() == 1


def test_new_fields_join_on_restart(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1"))
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run()
    assert "format" not in m.table("nvd_cves_raw").columns
    page(landing, 1, cve("CVE-2", cveTags=["disputed"]), format="NVD_CVE")
    m.run(evolve=False)
    assert "format" not in m.table("nvd_cves_raw").columns  # typed columns only, as asked
    page(landing, 2, cve("CVE-3"))
    os.utime(landing / page(landing, 3, cve("CVE-4", tooOld=1)).name, (1_600_000_000, 1_600_000_000))
    m.run()
    # Its file time is years old; its new field joins all the same.
    old = m.table("nvd_cves_raw").selectExpr("explode(vulnerabilities.cve) c").selectExpr("c.id", "c.tooOld").collect()
    assert {r["id"]: r["tooOld"] for r in old}["CVE-4"] == 1
    page(landing, 4, cve("CVE-5", cveTags=["disputed"]), format="NVD_CVE")
    m.run()
    raw = m.table("nvd_cves_raw")
    assert sorted(str(r["format"]) for r in raw.collect()) == ["NVD_CVE", "None", "None", "None", "None"]
    tags = raw.selectExpr("explode(vulnerabilities.cve) c").selectExpr("c.id", "c.cveTags").collect()
    assert sorted((r["id"], r["cveTags"]) for r in tags)[-1] == ("CVE-5", ["disputed"])
    assert m.table("cves").count() == 5
    wide = infer_pages(spark, str(landing)).simpleString()
    assert "tooOld" in wide and "cveTags" in wide


def test_no_field_is_lost_whenever_it_comes(spark, tmp_path):
    """After a look, before the start that takes the page in; and under a query that runs on."""
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-0"))
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    m.run()
    page(landing, 1, cve("CVE-1", newField=1), top={"a b": [1]})
    running = m.ingest("continuous", interval="200 milliseconds")
    try:
        running.processAllAvailable()
        page(landing, 2, cve("CVE-2", newField=2.5), **{"it's": "x"})
        running.processAllAvailable()
    finally:
        running.stop()
    m.run()
    page(landing, 3, cve("CVE-3", newField="three", other={"K": None}), top=7)
    (landing / "cves_20240101_20240131_p900_x.json").write_text('{"resultsPerPage": 3, "vulnerab')
    m.run()
    raw = m.table("nvd_cves_raw")
    found = raw.selectExpr("`it's`", "cast(top as string) top", "inline_outer(vulnerabilities)").selectExpr("cve.id", "cast(cve.newField as string) n", "top", "`it's`").collect()
    assert {r["id"]: (r["n"], r["top"], r["it's"]) for r in found} == {
        None: (None, None, None), "CVE-0": (None, None, None), "CVE-1": ("1", '{"a b":[1]}', None), "CVE-2": ("2.5", None, "x"), "CVE-3": ("three", "7", None),
    }
    assert "other" not in raw.schema.simpleString()  # only ever null
    assert m.table("cves").count() == 4
    lost = corrupt_pages(raw).collect()
    assert [(r["document"], r["lost"]) for r in lost] == [('{"resultsPerPage": 3, "vulnerab', True)]


def test_fields_of_many_shapes(spark, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    for n in range(6):
        page(landing, n, cve(f"CVE-{n}", **{f"f{n}": n}))
    monkeypatch.setattr("thornwall.sources.landing.MOST_SHAPES", 2)
    m.run()
    rows = m.table("nvd_cves_raw").selectExpr("inline(vulnerabilities)").selectExpr("cve.id", *(f"cve.f{n}" for n in range(6))).collect()
    assert sorted(tuple(r) for r in rows) == [(f"CVE-{n}", *(n if k == n else None for k in range(6))) for n in range(6)]


def test_types_that_pages_show():
    kind = shown_type("OBJECT<`OBJECT<x`: ARRAY<OBJECT<a: BIGINT, n: VOID>>, b: DECIMAL(2,1)>")
    assert kind.names == ["OBJECT<x", "b"] and kind["OBJECT<x"].dataType.elementType.names == ["a", "n"]
    one, other = shown_type("OBJECT<a: BIGINT, b: VOID, c: ARRAY<BIGINT>>"), shown_type("OBJECT<a: DECIMAL(3,1), b: STRING, c: BIGINT, d: BOOLEAN>")
    assert merged_type(one, other) == merged_type(other, one)
    assert merged_type(one, other).simpleString() == "struct<a:double,b:string,c:variant,d:boolean>"


def test_pages_taken_in_can_be_moved_away(spark, tmp_path):
    landing, archive = tmp_path / "landing", tmp_path / "archive"
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    for n in range(3):
        page(landing, n, cve(f"CVE-{n}"))
        m.ingest(cleanSource="archive", sourceArchiveDir=str(archive)).awaitTermination()
        m.upsert().awaitTermination()
    assert m.table("cves").count() == 3 and m.table("nvd_cves_raw").count() == 3
    left = {p.name for p in landing.glob("cves_*.json")}
    moved = {p.name for p in archive.rglob("cves_*.json")}
    assert len(moved) >= 1 and len(left | moved) == 3 and not left & moved


def test_both_hops_running_on(spark, tmp_path):
    landing = tmp_path / "landing"
    page(landing, 0, cve("CVE-1"))
    m = Medallion(spark, str(tmp_path / "root"), str(landing))
    raw = m.ingest(mode="continuous", interval="200 milliseconds")
    raw.processAllAvailable()
    current = m.upsert(mode="continuous", interval="200 milliseconds")
    try:
        for n in range(1, 4):
            page(landing, n, cve(f"CVE-{n}", modified=f"2024-02-0{n}T00:00:00"), cve("CVE-0", modified=f"2024-02-0{n}T00:00:00"))
            raw.processAllAvailable()
            current.processAllAvailable()
            assert m.table("cves").count() == n + 1
    finally:
        raw.stop()
        current.stop()
    assert m.state.base.latest() is not None
    newest = m.table("cves").where("cve_id = 'CVE-0'").selectExpr("cast(modified_at as string) t").first()
    assert newest["t"] == "2024-02-03 00:00:00"
    with pytest.raises(ValueError):
        m.ingest(mode="sometimes")
