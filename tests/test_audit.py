import datetime
import random
from collections import Counter

import pytest

from thornwall.operators import audit
from thornwall.sources.sample_feed import daily_page_index, page_documents

INDEX = "run_ts string, chunk_start date, chunk_end date, page int, total bigint, records bigint"


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


@pytest.fixture
def index(spark):
    def build(*rows):
        return spark.createDataFrame([(run, day(a), day(b), *rest) for run, a, b, *rest in rows], INDEX)

    return build


def test_summary(index):
    df = index(("r1", 0, 5, 0, 15, 10), ("r1", 0, 5, 1, 15, 5), ("r1", 5, 9, 0, 3, 3), ("r2", 0, 5, 0, 1, 1))
    rows = {(r["run_ts"], r["chunk_start"]): (r["files"], r["records"]) for r in audit.ingest_summary(df).collect()}
    assert rows == {("r1", day(0)): (2, 15), ("r1", day(5)): (1, 3), ("r2", day(0)): (1, 1)}
    runs = {r["run_ts"]: (r["files"], r["records"]) for r in audit.ingest_summary(df, ["run_ts"]).collect()}
    assert runs == {"r1": (3, 18), "r2": (1, 1)}


def test_completeness(index):
    df = index(
        ("whole", 0, 1, 0, 20, 10),
        ("whole", 0, 1, 1, 20, 10),
        ("lost_page", 0, 1, 0, 20, 10),
        ("short_page", 0, 1, 0, 20, 10),
        ("short_page", 0, 1, 1, 20, 9),
        ("empty_page", 0, 1, 0, 20, 10),
        ("empty_page", 0, 1, 1, 20, 0),
        ("exact", 0, 1, 0, 10, 10),
    )
    found = {r["run_ts"]: r for r in audit.page_completeness(df, 10).collect()}
    assert set(found) == {"lost_page", "short_page", "empty_page"}
    assert (found["lost_page"]["pages"], found["lost_page"]["expected_pages"]) == (1, 2)
    assert found["empty_page"]["empty_pages"] == 1


def gaps(df, **kw):
    return sorted((r["gap_start"], r["gap_end"]) for r in audit.window_gaps(df, **kw).collect())


def test_gaps_per_run(index):
    df = index(("r", 0, 3, 0, 1, 1), ("r", 3, 5, 0, 1, 1), ("r", 7, 9, 0, 1, 1), ("s", 5, 7, 0, 1, 1))
    assert gaps(df) == [(day(5), day(7))]
    assert gaps(df, across_runs=True) == []


def test_overlap_is_no_gap(index):
    # the second window lies inside the first
    df = index(("r", 0, 10, 0, 1, 1), ("r", 2, 3, 0, 1, 1), ("r", 8, 12, 0, 1, 1), ("r", 13, 14, 0, 1, 1))
    assert gaps(df) == [(day(12), day(13))]


def test_gaps_against_brute_force(index):
    rng = random.Random(4)
    rows = [("r", a, a + rng.randint(1, 6), 0, 1, 1) for a in (rng.randint(0, 200) for _ in range(40))]
    covered = {d for _, a, b, *_ in rows for d in range(a, b)}
    first, last = min(covered), max(covered)
    missing = [d for d in range(first, last) if d not in covered]
    found = gaps(index(*rows), across_runs=True)
    assert sorted(d for a, b in found for d in range((a - day(0)).days, (b - day(0)).days)) == missing


def times(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "cast(t as timestamp) modified_at")


def test_trailing_windows_include_both_ends(spark):
    df = times(spark, "2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 12:00:00", "2024-01-02 12:00:01")
    kept = audit.incremental_window(df, 24, "2024-01-02 12:00:00").collect()
    assert [r["t"] for r in kept] == ["2024-01-01 12:00:00", "2024-01-02 12:00:00"]
    assert audit.backfill_window(df, 2, "2024-01-02 12:00:00").count() == 3
    assert audit.incremental_window(df).count() == 0


def test_chunks_share_their_boundary(spark):
    df = times(
        spark,
        "2023-12-31 23:59:59",
        "2024-01-01 00:00:00",
        "2024-01-07 23:59:59.999999",
        "2024-01-08 00:00:00",
        "2024-01-15 00:00:00",
        "2024-01-18 00:00:00",
        "2024-01-18 00:00:01",
    )
    rows = audit.chunk_assign(df, "2024-01-01 00:00:00", "2024-01-18 00:00:00", 7).collect()
    assert sorted((r["t"], r["chunk"]) for r in rows) == [
        ("2024-01-01 00:00:00", 0),
        ("2024-01-07 23:59:59.999999", 0),
        ("2024-01-08 00:00:00", 0),
        ("2024-01-08 00:00:00", 1),
        ("2024-01-15 00:00:00", 1),
        ("2024-01-15 00:00:00", 2),
        ("2024-01-18 00:00:00", 2),
    ]
    # the last chunk is clipped
    assert {str(r["chunk_end"] - r["chunk_start"]) for r in rows if r["chunk"] == 2} == {"3 days, 0:00:00"}


def test_request_windows(spark):
    utc = datetime.timezone.utc
    start = datetime.datetime(2023, 4, 28, 23, 0, 0, 123456, tzinfo=utc)
    rows = audit.request_windows(spark, start, start + datetime.timedelta(days=365)).collect()
    assert [(r["request_start"], r["request_end"]) for r in rows] == [
        ("2023-04-28T23:00:00.000", "2023-08-26T23:00:00.000"),
        ("2023-08-26T23:00:00.000", "2023-12-24T23:00:00.000"),
        ("2023-12-24T23:00:00.000", "2024-04-22T23:00:00.000"),
        ("2024-04-22T23:00:00.000", "2024-04-27T23:00:00.000"),
    ]
    assert audit.request_windows(spark, start, start + datetime.timedelta(days=240)).count() == 2
    assert audit.request_windows(spark, start, start).count() == 0


def test_range_of_whole_chunks_has_no_extra_one(spark):
    df = times(spark, "2024-01-14 00:00:00", "2024-01-15 00:00:00")
    rows = audit.chunk_counts(df, "2024-01-01 00:00:00", "2024-01-15 00:00:00", 7).collect()
    assert [(r["chunk"], r["rows"]) for r in rows] == [(1, 2)]


def test_duplicates(spark):
    rows = [("a", 1, "f1"), ("a", 1, "f1"), ("a", 1, "f2"), ("a", 2, "f1"), ("b", 1, "f3"), ("b", 1, "f4")]
    df = spark.createDataFrame(rows, "cve_id string, m int, _ingest_file string").selectExpr(
        "cve_id", "timestamp_seconds(m) modified_at", "_ingest_file"
    )
    found = {r["cve_id"]: tuple(r)[2:] for r in audit.duplicate_versions(df).collect()}
    assert found == {"a": (3, 2, "f1", "f2"), "b": (2, 2, "f3", "f4")}


@pytest.mark.parametrize("block", [7, 10, 1000])
def test_page_index_by_counts_equals_numbering_the_rows(spark, block):
    rng = random.Random(block)
    # two thirds of all events on one day
    days = [0 if rng.random() < 0.66 else rng.randint(1, 12) for _ in range(400)]
    events = spark.createDataFrame([(i, str(day(d))) for i, d in enumerate(days)], "event_id bigint, d string").selectExpr(
        "event_id", "cast(d as timestamp_ntz) ts"
    )
    seen, pages = Counter(), Counter()
    for d in days:
        pages[d, seen[d] // 10] += 1
        seen[d] += 1
    expected = {
        (day(d), p, seen[d], n) for (d, p), n in pages.items() if not (d % 7 == 3 and p == 1) and d % 11 != 5
    }
    found = {
        (r["chunk_start"], r["page"], r["total"], r["records"])
        for r in daily_page_index(events, 10, block).collect()
    }
    assert found == expected


def test_repeated_event_ids_fail_loudly(spark):
    events = spark.createDataFrame([(1, "click"), (2, "view"), (2, "view")], "event_id bigint, event_type string")
    events = events.selectExpr("event_id", "timestamp '2024-01-01' ts", "1 user_id", "event_type")
    with pytest.raises(Exception, match="event ids must be unique"):
        page_documents(events).collect()
    assert page_documents(events.distinct()).count() == 1


def test_windows_without_a_known_total_are_shown(index):
    found = audit.page_completeness(index(("a", 0, 1, 0, None, 0), ("a", 1, 2, 0, 5, 5)), 10).collect()
    assert [r["chunk_start"] for r in found] == [day(0)]
