"""Every registered query against its SQL form, on the whole input."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import oracle_queries
from conftest import TESTDATA
from thornwall.plans import queries as registry

SF = str(TESTDATA / "sf0.001")
ORACLES = oracle_queries.all_sql()
# Queries without an SQL form.
ROWS_ONLY: set[str] = set()


def views(directory):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for path in Path(directory).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


@pytest.fixture(scope="module")
def duck():
    return views(SF)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    """The same events, but two of five fall on one day and as many are of one user."""
    directory = tmp_path_factory.mktemp("skewed")
    views(SF).execute(
        f"""copy (
              select event_id,
                     case when event_id % 5 in (1, 3) then timestamp '2024-01-09' + (ts - date_trunc('day', ts)) else ts end as ts,
                     case when event_id % 5 in (2, 3) then 7 else user_id end as user_id, event_type, value, props
              from events order by event_id) to '{directory}/events.parquet' (format parquet)"""
    )
    return str(directory)


def normal(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else f"{value:.9g}"
    return "NULL" if value is None else str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(registry.registered()) - ROWS_ONLY == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def assert_same(spark, con, name, directory):
    result = contract.queries()[name](spark, directory)
    cursor = con.execute(ORACLES[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    actual = canonical(result.columns, [tuple(r) for r in result.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert len(expected[1]) > 0
    assert actual[1] == expected[1]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert_same(spark, duck, name, SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql_on_skewed_events(spark, skewed, name):
    assert_same(spark, views(skewed), name, skewed)


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["day", "severity", "cve_count"]
    assert rows.count() == 124


def test_known_sizes(spark):
    queries = contract.queries()

    def rows(name):
        return queries[name](spark, SF)

    sizes = {"bronze_pages": 2, "cves_scd1": 334, "cve_severity_daily": 124, "cve_recent_critical": 22, "cve_cwe_top": 15}
    sizes |= {"page_completeness": 7, "window_gaps": 6, "window_gaps_across_runs": 2, "corrupt_pages": 2}
    assert {name: rows(name).count() for name in sizes} == sizes
    by_severity = rows("cve_severity_daily").groupBy("severity").sum("cve_count").collect()
    assert dict(tuple(r) for r in by_severity) == {"CRITICAL": 35, "HIGH": 61, "MEDIUM": 99, "LOW": 127, "UNKNOWN": 12}
    alerts = rows("detection_alerts").groupBy("rule_id").agg({"*": "count", "matched_rows": "sum"}).collect()
    found = {r["rule_id"]: (r["count(1)"], r["sum(matched_rows)"]) for r in alerts}
    assert found == {"R1": (73, 79), "R2": (118, 136), "R3": (2, 2)}
    assert rows("ingest_summary").agg({"files": "sum"}).first()[0] == 110
