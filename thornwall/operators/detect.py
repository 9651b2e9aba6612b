"""Detection rules: SQL predicates kept as data, all evaluated in one pass over the table they watch."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    rule_id: str
    severity: str
    source: str
    predicate: str
    technique: str | None = None


# The rule set over the events table.
EVENT_RULES = [
    Rule("R1", "HIGH", "events", "event_type = 'error' AND value >= 50", "TECH-1"),
    Rule("R2", "CRITICAL", "events", "value >= 100", "TECH-2"),
    Rule("R3", "LOW", "events", "indicator = 'click:13'", "TECH-3"),
    Rule("R4", "LOW", "events", "value < 0", "TECH-4"),
]

CVE_RULES = [
    Rule("C1", "CRITICAL", "cves", "coalesce(cvss_v31_score, cvss_v30_score, cvss_v2_score) >= 9.0"),
    Rule("C2", "MEDIUM", "cves", "vuln_status = 'Awaiting Analysis' AND cvss_v31_severity = 'HIGH'"),
    Rule("C3", "LOW", "cves", "array_size(reference_urls) = 0"),
]


def read_rules(spark: SparkSession, path: str) -> list[Rule]:
    """Rules from JSON documents, one rule per file or several in an array: as many as people have written."""
    schema = "rule_id string, severity string, source string, predicate string, technique string"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path).orderBy("rule_id")
    return [Rule(**row.asDict()) for row in rows.toLocalIterator()]


def matches(df: DataFrame, rules: list[Rule], source: str) -> DataFrame:
    """One row per (row, rule that holds), with ``rule_id`` and ``rule_severity`` added.

    The table is scanned once, whatever the number of rules; the disjunction in
    front lets the scan skip what no rule can match.
    """
    own = [r for r in rules if r.source == source]
    if not own:
        raise ValueError(f"no rule watches {source}")
    hits = F.array(
        *(
            F.when(
                F.expr(r.predicate),
                F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("rule_severity")),
            )
            for r in own
        )
    )
    return (
        df.where(reduce(or_, (F.expr(r.predicate) for r in own)))
        .withColumn("_rule", F.explode(hits))
        .where(F.col("_rule").isNotNull())
        .withColumns({"rule_id": F.col("_rule.rule_id"), "rule_severity": F.col("_rule.rule_severity")})
        .drop("_rule")
    )


def alerts(df: DataFrame, rules: list[Rule], source: str, asset: str, ts: str) -> DataFrame:
    """One alert per (rule, asset, UTC day), with the number of rows behind it. Counted before the shuffle.

    The id is a digest of the three, each with its length before it, so that no
    two alerts share one, whatever their names contain; a null has no length.
    """
    grouped = (
        matches(df, rules, source)
        .groupBy("rule_id", F.col("rule_severity").alias("severity"), F.col(asset).alias("asset"), F.to_date(ts).alias("day"))
        .agg(F.count(F.lit(1)).alias("matched_rows"))
    )
    parts = [F.col("rule_id"), F.col("asset").cast("string"), F.col("day").cast("string")]
    alert_id = F.sha2(F.concat(*(F.coalesce(F.concat(F.length(part).cast("string"), F.lit(":"), part), F.lit(":")) for part in parts)), 256)
    return grouped.select(alert_id.alias("alert_id"), "rule_id", "severity", "asset", "day", "matched_rows")


def alert_volume(alert_rows: DataFrame) -> DataFrame:
    """Alerts and matched rows per rule and day."""
    return alert_rows.groupBy("rule_id", "day").agg(
        F.count(F.lit(1)).alias("alerts"), F.sum("matched_rows").alias("matched_rows")
    )


def top_iocs(conformed: DataFrame, k: int) -> DataFrame:
    """The k indicators seen most often. Ties go to the smaller indicator."""
    return (
        conformed.groupBy("indicator")
        .agg(F.count(F.lit(1)).alias("sightings"))
        .orderBy(F.desc("sightings"), "indicator")
        .limit(k)
    )


# --- top indicators over any range of days ----------------------------------------


def daily_top(conformed: DataFrame, m: int) -> DataFrame:
    """(day, indicator, sightings): of each day the m indicators seen most often, and with a null indicator the most sightings any other has.

    A day's state never changes once the day is over, and states of several days
    are put together by ``top_iocs_between``. Rows without a day are of none.
    """
    counts = conformed.where("timestamp is not null and indicator is not null").groupBy(F.to_date("timestamp").alias("day"), "indicator").agg(F.count(F.lit(1)).alias("sightings"))
    place = F.row_number().over(Window.partitionBy("day").orderBy(F.desc("sightings"), "indicator"))
    # The (m + 1)-th row tells how many sightings an indicator that is not listed has at most.
    first = counts.withColumn("place", place).where(F.col("place") <= m + 1)
    return first.select("day", F.when(F.col("place") <= m, F.col("indicator")).alias("indicator"), "sightings")


def top_iocs_between(conformed: DataFrame, state: DataFrame, first: str, last: str, k: int) -> DataFrame:
    """``top_iocs`` of the days from ``first`` to ``last``, exact, from day states.

    Listed sightings are a lower bound for an indicator, and with the bounds of
    the days on which it is not listed an upper one. Only indicators whose upper
    bound reaches the k-th lower one are counted again, in those days. If one that
    no day lists might reach it, all are.
    """
    days = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    inside = state.where(days)
    listed = inside.where("indicator is not null")
    bounds = inside.where("indicator is null").select("day", F.col("sightings").alias("bound"))
    all_bounds = bounds.agg(F.coalesce(F.sum("bound"), F.lit(0)).alias("unlisted"))
    low = listed.join(bounds, "day", "left").groupBy("indicator").agg(F.sum("sightings").alias("low"), F.sum(F.coalesce("bound", F.lit(0))).alias("own"))
    floor = low.orderBy(F.desc("low"), "indicator").limit(k).agg(F.min("low").alias("floor"), F.count(F.lit(1)).alias("n"))
    floor_row, unlisted = floor.first(), all_bounds.first()["unlisted"]
    rows = conformed.where(F.to_date("timestamp").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).where("indicator is not null")
    if floor_row["n"] < k or unlisted >= floor_row["floor"]:
        return top_iocs(rows, k)
    candidates = low.where(F.col("low") + F.lit(unlisted) - F.col("own") >= F.lit(floor_row["floor"])).select("indicator")
    return top_iocs(rows.join(candidates, "indicator", "left_semi"), k)


# --- cases of rules -------------------------------------------------------------


def read_cases(spark: SparkSession, path: str) -> DataFrame:
    """(rule_id, case, expected, row) from JSON lines: ``row`` is the JSON of a row to try the rule on."""
    return spark.read.schema("rule_id string, case string, expected boolean, row string").json(path)


def tried(cases: DataFrame, rules: list[Rule], columns: str) -> DataFrame:
    """(rule_id, case, expected, found, passed): every rule on its own cases, in one scan of them.

    ``columns``: DDL of the rows. A predicate that is null does not hold. A rule
    without a positive or without a negative case fails by a row that says which
    one is missing, and so does a case of a rule that there is not.
    """
    rows = cases.withColumn("r", F.from_json("row", columns, {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})).select("rule_id", "case", "expected", "r.*")
    holds = F.lit(None).cast("boolean")
    for rule in rules:
        holds = F.when(F.col("rule_id") == rule.rule_id, F.coalesce(F.expr(rule.predicate), F.lit(False))).otherwise(holds)
    found = rows.select("rule_id", "case", "expected", holds.alias("found"))
    kinds = cases.sparkSession.createDataFrame([(r.rule_id, e) for r in rules for e in (True, False)], "rule_id string, expected boolean")
    missing = kinds.join(found.select("rule_id", "expected").distinct(), ["rule_id", "expected"], "left_anti")
    name = F.when(F.col("expected"), "no positive case").otherwise("no negative case")
    found = found.union(missing.select("rule_id", name.alias("case"), "expected", F.lit(None).cast("boolean").alias("found")))
    return found.withColumn("passed", F.coalesce(F.col("found") == F.col("expected"), F.lit(False)))
