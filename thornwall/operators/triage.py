"""Alerts with the CVE and technique context an analyst would look up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thornwall.functions.cve import score_any, severity_any
from thornwall.operators.detect import Rule

RANKS = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]


def cve_context(cves: DataFrame, by: str = "source_identifier") -> DataFrame:
    """One row per source: number of CVEs, of critical ones, and the worst one.

    Built before any join, so an alert meets one row and not every CVE of its source.
    """
    return cves.groupBy(by).agg(
        F.count(F.lit(1)).alias("related_cves"),
        F.count_if(severity_any() == "CRITICAL").alias("critical_cves"),
        F.max(score_any()).alias("worst_score"),
        F.max_by("cve_id", F.struct(score_any(), "cve_id")).alias("worst_cve"),
    )


def _rank(severity: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, RANKS)), severity)


def rule_techniques(spark: SparkSession, rules: list[Rule], catalogue: DataFrame | None = None) -> DataFrame:
    """One row per rule: its technique, and with a catalogue that one's name and tactics.

    Only techniques that a rule names are read. A technique listed several times
    counts once; one the catalogue does not know keeps its id.
    """
    own = spark.createDataFrame([(r.rule_id, r.technique) for r in rules], "rule_id string, technique string")
    if catalogue is None:
        return own
    named = sorted({r.technique for r in rules if r.technique})
    known = (
        catalogue.where(F.col("technique_id").isin(named))
        .groupBy(F.col("technique_id").alias("technique"))
        .agg(F.min(F.struct("name", "tactics")).alias("_t"))
        .select("technique", F.col("_t.name").alias("technique_name"), F.col("_t.tactics").alias("tactics"))
    )
    return own.join(known, "technique", "left")


def triage(
    alert_rows: DataFrame, context: DataFrame, alert_source: Column, rules: list[Rule], catalogue: DataFrame | None = None
) -> DataFrame:
    """Deterministic triage: every alert once, context or none.

    - An alert on a source with critical CVEs goes up one grade.
    - Confidence is 40 percent, 10 more per matched row up to 30, 20 more with critical CVEs around.

    The techniques come from the rule set: one row per rule, looked up in the
    ``catalogue`` (``technique_id, name, tactics``) if there is one. All is
    joined without a hint: Spark broadcasts what its size, known at run time,
    allows, and otherwise splits skewed sources.
    """
    techniques = rule_techniques(alert_rows.sparkSession, rules, catalogue)
    joined = (
        alert_rows.withColumn("source_identifier", alert_source)
        .join(context, "source_identifier", "left")
        .join(techniques, "rule_id", "left")
        .fillna(0, ["related_cves", "critical_cves"])
    )
    raised = F.least(_rank(F.col("severity")) + (F.col("critical_cves") > 0).cast("int"), F.lit(len(RANKS)))
    percent = (
        F.lit(40) + F.least(F.col("matched_rows") * 10, F.lit(30)) + F.when(F.col("critical_cves") > 0, 20).otherwise(0)
    )
    calibrated = F.get(F.array(*map(F.lit, RANKS)), (raised - 1).cast("int"))
    action = (
        F.when(calibrated == "CRITICAL", "isolate")
        .when(calibrated == "HIGH", "investigate")
        .when(calibrated == "MEDIUM", "review")
        .otherwise("monitor")
    )
    summary = F.concat_ws(
        " ",
        F.col("rule_id"),
        F.lit("on"),
        F.col("asset"),
        F.concat(F.lit("("), F.col("matched_rows"), F.lit(" rows);")),
        F.concat(F.col("related_cves"), F.lit(" related CVEs,")),
        F.concat(F.col("critical_cves"), F.lit(" critical")),
    )
    return joined.select(
        "alert_id",
        "rule_id",
        "severity",
        "asset",
        "day",
        "matched_rows",
        "technique",
        *(("technique_name", "tactics") if catalogue is not None else ()),
        "related_cves",
        "critical_cves",
        "worst_score",
        "worst_cve",
        calibrated.alias("severity_calibrated"),
        action.alias("recommended_action"),
        (percent / F.lit(100)).alias("confidence"),
        summary.alias("summary"),
    )
