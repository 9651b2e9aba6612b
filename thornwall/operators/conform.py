"""One shape for all telemetry: (timestamp, source, asset, indicator, severity, raw)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thornwall.functions.cve import severity_any
from thornwall.operators.quality import expect_all_or_drop, holds

COLUMNS = ["timestamp", "source", "asset", "indicator", "severity", "raw"]

#: How timestamps are written in ``raw`` documents: no digit is lost.
RAW_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"}

# Required of every conformed row.
REQUIRED = {
    "valid_timestamp": "timestamp IS NOT NULL",
    "valid_source": "source IS NOT NULL",
    "valid_asset": "asset IS NOT NULL",
}


def graded(value: Column, *steps: tuple[float, str], otherwise: str) -> Column:
    """The label of the first lower bound the value reaches."""
    grades = F.when(value >= steps[0][0], steps[0][1])
    for bound, label in steps[1:]:
        grades = grades.when(value >= bound, label)
    return grades.otherwise(otherwise)


def _events() -> list[Column]:
    return [
        F.col("ts").cast("timestamp"),
        F.lit("events"),
        F.concat(F.lit("user-"), F.col("user_id")),
        F.concat_ws(":", "event_type", F.get_json_object("props", "$.k")),
        graded(F.col("value"), (100, "CRITICAL"), (50, "HIGH"), (10, "MEDIUM"), otherwise="LOW"),
        F.col("props"),
    ]


def _zeek_conn() -> list[Column]:
    return [
        F.timestamp_micros(F.round(F.col("ts") * 1_000_000).cast("bigint")),
        F.lit("zeek"),
        F.col("`id.orig_h`"),
        F.concat_ws(":", "`id.resp_h`", F.col("`id.resp_p`").cast("string")),
        F.when(F.col("conn_state").isin("REJ", "S0", "RSTO", "RSTR"), "MEDIUM").otherwise("LOW"),
        F.to_json(F.struct("*")),
    ]


def _sysmon() -> list[Column]:
    return [
        F.try_to_timestamp(F.col("utc_time")),
        F.lit("sysmon"),
        F.col("computer"),
        F.coalesce("image", "target"),
        # 8 remote thread, 10 process access, 25 process tampering
        F.when(F.col("event_id").isin(8, 10, 25), "HIGH").when(F.col("event_id") == 1, "MEDIUM").otherwise("LOW"),
        F.to_json(F.struct("*")),
    ]


def _cves() -> list[Column]:
    return [
        F.col("modified_at"),
        F.lit("cves"),
        F.col("source_identifier"),
        F.col("cve_id"),
        severity_any(),
        F.to_json(F.struct("*"), RAW_FORMAT),
    ]


def _zeek_record() -> list[Column]:
    """A line of any log, by the names of its header."""
    field = F.col("fields")
    seconds = field["ts"].try_cast("double")
    place = F.concat_ws(":", field["id.resp_h"], field["id.resp_p"])
    refused = (F.col("path") == "conn") & field["conn_state"].isin("REJ", "S0", "RSTO", "RSTR")
    unknown = (F.col("path") == "dns") & (field["rcode_name"] == "NXDOMAIN")
    return [
        F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint")),
        F.lit("zeek"),
        field["id.orig_h"],
        F.when(F.col("path") == "dns", field["query"]).when(F.col("path") == "http", F.concat_ws("", field["host"], field["uri"])).otherwise(F.nullif(place, F.lit(""))),
        F.when(F.coalesce(refused | unknown, F.lit(False)), "MEDIUM").otherwise("LOW"),
        F.col("raw"),
    ]


def _endpoint(event_id: Column, utc_time: Column, computer: Column, *indicators: Column) -> list[Column]:
    grade = F.when(event_id.isin(8, 10, 25), "HIGH").when(event_id == 1, "MEDIUM").otherwise("LOW")
    return [F.try_to_timestamp(utc_time), F.lit("sysmon"), computer, F.coalesce(*indicators), grade, F.col("raw")]


def _sysmon_json_record() -> list[Column]:
    def item(name: str, kind: str = "string") -> Column:
        return F.try_variant_get("record", f"$.{name}", kind)

    return _endpoint(item("EventID", "int"), item("UtcTime"), item("Computer"), item("Image"), item("TargetFilename"))


def _sysmon_xml_record() -> list[Column]:
    def item(name: str) -> Column:
        return F.get(F.filter("record.EventData.Data", lambda d: d["_Name"] == name), F.lit(0))["_VALUE"]

    system = F.col("record.System")
    return _endpoint(system["EventID"], system["TimeCreated"]["_SystemTime"], system["Computer"], item("Image"), item("TargetFilename"))


#: Parsed records (``sources.records``) in the common shape.
RECORD_SHAPES = {"zeek": _zeek_record, "sysmon_json": _sysmon_json_record, "sysmon_xml": _sysmon_xml_record}


def judged(parsed: DataFrame, source: str) -> DataFrame:
    """Every record in the common shape, with the rules it fails; none is dropped.

    A record that could not be read has only its ``value``, and its fault among
    ``failed_rules``. Sound rows have no ``value``: ``raw`` says it all.
    """
    read = F.col("fault").isNull()
    # A catalogue's records are no events: they have no shape, and nothing is required of them.
    columns = RECORD_SHAPES[source]() if source in RECORD_SHAPES else [F.lit(None).cast("timestamp"), F.lit(source), *[F.lit(None).cast("string")] * 3, F.col("raw")]
    shaped = [F.when(read, column).alias(name) for name, column in zip(COLUMNS, columns)]
    rows = parsed.select(*shaped, "fault", "value", "_ingest_ts", "_ingest_file")
    required = REQUIRED if source in RECORD_SHAPES else {}
    failed = F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(~holds(p), F.lit(name)) for name, p in required.items())))
    failed = F.when(F.col("fault").isNotNull(), F.array("fault")).otherwise(failed)
    rows = rows.withColumn("failed_rules", failed)
    return rows.select(*COLUMNS, "failed_rules", F.when(F.size("failed_rules") > 0, F.col("value")).alias("value"), "_ingest_ts", "_ingest_file")


_SHAPES = {"events": _events, "zeek": _zeek_conn, "sysmon": _sysmon, "cves": _cves}


def event_columns() -> dict[str, Column]:
    """The conformed columns event rules refer to, to be added to the event's own."""
    shaped = dict(zip(COLUMNS, _events()))
    return {name: shaped[name] for name in ("asset", "indicator")}


def conform(df: DataFrame, source: str) -> DataFrame:
    """Rows of one source in the common shape; rows without the required fields are dropped."""
    shaped = df.select(*(column.alias(name) for name, column in zip(COLUMNS, _SHAPES[source]())))
    return expect_all_or_drop(shaped, REQUIRED)


def conform_all(sources: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (conform(df, name) for name, df in sources.items()))


def deduplicated(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each conformed row once.

    A stream can only remember so much: it keeps a digest per row for ``delay``
    of event time, and drops rows that come later than that. A batch has no such
    limit.
    """
    if not df.isStreaming:
        return df.dropDuplicates(COLUMNS)
    exact = F.to_json(F.struct(F.unix_micros("timestamp").alias("timestamp"), *COLUMNS[1:]))
    keyed = df.withColumn("_digest", F.sha2(exact, 256)).withWatermark("timestamp", delay)
    return keyed.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")
