"""The registered queries: each takes (spark, sf_dir) and covers the whole input.

Timestamps, dates, arrays and counts that may be missing are shown as text, so
that results compare across engines. The operators themselves return them typed.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thornwall.functions import cpe
from thornwall.functions.cve import iso_z
from thornwall.operators import audit, conform, detect, govern, quality, related, trends, triage, upsert
from thornwall.operators.flatten import flatten, occurrences
from thornwall.plans import gold, workspace
from thornwall.plans.medallion import Medallion
from thornwall.schema import CVE_FIELDS, EXPECTATIONS, INGEST_COLUMNS, KEY, POSITION, SILVER_SCHEMA, SEQUENCE, page_schema
from thornwall.sources import landing, records, sample_feed, telemetry
from thornwall.sources.files import bucket_count
from thornwall.streaming.batches import Batches
from thornwall.streaming.current_state import CurrentState
from thornwall.streaming.ingest import BATCH_SEQUENCE, LOG_SCHEMA, start_upsert

AS_OF = "2024-01-31"
RECENT_DAYS = 20
EVENTS_PER_FILE = 100_000
CHUNKS = ("2024-01-01 00:00:00", "2024-02-04 00:00:00", 7)

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def registered() -> dict[str, Query]:
    return dict(_queries)


# --- presentation ------------------------------------------------------------


def _stamp(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def _text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def _joined(name: str) -> Column:
    return F.concat_ws(",", name).alias(name)


def _file() -> Column:
    return landing.file_name(F.col("_ingest_file")).alias("ingest_file")


def _place() -> list[Column]:
    return [_file(), F.col(POSITION).alias("position")]


_SHOWN_SILVER = {
    "published_at": _stamp,
    "modified_at": _stamp,
    "cwe_ids": _joined,
    "reference_urls": _joined,
    "reference_count": _text,
}


def _shown(df: DataFrame, *extra: Column) -> DataFrame:
    names = [c for c in df.columns if not c.startswith("_")]
    return df.select(*(_SHOWN_SILVER.get(n, F.col)(n) for n in names), _file(), *extra)


# --- raw pages and occurrences -----------------------------------------------


def _raw(spark: SparkSession, sf_dir: str, *fields: str) -> DataFrame:
    """The raw table with only the given record fields in the read schema."""
    path = workspace.ingested(spark, sf_dir).raw_path
    return spark.read.schema(f"{page_schema(*fields)}, {INGEST_COLUMNS}").parquet(path)


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(occurrences(_raw(spark, sf_dir)), position=True)


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect_all_or_drop(_flat(spark, sf_dir), EXPECTATIONS)


_REQUIRED_FIELDS = ("id", "published", "lastModified")
_REQUIRED_COLUMNS = ("cve_id", "published_at", "modified_at")


def _required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Just the columns the expectations look at."""
    return flatten(occurrences(_raw(spark, sf_dir, *_REQUIRED_FIELDS)), *_REQUIRED_COLUMNS, position=True)


@query
def bronze_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = landing.read_pages(spark, workspace.landed(spark, sf_dir).landing, page_schema("id"))
    return landing.page_index(pages).withColumns(
        {"chunk_start": F.col("chunk_start").cast("string"), "chunk_end": F.col("chunk_end").cast("string")}
    )


@query
def bronze_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occurrences(_raw(spark, sf_dir, *_REQUIRED_FIELDS)).select(
        *_place(),
        F.col("cve.id").alias("cve_id"),
        F.col("cve.published").alias("published"),
        F.col("cve.lastModified").alias("last_modified"),
    )


@query
def cves_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_flat(spark, sf_dir), F.col(POSITION).alias("position"))


@query
def description_first_en(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten(occurrences(_raw(spark, sf_dir, "id", "descriptions")), "cve_id", "description_en", position=True)
    return rows.select(*_place(), "cve_id", "description_en")


@query
def cwe_ids_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten(occurrences(_raw(spark, sf_dir, "id", "weaknesses")), "cve_id", "cwe_ids", position=True)
    return rows.select(*_place(), "cve_id", _joined("cwe_ids"), F.array_size("cwe_ids").cast("string").alias("cwe_entries"))


@query
def reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten(occurrences(_raw(spark, sf_dir, "id", "references")), "cve_id", "reference_urls", position=True)
    return rows.select(*_place(), "cve_id", F.array_size("reference_urls").cast("string").alias("reference_count"))


# --- expectations --------------------------------------------------------------


@query
def cves_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_valid(spark, sf_dir), F.col(POSITION).alias("position"))


@query
def dq_expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rule_counts(_required(spark, sf_dir), EXPECTATIONS)


@query
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = quality.quarantine(_required(spark, sf_dir), EXPECTATIONS)
    return dropped.select(*_place(), "cve_id", _joined("failed_rules"))


@query
def dq_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the streaming upsert logged, added up over its batches."""
    log = workspace.upserted(spark, sf_dir).expectation_log()
    return log.groupBy("expectation").agg(
        F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records")
    )


# --- current state -------------------------------------------------------------


@query
def cves_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(upsert.latest_by_key(_valid(spark, sf_dir), KEY, BATCH_SEQUENCE).drop(POSITION))


@query
def cves_scd1_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files in four or more micro-batches, newest files first; changes folded into the base on the way."""

    medallion = workspace.landed(spark, sf_dir)
    root = workspace.folder(spark, sf_dir, "stream")
    state = CurrentState(spark, f"{root}/cves", SILVER_SCHEMA, KEY, SEQUENCE)

    def build() -> None:
        files = landing.landing_totals(spark, medallion.landing).first()["files"]
        per_batch = min(max(1, math.ceil(files / 4)), landing.FILES_PER_BATCH)
        pages = landing.read_pages(
            spark, medallion.landing, stream=True, maxFilesPerTrigger=per_batch, latestFirst="true"
        )
        log = Batches(spark, f"{root}/log", LOG_SCHEMA)
        start_upsert(pages, state, log, f"{root}/checkpoint", fold_ratio=0.5).awaitTermination()

    workspace.once(spark, sf_dir, "stream", build)
    return _shown(state.read())


@query
def cves_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hops in continuous mode, stopped once they have taken in what there is."""
    return _shown(workspace.continuous(spark, sf_dir).table("cves"))


# --- reporting -----------------------------------------------------------------


def _cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workspace.upserted(spark, sf_dir).table("cves")


@query
def cve_severity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.severity_daily(_cves(spark, sf_dir)).select(_text("day"), "severity", "cve_count")


@query
def cve_recent_critical(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.recent_critical(_cves(spark, sf_dir), AS_OF, RECENT_DAYS)
    return rows.select(*(_SHOWN_SILVER.get(n, F.col)(n) for n in rows.columns))


@query
def cve_cwe_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.cwe_top(_cves(spark, sf_dir))


def _reported(spark: SparkSession, sf_dir: str) -> Medallion:
    medallion = workspace.upserted(spark, sf_dir)
    workspace.once(spark, sf_dir, "gold", lambda: medallion.refresh_gold(AS_OF))
    return medallion


@query
def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the stored reports: what each is about, and what it counts."""
    medallion = _reported(spark, sf_dir)
    shown = {
        "cve_severity_daily": (F.concat_ws("|", F.col("day").cast("string"), "severity"), F.col("cve_count")),
        "cve_recent_critical": (F.concat_ws("|", "cve_id", "vuln_status", "description_short"), F.lit(1).cast("bigint")),
        "cve_cwe_top": (F.col("cwe_id"), F.col("cve_count")),
    }
    rows = [
        medallion.table(name).select(F.lit(name).alias("report"), item.alias("item"), counted.alias("counted"))
        for name, (item, counted) in shown.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query
def cvss_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.cvss_best(_cves(spark, sf_dir))


@query
def top_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.top_sources(_cves(spark, sf_dir))


@query
def trending_cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.expect_all_or_drop(_required(spark, sf_dir), EXPECTATIONS)
    return trends.trending_cves(rows).select("cve_id", _text("day"), "occurrences", "trailing_mean")


# --- landing audits ------------------------------------------------------------


@query
def landing_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.landing_totals(spark, workspace.landed(spark, sf_dir).landing).select("files")


@query
def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = landing.landing_inventory(spark, workspace.dated(spark, sf_dir))
    return found.select("file_name", _stamp("modificationTime").alias("modified"), (F.col("size_kb") > 0).alias("has_size"))


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in ("chunk_start", "chunk_end")})


@query
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(audit.ingest_summary(workspace.audited(spark, sf_dir).page_index()))


@query
def page_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(audit.page_completeness(workspace.audited(spark, sf_dir).page_index(), page_size=10))


@query
def window_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.window_gaps(workspace.audited(spark, sf_dir).page_index())
    return rows.select("run_ts", _text("gap_start"), _text("gap_end"), "gap_days")


@query
def window_gaps_across_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.window_gaps(workspace.audited(spark, sf_dir).page_index(), across_runs=True)
    return rows.select(_text("gap_start"), _text("gap_end"), "gap_days")


@query
def corrupt_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landing.corrupt_pages(workspace.audited(spark, sf_dir).table("nvd_cves_raw"))
    return rows.select(_file(), "lost", (F.length("document") > 0).alias("kept_text"))


@query
def schema_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that only some pages have, of pages and of records; those pages came between runs and under a running query."""
    raw = workspace.evolved_on_the_way(spark, sf_dir).table("nvd_cves_raw")
    rows = raw.select("_ingest_file", "format", F.posexplode("vulnerabilities.cve").alias(POSITION, "cve"))
    return rows.select(*_place(), F.col("cve.id").alias("cve_id"), "format", F.concat_ws(",", "cve.cveTags").alias("cve_tags"))


@query
def ingest_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page has the time it was taken in, one time for all of a batch."""
    raw = workspace.evolved(spark, sf_dir).table("nvd_cves_raw")
    step = landing.file_parts(landing.file_name(F.col("_ingest_file")))["page"] % 2
    return raw.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("pages"), F.count("_ingest_ts").alias("clocked"), F.count_distinct("_ingest_ts").alias("clocks")
    )


@query
def incremental_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.incremental_window(_cves(spark, sf_dir), as_of="2024-01-20 00:00:00")
    return rows.select("cve_id", _stamp("modified_at"))


@query
def backfill_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audit.backfill_window(_cves(spark, sf_dir), days=14, as_of="2024-01-20 12:00:00")
    return rows.select("cve_id", _stamp("modified_at"))


@query
def chunk_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.expect_all_or_drop(_required(spark, sf_dir), EXPECTATIONS)
    return audit.chunk_counts(rows, *CHUNKS).select(
        "chunk",
        iso_z(F.col("chunk_start")).alias("chunk_start"),
        iso_z(F.col("chunk_end")).alias("chunk_end"),
        "rows",
        _stamp("first_ts"),
        _stamp("last_ts"),
    )


@query
def duplicate_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.expect_all_or_drop(_required(spark, sf_dir), EXPECTATIONS)
    found = audit.duplicate_versions(rows.withColumn("_ingest_file", _file()))
    return found.select("cve_id", _stamp("modified_at"), "occurrences", "files", "first_file", "last_file")


# --- detections ----------------------------------------------------------------


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform(workspace.events(spark, sf_dir), "events")


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = workspace.events(spark, sf_dir).withColumns(conform.event_columns())
    return detect.alerts(rows, detect.EVENT_RULES, "events", "asset", "ts")


@query
def conformed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conformed(spark, sf_dir).withColumn("timestamp", _stamp("timestamp"))


@query
def conformed_cves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With all columns of the record, read back from ``raw``."""
    rows = conform.conform(_cves(spark, sf_dir), "cves")
    record = F.from_json("raw", SILVER_SCHEMA, conform.RAW_FORMAT).alias("r")
    return _shown(rows.select(_stamp("timestamp"), "source", "asset", "indicator", "severity", record).select("*", "r.*").drop("r"))


@query
def conformed_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = _conformed(spark, sf_dir).unionByName(_conformed(spark, sf_dir))
    return conform.deduplicated(twice).withColumn("timestamp", _stamp("timestamp"))


@query
def conformed_distinct_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed rows streamed, then all of them landed and streamed once more: the second time adds nothing."""
    root = workspace.folder(spark, sf_dir, "distinct")

    def build() -> None:
        rows = _conformed(spark, sf_dir)
        for _ in range(2):
            rows.write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
            # Longer than the events span: as the batch form, it then forgets nothing.
            distinct = conform.deduplicated(stream, "60 days").writeStream.format("parquet")
            distinct.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out").awaitTermination()

    workspace.once(spark, sf_dir, "distinct", build)
    return spark.read.schema(_conformed(spark, sf_dir).schema).parquet(f"{root}/out").withColumn("timestamp", _stamp("timestamp"))


@query
def detection_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir).withColumn("day", _text("day"))


@query
def cve_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detect.alerts(_cves(spark, sf_dir), detect.CVE_RULES, "cves", "source_identifier", "modified_at")
    return rows.withColumn("day", _text("day"))


@query
def alert_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.alert_volume(_alerts(spark, sf_dir)).withColumn("day", _text("day"))


@query
def top_iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.top_iocs(_conformed(spark, sf_dir), 20)


def _cve_source() -> Column:
    """The reporting source that stands for the user an alert is about."""
    user = F.substring_index("asset", "-", -1).cast("bigint")
    return F.concat(F.lit("src"), (user % 10).cast("string"), F.lit("@example.org"))


@query
def triage_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    context = triage.cve_context(_cves(spark, sf_dir))
    rows = triage.triage(_alerts(spark, sf_dir), context, _cve_source(), detect.EVENT_RULES)
    return rows.withColumn("day", _text("day"))


def _refresh_alerts(spark: SparkSession, sf_dir: str, medallion: Medallion) -> None:
    rows = workspace.events(spark, sf_dir).withColumns(conform.event_columns())
    medallion.refresh_alerts(rows, detect.EVENT_RULES, "events", "asset", "ts", _cve_source())


def _alerted(spark: SparkSession, sf_dir: str) -> Medallion:
    medallion = workspace.upserted(spark, sf_dir)
    workspace.once(spark, sf_dir, "alerts", lambda: _refresh_alerts(spark, sf_dir, medallion))
    return medallion


@query
def alerts_triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, stored and read back: alerts first, then triage on the stored alerts."""
    return _alerted(spark, sf_dir).table("alerts_triaged").withColumn("day", _text("day"))


@query
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored datasets in a catalog, with changes pending: layer and description of each, and its number of rows."""
    medallion = workspace.half_folded(spark, sf_dir)
    location = workspace.folder(spark, sf_dir, "catalog")
    database = f"thornwall_{hashlib.sha256(location.encode()).hexdigest()[:12]}"

    def build() -> None:
        medallion.refresh_gold(AS_OF)
        _refresh_alerts(spark, sf_dir, medallion)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
        medallion.publish(database)

    workspace.once(spark, sf_dir, "catalog", build)
    tables = spark.catalog.listTables(database)
    layers = {t.name: spark.sql(f"SHOW TBLPROPERTIES {database}.{t.name} ('quality')").first()["value"] for t in tables}
    about = spark.createDataFrame([(t.name, layers[t.name], t.description) for t in tables], "dataset string, quality string, description string")
    rows = reduce(DataFrame.union, [spark.table(f"{database}.{t.name}").select(F.lit(t.name).alias("dataset")) for t in tables])
    counts = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows"))
    return about.join(counts, "dataset", "left").fillna(0, ["rows"])


# --- governance ----------------------------------------------------------------


@query
def retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = govern.retained(workspace.events(spark, sf_dir), AS_OF, 10, ts="ts")
    return rows.select("event_id", _stamp("ts"))


@query
def conformed_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed rows stored by day, the days past retention dropped."""
    path = workspace.folder(spark, sf_dir, "conformed")

    def build() -> None:
        govern.store_by_day(_conformed(spark, sf_dir), path)
        govern.drop_expired(spark, path, AS_OF, 14)

    workspace.once(spark, sf_dir, "conformed", build)
    return spark.read.parquet(path).select(_stamp("timestamp"), "asset", "indicator", "severity", _text("day"))


@query
def masked_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = {"event_id": "public", "ts": "public", "event_type": "public", "user_id": "pii", "props": "sensitive"}
    shown = govern.masked_view(workspace.events(spark, sf_dir), tags, "event_type <> 'purchase'", salt="example")
    return shown.withColumn("ts", _stamp("ts"))


# --- further sources -------------------------------------------------------------


def _zeek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as connection logs with four fields more than the schema names, read back."""

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "zeek")
        user, host = F.col("user_id"), F.col("event_id") % 250
        log = workspace.events(spark, sf_dir).select(
            (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(20,0)") / 1_000_000).cast("decimal(20,6)").alias("ts"),
            F.concat(F.lit("C"), F.col("event_id")).alias("uid"),
            F.concat(F.lit("10.0."), user % 250, F.lit(".7")).alias("orig_h"),
            (F.lit(30000) + user % 1000).cast("int").alias("orig_p"),
            F.concat(F.lit("192.0.2."), host).alias("resp_h"),
            F.when(F.col("event_type") == "error", 22).otherwise(443).alias("resp_p"),
            F.lit("tcp").alias("proto"),
            F.when(F.col("event_type") != "error", "ssl").alias("service"),
            F.col("value").alias("duration"),
            F.lit(None).cast("bigint").alias("orig_bytes"),
            F.lit(None).cast("bigint").alias("resp_bytes"),
            F.when(F.col("event_type") == "error", "REJ").otherwise("SF").alias("conn_state"),
            F.lit("T").alias("local_orig"),
            F.lit("F").alias("local_resp"),
            F.col("event_id").alias("missed_bytes"),
            F.lit("ShADad").alias("history"),
        )
        log.write.options(sep="\t", nullValue="-", quote="").csv(path)
        return path

    return telemetry.read_zeek(spark, workspace.once(spark, sf_dir, "zeek", build))


@query
def zeek_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With fields of the record, read back from ``raw``: two that have a column, and those that have none."""
    r = F.from_json("raw", "uid string, duration double, more array<string>")
    rows = conform.conform(_zeek(spark, sf_dir), "zeek").withColumn("r", r)
    shown = (F.col("r.uid").alias("uid"), F.col("r.duration").alias("duration"), F.concat_ws(",", "r.more").alias("more"))
    return rows.select(_stamp("timestamp"), "source", "asset", "indicator", "severity", *shown)


def _with_items(conformed: DataFrame) -> DataFrame:
    """With all items of the event, read back from ``raw``."""
    items = F.from_json("raw", "data array<struct<name:string,value:string>>")["data"]
    pairs = F.array_sort(F.transform(items, lambda x: F.concat_ws("=", x["name"], x["value"])))
    return conformed.select(_stamp("timestamp"), "source", "asset", "indicator", "severity", F.concat_ws(";", pairs).alias("items"))


def _sysmon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as endpoint XML, read back."""

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "sysmon")

        def data(name: str, value: Column) -> Column:
            return F.struct(F.lit(name).alias("_Name"), value.alias("_VALUE"))

        rows = workspace.spread(workspace.events(spark, sf_dir)).select(
            F.struct(
                F.when(F.col("event_type") == "error", 8).otherwise(1).alias("EventID"),
                F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("_SystemTime")).alias("TimeCreated"),
                F.concat(F.lit("HOST-"), F.col("user_id")).alias("Computer"),
            ).alias("System"),
            F.struct(
                F.array(
                    data("Image", F.concat(F.lit("C:\\bin\\"), F.col("event_type"), F.lit(".exe"))),
                    data("User", F.concat(F.lit("u"), F.col("user_id"))),
                    data("CommandLine", F.concat(F.lit("run --id "), F.col("event_id"))),
                    data("DestinationIp", F.lit("192.0.2.9")),
                ).alias("Data")
            ).alias("EventData"),
        )
        # A file is read by one task: none gets more rows than this.
        rows.write.format("xml").options(rootTag="Events", rowTag="Event", maxRecordsPerFile=EVENTS_PER_FILE).save(path)
        return path

    return telemetry.read_sysmon(spark, workspace.once(spark, sf_dir, "sysmon", build))


@query
def sysmon_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_items(conform.conform(_sysmon(spark, sf_dir), "sysmon"))


@query
def sysmon_json_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as endpoint JSON lines, read back and conformed."""

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "sysmon-json")
        rows = workspace.events(spark, sf_dir).select(
            F.when(F.col("event_type") == "error", 8).otherwise(1).alias("EventID"),
            F.concat(F.lit("HOST-"), F.col("user_id")).alias("Computer"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("UtcTime"),
            F.concat(F.lit("C:\\bin\\"), F.col("event_type"), F.lit(".exe")).alias("Image"),
            F.concat(F.lit("run --id "), F.col("event_id")).alias("CommandLine"),
        )
        rows.write.json(path)
        return path

    rows = telemetry.read_sysmon(spark, workspace.once(spark, sf_dir, "sysmon-json", build), "json")
    return _with_items(conform.conform(rows, "sysmon"))


@query
def conformed_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sources in one shape."""
    sources = {
        "events": workspace.events(spark, sf_dir),
        "zeek": _zeek(spark, sf_dir),
        "sysmon": _sysmon(spark, sf_dir),
        "cves": _cves(spark, sf_dir),
    }
    rows = conform.conform_all(sources)
    return rows.select(_stamp("timestamp"), "source", "asset", "indicator", "severity")


def _techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technique bundles derived from the events, one small document per block of ids, read back."""

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "stix")
        h = F.col("event_id")
        item = F.struct(
            F.when(h % 5 == 4, "malware").otherwise("attack-pattern").alias("type"),
            F.concat(F.lit("attack-pattern--"), h).alias("id"),
            F.concat(F.col("event_type"), F.lit(" "), h).alias("name"),
            F.when(h % 7 == 0, True).alias("revoked"),
            F.when(h % 11 == 0, True).otherwise(False).alias("x_mitre_deprecated"),
            F.array(
                F.struct(F.lit("capec").alias("source_name"), F.lit("CAPEC-1").alias("external_id")),
                F.struct(F.lit("mitre-attack").alias("source_name"), F.concat(F.lit("T"), h).alias("external_id")),
            ).alias("external_references"),
            F.array(
                F.struct(F.lit("mitre-attack").alias("kill_chain_name"), F.col("event_type").alias("phase_name"))
            ).alias("kill_chain_phases"),
        )
        bundles = sample_feed.paged(workspace.events(spark, sf_dir), 1000, item)
        documents = bundles.select(
            F.format_string("enterprise_%s.json", F.col("page").cast("string")).alias("file_name"),
            F.to_json(F.struct(F.lit("bundle").alias("type"), F.col("items").alias("objects"))).alias("document"),
        )
        landing.write_pages(documents, path).count()
        return path

    return telemetry.read_techniques(spark, workspace.once(spark, sf_dir, "stix", build))


@query
def attack_techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _techniques(spark, sf_dir).select("technique_id", "name", _joined("tactics"), "stix_id")


@query
def triage_techniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage by rules kept in files, their techniques looked up in the catalogue; it does not know that of R2."""
    technique = {"R1": "T1", "R2": "T4", "R3": "T3", "R4": "T2"}

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "rules")
        documents = [
            (f"{r.rule_id}.json", json.dumps(dataclasses.asdict(r) | {"technique": technique[r.rule_id]})) for r in detect.EVENT_RULES
        ]
        landing.write_pages(spark.createDataFrame(documents, "file_name string, document string"), path).count()
        return path

    rules = detect.read_rules(spark, workspace.once(spark, sf_dir, "rules", build))
    rows = workspace.events(spark, sf_dir).withColumns(conform.event_columns())
    found = detect.alerts(rows, rules, "events", "asset", "ts")
    context = triage.cve_context(_cves(spark, sf_dir))
    triaged = triage.triage(found, context, _cve_source(), rules, _techniques(spark, sf_dir))
    return triaged.withColumns({"day": F.col("day").cast("string"), "tactics": F.concat_ws(",", "tactics")})


# --- telemetry taken in with its raw records ------------------------------------

_TAKEN_IN = ("zeek", "sysmon_json", "sysmon_xml")


def _all_of(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


@query
def telemetry_conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sound records of all files; those of files that landed twice are there twice."""
    tables = workspace.telemetry(spark, sf_dir, *_TAKEN_IN)
    rows = _all_of([tables.conformed(source) for source in _TAKEN_IN])
    return rows.select(_stamp("timestamp"), "source", "asset", "indicator", "severity", _file())


@query
def telemetry_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that could not be read or lacks what is required, with the beginning of its text."""
    tables = workspace.telemetry(spark, sf_dir)
    parts = [tables.quarantine(source).withColumn("kind", F.lit(source)) for source in (*_TAKEN_IN, "attack")]
    return _all_of(parts).select("kind", F.concat_ws(",", "failed_rules").alias("failed_rules"), F.left("value", F.lit(20)).alias("begins"), _file())


@query
def telemetry_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per source: as logged, and as they are in the raw table."""
    tables = workspace.telemetry(spark, sf_dir)
    logged = _all_of([tables.counts(source) for source in (*_TAKEN_IN, "attack")])
    sums = [F.sum(name).alias(name) for name in ("records", "conformed", "quarantined")]
    raw = _all_of([tables.raw(source).groupBy(F.lit(source).alias("source")).agg(F.count("_ingest_ts").alias("raw_records"), F.count_distinct("_ingest_file").alias("files")) for source in (*_TAKEN_IN, "attack")])
    return logged.groupBy("source").agg(*sums).join(raw, "source")


@query
def telemetry_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each connection record once, though some files landed twice."""
    rows = conform.deduplicated(workspace.telemetry(spark, sf_dir, "zeek").conformed("zeek").select(*conform.COLUMNS))
    return rows.select(_stamp("timestamp"), "asset", "indicator", "severity", F.get_json_object("raw", "$.uid").alias("uid"))


@query
def zeek_by_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by the names of each file's header: two orders, two separators, two types of log."""
    parsed = records.zeek_parsed(workspace.telemetry(spark, sf_dir, "zeek").raw("zeek")).where("fault is null")
    field = F.col("fields")
    shown = {name: field[name] for name in ("uid", "service", "conn_state", "query", "rcode_name")}
    duration = F.get_json_object("raw", "$.duration").cast("double")
    return parsed.select(_file(), "path", *(c.alias(n) for n, c in shown.items()), duration.alias("duration"), F.get_json_object("raw", "$.answers[1]").alias("second_answer"))


@query
def attack_taken_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Techniques of the bundles that could be read."""
    found = telemetry.techniques_of(workspace.telemetry(spark, sf_dir, "attack").conformed("attack"))
    return found.select("technique_id", "name", "stix_id")


# --- views by entitlement, vendors, cases of rules, rates, layout ------------------


@query
def secured_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table seen by two analysts, and by whoever runs this through the view in the catalog."""
    location = workspace.folder(spark, sf_dir, "secured")
    database = f"thornwall_{hashlib.sha256(location.encode()).hexdigest()[:12]}"
    table, entitlements = f"{database}.events", f"{database}.entitlements"

    def build() -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
        rows = workspace.events(spark, sf_dir)
        tags = {"event_id": "public", "ts": "public", "event_type": "public", "user_id": "pii", "props": "sensitive"}
        govern.tagged(rows, tags).write.format("parquet").saveAsTable(table)
        kinds = rows.select(F.col("event_type").alias("scope")).distinct()
        odd = F.length("scope") % 2 == 1
        reader = F.when(odd, F.array(F.lit("analyst_a"), F.lit("analyst_a"))).otherwise(F.array(F.lit("analyst_b")))
        own = kinds.where("scope <> 'purchase'").select(F.current_user().alias("user_name"), "scope")
        nobody = spark.createDataFrame([("analyst_b", None)], "user_name string, scope string")
        kinds.select(F.explode(reader).alias("user_name"), "scope").union(own).union(nobody).write.format("parquet").saveAsTable(entitlements)
        govern.secured_view(spark, f"{database}.events_shown", table, entitlements, "event_type", "example")

    workspace.once(spark, sf_dir, "secured", build)
    seen = [spark.sql(govern.secured_sql(spark, table, entitlements, "event_type", "example", user)).withColumn("reader", F.lit(user)) for user in ("analyst_a", "analyst_b")]
    rows = _all_of([*seen, spark.table(f"{database}.events_shown").withColumn("reader", F.lit("me"))])
    return rows.withColumn("ts", _stamp("ts"))


@query
def top_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendors by number of CVEs whose newest version names one of their products as affected."""
    known = {name: CVE_FIELDS[name] for name in _REQUIRED_FIELDS}
    rows = workspace.configured(spark, sf_dir).occurrences(**known, configurations=cpe.CONFIGURATIONS)
    flat = flatten(rows, *_REQUIRED_COLUMNS, position=True, vendors=cpe.vendors(F.col("cve.configurations")))
    current = upsert.latest_by_key(quality.expect_all_or_drop(flat, EXPECTATIONS), KEY, BATCH_SEQUENCE)
    return gold.top_vendors(current)


@query
def rule_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules tried on cases from files; a rule without cases of both kinds fails."""

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "cases")
        rows = workspace.events(spark, sf_dir).where("event_id % 20 = 0").withColumns(conform.event_columns())
        expected = {
            "R1": (F.col("event_type") == "error") & ~(F.col("value") < 50),
            "R2": ~(F.col("value") < 100),
            "R3": (F.col("event_type") == "click") & (F.get_json_object("props", "$.k") == "13"),
        }
        row = F.to_json(F.struct("event_type", "value", "indicator"))
        cases = [rows.select(F.lit(rule).alias("rule_id"), F.concat(F.lit(f"{rule}-"), "event_id").alias("case"), e.alias("expected"), row.alias("row")) for rule, e in expected.items()]
        _all_of(cases).write.json(path)
        return path

    cases = detect.read_cases(spark, workspace.once(spark, sf_dir, "cases", build))
    return detect.tried(cases, detect.EVENT_RULES, "event_type string, value double, indicator string")


@query
def dq_rate_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily failure rates against the week before."""
    rules = {"no_error": "event_type <> 'error'", "in_range": "value < 100", "keyed": "get_json_object(props, '$.k') IS NOT NULL"}
    rows = quality.rate_changes(workspace.events(spark, sf_dir), rules, "ts")
    return rows.withColumn("day", _text("day"))


@query
def base_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the base of the current-state table lies: buckets, files of the fullest one, rows, and rows in a wrong one."""
    base = workspace.upserted(spark, sf_dir).state.base.latest()
    buckets = bucket_count(base)
    in_file = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d{5,})\.", 1).cast("int")
    rows = spark.read.schema(SILVER_SCHEMA).parquet(base).select(in_file.alias("bucket"), F.pmod(F.hash(KEY), F.lit(buckets)).alias("own"), F.col("_metadata.file_path").alias("file"))
    per = rows.groupBy("bucket").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("bucket") != F.col("own")).alias("wrong"))
    return per.agg(F.lit(buckets).cast("bigint").alias("buckets"), F.max("files").alias("files_a_bucket"), F.sum("n").alias("rows"), F.sum("wrong").alias("misplaced"))


_IOC_RANGES = (("2024-01-01", "2024-01-31"), ("2024-01-05", "2024-01-11"), ("2024-01-20", "2024-01-20"))


@query
def top_iocs_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten indicators seen most in each of three ranges of days, by way of one state per day."""
    rows = conform.conform(workspace.events(spark, sf_dir), "events")

    def build() -> str:
        path = workspace.folder(spark, sf_dir, "ioc-days")
        detect.daily_top(rows, 500).write.parquet(path)
        return path

    state = spark.read.parquet(workspace.once(spark, sf_dir, "ioc days", build))
    found = [detect.top_iocs_between(rows, state, first, last, 10).withColumn("days", F.lit(f"{first}..{last}")) for first, last in _IOC_RANGES]
    return _all_of(found)


@query
def triage_related(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each alert the three CVEs whose descriptions have most in common with what its rule says."""
    said = spark.createDataFrame([(r.rule_id, r.predicate) for r in detect.EVENT_RULES], "rule_id string, said string")
    alerts = detection_alerts(spark, sf_dir).select("alert_id", "rule_id").join(said, "rule_id")
    index = related.TermIndex(_cves(spark, sf_dir), 3)
    return related.related(alerts, index, F.col("said"))
