"""Readers for further public formats: Zeek TSV, Sysmon XML or JSON, ATT&CK STIX bundles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thornwall.sources.landing import FILES_PER_BATCH, stream_options

# The leading columns of a Zeek connection log, in file order.
ZEEK_CONN = (
    "ts double, uid string, `id.orig_h` string, `id.orig_p` int, `id.resp_h` string, `id.resp_p` int, "
    "proto string, service string, duration double, orig_bytes bigint, resp_bytes bigint, conn_state string"
)

# The parts of a Windows event.
SYSMON_XML = (
    "System struct<Provider:struct<_Name:string,_Guid:string>,EventID:int,Version:int,Level:int,Task:int,Opcode:int,"
    "Keywords:string,TimeCreated:struct<_SystemTime:string>,EventRecordID:bigint,Correlation:struct<_ActivityID:string>,"
    "Execution:struct<_ProcessID:bigint,_ThreadID:bigint>,Channel:string,Computer:string,Security:struct<_UserID:string>>, "
    "EventData struct<Data:array<struct<_Name:string,_VALUE:string>>>"
)

# The parts of a STIX bundle that are read.
STIX_BUNDLE = (
    "objects array<struct<type:string,id:string,name:string,revoked:boolean,x_mitre_deprecated:boolean,"
    "external_references:array<struct<source_name:string,external_id:string,url:string>>,"
    "kill_chain_phases:array<struct<kill_chain_name:string,phase_name:string>>>>"
)


def _reader(spark: SparkSession, stream: bool, options: dict):
    return (spark.readStream, stream_options(options, FILES_PER_BATCH)) if stream else (spark.read, options)


def read_zeek(spark: SparkSession, path: str, schema: str = ZEEK_CONN, stream: bool = False, **options) -> DataFrame:
    """Tab-separated log; header lines start with ``#``, ``-`` is unset and ``(empty)`` an empty string.

    Fields behind those of the schema are kept as they stand, in the array
    ``more``; a field that does not read as its type is null.
    """
    reader, options = _reader(spark, stream, options)
    lines = reader.format("text").options(**options).load(path)
    lines = lines.where((F.length("value") > 0) & ~F.startswith("value", F.lit("#")))
    fields = T.StructType.fromDDL(schema).fields
    parts = F.split("value", "\t")

    def typed(i: int, field: T.StructField):
        text = F.nullif(F.get(parts, F.lit(i)), F.lit("-"))
        if field.dataType == T.StringType():
            return F.when(text == "(empty)", "").otherwise(text)
        return text.try_cast(field.dataType)

    known = len(fields)
    more = F.when(F.size(parts) > known, F.slice(parts, F.lit(known + 1), F.size(parts) - known))
    return lines.select(*(typed(i, field).alias(field.name) for i, field in enumerate(fields)), more.alias("more"))


def _event_data(name: str):
    return F.get(F.filter("EventData.Data", lambda d: d["_Name"] == name), F.lit(0))["_VALUE"]


def _item(name: str, kind: str = "string"):
    return F.try_variant_get("record", f"$.{name}", kind)


def read_sysmon(spark: SparkSession, path: str, fmt: str = "xml", stream: bool = False, **options) -> DataFrame:
    """Endpoint events as ``event_id, computer, utc_time, image, target, user``, from XML or JSON lines.

    ``data`` holds all items of the event by name, those six columns included
    where the source lists them; XML has its ``system`` part besides.
    """
    reader, options = _reader(spark, stream, options)
    if fmt == "json":
        return (
            reader.schema("record variant")
            .format("json")
            .options(singleVariantColumn="record")
            .options(**options)
            .load(path)
            .select(
                _item("EventID", "int").alias("event_id"),
                _item("Computer").alias("computer"),
                _item("UtcTime").alias("utc_time"),
                _item("Image").alias("image"),
                _item("TargetFilename").alias("target"),
                _item("User").alias("user"),
                F.transform(
                    F.map_entries(F.try_variant_get("record", "$", "map<string,string>")),
                    lambda e: F.struct(e["key"].alias("name"), e["value"].alias("value")),
                ).alias("data"),
            )
        )
    return (
        reader.schema(SYSMON_XML)
        .format("xml")
        .options(rowTag="Event")
        .options(**options)
        .load(path)
        .select(
            F.col("System.EventID").alias("event_id"),
            F.col("System.Computer").alias("computer"),
            F.col("System.TimeCreated._SystemTime").alias("utc_time"),
            _event_data("Image").alias("image"),
            _event_data("TargetFilename").alias("target"),
            _event_data("User").alias("user"),
            F.transform("EventData.Data", lambda d: F.struct(d["_Name"].alias("name"), d["_VALUE"].alias("value"))).alias("data"),
            F.col("System").alias("system"),
        )
    )


def read_techniques(spark: SparkSession, path: str, stream: bool = False, **options) -> DataFrame:
    """ATT&CK techniques in force: ``technique_id, name, tactics, stix_id``, from STIX bundles (one document per file)."""
    reader, options = _reader(spark, stream, options)
    objects = (
        reader.schema(STIX_BUNDLE)
        .format("json")
        .options(multiLine="true")
        .options(**options)
        .load(path)
        .select(F.explode("objects").alias("o"))
    )
    return _techniques(_in_force(objects))


def _in_force(objects: DataFrame) -> DataFrame:
    gone = F.coalesce("o.revoked", F.lit(False)) | F.coalesce("o.x_mitre_deprecated", F.lit(False))
    return objects.where((F.col("o.type") == "attack-pattern") & ~gone)


STIX_OBJECT = STIX_BUNDLE[len("objects array<") : -1]


def techniques_of(records: DataFrame) -> DataFrame:
    """``read_techniques`` of stored records: ``raw`` has one STIX object a row."""
    objects = records.select(F.from_json("raw", STIX_OBJECT).alias("o"))
    return _techniques(_in_force(objects))


def _techniques(objects: DataFrame) -> DataFrame:
    listed = F.filter("o.external_references", lambda r: r["source_name"] == "mitre-attack")
    return objects.select(
        F.get(listed, F.lit(0))["external_id"].alias("technique_id"),
        F.col("o.name").alias("name"),
        F.transform("o.kill_chain_phases", lambda p: p["phase_name"]).alias("tactics"),
        F.col("o.id").alias("stix_id"),
    )
