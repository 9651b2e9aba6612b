"""Telemetry files as raw records, and what each record says or what is wrong with it.

``raw_records`` loses nothing: it cuts files into records without reading them.
The ``parsed`` functions read a record; one that cannot be read keeps its text and
has the reason in ``fault``. All of them work on batches; Zeek lines need their
file's header, so a file's lines must be in one batch (a file source sees to that).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thornwall.sources.landing import FILES_PER_BATCH, stream_options
from thornwall.sources.telemetry import SYSMON_XML

RAW_SCHEMA = "value string, _ingest_ts timestamp, _ingest_file string"
_RAW = ["value", "_ingest_ts", "_ingest_file"]

#: How a source's files are cut into records.
CUTS = {
    "zeek": {},
    "sysmon_json": {},
    "sysmon_xml": {"lineSep": "</Event>"},
    "attack": {"wholetext": "true"},
}


def raw_records(spark: SparkSession, path: str, source: str, stream: bool = False, **options) -> DataFrame:
    """(value, _ingest_ts, _ingest_file): every record of the files, as it stands."""
    reader, options = (spark.readStream, stream_options(options, FILES_PER_BATCH)) if stream else (spark.read, options)
    records = reader.format("text").options(**CUTS[source]).options(**options).load(path)
    return records.select("value", F.current_timestamp().alias("_ingest_ts"), F.col("_metadata.file_path").alias("_ingest_file"))


# --- Zeek ---------------------------------------------------------------------

# What stands in a log's header, and its types that are numbers.
_HEADER = ("separator", "set_separator", "empty_field", "unset_field", "path", "fields", "types")
_NUMBERS = ("time", "interval", "double", "count", "int", "port")
_PLAIN = r'^[ !#-\[\]-~]*\z'
_JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?$"


def _quoted(separator: Column) -> Column:
    return F.concat(F.lit("\\Q"), separator, F.lit("\\E"))


def zeek_headers(records: DataFrame) -> DataFrame:
    """(_ingest_file, separator, set_separator, empty_field, unset_field, path, fields, types, headers), a row per file."""
    lines = records.where(F.startswith("value", F.lit("#")))
    kept = {name: F.when(F.startswith("value", F.lit(f"#{name}")) & F.col("value").rlike(f"^#{name}[^a-z_]"), F.col("value")) for name in _HEADER}
    found = lines.groupBy("_ingest_file").agg(F.count_distinct(kept["fields"]).alias("headers"), *(F.max(line).alias(name) for name, line in kept.items()))
    code = F.regexp_extract("separator", r"\\x([0-9a-fA-F]{2})", 1)
    separator = F.when(code != "", F.decode(F.unhex(code), "UTF-8")).otherwise(F.nullif(F.substring("separator", 12, 1), F.lit("")))
    found = found.withColumn("separator", F.coalesce(separator, F.lit("\t")))

    def items(name: str) -> Column:
        parts = F.split(name, _quoted(F.col("separator")))
        return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    one = {"set_separator": ",", "empty_field": "(empty)", "unset_field": "-", "path": None}
    return found.select(
        "_ingest_file",
        "headers",
        "separator",
        *(F.coalesce(F.get(items(name), F.lit(0)), F.lit(default)).alias(name) for name, default in one.items()),
        items("fields").alias("fields"),
        items("types").alias("types"),
    )


def _text_json(text: Column) -> Column:
    """A text as JSON writes it. Most have nothing to escape and only need their quotes."""
    whole = F.to_json(F.array(text))
    return F.when(text.rlike(_PLAIN), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.substring(whole, F.lit(2), F.length(whole) - 2))


def _split(text: Column, separator: Column) -> Column:
    """Cut at a separator that differs from row to row; at the usual ones without a pattern compiled for each row."""
    return F.when(separator == "\t", F.split(text, "\t")).when(separator == ",", F.split(text, ",")).otherwise(F.split(text, _quoted(separator)))


def _kind(shown: Column) -> Column:
    """How values of a type are written as JSON."""
    many = shown.startswith("set[") | shown.startswith("vector[")
    return F.when(shown.isin(*_NUMBERS), "number").when(shown == "bool", "bool").when(many, "many").otherwise("string")


def zeek_parsed(records: DataFrame) -> DataFrame:
    """(path, fields, raw, fault, value, ...): each line by its own file's header.

    ``fields`` maps names to texts (null if unset); ``raw`` is a JSON document of
    all of them by type, sets and vectors as arrays. Faults: no header, several
    different ones in one file, a name twice, or another number of fields than
    the header names.
    """
    # What follows from a header alone is worked out once a file, not for every line of it.
    heads = zeek_headers(records).withColumns(
        {"names": F.transform("fields", lambda f: F.concat(_text_json(f), F.lit(":"))), "kinds": F.transform("types", _kind), "repeated": F.size(F.array_distinct("fields")) != F.size("fields")}
    )
    lines = records.where((F.length("value") > 0) & ~F.startswith("value", F.lit("#")))
    # A row per file: kept in memory by partition, so the lines, hashed by file, are not sorted.
    rows = lines.join(heads.hint("shuffle_hash"), "_ingest_file", "left").withColumn("parts", _split(F.col("value"), F.col("separator")))
    fault = (
        F.when(F.col("headers").isNull() | (F.col("headers") == 0), "no_header")
        .when(F.col("headers") > 1, "several_headers")
        .when(F.col("repeated"), "repeated_field")
        .when(F.size("parts") != F.size("fields"), "field_count")
    )
    rows = rows.withColumn("fault", fault)

    def plain(text: Column) -> Column:
        return F.when(text == F.col("unset_field"), None).when(text == F.col("empty_field"), "").otherwise(text)

    def document(x: Column) -> Column:
        kind, text = x["kinds"], x["parts"]
        many = F.when(text == F.col("empty_field"), F.array().cast("array<string>")).otherwise(_split(text, F.col("set_separator")))
        value = (
            F.when(text == F.col("unset_field"), "null")
            .when((kind == "number") & text.rlike(_JSON_NUMBER), text)
            .when((kind == "bool") & text.isin("T", "F"), F.when(text == "T", "true").otherwise("false"))
            .when(kind == "many", F.to_json(many))
            .otherwise(_text_json(F.when(text == F.col("empty_field"), "").otherwise(text)))
        )
        return F.concat(x["names"], value)

    good = F.col("fault").isNull()
    fields = F.when(good, F.map_from_arrays("fields", F.transform("parts", plain)))
    raw = F.when(good, F.concat(F.lit("{"), F.array_join(F.transform(F.arrays_zip("names", "kinds", "parts"), document), ","), F.lit("}")))
    return rows.select("path", fields.alias("fields"), raw.alias("raw"), "fault", *_RAW)


# --- endpoint events ----------------------------------------------------------


def sysmon_json_parsed(records: DataFrame) -> DataFrame:
    """(record, raw, fault, value, ...): a JSON object a line; ``record`` is a VARIANT. Blank lines are no records."""
    rows = records.where(F.trim("value") != "").withColumn("record", F.try_parse_json("value"))
    kind = F.schema_of_variant("record")
    fault = F.when(F.col("record").isNull(), "malformed").when(~F.startswith(kind, F.lit("OBJECT")), "not_an_object")
    return rows.select("record", F.when(fault.isNull(), F.col("value")).alias("raw"), fault.alias("fault"), *_RAW)


def sysmon_xml_parsed(records: DataFrame) -> DataFrame:
    """(record, raw, fault, value, ...): the events of XML files, and as faults whatever else stands between or after them."""
    begin = F.regexp_instr("value", F.lit("<Event[ \t\r\n/>]"))
    before = F.when(begin > 0, F.left("value", begin - 1)).otherwise(F.col("value"))
    rest = F.trim(F.regexp_replace(before, r"<\?[^>]*\?>|</?Events\b[^>]*>|[\x{FEFF}\s]+", " "))
    event = F.when(begin > 0, F.concat(F.substring("value", begin, F.length("value")), F.lit("</Event>")))
    found = F.array(F.struct(F.nullif(rest, F.lit("")).alias("stray"), F.lit(None).cast("string").alias("event")), F.struct(F.lit(None).cast("string").alias("stray"), event.alias("event")))
    rows = records.select(F.inline(found), "_ingest_ts", "_ingest_file").where("stray is not null or event is not null")
    read = F.from_xml("event", f"{SYSMON_XML}, _corrupt string", {"rowTag": "Event", "columnNameOfCorruptRecord": "_corrupt"})
    rows = rows.withColumn("record", read)
    broken = F.col("record").isNull() | F.col("record._corrupt").isNotNull() | (F.col("record.System").isNull() & F.col("record.EventData").isNull())
    fault = F.when(F.col("stray").isNotNull(), "outside_events").when(broken, "malformed")
    value = F.coalesce("event", "stray").alias("value")
    return rows.select("record", F.when(fault.isNull(), F.col("event")).alias("raw"), fault.alias("fault"), value, "_ingest_ts", "_ingest_file")


def attack_parsed(records: DataFrame) -> DataFrame:
    """(record, raw, fault, value, ...): each object of STIX bundles as a VARIANT; a file that is no bundle is a fault."""
    bundle = records.withColumn("bundle", F.try_parse_json("value"))
    objects = bundle.withColumn("objects", F.try_variant_get("bundle", "$.objects", "array<variant>"))
    fault = F.when(F.col("objects").isNull(), "malformed")
    # Only a faulty file's text goes along: each object of a sound one would have a copy of the whole bundle.
    files = objects.select("objects", fault.alias("fault"), F.when(F.col("objects").isNull(), F.col("value")).alias("value"), "_ingest_ts", "_ingest_file")
    rows = files.select(F.explode_outer("objects").alias("record"), "fault", *_RAW)
    # A bundle without objects is sound and has no records.
    rows = rows.where("fault is not null or record is not null")
    return rows.select("record", F.to_json("record").alias("raw"), "fault", *_RAW)


PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "zeek": zeek_parsed,
    "sysmon_json": sysmon_json_parsed,
    "sysmon_xml": sysmon_xml_parsed,
    "attack": attack_parsed,
}
