"""Landing directory: one JSON document (a page of CVE records) per file."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thornwall.schema import CORRUPT, INGEST_COLUMNS, page_schema
from thornwall.sources.files import Versions, is_complete, marked, qualified, subdirectories

# File name pattern of landed pages.
FILE_GLOB = "cves_*.json"
FILE_NAME = r"^cves_(\d{8})_(\d{8})_p(\d{3,})_(\w+)\.json$"

# Columns of the raw table: a page as it came, and the schema it shows.
PAGE, PAGE_FIELDS = "_page", "_page_fields"
# As many schemas of pages are merged on the driver; of more, by the tasks that read the pages.
MOST_SHAPES = 1_000

# The driver holds the file names of a micro-batch; at 2000 records a page this many make some 600 GB.
FILES_PER_BATCH = 100_000
# Packs are written by tasks and hold many pages each.
PACKS_PER_BATCH = 10_000

# Documents a Python worker is given at a time.
WRITTEN_BYTES = 4 << 20

# What a pack holds: page files by name, as they came.
PACK = "file_name string, document string"


def stream_options(options: dict, files_per_batch: int) -> dict:
    """Reader options of a file stream, with two defaults of its own.

    Batches are bounded. And no file counts as too old: by default a file whose
    time lies a week behind the newest one is skipped without a word, which
    happens to pages that were moved or copied into place late. The price is
    that the driver remembers all names; set ``maxFileAge`` to bound that.
    """
    limits = {} if "maxBytesPerTrigger" in options else {"maxFilesPerTrigger": files_per_batch}
    return {"maxFileAge": "36500d"} | limits | options


def read_pages(
    spark: SparkSession, landing: str, schema: str | T.StructType | None = None, stream: bool = False, **options
) -> DataFrame:
    """Landed pages, one row per file, with the ingest clock and the file they came from.

    Directories that start with ``_`` (pages being written) are hidden from
    Spark. A file cut short becomes a row with NULL fields and its text in the
    corrupt-record column. ``options`` go to the reader, for instance
    ``maxFilesPerTrigger``, or ``cleanSource`` to move pages taken in out of the
    directory, which keeps it quick to list.
    """
    reader = spark.readStream if stream else spark.read
    if stream:
        options = stream_options(options, FILES_PER_BATCH)
    return (
        reader.schema(schema or page_schema())
        .format("json")
        .options(
            multiLine="true",
            pathGlobFilter=FILE_GLOB,
            recursiveFileLookup="true",
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
        )
        .options(**options)
        .load(landing)
        .withColumns({"_ingest_ts": F.current_timestamp(), "_ingest_file": F.col("_metadata.file_path")})
    )


def read_whole_pages(spark: SparkSession, landing: str, stream: bool = False, **options) -> DataFrame:
    """As ``read_pages``, and beside the typed columns the whole page as a VARIANT, with the schema it shows.

    Every page is parsed once. Whatever field it has is in ``_page`` from then
    on, known or not, so none is lost for want of a schema. A page that is no
    JSON document, or too large for a VARIANT, has its text in the
    corrupt-record column, and as many typed fields as can be read.
    """
    reader = spark.readStream if stream else spark.read
    if stream:
        options = stream_options(options, FILES_PER_BATCH)
    files = reader.format("text").options(wholetext="true", pathGlobFilter=FILE_GLOB, recursiveFileLookup="true").options(**options).load(landing)
    return _whole(files.select("value", F.col("_metadata.file_path").alias("_ingest_file")))


def _whole(files: DataFrame) -> DataFrame:
    typed = T.StructType(T.StructType.fromDDL(page_schema()).fields[:-1])
    pages = files.select("value", F.try_parse_json("value").alias(PAGE), "_ingest_file")
    lost = F.col(PAGE).isNull()
    read = F.when(lost, F.from_json("value", typed)).otherwise(F.try_variant_get(PAGE, "$", typed.simpleString()))
    pages = pages.withColumn("_typed", read)
    return pages.select(
        *(F.col("_typed")[name].alias(name) for name in typed.names),
        F.when(lost, F.col("value")).alias(CORRUPT),
        F.current_timestamp().alias("_ingest_ts"),
        "_ingest_file",
        PAGE,
        F.schema_of_variant(PAGE).alias(PAGE_FIELDS),
    )


def read_packed_pages(spark: SparkSession, landing: str, whole: bool = False, stream: bool = False, **options) -> DataFrame:
    """As ``read_pages`` or ``read_whole_pages``, of pages that landed in packs (``write_packs``).

    ``_ingest_file`` is the path of the pack and, below it, the page's own file name.
    """
    reader = spark.readStream if stream else spark.read
    if stream:
        options = stream_options(options, PACKS_PER_BATCH)
    packs = reader.schema(PACK).options(**options).parquet(landing)
    files = packs.select(F.col("document").alias("value"), F.concat_ws("/", "_metadata.file_path", "file_name").alias("_ingest_file"))
    if whole:
        return _whole(files)
    read = F.from_json("value", page_schema(), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    pages = files.select(read.alias("_read"), "_ingest_file")
    return pages.select("_read.*", F.current_timestamp().alias("_ingest_ts"), "_ingest_file")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_parts(name: Column) -> dict[str, Column]:
    """What a page's file name says: requested window, page number, run."""

    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract(name, FILE_NAME, i), F.lit(""))

    return {
        "chunk_start": F.to_date(part(1), "yyyyMMdd"),
        "chunk_end": F.to_date(part(2), "yyyyMMdd"),
        "page": part(3).cast("int"),
        "run_ts": part(4),
    }


def page_file_name(chunk_start: Column, chunk_end: Column, page: Column, run_ts: Column, width: int = 3) -> Column:
    """Inverse of ``file_parts``. Pad to the widest page number, or names do not sort by page."""
    return F.format_string(
        f"cves_%s_%s_p%0{max(width, 3)}d_%s.json",
        F.date_format(chunk_start, "yyyyMMdd"),
        F.date_format(chunk_end, "yyyyMMdd"),
        page,
        run_ts,
    )


def page_index(pages: DataFrame) -> DataFrame:
    """One row per landed page: window, run, page number and the counters of the document."""
    parts = file_parts(file_name(F.col("_ingest_file")))
    return pages.select(
        file_name(F.col("_ingest_file")).alias("file_name"),
        *(column.alias(name) for name, column in parts.items()),
        F.col("resultsPerPage").alias("results_per_page"),
        F.col("startIndex").alias("start_index"),
        F.col("totalResults").alias("total"),
        F.coalesce(F.array_size("vulnerabilities"), F.lit(0)).cast("bigint").alias("records"),
    )


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """Page files that could not be parsed, in whole or in part; ``explode`` alone would lose them silently.

    To be used on the stored raw table: Spark finds only the faults of fields a
    query on the files themselves selects.
    """
    return pages.where(F.col(CORRUPT).isNotNull()).select(
        "_ingest_file", "_ingest_ts", F.col(CORRUPT).alias("document"), F.col("vulnerabilities").isNull().alias("lost")
    )


def listed_pages(spark: SparkSession, landing: str, **options) -> DataFrame:
    # The file content is not selected, so it is not read.
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=FILE_GLOB, recursiveFileLookup="true", **options)
        .load(landing)
        .select("path", "modificationTime", "length")
    )


def landing_totals(spark: SparkSession, landing: str) -> DataFrame:
    return listed_pages(spark, landing).agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def landing_inventory(spark: SparkSession, landing: str, n: int = 20) -> DataFrame:
    """The n page files modified last."""
    name = file_name(F.col("path"))
    return (
        listed_pages(spark, landing)
        .select(name.alias("file_name"), "modificationTime", F.round(F.col("length") / 1024, 1).alias("size_kb"))
        .orderBy(F.col("modificationTime").desc(), F.col("file_name").desc())
        .limit(n)
    )


def write_pages(pages: DataFrame, landing: str) -> DataFrame:
    """Publish ``(file_name, document)`` rows as one file each; returns ``(file_name, bytes)``.

    Lazy, like every DataFrame: an action on the result does the writing, in the
    tasks. Each file is written aside under a name of its own and then renamed,
    so no reader sees a part of it and a task that runs twice does no harm.
    Python workers get about 4 MB of documents at a time in this session and hold one text
    besides: how many pages a task writes does not matter to its memory.
    """
    target = qualified(pages.sparkSession, landing)
    pages.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", WRITTEN_BYTES)

    def publish(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        if target.startswith("file:"):
            store, root = fs.LocalFileSystem(), "/" + target[len("file:") :].lstrip("/")
        else:
            store, root = fs.FileSystem.from_uri(target.replace("s3a://", "s3://", 1))
        store.create_dir(f"{root}/_tmp", recursive=True)
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for name, document in zip(names, batch.column(1)):
                aside = f"{root}/_tmp/{uuid.uuid4().hex}"
                # A view on the batch, not a copy.
                body = document.as_buffer()
                with store.open_output_stream(aside) as out:
                    out.write(body)
                try:
                    store.move(aside, f"{root}/{name}")
                except OSError:
                    # Not every store renames over a file; an earlier attempt has published the same one.
                    if store.get_file_info(f"{root}/{name}").type != fs.FileType.File:
                        raise
                    store.delete_file(aside)
                sizes.append(body.size)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["file_name", "bytes"])

    return pages.select("file_name", "document").mapInArrow(publish, "file_name string, bytes bigint")


def write_packs(pages: DataFrame, landing: str) -> None:
    """Publish ``(file_name, document)`` rows with many pages to a file, for feeds whose pages are small and many.

    Every file costs the driver its name, status and a place in its list, whatever it
    holds: a feed of ten records a page has a hundred thousand files in a GB.
    A pack appears whole, by Spark's commit; a page's name and text are kept as they are.
    """
    pages.select("file_name", "document").write.mode("append").parquet(landing)


# --- schema inference and evolution -------------------------------------------------


def infer_pages(spark: SparkSession, landing: str | list[str], **options) -> T.StructType:
    """Typed columns found in the landed documents: one distributed pass over them, for a first look at a feed."""
    return (
        spark.read.format("json")
        .options(multiLine="true", pathGlobFilter=FILE_GLOB, recursiveFileLookup="true", columnNameOfCorruptRecord=CORRUPT)
        .options(**options)
        .load(landing)
        .schema
    )


def shown_type(shown: str) -> T.DataType:
    """The type that ``schema_of_variant`` shows. Objects are its word for structs; quoted names stay as they are."""
    parts = shown.split("`")
    return T.DataType.fromDDL("`".join(part if i % 2 else part.replace("OBJECT<", "STRUCT<") for i, part in enumerate(parts)))


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type of a field that is ``a`` in some pages and ``b`` in others, whichever comes first; what cannot be one is a VARIANT."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        types = {f.name: f.dataType for f in a}
        for f in b:
            types[f.name] = merged_type(types[f.name], f.dataType) if f.name in types else f.dataType
        return T.StructType([T.StructField(name, types[name]) for name in sorted(types)])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType))
    numbers = (T.LongType, T.DecimalType, T.DoubleType)
    return T.DoubleType() if isinstance(a, numbers) and isinstance(b, numbers) else T.VariantType()


def with_new_fields(known: T.DataType, found: T.DataType) -> T.DataType:
    """``known`` plus the fields only ``found`` has, at any depth. A known field keeps its type; nulls alone make no field."""
    if isinstance(known, T.StructType) and isinstance(found, T.StructType):
        # Names that differ in case only would be one column to Spark.
        theirs = {f.name.lower(): f.dataType for f in found}
        kept = [T.StructField(f.name, with_new_fields(f.dataType, theirs.pop(f.name.lower(), f.dataType))) for f in known]
        new = {f.name.lower(): T.StructField(f.name, held) for f in found if f.name.lower() in theirs and (held := _not_null(f.dataType)) is not None}
        return T.StructType(kept + list(new.values()))
    if isinstance(known, T.ArrayType) and isinstance(found, T.ArrayType):
        return T.ArrayType(with_new_fields(known.elementType, found.elementType))
    return known


def _not_null(kind: T.DataType) -> T.DataType | None:
    """``kind`` without what has only been null so far."""
    if isinstance(kind, T.StructType):
        fields = [T.StructField(f.name, held) for f in kind if (held := _not_null(f.dataType)) is not None]
        return T.StructType(fields) if fields else None
    if isinstance(kind, T.ArrayType):
        held = _not_null(kind.elementType)
        return None if held is None else T.ArrayType(held)
    return None if isinstance(kind, T.NullType) else kind


class PageFields:
    """The fields that pages of a raw table have shown so far, kept in a folder of their own.

    The table holds whole pages, so this is a matter of reading: a field found
    late is there for all pages that have it.
    """

    def __init__(self, spark: SparkSession, raw: str, store: str):
        self.spark, self.raw, self.store, self.versions = spark, raw, store, Versions(spark, store)

    def found(self) -> T.StructType | None:
        last = self.versions.latest()
        return T.StructType.fromJson(json.loads(self.spark.read.text(last, wholetext=True).first()[0])) if last else None

    def look(self) -> T.StructType | None:
        """Take up the fields of pages that came since the last look; of each, one short column is read."""
        if is_complete(self.spark, self.raw) or subdirectories(self.spark, self.raw):
            shown = self.spark.readStream.schema(f"{PAGE_FIELDS} string, {PAGE} variant").options(**stream_options({}, FILES_PER_BATCH)).parquet(self.raw)
            query = shown.writeStream.foreachBatch(self._widen).option("checkpointLocation", f"{self.store}/_checkpoint").trigger(availableNow=True).start()
            query.awaitTermination()
        return self.found()

    def _widen(self, pages: DataFrame, batch_id: int) -> None:
        kinds = [r[0] for r in pages.select(PAGE_FIELDS).where(F.col(PAGE_FIELDS).isNotNull()).distinct().limit(MOST_SHAPES + 1).collect()]
        if len(kinds) > MOST_SHAPES:
            # Few pages look alike: their schemas are merged by the tasks that read them.
            kinds = [pages.agg(F.schema_of_variant_agg(PAGE)).first()[0]]
        before = self.found()
        after = before
        for kind in sorted(kinds):
            shape = shown_type(kind)
            if isinstance(shape, T.StructType):
                after = shape if after is None else merged_type(after, shape)
        if after is None or after == before:
            return
        text = self.spark.createDataFrame([(after.json(),)], "value string").coalesce(1)
        marked(text.write).text(self.versions.next())
        self.versions.vacuum()

    def stored(self) -> T.StructType:
        """What the files are read as: every field found, by its type, and the whole page."""
        wide = with_new_fields(T.StructType.fromDDL(page_schema()), self.found() or T.StructType())
        return T.StructType([*wide.fields, *T.StructType.fromDDL(INGEST_COLUMNS).fields, T.StructField(PAGE, T.VariantType())])

    def shown(self) -> list[str]:
        """The columns of the raw table in SQL, on its files. Pages taken in without their VARIANT have the typed ones."""
        typed = {f.name: f.dataType for f in T.StructType([*T.StructType.fromDDL(page_schema()), *T.StructType.fromDDL(INGEST_COLUMNS)])}
        columns = []
        for field in self.stored().fields[:-1]:
            name = "`" + field.name.replace("`", "``") + "`"
            if typed.get(field.name) != field.dataType:
                # A struct of the one field: paths have no way to write every name.
                kind = _ddl(T.StructType([field])).replace("\\", "\\\\").replace("'", "\\'")
                name = f"CASE WHEN {PAGE} IS NULL THEN {name} ELSE try_variant_get({PAGE}, '$', '{kind}').{name} END AS {name}"
            columns.append(name)
        return columns

    def read(self) -> DataFrame:
        """The raw table with every field found."""
        return self.spark.read.schema(self.stored()).parquet(self.raw).selectExpr(*self.shown())


def _ddl(kind: T.DataType) -> str:
    """A type as SQL writes it, with all names quoted."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join("`" + f.name.replace("`", "``") + "`:" + _ddl(f.dataType) for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()
