"""Streaming hops: landing directory -> raw pages -> current CVEs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from thornwall.operators.flatten import flatten, occurrences
from thornwall.operators.upsert import latest_valid_by_key
from thornwall.schema import EXPECTATIONS, INGEST_COLUMNS, KEY, POSITION, SEQUENCE, page_schema
from thornwall.session import same_settings
from thornwall.sources.landing import read_packed_pages, read_pages, read_whole_pages, stream_options
from thornwall.streaming.batches import Batches, batch_tag
from thornwall.streaming.current_state import CurrentState

# Of the usual 128 MB each, somewhat more than 1 TB per micro-batch.
RAW_FILES_PER_BATCH = 10_000
# Pages shrink about fivefold in Parquet: this makes files of some 100 MB.
RAW_SPLIT_BYTES = 512 << 20
# Ties on the time of modification go to the later run, then to the later file and place in it.
BATCH_SEQUENCE = [*SEQUENCE, POSITION]


def trigger(mode: str = "triggered", interval: str = "1 minute") -> dict:
    """``triggered``: take what has landed, then stop. ``continuous``: look every ``interval``."""
    if mode == "triggered":
        return {"availableNow": True}
    if mode == "continuous":
        return {"processingTime": interval}
    raise ValueError(f"unknown mode: {mode}")


def start_raw(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    whole: bool = True,
    mode: str = "triggered",
    interval: str = "1 minute",
    sink_options: dict[str, str] | None = None,
    packed: bool = False,
    **options,
) -> StreamingQuery:
    """Append every landed page file once. Repeated content is kept: the upsert removes it.

    ``whole`` keeps each page whole beside its typed columns; without it, only
    those columns. ``sink_options`` may set ``retention`` (for instance ``90d``), after which
    old pages leave the table. ``packed``: pages landed in packs, many to a file.
    """
    if packed:
        pages = read_packed_pages(spark, landing, whole, stream=True, **options)
    else:
        # A task writes one file, so more pages per task make larger files without a shuffle.
        # The scan looks this up in the session of its reader, for every batch: hence one of its own.
        wide = same_settings(spark, {"spark.sql.files.maxPartitionBytes": RAW_SPLIT_BYTES})
        pages = (read_whole_pages if whole else read_pages)(wide, landing, stream=True, **options)
    return (
        pages.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**(sink_options or {}))
        .trigger(**trigger(mode, interval))
        .start(table)
    )


def raw_stream(spark: SparkSession, table: str, **options) -> DataFrame:
    """New rows of the raw table, with just the fields the upsert reads."""
    options = stream_options(options, RAW_FILES_PER_BATCH)
    return spark.readStream.schema(f"{page_schema()}, {INGEST_COLUMNS}").options(**options).parquet(table)


LOG_SCHEMA = "batch_id bigint, expectation string, passed_records bigint, failed_records bigint, logged_at timestamp"


def upsert_batch(state: CurrentState, log: Batches, fold_ratio: float | None) -> Callable[[DataFrame, int], None]:
    """One micro-batch: drop and count what fails the expectations, store the newest row per CVE, in one pass."""

    def run(pages: DataFrame, batch_id: int) -> None:
        spark = pages.sparkSession
        tag = batch_tag(spark, batch_id)
        counts = Observation()
        flat = flatten(occurrences(pages), position=True)
        state.add_reduced(latest_valid_by_key(flat, KEY, BATCH_SEQUENCE, EXPECTATIONS, counts), tag)
        # The day is that of a page, the same one in a replay, which so finds its own rows again.
        page = pages.select("_ingest_ts").first()
        if page is not None:
            log.add(_counted(spark, batch_id, counts.get), tag, page[0].date())
        if fold_ratio is not None:
            state.fold_if_due(fold_ratio)

    return run


def _counted(spark: SparkSession, batch_id: int, counts: dict) -> DataFrame:
    """One row per rule."""
    failed = {name: counts[name] or 0 for name in EXPECTATIONS}
    rows = [(batch_id, name, (counts["records"] or 0) - n, n) for name, n in failed.items()]
    counted = spark.createDataFrame(rows, "batch_id bigint, expectation string, passed_records bigint, failed_records bigint")
    return counted.coalesce(1).withColumn("logged_at", F.current_timestamp())


def start_upsert(
    pages: DataFrame,
    state: CurrentState,
    log: Batches,
    checkpoint: str,
    mode: str = "triggered",
    interval: str = "1 minute",
    fold_ratio: float | None = None,
) -> StreamingQuery:
    """Keep the newest version of each CVE; older versions that come late change nothing.

    With a ``fold_ratio`` the changes are folded into the base on the way, each
    time they reach that share of it: right for a query that runs on. One that
    takes in what there is and stops is better folded once, afterwards.
    """
    return (
        pages.writeStream.foreachBatch(upsert_batch(state, log, fold_ratio))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(mode, interval))
        .start()
    )
