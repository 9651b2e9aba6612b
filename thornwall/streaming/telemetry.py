"""Telemetry files -> raw records, conformed rows and quarantine, per micro-batch."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from thornwall.operators.conform import COLUMNS, judged
from thornwall.sources.files import qualified
from thornwall.sources.records import PARSERS, RAW_SCHEMA, raw_records
from thornwall.streaming.batches import Batches, batch_tag
from thornwall.streaming.ingest import trigger

JUDGED_SCHEMA = (
    "timestamp timestamp, source string, asset string, indicator string, severity string, raw string, "
    f"failed_rules array<string>, {RAW_SCHEMA}"
)
COUNTS_SCHEMA = "source string, records bigint, conformed bigint, quarantined bigint, logged_at timestamp"


class Telemetry:
    """For each source a raw table, one of judged records, and counts; all replay-safe, by day of ingest.

    >>> t = Telemetry(spark, "/shared/telemetry")
    >>> t.start("zeek", "/shared/logs/zeek").awaitTermination()
    >>> t.conformed("zeek"), t.quarantine("zeek"), t.raw("zeek")
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, qualified(spark, root)

    def raw_batches(self, source: str) -> Batches:
        return Batches(self.spark, f"{self.root}/{source}/raw", RAW_SCHEMA)

    def judged_batches(self, source: str) -> Batches:
        return Batches(self.spark, f"{self.root}/{source}/judged", JUDGED_SCHEMA)

    def count_batches(self, source: str) -> Batches:
        return Batches(self.spark, f"{self.root}/{source}/counts", COUNTS_SCHEMA)

    def start(self, source: str, path: str, mode: str = "triggered", interval: str = "1 minute", **options) -> StreamingQuery:
        """Take in files that landed. A batch goes to the raw table first; what follows reads it from there."""
        raw, out, log = self.raw_batches(source), self.judged_batches(source), self.count_batches(source)

        def run(records: DataFrame, batch_id: int) -> None:
            first = records.select("_ingest_ts").first()
            if first is None:
                return
            # The clock is the batch's own, kept in the checkpoint: a replay has the same.
            clock: datetime.datetime = first[0]
            tag = batch_tag(records.sparkSession, batch_id)
            if out.holds(tag, clock.date()):
                return  # replayed after its day was compacted
            stored = records.sparkSession.read.schema(RAW_SCHEMA).parquet(raw.add(records, tag, clock.date()))
            counts = Observation()
            good = F.size("failed_rules") == 0
            rows = judged(PARSERS[source](stored), source).observe(counts, F.count(F.lit(1)).alias("records"), F.count_if(good).alias("conformed"))
            out.add(rows, tag, clock.date())
            n, m = counts.get["records"], counts.get["conformed"] or 0
            seen = [(source, n, m, n - m, clock)]
            log.add(self.spark.createDataFrame(seen, COUNTS_SCHEMA).coalesce(1), tag, clock.date())

        return (
            raw_records(self.spark, path, source, stream=True, **options)
            .writeStream.foreachBatch(run)
            .option("checkpointLocation", f"{self.root}/checkpoints/{source}")
            .trigger(**trigger(mode, interval))
            .start()
        )

    def raw(self, source: str) -> DataFrame:
        return self.raw_batches(source).read()

    def conformed(self, source: str) -> DataFrame:
        """The sound records in the common shape."""
        return self.judged_batches(source).read().where(F.size("failed_rules") == 0).select(*COLUMNS, "_ingest_ts", "_ingest_file")

    def quarantine(self, source: str) -> DataFrame:
        """The others, with their text and the rules they failed."""
        return self.judged_batches(source).read().where(F.size("failed_rules") > 0)

    def counts(self, source: str) -> DataFrame:
        return self.count_batches(source).read()
