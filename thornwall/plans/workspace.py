"""Layers built from the given tables, once per session and input, in the shared working folder."""

from __future__ import annotations

import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thornwall.plans.medallion import Medallion
from thornwall.session import configure, workdir
from thornwall.sources import landing, sample_feed
from thornwall.sources.files import set_modified_at
from thornwall.streaming.telemetry import Telemetry

_lock = threading.RLock()
_built: dict[tuple[str, str, str], object] = {}


def once(spark: SparkSession, sf_dir: str, what: str, build):
    """``build()`` the first time in this application, its result from then on."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir, what)
    with _lock:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parquet"
    return configure(spark, path).read.parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over twice the cores.

    A table of few row groups is read by as few tasks, and so is what those write, where a file is read whole.
    """
    return rows.repartition(2 * rows.sparkSession.sparkContext.defaultParallelism)


def folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    return f"{workdir(spark)}/{hashlib.sha256(sf_dir.encode()).hexdigest()[:24]}/{name}"


def medallion(spark: SparkSession, sf_dir: str) -> Medallion:
    return Medallion(spark, folder(spark, sf_dir, "tables"), folder(spark, sf_dir, "landing"))


def landed(spark: SparkSession, sf_dir: str) -> Medallion:
    """The derived feed as page files in a landing directory; nothing read yet."""
    found = medallion(spark, sf_dir)
    once(spark, sf_dir, "landing", lambda: sample_feed.land(events(spark, sf_dir), found.landing))
    return found


def ingested(spark: SparkSession, sf_dir: str) -> Medallion:
    """... and the raw table filled from it."""
    found = landed(spark, sf_dir)
    once(spark, sf_dir, "raw", lambda: found.ingest(evolve=False).awaitTermination())
    return found


def upserted(spark: SparkSession, sf_dir: str) -> Medallion:
    """... and the current-state table."""
    found = ingested(spark, sf_dir)

    def build() -> None:
        found.upsert().awaitTermination()
        found.state.fold_if_due()

    once(spark, sf_dir, "cves", build)
    return found


def audited(spark: SparkSession, sf_dir: str) -> Medallion:
    """The raw table of two runs with one window per day, in which pages and days are missing, empty or cut short.

    With ten records a page there are a tenth as many pages as events: they land in packs.
    """
    found = Medallion(spark, folder(spark, sf_dir, "daily/tables"), folder(spark, sf_dir, "daily/landing"))

    def build() -> None:
        landing.write_packs(sample_feed.daily_documents(events(spark, sf_dir)), found.landing)
        found.ingest(evolve=False, packed=True).awaitTermination()

    once(spark, sf_dir, "daily", build)
    return found


def evolved(spark: SparkSession, sf_dir: str) -> Medallion:
    """A raw table filled in two steps: the pages of the second have fields the first has not."""
    found = Medallion(spark, folder(spark, sf_dir, "evolved/tables"), folder(spark, sf_dir, "evolved/landing"))

    def build() -> None:
        for rest in (0, 1):
            sample_feed.land_with_new_fields(events(spark, sf_dir), found.landing, lambda page, rest=rest: page % 2 == rest)
            found.ingest().awaitTermination()
            found.look_for_fields()

    once(spark, sf_dir, "evolved", build)
    return found


def half_folded(spark: SparkSession, sf_dir: str) -> Medallion:
    """A current-state table whose base holds the even pages; the changes of the odd ones are pending."""
    found = Medallion(spark, folder(spark, sf_dir, "half/tables"), folder(spark, sf_dir, "half/landing"))

    def build() -> None:
        for rest in (0, 1):
            sample_feed.land_with_new_fields(events(spark, sf_dir), found.landing, lambda page, rest=rest: page % 2 == rest)
            found.ingest(evolve=False).awaitTermination()
            found.upsert().awaitTermination()
            if rest == 0:
                found.state.fold()

    once(spark, sf_dir, "half folded", build)
    return found


def configured(spark: SparkSession, sf_dir: str) -> Medallion:
    """A raw table whose records have configurations, a field the tables do not know."""
    found = Medallion(spark, folder(spark, sf_dir, "configured/tables"), folder(spark, sf_dir, "configured/landing"))

    def build() -> None:
        documents = sample_feed.page_documents(events(spark, sf_dir), record_fields=lambda e: {"configurations": sample_feed.configurations(e)})
        landing.write_pages(documents, found.landing).count()
        found.ingest().awaitTermination()

    once(spark, sf_dir, "configured", build)
    return found


def dated(spark: SparkSession, sf_dir: str, newest: int = 20) -> str:
    """A landing directory whose last pages have file times of their own, a second apart."""
    path = folder(spark, sf_dir, "dated")

    def build() -> None:
        sample_feed.land(events(spark, sf_dir), path)
        pages = landing.listed_pages(spark, path).select("path", landing.file_parts(landing.file_name(F.col("path")))["page"].alias("page"))
        for row in pages.orderBy(F.desc("page")).limit(newest).collect():
            set_modified_at(spark, row["path"], 1_900_000_000 + row["page"])

    once(spark, sf_dir, "dated", build)
    return path


def evolved_on_the_way(spark: SparkSession, sf_dir: str) -> Medallion:
    """A raw table whose new fields come at the worst times: between a look for them and a start, and under a query that runs on."""
    found = Medallion(spark, folder(spark, sf_dir, "on_the_way/tables"), folder(spark, sf_dir, "on_the_way/landing"))

    def land(rest: int) -> None:
        sample_feed.land_with_new_fields(events(spark, sf_dir), found.landing, lambda page: page % 4 == rest)

    def build() -> None:
        land(0)
        found.ingest().awaitTermination()
        found.look_for_fields()
        land(1)
        running = found.ingest("continuous", interval="200 milliseconds")
        try:
            running.processAllAvailable()
            found.look_for_fields()
            land(2)
            land(3)
            running.processAllAvailable()
        finally:
            running.stop()
        found.look_for_fields()

    once(spark, sf_dir, "evolved on the way", build)
    return found


def continuous(spark: SparkSession, sf_dir: str) -> Medallion:
    """The current-state table as two hops that run on keep it."""
    found = Medallion(spark, folder(spark, sf_dir, "continuous"), landed(spark, sf_dir).landing)

    def build() -> None:
        for hop in (lambda: found.ingest("continuous", evolve=False, interval="200 milliseconds"), lambda: found.upsert("continuous", "200 milliseconds")):
            running = hop()
            try:
                running.processAllAvailable()
            finally:
                running.stop()

    once(spark, sf_dir, "continuous", build)
    return found


TELEMETRY = {
    "zeek": sample_feed.zeek_documents,
    "sysmon_json": partial(sample_feed.sysmon_documents, xml=False),
    "sysmon_xml": partial(sample_feed.sysmon_documents, xml=True),
    "attack": sample_feed.bundle_documents,
}


def telemetry(spark: SparkSession, sf_dir: str, *sources: str) -> Telemetry:
    """Raw, conformed and quarantined records of the given kinds of files, of all if none is given, with broken records among them."""
    found = Telemetry(configure(spark), folder(spark, sf_dir, "telemetry/tables"))

    def build(source: str) -> None:
        path = folder(spark, sf_dir, f"telemetry/{source}")
        landing.write_pages(TELEMETRY[source](events(spark, sf_dir)), path).count()
        found.start(source, path).awaitTermination()

    # One stage's last tasks leave cores idle: the others' first ones take them.
    with _lock:
        missing = [source for source in sources or TELEMETRY if (spark.sparkContext.applicationId, sf_dir, f"telemetry {source}") not in _built]
        with ThreadPoolExecutor(len(TELEMETRY)) as pool:
            running = {source: pool.submit(build, source) for source in missing}
        for source, built in running.items():
            once(spark, sf_dir, f"telemetry {source}", built.result)
    return found
