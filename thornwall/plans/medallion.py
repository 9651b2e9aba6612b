"""All datasets under one root, and how they are brought up to date."""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from thornwall.operators import detect, triage
from thornwall.operators.detect import Rule
from thornwall.operators.flatten import flatten, occurrences
from thornwall.operators.quality import expect_all_or_drop
from thornwall.plans import gold
from thornwall.schema import DATASETS, EXPECTATIONS, INGEST_COLUMNS, KEY, SEQUENCE, SILVER_SCHEMA, page_schema
from thornwall.session import configure
from thornwall.sources.files import Versions, marked, qualified
from thornwall.sources.landing import PAGE, PageFields, page_index
from thornwall.streaming.batches import Batches
from thornwall.streaming.current_state import FOLD_RATIO, CurrentState
from thornwall.streaming.ingest import LOG_SCHEMA, raw_stream, start_raw, start_upsert

GOLD: dict[str, Callable[..., DataFrame]] = {
    "cve_severity_daily": gold.severity_daily,
    "cve_recent_critical": gold.recent_critical,
    "cve_cwe_top": gold.cwe_top,
}


VERSIONED = [*GOLD, "alerts", "alerts_triaged"]


class Medallion:
    """Landing directory -> raw pages -> current CVEs -> reporting tables.

    >>> m = Medallion(spark, "/shared/cves", landing="/shared/landing")
    >>> m.run()                      # take in what has landed, refresh everything
    >>> m.table("cve_severity_daily").show()
    """

    def __init__(self, spark: SparkSession, root: str, landing: str | None = None):
        self.spark = configure(spark)
        self.root = qualified(spark, root)
        self.landing = landing or f"{self.root}/landing"
        self.raw_path = f"{self.root}/nvd_cves_raw"
        self.log = Batches(spark, f"{self.root}/expectations", LOG_SCHEMA)
        self.fields = PageFields(spark, self.raw_path, f"{self.root}/schema")
        self.state = CurrentState(spark, f"{self.root}/cves", SILVER_SCHEMA, KEY, SEQUENCE)

    # --- refresh ---------------------------------------------------------------

    def ingest(self, mode: str = "triggered", evolve: bool = True, **options) -> StreamingQuery:
        """Start the raw hop.

        Pages are kept whole beside their typed columns, so a field that is new
        is in the table whenever it comes, also under a running query;
        ``look_for_fields`` makes it a column. ``evolve=False`` keeps the typed
        columns only, which halves the table where the feed's fields are known.
        """
        return start_raw(self.spark, self.landing, self.raw_path, f"{self.root}/checkpoints/raw", evolve, mode, **options)

    def look_for_fields(self) -> None:
        """Take up new fields of the pages that came since the last look."""
        self.fields.look()

    def upsert(self, mode: str = "triggered", interval: str = "1 minute", **options) -> StreamingQuery:
        """Start the current-state hop. A continuous one folds its changes as it goes."""
        pages = raw_stream(self.spark, self.raw_path, **options)
        ratio = FOLD_RATIO if mode == "continuous" else None
        return start_upsert(
            pages, self.state, self.log, f"{self.root}/checkpoints/cves", mode, interval, fold_ratio=ratio
        )

    def refresh_gold(self, as_of: datetime.date | str | None = None) -> None:
        """Recompute the reporting tables, each into a new version that replaces the old one whole."""
        cves = self.state.read()
        for name, compute in GOLD.items():
            rows = compute(cves, as_of=as_of) if name == "cve_recent_critical" else compute(cves)
            marked(rows.write).parquet(self._versions(name).next())

    def refresh_alerts(
        self,
        rows: DataFrame,
        rules: list[Rule],
        source: str,
        asset: str,
        ts: str,
        cve_source: Column,
        catalogue: DataFrame | None = None,
    ) -> None:
        """Recompute ``alerts`` from the rules over ``rows``, and ``alerts_triaged`` from those and the current CVEs.

        ``cve_source`` gives, from an alert's columns, the reporting source whose CVEs concern it;
        a ``catalogue`` of techniques adds their names and tactics.
        """
        alerts = detect.alerts(rows, rules, source, asset, ts)
        marked(alerts.write).parquet(self._versions("alerts").next())
        triaged = triage.triage(self.table("alerts"), triage.cve_context(self.state.read()), cve_source, rules, catalogue)
        marked(triaged.write).parquet(self._versions("alerts_triaged").next())

    def run(self, as_of: datetime.date | str | None = None, evolve: bool = True) -> None:
        """One triggered pass through all layers, in order."""
        self.ingest(evolve=evolve).awaitTermination()
        if evolve:
            self.look_for_fields()
        self.upsert().awaitTermination()
        self.state.fold_if_due()
        self.refresh_gold(as_of)

    # --- access ----------------------------------------------------------------

    def _versions(self, name: str) -> Versions:
        return Versions(self.spark, f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        if name == "nvd_cves_raw":
            # Its schema is given, not merged from the footers of all files.
            return self.fields.read()
        if name == "cves_exploded":
            return expect_all_or_drop(flatten(occurrences(self.table("nvd_cves_raw"))), EXPECTATIONS)
        if name == "cves":
            return self.state.read()
        if name in VERSIONED:
            path = self._versions(name).latest()
            if path is None:
                raise LookupError(f"{name} has not been refreshed yet")
            return self.spark.read.parquet(path)
        raise LookupError(name)

    def occurrences(self, **fields: str) -> DataFrame:
        """One row per CVE in the raw pages, ``cve`` with the given fields of its record by type, known to the tables or not.

        They are read from the whole pages, so pages taken in without those have none.
        """
        record = ",".join(f"`{name}`:{kind}" for name, kind in fields.items())
        pages = self.spark.read.schema(f"{PAGE} variant, {INGEST_COLUMNS}").parquet(self.raw_path)
        found = F.try_variant_get(PAGE, "$.vulnerabilities", f"array<struct<cve:struct<{record}>>>")
        return occurrences(pages.withColumn("vulnerabilities", found))

    def page_index(self) -> DataFrame:
        """One row per page in the raw table, for the audits; of the records, only ids are read."""
        raw = self.spark.read.schema(f"{page_schema('id')}, {INGEST_COLUMNS}").parquet(self.raw_path)
        return page_index(raw)

    def vacuum(self, keep: int = 2) -> None:
        """Delete superseded versions of the stored datasets, and bring the log of each closed day into one file.

        Readers of the newest ``keep`` versions are not disturbed.
        """
        self.state.vacuum(keep)
        self.log.compact(datetime.datetime.now(datetime.timezone.utc).date())
        for name in VERSIONED:
            self._versions(name).vacuum(keep)

    def expectation_log(self) -> DataFrame:
        """Passed and failed records per batch and rule."""
        return self.log.read()

    def register_views(self) -> None:
        """Make every dataset known to SQL under its name; alerts only once there are some."""
        for name in DATASETS:
            if name not in GOLD and name in VERSIONED and self._versions(name).latest() is None:
                continue
            self.table(name).createOrReplaceTempView(name)

    def publish(self, database: str) -> None:
        """Put the stored datasets in a catalog, with description and layer, as they are now.

        ``cves`` is a view: base and pending changes are put together when it is
        read, so publishing writes no row. So are the raw pages, whose new fields
        are read from the whole page. Tables that are there already, with
        the same columns, are moved to their new version by one change of location.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        paths = {name: self._versions(name).latest() for name in VERSIONED}
        for name, path in paths.items():
            if path is None:
                continue
            self._publish_table(f"{database}.{name}", path, self.table(name).schema, *DATASETS[name])
        self._publish_view(f"{database}.cves", self.state.view_sql(), *DATASETS["cves"])
        self._publish_view(f"{database}.nvd_cves_raw", f"SELECT {', '.join(self.fields.shown())} FROM {self._raw_files()}", *DATASETS["nvd_cves_raw"])

    def _raw_files(self) -> str:
        """A table on the raw files as they are read now; another one once there are more fields."""
        schema = self.fields.stored()
        name = f"{self.spark.catalog.currentDatabase()}.thornwall_raw_{hashlib.md5((self.raw_path + schema.json()).encode()).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            self.spark.catalog.createTable(name, path=self.raw_path, source="parquet", schema=schema)
        self.spark.catalog.refreshTable(name)
        return name

    def _publish_view(self, view: str, select: str, layer: str, text: str) -> None:
        if self.spark.catalog.tableExists(view) and self.spark.catalog.getTable(view).tableType != "VIEW":
            self.spark.sql(f"DROP TABLE {view}")
        self.spark.sql(f"CREATE OR REPLACE VIEW {view} COMMENT '{text}' TBLPROPERTIES ('quality' = '{layer}') AS {select}")

    def _publish_table(self, table: str, path: str, schema: T.StructType, layer: str, text: str) -> None:
        catalog = self.spark.catalog
        if catalog.tableExists(table) and self.spark.table(table).schema.names == schema.names:
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            catalog.refreshTable(table)
            return
        # Dropping an external table leaves its files alone.
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        catalog.createTable(table, path=path, source="parquet", schema=schema, description=text)
        self.spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('quality' = '{layer}')")
