import os
from pathlib import Path

import pytest
from feed import NAME, cve, page
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thornwall import session
from thornwall.functions.cve import iso_z
from thornwall.plans import workspace
from thornwall.sources import landing, sample_feed
from thornwall.sources.files import Versions


def test_name_codec_both_ways(spark):
    df = spark.sql("select date'2024-01-01' s, date'2024-04-30' e, 7L p, '20240501T101112Z' r")
    name = landing.page_file_name(F.col("s"), F.col("e"), F.col("p"), F.col("r"))
    row = df.select(name.alias("n")).select("n", *(c.alias(k) for k, c in landing.file_parts(F.col("n")).items())).first()
    assert row["n"] == "cves_20240101_20240430_p007_20240501T101112Z.json"
    assert str(row["chunk_start"]) == "2024-01-01" and str(row["chunk_end"]) == "2024-04-30"
    assert row["page"] == 7 and row["run_ts"] == "20240501T101112Z"


def test_wide_page_numbers_and_foreign_names(spark):
    df = spark.createDataFrame([("cves_20240101_20240430_p12345_x.json",), ("cves_bad.json",)], "n string")
    rows = df.select(*(c.alias(k) for k, c in landing.file_parts(F.col("n")).items())).collect()
    assert rows[0]["page"] == 12345
    assert tuple(rows[1]) == (None, None, None, None)


def test_request_timestamps_cut_fractions(spark):
    row = spark.sql("select timestamp'2024-01-02 03:04:05.987654' t, timestamp'2024-01-02 03:04:05+02:00' z").select(
        iso_z(F.col("t")), iso_z(F.col("z"))
    )
    assert tuple(row.first()) == ("2024-01-02T03:04:05.000", "2024-01-02T01:04:05.000")


def test_inventory(spark, tmp_path):
    for i in range(25):
        path = page(tmp_path, i, cve("CVE-%d" % i))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    page(tmp_path / "_tmp", 99, cve())
    (tmp_path / "notes.json").write_text("{}")
    totals = landing.landing_totals(spark, str(tmp_path)).first()
    assert totals["files"] == 25 and totals["bytes"] == sum(p.stat().st_size for p in tmp_path.glob("cves_*"))
    recent = landing.landing_inventory(spark, str(tmp_path)).collect()
    assert [r["file_name"] for r in recent] == [NAME.format(page=i) for i in range(24, 4, -1)]


def test_published_pages_are_whole_and_repeatable(spark, tmp_path):
    pages = spark.range(40).selectExpr(
        "format_string('cves_20240101_20240130_p%03d_x.json', id) file_name", "concat('{\"a\": \"ü', id, '\"}') document"
    )
    target = str(tmp_path / "landing")
    for _ in range(2):
        assert landing.write_pages(pages, target).agg(F.sum("bytes")).first()[0] > 0
    files = list(Path(target).glob("cves_*.json"))
    assert len(files) == 40 and not list(Path(target, "_tmp").iterdir())
    assert spark.read.option("multiLine", "true").json(target).where("a like 'ü%'").count() == 40


def events_of(spark, n, users=40):
    return spark.range(n).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 20) ts", f"id % {users} user_id", "'click' event_type", "double(id) value", "'{\"k\": 1}' props"
    )


@pytest.mark.parametrize("whole", [False, True])
def test_packed_pages_read_like_files(spark, tmp_path, whole):
    pages = spark.createDataFrame(
        [
            (NAME.format(page=0), '{"totalResults": 3, "vulnerabilities": [{"cve": {"id": "CVE-ü"}}, {"cve": {"id": "CVE-1"}}]}'),
            (NAME.format(page=1), '{"totalResults": 3, "vulnerabilities": [{"cve": {"id": "CV'),
            (NAME.format(page=2), '{"totalResults": "x", "vulnerabilities": [{"cve": {"id": "CVE-2"}}]}'),
            (NAME.format(page=3), '{"vulnerabilities": []}'),
        ],
        "file_name string, document string",
    )
    landing.write_pages(pages, str(tmp_path / "files")).count()
    landing.write_packs(pages, str(tmp_path / "packs"))
    files = (landing.read_whole_pages if whole else landing.read_pages)(spark, str(tmp_path / "files"))
    packs = landing.read_packed_pages(spark, str(tmp_path / "packs"), whole)
    assert packs.columns == files.columns

    def rows(df):
        name = landing.file_name(F.col("_ingest_file")).alias("name")
        return sorted(map(str, df.select(name, "totalResults", F.to_json("vulnerabilities"), landing.CORRUPT).collect()))

    assert rows(packs) == rows(files)


def test_small_pages_do_not_land_file_by_file(spark, tmp_path):
    events_of(spark, 3000).write.parquet(str(tmp_path / "events.parquet"))
    audited = workspace.audited(spark, str(tmp_path))
    landed = [p for p in Path(audited.landing.removeprefix("file:")).rglob("*") if p.is_file() and not p.name.startswith((".", "_"))]
    assert audited.page_index().count() > 250 and len(landed) < 30


def test_writers_get_few_documents_at_a_time(spark, tmp_path):
    """Pages grow with the records they hold: the memory of a worker must not grow with the pages of its task."""
    pages = spark.range(0, 60, 1, 1).select(
        F.format_string("cves_20240101_20240130_p%03d_x.json", "id").alias("file_name"), F.repeat(F.lit("ü"), 100_000).alias("document")
    )

    def counted(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["rows"])

    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    assert landing.write_pages(pages, str(tmp_path / "landing")).agg(F.sum("bytes")).first()[0] == 60 * 200_000
    assert max(r["rows"] for r in pages.mapInArrow(counted, "rows bigint").collect()) < 30
    assert (tmp_path / "landing" / "cves_20240101_20240130_p059_x.json").read_text() == "ü" * 100_000


def test_derived_feed_has_its_irregularities(spark, tmp_path):
    events = spark.range(1200).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(id % 20) ts", "id % 40 user_id", "'click' event_type"
    )
    target = str(tmp_path / "landing")
    assert sample_feed.land(events, target) == 3
    pages = landing.page_index(landing.read_pages(spark, target)).orderBy("page").collect()
    assert [(p["page"], p["records"], p["start_index"], p["total"]) for p in pages] == [
        (0, 500, 0, 1200),
        (1, 500, 500, 1200),
        (2, 200, 1000, 1200),
    ]


def test_inference_and_widening(spark, tmp_path):
    page(tmp_path, 0, cve("CVE-1", metrics={"cvssMetricV40": [{"cvssData": {"baseScore": 5.5}}]}), timestamp="t")
    found = landing.infer_pages(spark, str(tmp_path))
    known = T.StructType.fromDDL(landing.page_schema("id", "metrics"))
    wider = landing.with_new_fields(known, found)
    record = wider["vulnerabilities"].dataType.elementType["cve"].dataType
    assert set(record["metrics"].dataType.names) == {"cvssMetricV31", "cvssMetricV30", "cvssMetricV2", "cvssMetricV40"}
    assert "published" in record.names and "timestamp" in wider.names
    assert wider["totalResults"].dataType == T.LongType()


def test_known_fields_keep_their_type():
    known = T.StructType.fromDDL("a double, b array<struct<c:int>>")
    found = T.StructType.fromDDL("a string, b array<struct<c:string,d:string>>, e int")
    assert landing.with_new_fields(known, found) == T.StructType.fromDDL("a double, b array<struct<c:int,d:string>>, e int")
    found = T.StructType([T.StructField(name, T.StringType()) for name in ("A", "e", "E")])
    assert landing.with_new_fields(known, found).names in (["a", "b", "e"], ["a", "b", "E"])


def test_versions_count_from_their_marker_on(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "v"))
    assert versions.latest() is None
    (tmp_path / "v" / "v000001").mkdir(parents=True)
    assert versions.latest() is None and versions.next().endswith("v000002")
    spark.range(1).write.parquet(versions.next())
    assert versions.latest().endswith("v000002")


def test_session_with_other_settings(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 7)
    try:
        other = session.same_settings(spark, {"spark.sql.files.maxPartitionBytes": 1 << 20})
        assert other.conf.get("spark.sql.shuffle.partitions") == "7"
        assert other.conf.get("spark.sql.session.timeZone") == "UTC"
        assert other.conf.get("spark.sql.files.maxPartitionBytes") == "1048576"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") != "1048576"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_working_folder_follows_the_session(spark, monkeypatch):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.workdir(spark).startswith(shared)
    assert session.workdir(spark) == session.workdir(spark)

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId, master = "app-1", "spark://host:7077"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.workdir(Cluster())
