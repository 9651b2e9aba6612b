"""A CVE feed derived from the ``events`` table, with every irregularity the readers must bear.

Three consecutive events are three versions of one CVE, the newest mostly not
the last to arrive. Ids, dates, descriptions, metrics, weaknesses and references
are missing, empty, malformed or repeated by fixed rules on the event id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.sources.landing import file_parts, page_file_name, write_pages

# Fixed values of the derived feed.
CHUNK_START, CHUNK_END, RUN_TS = "2024-01-01", "2024-01-30", "20240131T000000Z"
RERUN_TS = "20240201T000000Z"
PAGE_SIZE = 500
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


def _texts(*pairs: tuple[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(lang).alias("lang"), value.alias("value")) for lang, value in pairs))


def _severity(score: Column, critical: bool) -> Column:
    top = F.when(score >= 9, "CRITICAL") if critical else F.when(score >= 7, "HIGH")
    return top.when(score >= 7, "HIGH").when(score >= 4, "MEDIUM").otherwise("LOW")


def _v3(score: Column, vector: Column | None = None) -> Column:
    data = [score.alias("baseScore"), _severity(score, True).alias("baseSeverity")]
    if vector is not None:
        data.append(vector.alias("vectorString"))
    return F.array(F.struct(F.struct(*data).alias("cvssData")))


def record(event: Column, **more: Column) -> Column:
    """The CVE record of one event, with further fields."""
    h, ts, user, kind = event["event_id"], event["ts"], event["user_id"], event["event_type"]
    k = _div(h, 3)
    score = (h * 13 % 101).cast("double") / 10
    day_shift = F.when(k % 10 == 0, F.lit(5)).otherwise((h * 2 % 3).cast("int"))
    v2 = F.array(
        F.struct(_severity(score, False).alias("baseSeverity"), F.struct(score.alias("baseScore")).alias("cvssData"))
    )
    cwe_25 = F.concat(F.lit("CWE-"), (user % 25).cast("string"))
    cwe_7 = F.concat(F.lit("CWE-"), (user % 7).cast("string"))

    def weaknesses(*descriptions: Column) -> Column:
        return F.array(*(F.struct(d.alias("description")) for d in descriptions))

    fields = {
        "id": F.when(h % 97 != 0, F.concat(F.lit("CVE-2024-"), F.lpad(k.cast("string"), 6, "0"))),
        "published": F.when(h % 89 == 0, None).when(h % 83 == 0, "not-a-date").otherwise(F.date_format(ts, DATE_FORMAT)),
        "lastModified": F.when(
            h % 101 != 0, F.date_format(F.date_trunc("day", ts) + F.make_dt_interval(days=day_shift), DATE_FORMAT)
        ),
        "vulnStatus": F.get(F.array(F.lit("Analyzed"), F.lit("Modified"), F.lit("Awaiting Analysis")), (h % 3).cast("int")),
        "sourceIdentifier": F.concat(F.lit("src"), (user % 10).cast("string"), F.lit("@example.org")),
        "descriptions": F.when(h % 7 == 0, None)
        .when(h % 5 == 0, _texts(("es", F.lit("hola"))))
        .otherwise(
            _texts(
                ("es", F.lit("hola")),
                ("en", F.repeat(F.concat(kind, F.lit(" ")), (h % 90 + 1).cast("int"))),
            )
        ),
        "metrics": F.struct(
            F.when(
                (h % 6).isin(0, 1, 4), _v3(score, F.concat(F.lit("CVSS:3.1/S:"), score.cast("string")))
            ).alias("cvssMetricV31"),
            F.when(h % 6 == 2, _v3(score)).alias("cvssMetricV30"),
            F.when((h % 6).isin(3, 4), v2).when(h % 6 == 5, F.slice(v2, 1, 0)).alias("cvssMetricV2"),
        ),
        "weaknesses": F.when(h % 4 == 1, weaknesses(_texts(("en", cwe_25))))
        .when(
            h % 4 == 2,
            weaknesses(_texts(("en", cwe_25)), _texts(("en", cwe_25)), _texts(("en", F.lit("NVD-CWE-noinfo")))),
        )
        .when(h % 4 == 3, weaknesses(_texts(("es", F.lit("otro"))), _texts(("en", cwe_7)))),
        "references": F.when(
            h % 4 != 3,
            F.transform(
                F.slice(F.array(*map(F.lit, range(3))), F.lit(1), (h % 4).cast("int")),
                lambda i: F.struct(F.concat_ws("/", F.lit("http://r"), h.cast("string"), i.cast("string")).alias("url")),
            ),
        ),
    }
    return F.struct(*(column.alias(name) for name, column in (fields | more).items()))


def paged(events: DataFrame, page_size: int, item: Column) -> DataFrame:
    """(page, items) of consecutive events.

    A list has at most ``page_size`` items, as ids are unique. Where they are
    not, the job fails: repeated rows are counted, never collected.
    """
    once = F.when(F.col("n") == 1, F.col("item")).otherwise(F.raise_error(F.lit("event ids must be unique")))
    return (
        events.select(_div(F.col("event_id"), page_size).alias("page"), "event_id", item.alias("item"))
        .repartition("page")
        .groupBy("page", "event_id")
        .agg(F.first("item").alias("item"), F.count(F.lit(1)).alias("n"))
        .groupBy("page")
        .agg(F.sort_array(F.collect_list(once)).alias("items"))
    )


def page_documents(
    events: DataFrame,
    page_size: int = PAGE_SIZE,
    page_fields: dict[str, Column] | None = None,
    record_fields: Callable[[Column], dict[str, Column]] | None = None,
) -> DataFrame:
    """(file_name, document) per page of consecutive events.

    The narrow event columns are shuffled; records are built after it. Further
    fields may be given for pages (of ``page``) and records (of the event); where
    they are NULL, the document does not have them.
    """
    total = events.count()
    last_page = max(0, (total - 1) // page_size)
    pages = paged(events, page_size, F.struct("event_id", "ts", "user_id", "event_type")).withColumnRenamed("items", "page_events")
    document = F.to_json(
        F.struct(
            F.lit(page_size).alias("resultsPerPage"),
            (F.col("page") * page_size).alias("startIndex"),
            F.lit(total).alias("totalResults"),
            F.transform("page_events", lambda e: F.struct(record(e, **(record_fields(e) if record_fields else {})).alias("cve"))).alias("vulnerabilities"),
            *(column.alias(field) for field, column in (page_fields or {}).items()),
        )
    )
    name = page_file_name(
        F.lit(CHUNK_START).cast("date"), F.lit(CHUNK_END).cast("date"), F.col("page"), F.lit(RUN_TS), len(str(last_page))
    )
    return pages.select(name.alias("file_name"), document.alias("document"))


def land(events: DataFrame, landing: str, page_size: int = PAGE_SIZE) -> int:
    """Publish the derived pages; returns how many."""
    return write_pages(page_documents(events, page_size), landing).count()


def land_with_new_fields(events: DataFrame, landing: str, which: Callable[[Column], Column], page_size: int = PAGE_SIZE) -> int:
    """Publish the pages whose number meets a condition. The odd ones have a field of the page and one of the records more."""

    def of_odd(page: Column, value: Column) -> Column:
        return F.when(page % 2 == 1, value)

    documents = page_documents(
        events,
        page_size,
        {"format": of_odd(F.col("page"), F.lit("CVE_PAGE"))},
        lambda e: {"cveTags": of_odd(_div(e["event_id"], page_size), F.array(e["event_type"]))},
    )
    return write_pages(documents.where(which(file_parts(F.col("file_name"))["page"])), landing).count()


def configurations(event: Column) -> Column:
    """A tree of affected products: two levels of nodes, platforms, negated nodes, wildcards and escaped names."""
    h, user = event["event_id"], event["user_id"]

    def match(vulnerable: bool, *parts: Column) -> Column:
        name = F.concat(F.lit("cpe:2.3:"), *parts, F.lit(":*:*:*:*:*:*:*"))
        return F.struct(F.lit(vulnerable).alias("vulnerable"), name.alias("criteria"))

    def node(negate: Column, matches: list[Column], *below: Column) -> Column:
        children = [F.array(*below).alias("children")] if below else []
        return F.struct(F.lit("OR").alias("operator"), negate.alias("negate"), F.array(*matches).alias("cpeMatch"), *children)

    vendor = F.when(h % 6 == 1, "*").otherwise(F.concat(F.lit("vendor"), user % 7))
    own = match(True, F.lit("a:"), vendor, F.lit(":product\\:x:1.0"))
    platform = match(False, F.lit("o:platform:os:-"))
    deep = node(h % 5 == 0, [match(True, F.lit("a:deep"), user % 3, F.lit("\\:co:thing:*"))])
    never = node(F.lit(True), [match(True, F.lit("a:never:x:1"))], deep)
    tree = F.struct(F.lit("AND").alias("operator"), F.array(node(F.lit(False), [own, own, platform], deep), never).alias("nodes"))
    return F.when(h % 4 != 0, F.array(tree))


def _daily_pages(events: DataFrame, page_size: int, block: int) -> DataFrame:
    """(chunk_start, n, page, total, records): the pages of a run that asks for one window per day, n counting days.

    Pages follow the event id within the day. No day is sorted for that: events
    are counted per block of ids, and a block's pages follow from its count and
    the counts before it. A block holds at most ``block`` events, so a day with
    a third of all events is still spread.
    """
    day = F.to_date("ts")
    blocks = events.groupBy(day.alias("chunk_start"), _div(F.col("event_id"), block).alias("block")).agg(
        F.count(F.lit(1)).alias("n")
    )
    of_day = Window.partitionBy("chunk_start")
    before = of_day.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.select(
        "chunk_start",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"),
        "n",
        F.sum("n").over(of_day).alias("total"),
    ).withColumn("end", F.col("begin") + F.col("n"))
    page = F.col("page")
    pages = (
        placed.withColumn("page", F.explode(F.sequence(_div(F.col("begin"), page_size), _div(F.col("end") - 1, page_size))))
        .withColumn("part", F.least("end", (page + 1) * page_size) - F.greatest("begin", page * page_size))
        .groupBy("chunk_start", "page", "total")
        .agg(F.sum("part").alias("records"))
    )
    n = F.date_diff("chunk_start", F.lit(CHUNK_START).cast("date"))
    return pages.select("chunk_start", n.alias("n"), page.cast("int").alias("page"), "total", "records")


def daily_page_index(events: DataFrame, page_size: int = 10, block: int = 100_000) -> DataFrame:
    """Page index of a run that asked for one window per day, with pages and whole days left out.

    Page 1 is missing on days n with n % 7 = 3, the whole day when n % 11 = 5.
    """
    n = F.col("n")
    return (
        _daily_pages(events, page_size, block)
        .where(~((n % 7 == 3) & (F.col("page") == 1)) & (n % 11 != 5))
        .select(F.lit(RUN_TS).alias("run_ts"), "chunk_start", F.date_add("chunk_start", 1).alias("chunk_end"), "page", "total", "records")
    )


def daily_documents(events: DataFrame, page_size: int = 10, block: int = 100_000) -> DataFrame:
    """(file_name, document) of two runs with one window per day.

    The first leaves out what ``daily_page_index`` says; its page 0 is cut short
    on days n with n % 13 = 4, its page 2 empty when n % 13 = 6. The second asks
    again for the days with n % 9 = 0 and gets all their pages.
    """
    again = _daily_pages(events, page_size, block).where(F.col("n") % 9 == 0)
    again = again.select(F.lit(RERUN_TS).alias("run_ts"), "chunk_start", F.date_add("chunk_start", 1).alias("chunk_end"), "page", "total", "records")
    # Pages lie by day so far, in as few tasks as their narrow rows need: documents are built in more.
    pages = daily_page_index(events, page_size, block).union(again).repartition("chunk_start", "page")
    n = F.date_diff("chunk_start", F.lit(CHUNK_START).cast("date"))
    first, page = F.col("run_ts") == RUN_TS, F.col("page")
    begin = page * page_size
    ids = F.transform(
        F.sequence(F.lit(1).cast("bigint"), "records"),
        lambda i: F.struct(F.struct(F.concat_ws("-", F.lit("CVE"), F.date_format("chunk_start", "yyyyMMdd"), (begin + i).cast("string")).alias("id")).alias("cve")),
    )
    document = F.to_json(
        F.struct(
            F.lit(page_size).alias("resultsPerPage"),
            begin.alias("startIndex"),
            F.col("total").alias("totalResults"),
            F.when(first & (n % 13 == 6) & (page == 2), F.slice(ids, 1, 0)).otherwise(ids).alias("vulnerabilities"),
        )
    )
    cut = F.substr(document, F.lit(1), (F.length(document) / 2).cast("int"))
    return pages.select(
        page_file_name(F.col("chunk_start"), F.col("chunk_end"), page, F.col("run_ts")).alias("file_name"),
        F.when(first & (n % 13 == 4) & (page == 0), cut).otherwise(document).alias("document"),
    )


# --- telemetry files ----------------------------------------------------------------

_ZEEK_LOGS = (
    ("conn", "\t", "ts uid id.orig_h id.orig_p id.resp_h id.resp_p proto service duration conn_state", "time string addr port addr port enum string interval string"),
    ("conn", "|", "conn_state duration service proto id.resp_p id.resp_h id.orig_p id.orig_h uid ts", "string interval string enum port addr port addr string time"),
    ("dns", "\t", "ts uid id.orig_h id.orig_p id.resp_h id.resp_p proto query rcode_name answers", "time string addr port addr port enum string string vector[string]"),
)


def zeek_documents(events: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(file_name, document): logs of two types, one also with other separator and order of fields.

    The line of an event with id % 50 = 7 is cut after 20 characters, that of
    id % 50 = 8 has no time. Every fifth file is there twice, under two names.
    """
    pages = paged(events, page_size, F.struct("event_id", "ts", "user_id", "event_type", "value"))

    def log(path: str, separator: str, fields: str, types: str) -> Column:
        head = [f"#separator \\x{ord(separator):02x}", f"#set_separator{separator},", f"#empty_field{separator}(empty)", f"#unset_field{separator}-", f"#path{separator}{path}"]
        head += ["#fields" + separator + separator.join(fields.split()), "#types" + separator + separator.join(types.split())]

        def line(e: Column) -> Column:
            h, failed = e["event_id"], e["event_type"] == "error"
            micros = F.unix_micros(e["ts"].cast("timestamp"))
            text = {
                "ts": F.when(h % 50 == 8, "-").otherwise(F.concat_ws(".", _div(micros, 1_000_000).cast("string"), F.lpad((micros % 1_000_000).cast("string"), 6, "0"))),
                "uid": F.concat(F.lit("C"), h),
                "id.orig_h": F.concat(F.lit("10.0."), e["user_id"] % 250, F.lit(".7")),
                "id.orig_p": (h % 60_000).cast("string"),
                "id.resp_h": F.concat(F.lit("192.0.2."), h % 250),
                "id.resp_p": F.when(failed, "22").otherwise("443"),
                "proto": F.lit("tcp"),
                "service": F.when(h % 3 == 0, "(empty)").when(h % 3 == 1, "-").otherwise("ssl"),
                "duration": F.when(h % 4 == 0, "-").otherwise(e["value"].cast("string")),
                "conn_state": F.when(failed, "REJ").otherwise("SF"),
                "query": F.concat(e["event_type"], F.lit(".example.org")),
                "rcode_name": F.when(failed, "NXDOMAIN").otherwise("NOERROR"),
                "answers": F.when(failed, "(empty)").otherwise(F.concat_ws(",", F.lit("192.0.2.1"), F.concat(F.lit("192.0.2."), h % 250))),
            }
            whole = F.concat_ws(separator, *(text[name] for name in fields.split()))
            return F.when(h % 50 == 7, F.substring(whole, 1, 20)).otherwise(whole)

        return F.concat_ws("\n", F.array(*map(F.lit, head)), F.transform("items", line), F.array(F.lit("#close"), F.lit("")))

    kinds = [log(*kind) for kind in _ZEEK_LOGS]
    document = F.when(F.col("page") % 3 == 0, kinds[0]).when(F.col("page") % 3 == 1, kinds[1]).otherwise(kinds[2])
    number = F.lpad(F.col("page").cast("string"), 6, "0")
    copies = F.when(F.col("page") % 5 == 0, F.array(F.lit("log"), F.lit("copy"))).otherwise(F.array(F.lit("log")))
    return pages.select(F.explode(copies).alias("kind"), number.alias("number"), document.alias("document")).select(
        F.concat("kind", F.lit("_"), "number", F.lit(".log")).alias("file_name"), "document"
    )


def sysmon_documents(events: DataFrame, xml: bool, page_size: int = PAGE_SIZE) -> DataFrame:
    """(file_name, document): endpoint events, as JSON lines or XML.

    Of id % 50 = 7 the line is cut after 20 characters or an end tag is missing;
    id % 50 = 8 has no computer; in XML, text stands before id % 50 = 9.
    """
    pages = paged(events, page_size, F.struct("event_id", "ts", "user_id", "event_type"))

    def line(e: Column) -> Column:
        h = e["event_id"]
        number = F.when(e["event_type"] == "error", 8).otherwise(1)
        computer = F.when(h % 50 != 8, F.concat(F.lit("HOST-"), e["user_id"]))
        image = F.concat(F.lit("C:\\bin\\"), e["event_type"], F.lit(".exe"))
        if not xml:
            time = F.date_format(e["ts"], "yyyy-MM-dd HH:mm:ss.SSS")
            whole = F.to_json(F.struct(number.alias("EventID"), computer.alias("Computer"), time.alias("UtcTime"), image.alias("Image"), h.alias("RecordId")))
            return F.when(h % 50 == 7, F.substring(whole, 1, 20)).otherwise(whole)
        time = F.date_format(e["ts"], "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        system = F.concat(
            F.lit("<System><EventID>"), number, F.lit("</EventID><TimeCreated SystemTime=\""), time, F.lit("\"/>"),
            F.coalesce(F.concat(F.lit("<Computer>"), computer, F.lit("</Computer>")), F.lit("")), F.lit("</System>"),
        )
        data = F.concat(F.lit("<EventData><Data Name=\"Image\">"), image, F.lit("</Data><Data Name=\"RecordId\">"), h, F.lit("</Data>"))
        noise = F.when(h % 50 == 9, F.concat(F.lit("noise "), h, F.lit(" "))).otherwise("")
        return F.concat(noise, F.lit("<Event>"), system, data, F.when(h % 50 == 7, "").otherwise("</EventData>"), F.lit("</Event>"))

    around = (["<?xml version=\"1.0\"?>", "<Events>"], ["</Events>", ""]) if xml else ([], [""])
    head, tail = (F.array(*map(F.lit, part)).cast("array<string>") for part in around)
    number = F.lpad(F.col("page").cast("string"), 6, "0")
    return pages.select(F.concat(F.lit("endpoint_"), number, F.lit(".xml" if xml else ".json")).alias("file_name"), F.concat_ws("\n", head, F.transform("items", line), tail).alias("document"))


def bundle_documents(events: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """(file_name, document): a STIX bundle per page; on pages with number % 7 = 3 it is cut in half."""
    pages = paged(events, page_size, F.struct("event_id", "event_type"))

    def item(e: Column) -> Column:
        h = e["event_id"]
        return F.struct(
            F.when(h % 5 == 4, "malware").otherwise("attack-pattern").alias("type"),
            F.concat(F.lit("attack-pattern--"), h).alias("id"),
            F.concat_ws(" ", e["event_type"], h.cast("string")).alias("name"),
            F.when(h % 7 == 0, True).alias("revoked"),
            F.array(F.struct(F.lit("mitre-attack").alias("source_name"), F.concat(F.lit("T"), h).alias("external_id"))).alias("external_references"),
        )

    document = F.to_json(F.struct(F.lit("bundle").alias("type"), F.transform("items", item).alias("objects")))
    cut = F.substr(document, F.lit(1), (F.length(document) / 2).cast("int"))
    number = F.lpad(F.col("page").cast("string"), 6, "0")
    return pages.select(F.concat(F.lit("bundle_"), number, F.lit(".json")).alias("file_name"), F.when(F.col("page") % 7 == 3, cut).otherwise(document).alias("document"))
