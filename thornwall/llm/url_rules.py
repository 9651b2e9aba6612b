"""URL rules by a sort-merge range join.

A rule (host, path) covers its host, all subdomains, and paths that start with
its path: with an empty or null one, all of them. Keys are canonical: the labels
of the host in reverse order, a separator, then the path, so that a rule is the
interval of keys that start with its own key.
Intervals are nested or apart. Rules and URLs are sorted by key together and
swept: where an interval starts, its rule comes on top of the stack of rules
that are active; where it ends, the stack below is back; a URL is judged by the
stack it meets. A URL is swept once for each of its parent domains that a rule
could name (no rule names more labels than the longest), and the longest rule
wins: by the length of host and path, then of the host.

A sweep covers one top-level domain; large ones are dealt to several sweeps,
each of which gets all rules of the domain. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, named

#: Between host and path of a key; neither part of a URL can hold it, so no key of one host starts with another's.
_END = "#"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def _key(host: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(_END), path)


def _events(rules: DataFrame) -> DataFrame:
    """(tld, key, kind, stack): where intervals start and end, with the rules that are active from there on, the outermost first."""
    r = rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").filter("host != ''")
    # Of rules that say the same, blocking wins.
    r = r.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    entry = F.struct(
        (F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict"
    )
    r = r.select(F.substring_index("host", ".", -1).alias("tld"), _key(F.col("host"), F.col("path")).alias("key"), entry.alias("entry"))
    prefixes = r.select("key", F.explode(F.expr("transform(sequence(1, length(key)), i -> left(key, i))")).alias("outer_key"))
    outer = r.select(F.col("key").alias("outer_key"), "entry")
    # A rule's chain is as long as its key at most.
    chains = prefixes.join(outer, "outer_key").groupBy("key").agg(F.sort_array(F.collect_list("entry")).alias("stack"))
    r = r.join(chains, "key")
    below = F.slice("stack", F.lit(1), F.size("stack") - 1)
    # No byte of UTF-8 is 0xFF: the end sorts after all that starts with the key.
    return r.select("tld", F.col("key").cast("binary").alias("key"), F.lit(0).alias("kind"), "stack").union(
        r.select("tld", F.concat(F.col("key").cast("binary"), F.unhex(F.lit("FF"))), F.lit(1), below)
    )


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow", sweep_rows: int = 8192) -> DataFrame:
    """(id, url, host, path, rule, verdict): a row per row of ``pages``.

    ``rules``: (host, path, verdict). A rule without a path, empty or null, fits
    its host and all subdomains; one without a host, empty or null, names no URL
    and is left out. ``rule`` is host and path of the longest
    that fits, else null, and then the verdict is the default: also for null
    URLs and those without ``://``, whose host and path are empty. Each distinct
    URL is judged once, however often it occurs.
    """
    scratch = Scratch(pages.sparkSession)
    host, path = split_url(F.col("url"))
    urls = scratch.keep(pages.select(named(url_col).alias("url")).distinct().select("url", host.alias("host"), path.alias("path")))
    events = scratch.keep(_events(rules))
    labels = rules.agg(F.max(F.size(F.split("host", r"\."))).alias("n")).first()["n"] or 0

    depth = F.least(F.lit(labels), F.size(F.split("host", r"\.")))
    probes = urls.filter("host != ''").select("url", "host", "path", F.substring_index("host", ".", -1).alias("tld"), F.explode(F.sequence(F.lit(1), depth)).alias("level")) if labels else None
    if probes is None:
        return _answer(pages, urls.withColumn("best", F.lit(None).cast("struct<size:int,host_size:int,rule:string,verdict:string>")), id_col, url_col, default)
    parent = F.expr("substring_index(host, '.', -level)")
    probes = probes.select("url", "tld", _key(parent, F.col("path")).cast("binary").alias("key"))

    ruled = events.filter("kind = 0").groupBy("tld").agg(F.count("*").alias("rules"))
    sweeps = probes.groupBy("tld").agg(F.count("*").alias("n")).join(ruled, "tld")
    sweeps = scratch.keep(sweeps.select("tld", F.ceil(F.col("n") / F.greatest(F.lit(sweep_rows), 4 * F.col("rules"))).cast("long").alias("sweeps")))
    dealt = probes.join(sweeps, "tld").select("tld", F.pmod(F.xxhash64("url"), F.col("sweeps")).alias("sweep"), "key", F.lit(2).alias("kind"), F.lit(None).alias("stack"), "url")
    copied = events.join(sweeps, "tld").select("tld", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sweeps") - 1)).alias("sweep"), "key", "kind", "stack", F.lit(None).alias("url"))

    upto_here = Window.partitionBy("tld", "sweep").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = copied.union(dealt).withColumn("active", F.last("stack", ignorenulls=True).over(upto_here))
    met = swept.filter("kind = 2 and size(active) > 0").select("url", F.element_at("active", -1).alias("top"))
    best = met.groupBy("url").agg(F.max("top").alias("best"))
    return _answer(pages, urls.join(best, "url", "left"), id_col, url_col, default)


def _answer(pages: DataFrame, judged: DataFrame, id_col: str, url_col: str, default: str) -> DataFrame:
    judged = judged.withColumnRenamed("url", "u")
    rows = pages.select(named(id_col).alias("id"), named(url_col).alias("url"))
    verdict = F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")
    return rows.join(judged, rows["url"].eqNullSafe(judged["u"])).select("id", "url", "host", "path", F.col("best.rule").alias("rule"), verdict)
