"""WARC archives and their fixity: Merkle trees over ordered offset ranges, one of each replica.

Both sides are listed in their own order; a record's offset is the sum of the
lengths before it. Ranges of ids are the leaves: ``fanout`` ids each, fixed
without looking at either side. A leaf is the digest of its records in the order
of the listing, each with its digest, length and place behind the leaf's first
one (which make its offset there), so bytes lost in one range do not touch the
digests of others. A node is
the digest of up to ``fanout`` children in the order of the listing. Each tree is
built from its own listing; replicas agree if their roots do. If not, the
comparison descends: only children of nodes that differ are compared. A child
with the same digest at another place among those both have was moved as a
whole. Records are compared in leaves that differ only.

A range of ids that very many records share (or that have none) is cut into
runs of consecutive records, each a leaf.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, measured, named, ranked, repeated, running

_LEAF_RECORDS = 1024


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(id, name, record): a WARC record a row, as bytes; null urls and bodies are written as empty.

    ``date``: when the pages were captured, for the header. Further columns of
    ``pages`` are left out; repeated rows are records of their own.
    """
    body = F.coalesce(named(body_col), F.lit(""))
    name = F.concat(F.lit("urn:page:"), F.coalesce(named(id_col).cast("string"), F.lit("")))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <"), name, F.lit(f">\r\nWARC-Date: {date}\r\nWARC-Target-URI: "),
        F.coalesce(named(url_col), F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select(named(id_col).alias("id"), name.alias("name"), F.concat(head, body, F.lit("\r\n\r\n")).cast("binary").alias("record"))


def parsed(archive: DataFrame) -> DataFrame:
    """(id, name, url, date, length, body, sound): what records say; ``sound`` if the body has the length that the header states."""
    text = F.col("record").cast("string")
    head = F.substring_index(text, "\r\n\r\n", 1)

    def field(name: str) -> Column:
        return F.regexp_extract(head, f"(?m)^{name}: ?(.*?)\r?$", 1)

    length = field("Content-Length").try_cast("long")
    begin = F.octet_length(head) + 4
    body = F.col("record").substr((begin + 1).cast("int"), F.octet_length("record") - begin - 4)
    return archive.select(
        "id", F.regexp_extract(field("WARC-Record-ID"), "^<(.*)>$", 1).alias("name"), field("WARC-Target-URI").alias("url"), field("WARC-Date").alias("date"),
        length.alias("length"), body.cast("string").alias("body"), F.coalesce(F.octet_length(body) == length, F.lit(False)).alias("sound"),
    )


def digested(archive: DataFrame) -> DataFrame:
    """(id, name, head, sha, length, and place if given): ``head`` hashes a record up to its content length, so by name and URL."""
    head = F.xxhash64(F.substring_index(F.col("record").cast("string"), "\r\nContent-Length:", 1))
    place = ["place"] if "place" in archive.columns else []
    return archive.select("id", "name", head.alias("head"), F.sha2("record", 256).alias("sha"), F.octet_length("record").cast("long").alias("length"), *place)


def listing(scratch: Scratch, archive: DataFrame) -> DataFrame:
    """(id, name, head, sha, length, rank): the records in order of ``place``, if there is one, then id, name and digest."""
    place = [F.col("place").asc_nulls_last()] if "place" in archive.columns else []
    return scratch.keep(ranked(scratch, digested(archive), *place, F.col("id").asc_nulls_first(), "name", "sha", "length").drop("place"))


def copies(records: DataFrame) -> DataFrame:
    """(name, sha, id, head, length, n): how often each record is there; a sound archive has one of a name."""
    return records.groupBy("name", "sha").agg(F.min("id").alias("id"), F.min("head").alias("head"), F.min("length").alias("length"), F.count("*").alias("n"))


def numbered(scratch: Scratch, rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """``rows`` with ``nth`` 0, 1, 2, ... among those of equal keys."""
    rows = scratch.keep(ranked(scratch, rows, *keys, *order))
    # Stored before the join, so that a name many records share can be split.
    first = scratch.keep(rows.groupBy(*keys).agg(F.min("rank").alias("first")))
    return rows.join(first, keys).withColumn("nth", F.col("rank") - F.col("first")).drop("rank", "first")


def unlike(scratch: Scratch, ours: DataFrame, mine: DataFrame, theirs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rank, kind) of the records without an equal one in the replica, and (id, sha, length) of what only that has.

    ``ours``: the listing, ``mine`` and ``theirs``: copies. Equal records are
    matched first, as many as both sides have. Of what is left of a name, records
    of one head and length are paired, then of one head, then any, by length.
    Records that find no partner are missing.
    """
    counted = mine.select("name", "sha", F.col("n").alias("own")).join(theirs, ["name", "sha"], "full")
    counted = scratch.keep(counted.fillna(0, ["own", "n"]).filter("own != n"))
    fewer = counted.filter("own > n").select("name", "sha", "n")
    left = numbered(scratch, ours.withColumnRenamed("rank", "at").join(fewer, ["name", "sha"]), ["name", "sha"], "at").filter("nth >= n")
    left = scratch.keep(left.select("at", "name", "head", "sha", "length"))
    others = repeated(counted.filter("n > own").withColumn("more", F.col("n") - F.col("own")), "more")
    others = scratch.keep(others.select("id", "name", "head", "sha", "length"))
    found = []
    for keys in (["name", "head", "length"], ["name", "head"], ["name"]):
        if left.isEmpty() or others.isEmpty():
            break
        a, b = numbered(scratch, left, keys, "length", "sha", "at"), numbered(scratch, others, keys, "length", "sha")
        b = b.select(*(F.col(c).alias(f"their_{c}") for c in b.columns))
        same = [F.col(c) == F.col(f"their_{c}") for c in [*keys, "nth"]]
        both = scratch.keep(a.join(b, same, "full"))
        kind = F.when(F.col("their_length") < F.col("length"), "truncated").otherwise("altered")
        found.append(both.filter("at is not null and their_sha is not null").select(F.col("at").alias("rank"), kind.alias("kind")))
        left = both.filter("their_sha is null").select(left.columns)
        others = both.filter("at is null").select(*(F.col(f"their_{c}").alias(c) for c in others.columns))
    lost = left.select(F.col("at").alias("rank"), F.lit("missing").alias("kind"))
    return reduce(DataFrame.union, found, lost), others.select("id", "sha", "length")


def ranges(ours: DataFrame, theirs: DataFrame, fanout: int) -> tuple[DataFrame, DataFrame, int]:
    """Both listings with ``node`` (the range of ids) and ``part`` (of a range with many records), and the levels above the leaves.

    Integer ids are cut into runs of ``fanout``; other ids stand in the order of
    their hash; records without an id are the range before all others.
    """
    kind = dict(ours.dtypes)["id"]
    number = F.col("id").cast("long") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64("id")
    sides = [side.withColumn("node", F.floor(number / fanout).cast("long")) for side in (ours, theirs)]
    low, high = sides[0].select("node").union(sides[1].select("node")).agg(F.min("node"), F.max("node")).first()
    low, high = (low, high) if low is not None else (0, 0)
    nothing, levels = low - 1, 0
    found = []
    for side in sides:
        side = side.fillna(nothing, ["node"])
        large = side.groupBy("node").agg(F.count("*").alias("n"), F.min("rank").alias("first")).filter(F.col("n") > _LEAF_RECORDS).drop("n")
        part = F.coalesce(F.floor((F.col("rank") - F.col("first")) / _LEAF_RECORDS), F.lit(0).cast("long"))
        found.append(side.join(measured(large), "node", "left").withColumn("part", part).drop("first"))
    low = nothing
    while low != high and (low, high) != (-1, 0):  # those two never meet: they are compared as two roots
        low, high, levels = low // fanout, high // fanout, levels + 1
    return found[0], found[1], levels


def tree(scratch: Scratch, placed: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """Levels (node, part, begin, hash) from the leaves up; above them ``part`` is 0. Empty ranges have no node.

    A leaf has ``_LEAF_RECORDS`` records at most, a node ``fanout`` children, or
    as many as the runs of a large range.
    """
    said = F.struct("rank", F.concat_ws(":", "name", "sha", "length").alias("said"))
    leaves = placed.groupBy("node", "part").agg(F.min("rank").alias("begin"), F.sort_array(F.collect_list(said)).alias("held"))
    lines = F.transform("held", lambda x: F.concat_ws("@", x["said"], x["rank"] - F.col("begin")))
    level = scratch.keep(leaves.select("node", "part", "begin", F.sha2(F.array_join(lines, "\n"), 256).alias("hash")))
    found = [level]
    for _ in range(levels):
        # Where a child begins depends on those before it; its place among them is what counts.
        child = F.struct("begin", F.concat_ws(":", "node", "part", "hash").alias("said"))
        up = level.withColumn("child", child).groupBy(F.floor(F.col("node") / fanout).alias("up"))
        up = up.agg(F.min("begin").alias("begin"), F.sha2(F.array_join(F.sort_array(F.collect_list("child"))["said"], "\n"), 256).alias("hash"))
        level = scratch.keep(up.select(F.col("up").alias("node"), F.lit(0).cast("long").alias("part"), "begin", "hash"))
        found.append(level)
    return found


def differing(scratch: Scratch, one: list[DataFrame], other: list[DataFrame], fanout: int) -> tuple[DataFrame, list[tuple[int, DataFrame]]] | None:
    """None if the roots agree; else the leaves (node, part) that differ, and (level, nodes) that were moved whole.

    Between two levels only nodes that differ are kept. Of a node's children with
    equal digests, those at another place among the children both sides have
    were moved.
    """
    frontier, moved = None, []
    keys = ["node", "part"]

    def below(level: DataFrame) -> DataFrame:
        level = level.withColumn("parent", F.floor(F.col("node") / fanout))
        return level if frontier is None else level.join(frontier, "parent", "left_semi")

    for level, (a, b) in reversed(list(enumerate(zip(one, other, strict=True)))):
        pairs = below(a).join(below(b).select(*keys, F.col("begin").alias("their_begin"), F.col("hash").alias("their_hash")), keys, "full")
        pairs = pairs.withColumn("parent", F.floor(F.col("node") / fanout))
        both = Window.partitionBy("parent", F.col("hash").isNotNull() & F.col("their_hash").isNotNull())
        pairs = pairs.withColumn("place", F.row_number().over(both.orderBy("begin", *keys))).withColumn("their_place", F.row_number().over(both.orderBy("their_begin", *keys)))
        same = F.col("hash").eqNullSafe(F.col("their_hash"))
        pairs = scratch.keep(pairs.select(*keys, same.alias("same"), (F.col("place") != F.col("their_place")).alias("away")).filter("not same or away"))
        n = pairs.agg(F.count_if(~F.col("same")).alias("differ"), F.count_if("same").alias("moved")).first()
        if n["moved"]:
            moved.append((level, pairs.filter("same").select(*keys)))
        if not n["differ"] and frontier is None:
            return None
        found = pairs.filter("not same").select(*keys)
        frontier = found.select(F.col("node").alias("parent")).distinct()
    return found, moved


def audit(archive: DataFrame, replica: DataFrame, fanout: int = 64, file_records: int = 1000) -> DataFrame:
    """(id, file, start, length, sha, status): every record of the archive, and what only the replica has.

    ``archive`` and ``replica``: (id, name, record), and ``place`` where a side
    has an order of its own; else it is that of the ids. Records are filed
    ``file_records`` at a time; ``start`` is the offset in the file. ``status``
    is intact, moved (the same bytes at another place among those both have),
    missing, truncated (shorter), altered, or extra (file and start are null
    then). Records that share a name are told apart by digest, URL and length, so
    one lost or altered does not shift the others. Null ids are ids like others;
    equal records are as many as they are. Either side may be empty; a record is
    read whole where it is hashed and goes nowhere after that.
    """
    scratch = Scratch(archive.sparkSession)
    listed = listing(scratch, archive)
    ours, theirs, levels = ranges(listed, listing(scratch, replica), fanout)
    damaged = differing(scratch, tree(scratch, ours, fanout, levels), tree(scratch, theirs, fanout, levels), fanout)

    placed = running(listed, "length", "offset").withColumn("file", F.floor(F.col("rank") / file_records))
    begin = placed.groupBy("file").agg(F.min("offset").alias("begin"))
    placed = placed.join(begin, "file").withColumn("start", F.col("offset") - F.col("begin"))
    if damaged is None:
        return placed.select("id", "file", "start", "length", "sha", F.lit("intact").alias("status"))
    leaves, moved = damaged
    inside = [scratch.keep(side.join(leaves, ["node", "part"], "left_semi")) for side in (ours, theirs)]
    changed, extra = unlike(scratch, inside[0].drop("node", "part"), copies(inside[0]), copies(inside[1]))
    changed = scratch.keep(changed)

    # Of equal records in a leaf that differs: their places among those both sides have.
    equal, leaf = ["node", "part", "name", "sha"], Window.partitionBy("node", "part")
    nth = F.row_number().over(Window.partitionBy(*equal).orderBy("rank"))
    mine = inside[0].join(changed, "rank", "left_anti").select(*equal, nth.alias("nth"), F.col("rank").alias("at"))
    other = inside[1].select(*equal, nth.alias("nth"), F.col("rank").alias("their_at"))
    both = mine.join(other, [*equal, "nth"])
    both = both.withColumn("place", F.row_number().over(leaf.orderBy("at"))).withColumn("their_place", F.row_number().over(leaf.orderBy("their_at")))
    kinds = changed.union(both.filter("place != their_place").select(F.col("at").alias("rank"), F.lit("moved").alias("kind")))
    for level, nodes in moved:
        up = ours.withColumn("node", F.floor(F.col("node") / fanout**level).cast("long")) if level else ours
        whole = up.join(nodes, ["node"] if level else ["node", "part"], "left_semi")
        kinds = kinds.union(whole.select("rank", F.lit("moved").alias("kind")))
    kinds = scratch.keep(kinds.groupBy("rank").agg(F.min("kind").alias("kind")))
    placed = placed.join(kinds, "rank", "left").withColumn("status", F.coalesce("kind", F.lit("intact")))
    nothing = F.lit(None).cast("long")
    extra = extra.select("id", nothing.alias("file"), nothing.alias("start"), "length", "sha", F.lit("extra").alias("status"))
    return placed.select("id", "file", "start", "length", "sha", "status").union(extra)
