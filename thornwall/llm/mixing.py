"""Mixing sources to target weights by hash-threshold histograms.

Every document has a hash, every source a budget of tokens. Tokens are summed by
source and range of hashes; the range in which a source's budget runs out is
split into finer ones, level by level, until it holds a single hash. That is the
source's threshold: documents up to it are taken. Nothing is sorted or ranked,
and a larger budget always takes what a smaller one takes and more.

A budget above the source's tokens takes whole rounds of it first, and a
threshold for the rest. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import WORD, Scratch, named, ranked, repeated

_BITS, _LEVEL = 60, 12


def words(text_col: str) -> Column:
    return F.regexp_count(F.coalesce(named(text_col), F.lit("")), F.lit(WORD)).cast("long")


def place(id_col: str, text_col: str) -> Column:
    """60 bits from id and text: equal in every run, whatever the partitions."""
    text = F.md5(F.coalesce(named(text_col), F.lit("")))
    digest = F.md5(F.concat(F.coalesce(named(id_col).cast("string"), F.lit("null")), F.lit("|"), text))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def targets(scratch: Scratch, rows: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """(source, source_size, target): weights go round in the order of the sources, null last.

    A source's target stops at ``repeats`` times its size; what it leaves is
    shared by weight among the others, until none is above. Only sums come to
    the driver.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sizes = ranked(scratch, sizes, F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sizes = scratch.keep(sizes.select("source", "rank", "source_size", weight.alias("weight"), (F.col("source_size") * repeats).alias("cap")))
    budget = (sizes.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * share
    rest, open_weight, closed = budget, None, -1
    capped = F.lit(False)
    while True:
        sums = sizes.agg(
            F.count(F.when(capped, 1)).alias("n"), F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("cap"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if sums["n"] == closed:
            break
        closed, rest, open_weight = sums["n"], budget - sums["cap"], sums["weight"]
        if not open_weight:
            break
        capped = F.col("cap") * F.lit(float(open_weight)) < F.lit(float(rest)) * F.col("weight")
    fair = F.lit(float(rest)) * F.col("weight") / F.lit(float(open_weight or 1))
    return sizes.select("source", "rank", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(fair).alias("target"))


def thresholds(scratch: Scratch, rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold, some): hashes below it are within the source's budget, and ``some`` rows of it; null: all.

    ``rows``: (source, h, size), ``budgets``: (source, rank, rest). Of the rows of
    the threshold, equal ones as a rule, as many are taken as come nearest to the
    budget.
    """
    state = budgets.select("source", "rank", "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("base"))
    found = []
    for shift in range(_BITS - _LEVEL, -1, -_LEVEL):
        of = state.withColumnRenamed("source", "s")
        inside = rows.join(of, rows["source"].eqNullSafe(of["s"]) & (F.shiftright("h", shift + _LEVEL) == F.col("prefix")))
        sums = inside.groupBy("rank", F.shiftright("h", shift).alias("bucket")).agg(
            F.first("rest").alias("rest"), F.first("base").alias("base"), F.sum("size").alias("size"), F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")
        )
        upto = F.sum("size").over(Window.partitionBy("rank").orderBy("bucket")) + F.col("base")
        sums = sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("size"))
        edge = scratch.keep(sums.filter("before <= rest and upto > rest"))
        some = F.floor((F.col("rest") - F.col("before")) * F.col("n") / F.col("size") + 0.5)
        found.append(edge.filter("low = high").select("rank", F.col("low").alias("threshold"), some.cast("long").alias("some")))
        open_ = edge.filter("low < high")
        if open_.isEmpty():
            break
        state = budgets.join(open_.select("rank", F.col("bucket").alias("prefix"), F.col("before").alias("base")), "rank").select("source", "rank", "rest", "prefix", "base")
    limits = found[0]
    for part in found[1:]:
        limits = limits.union(part)
    return budgets.select("source", "rank").join(limits, "rank", "left").select("source", "threshold", "some")


def _planned(scratch: Scratch, docs: DataFrame, id_col: str, source_col: str, text_col: str, weights: Sequence[int], share: float, repeats: int) -> tuple[DataFrame, DataFrame]:
    """(id, source, h, size), and (source, rank, source_size, target, rounds, threshold, some)."""
    rows = docs.select(named(id_col).alias("id"), named(source_col).cast("string").alias("source"), place(id_col, text_col).alias("h"), words(text_col).alias("size"))
    rows = scratch.keep(rows)
    goals = scratch.keep(targets(scratch, rows, weights, share, repeats))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("rounds", rounds).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    limits = thresholds(scratch, rows.select("source", "h", "size"), goals.select("source", "rank", "rest")).withColumnRenamed("source", "s")
    goals = goals.join(limits, goals["source"].eqNullSafe(limits["s"])).select("source", "rank", "source_size", "target", "rounds", "threshold", "some")
    return rows, scratch.keep(goals)


def _taken(scratch: Scratch, df: DataFrame, goals: DataFrame, source: Column, h: Column) -> DataFrame:
    """(row, source_size, target, copies): how often each row of ``df``, a struct here, is taken.

    Rows at a threshold, as many as repeated rows may be, are numbered by a
    distributed sort; all others need no more than the goals.
    """
    hashed = [named(c) for c, kind in df.dtypes if not any(k in kind for k in ("map<", "variant"))]
    rows = df.select(F.struct(*map(named, df.columns)).alias("row"), source.alias("of"), h.alias("h"), F.xxhash64(*hashed).alias("key"))
    joined = rows.join(goals, rows["of"].eqNullSafe(goals["source"]))
    at = F.coalesce(F.col("h") == F.col("threshold"), F.lit(False))
    below = F.when(F.col("threshold").isNull() | (F.col("h") < F.col("threshold")), 1).otherwise(0)
    plain = joined.filter(~at).select("row", "source_size", "target", (F.col("rounds") + below).alias("copies"))
    edge = joined.filter(at).select("row", F.col("rank").alias("number"), "source_size", "target", "rounds", "some", "key")
    edge = scratch.keep(ranked(scratch, edge, "number", "key"))
    first = scratch.keep(edge.groupBy("number").agg(F.min("rank").alias("first")))
    some = F.when(F.col("rank") - F.col("first") < F.col("some"), 1).otherwise(0)
    return plain.union(edge.join(first, "number").select("row", "source_size", "target", (F.col("rounds") + some).alias("copies")))


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[int] = (1, 2, 3), share: float = 1, repeats: int = 3) -> DataFrame:
    """(id, source, size, source_size, target, copies): how often the mix takes each row of ``docs``.

    Sizes are words; null texts have none. A null source is a source like others,
    the last. A source without words has nothing to take: its rows count once.
    Of equal rows at a threshold as many are taken as the budget has room for.
    """
    scratch = Scratch(docs.sparkSession)
    rows, goals = _planned(scratch, docs, id_col, source_col, text_col, weights, share, repeats)
    taken = _taken(scratch, rows, goals, rows["source"], rows["h"])
    return taken.select("row.id", "row.source", "row.size", "source_size", "target", "copies")


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: Sequence[int] = (1, 2, 3), share: float = 1, repeats: int = 3) -> DataFrame:
    """The mix itself: rows of ``docs`` with all their columns, each as often as it is taken."""
    scratch = Scratch(docs.sparkSession)
    _, goals = _planned(scratch, docs, id_col, source_col, text_col, weights, share, repeats)
    taken = _taken(scratch, docs, goals, named(source_col).cast("string"), place(id_col, text_col))
    return repeated(taken.select("row", "copies"), "copies").select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
