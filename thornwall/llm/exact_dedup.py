"""Exact duplicates by deterministic block naming.

White space is normalised, the text cut into blocks of a fixed number of bytes.
Distinct blocks are sorted and numbered: the number is the block's name. Then
adjacent names are paired, distinct pairs sorted and numbered, and so on: each
round halves the sequences, until every document is down to one name. Equal
names in one round mean equal texts and different names different ones: no step
trusts a hash.

Blocks are sorted by (XXH64, content). Most hashes belong to one block, which is
checked by counting the distinct blocks of each; then the hash stands for the
block from there on, and texts are shuffled once only (after equal blocks of a
task are merged). Blocks whose hash belongs to several are told apart by content.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import SPACE, Scratch, named, ranked, repeated


def normalised(text_col: str) -> Column:
    """Runs of ASCII white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(named(text_col), F.lit("")), f"{SPACE}+", " ")


def _blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int, hash_bits: int) -> DataFrame:
    """(id, sha, n, at, block, h): the text's n blocks."""
    texts = docs.select(named(id_col).alias("id"), normalised(text_col).cast("binary").alias("text"))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / block_bytes)).cast("long")
    texts = texts.select("id", F.sha2("text", 256).alias("sha"), count.alias("n"), "text")
    blocks = texts.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    blocks = blocks.withColumn("block", F.col("text").substr((F.col("at") * block_bytes + 1).cast("int"), F.lit(block_bytes)))
    h = F.xxhash64("block")
    return blocks.select("id", "sha", "n", "at", "block", (h if hash_bits == 64 else F.pmod(h, F.lit(1 << hash_bits))).alias("h"))


def _block_names(scratch: Scratch, blocks: DataFrame) -> DataFrame:
    """(id, sha, n, at, name, rows): the first round; ``rows`` counts repeated rows."""
    hashes = scratch.keep(blocks.select("h", "block").distinct().groupBy("h").agg(F.count("*").alias("blocks")))
    shared = hashes.filter("blocks > 1").select("h")
    if shared.isEmpty():
        occurrences = blocks.withColumn("tie", F.lit(1).cast("long"))
    else:
        tied = blocks.select("h", "block").join(shared, "h", "left_semi").distinct()
        tied = tied.withColumn("tie", F.row_number().over(Window.partitionBy("h").orderBy("block")).cast("long"))
        occurrences = blocks.join(tied, ["h", "block"], "left").withColumn("tie", F.coalesce("tie", F.lit(1).cast("long")))
    occurrences = scratch.keep(occurrences.groupBy("id", "sha", "n", "at", "h", "tie").agg(F.count("*").alias("rows")))
    distinct = hashes.select("h", F.explode(F.sequence(F.lit(1).cast("long"), "blocks")).alias("tie"))
    names = ranked(scratch, distinct, "h", "tie").withColumnRenamed("rank", "name")
    return scratch.keep(occurrences.join(names, ["h", "tie"]).select("id", "sha", "n", "at", "name", "rows"))


def identities(scratch: Scratch, docs: DataFrame, id_col: str, text_col: str, block_bytes: int, hash_bits: int) -> DataFrame:
    """(id, sha, rows, round, name): (round, name) is the identity of the text."""
    level = _block_names(scratch, _blocks(docs, id_col, text_col, block_bytes, hash_bits))
    done, number = [], 0
    while True:
        done.append(level.filter("n = 1").select("id", "sha", "rows", F.lit(number).alias("round"), "name"))
        rest = level.filter("n > 1")
        if rest.isEmpty():
            break
        # A sequence of odd length ends with a pair whose second name is missing.
        even = F.col("at") % 2 == 0
        pairs = rest.groupBy("id", "sha", "n", "rows", F.floor(F.col("at") / 2).alias("at")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("b")
        )
        pairs = scratch.keep(pairs)
        names = ranked(scratch, pairs.select("a", "b").distinct(), "a", "b").withColumnRenamed("rank", "name")
        level = scratch.keep(pairs.join(names, ["a", "b"]).select("id", "sha", F.ceil(F.col("n") / 2).alias("n"), "at", "name", "rows"))
        number += 1
    found = done[0]
    for part in done[1:]:
        found = found.union(part)
    return found


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 8192, hash_bits: int = 64) -> DataFrame:
    """(id, keep_id, group_size, kept, sha, rows): a row per id and text, ``rows`` saying how often it occurs.

    Null texts count as empty. The smallest id of a group of equal texts stays,
    null ids last; its row here is ``kept``, however often it occurs. ``hash_bits`` below 64 makes hashes meet, for tests.
    """
    scratch = Scratch(docs.sparkSession)
    found = identities(scratch, docs, id_col, text_col, block_bytes, hash_bits)
    groups = found.groupBy("round", "name").agg(F.min("id").alias("keep_id"), F.sum("rows").alias("group_size"))
    groups = scratch.keep(groups)  # a join of two shuffled sides, so that a large group can be split
    return found.join(groups, ["round", "name"]).select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha", "rows")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, keep_id, group_size, kept, sha): as ``exact_groups``, a row per row of ``docs``.

    One row of a group is ``kept``: where the row that stays is repeated, or its
    id null, the first of those.
    """
    groups = exact_groups(docs, id_col, text_col, **options)
    one = F.struct(F.col("kept").alias("stays"), F.lit(1).cast("long").alias("times"))
    rest = F.struct(F.lit(False).alias("stays"), (F.col("rows") - F.when(F.col("kept"), 1).otherwise(0)).alias("times"))
    split = groups.select("id", "keep_id", "group_size", "sha", F.inline(F.when(F.col("kept"), F.array(one, rest)).otherwise(F.array(rest))))
    return repeated(split, "times").select("id", "keep_id", "group_size", F.col("stays").alias("kept"), "sha")
