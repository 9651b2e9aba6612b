"""Benchmark decontamination by a positional inverted index of the training texts.

A posting says that a term stands at a place of a row. Postings are stored by
term, a frequent term's in several parts. A phrase is looked up from its rarest
term: its postings, moved back by the term's offset in the phrase, are the places
where the phrase can begin. The postings of the next rarest term, moved likewise,
are intersected with them, and those of all other terms with what is left.
Proximity is looked up from the rarest term as well, the other terms anywhere
within a number of words. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, measured, named, ranked

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What Spark's lower() would change besides A-Z.
_CASED = r"[\p{IsUppercase}\p{Lt}&&[^\x00-\x7F]]"
_PARTS = 256
_DOCUMENT = 0


def words_of(text: Column) -> Column:
    """A-Z in lower case, ASCII but letters and digits between words; null has none."""
    raw = F.coalesce(text, F.lit(""))
    folded = F.when(raw.rlike(_CASED), F.translate(raw, _UPPER, _LOWER)).otherwise(F.lower(raw))
    return F.regexp_extract_all(folded, F.lit(WORD), F.lit(0))


class Index:
    """``postings``: (term, row, pos), words from 1; ``documents``: (row, id, n_words); ``terms``: (word, term)."""

    def __init__(self, scratch: Scratch, stored: DataFrame, terms: DataFrame):
        self.scratch, self.terms = scratch, terms
        self.postings = stored.filter(F.col("term") != _DOCUMENT).select("term", "row", "pos")
        self.documents = stored.filter(F.col("term") == _DOCUMENT).select("row", "id", "n_words")


def build(scratch: Scratch, docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all rows and whole texts. Repeated rows are rows of their own.

    ``vocabulary``: (word), the terms that will be looked up; other words need no
    postings. A posting of term 0 stands for the row itself.
    """
    terms = vocabulary.select("word").distinct()
    terms = scratch.keep(ranked(scratch, terms, "word").select("word", (F.col("rank") + 1).cast("int").alias("term")))
    known = measured(terms.union(docs.sparkSession.createDataFrame([("", _DOCUMENT)], "word string, term int")))
    rows = docs.select(named(id_col).alias("id"), words_of(named(text_col)).alias("words")).withColumn("row", F.monotonically_increasing_id())
    at = F.posexplode(F.concat(F.array(F.lit("")), F.col("words"))).alias("pos", "word")
    tokens = rows.select("row", "id", F.size("words").alias("n_words"), at).join(known, "word")
    head = F.col("pos") == 0
    tokens = tokens.select("term", "row", "pos", F.when(head, F.col("id")).alias("id"), F.when(head, F.col("n_words")).cast("long").alias("n_words"))
    part = F.pmod(F.xxhash64("row"), F.lit(_PARTS))
    stored = scratch.keep(tokens.repartition("term", part).sortWithinPartitions("term", "row", "pos"))
    return Index(scratch, stored, terms)


class Phrases:
    """``members``: (phrase, offset, term, length, rarity) of the phrases whose terms all occur; rarity from 1.

    ``phrases``: (phrase, words), words an array without nulls, phrase a key.
    """

    def __init__(self, index: Index, phrases: DataFrame):
        counts = index.scratch.keep(index.postings.groupBy("term").agg(F.count("*").alias("n")))
        own = phrases.select("phrase", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
        own = own.join(index.terms, "word").join(counts, "term")
        each = Window.partitionBy("phrase")
        rarity = F.row_number().over(each.orderBy("n", "term", "offset"))
        own = own.withColumn("rarity", rarity).withColumn("found", F.count("*").over(each)).filter("found = length")
        self.members = index.scratch.keep(own.select("phrase", "offset", "term", "length", "rarity"))

    def rarest(self, k: int) -> DataFrame:
        return self.members.filter(F.col("rarity") == k).select("phrase", "offset", "term", "length")


def _of_terms(postings: DataFrame, members: DataFrame) -> DataFrame:
    return postings.join(measured(members.select("term").distinct()), "term", "left_semi")


def exact(index: Index, phrases: Phrases) -> DataFrame:
    """(phrase, row, start, length): every place where a phrase stands, words from 1."""
    scratch, second = index.scratch, phrases.rarest(2)
    begin = (F.col("pos") - F.col("offset")).alias("start")
    # The first word of a row is 1: places before it are none.
    places = index.postings.join(measured(phrases.rarest(1)), "term").select("phrase", "row", begin, "length").filter("start > 0")
    single = places.filter("length = 1")
    both = places.filter("length > 1").join(measured(second.drop("length")), "phrase").withColumn("pos", (F.col("start") + F.col("offset")).cast("int"))
    both = scratch.keep(both.join(_of_terms(index.postings, second), ["term", "row", "pos"]).select("phrase", "row", "start", "length"))

    rest = phrases.members.filter("rarity > 2").select("phrase", "offset", "term")
    near = measured(both.filter("length > 2").select("row").distinct())
    postings = _of_terms(index.postings, rest).join(near, "row", "left_semi")
    wanted = both.join(measured(rest), "phrase").withColumn("pos", (F.col("start") + F.col("offset")).cast("int"))
    whole = wanted.join(postings, ["term", "row", "pos"]).groupBy("phrase", "row", "start", "length").agg(F.count("*").alias("n")).filter("n = length - 2")
    return scratch.keep(single.union(both.filter("length = 2")).union(whole.drop("n")))


def near(index: Index, phrases: Phrases, within: int) -> DataFrame:
    """(phrase, row, at): the places of a phrase's rarest term that have all its other terms at most ``within`` words away, in any order."""
    spread = 2 * within + 1
    places = index.postings.join(measured(phrases.rarest(1)), "term").select("phrase", "row", F.col("pos").alias("at"), F.col("term").alias("own"))
    others = phrases.members.select("phrase", "term").distinct()
    postings = _of_terms(index.postings, others).withColumn("block", F.floor(F.col("pos") / spread))
    wanted = places.join(measured(others), "phrase").filter("term != own")
    blocks = F.array_distinct(F.array(F.floor((F.col("at") - within) / spread), F.floor((F.col("at") + within) / spread)))
    wanted = wanted.withColumn("block", F.explode(blocks))
    found = wanted.join(postings, ["term", "row", "block"]).filter(F.abs(F.col("pos") - F.col("at")) <= within)
    found = found.select("phrase", "row", "at", "term").distinct().groupBy("phrase", "row", "at").agg(F.count("*").alias("n"))
    needed = others.groupBy("phrase").agg((F.count("*") - 1).alias("needed"))
    met = found.join(measured(needed), "phrase").filter("n = needed").select("phrase", "row", "at")
    alone = places.join(measured(needed.filter("needed = 0")), "phrase", "left_semi").select("phrase", "row", "at")
    return met.union(alone)


def windows(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): each run of ``size`` words of an item; a shorter item with words is one window."""
    own = items.select(named(id_col).alias("item"), words_of(named(text_col)).alias("words")).filter("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - size + 1))
    own = own.select("item", "words", F.explode(starts).alias("start"))
    return own.select("item", F.slice("words", F.col("start"), size).alias("words"))


def contaminated(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items): a row per row of ``docs``; which items it holds windows of, and how many of its words they cover.

    Null texts have no words; ``items`` is sorted as strings, items without an
    id count in ``n_hit`` only. Rows of one id are judged each by itself. Empty
    tables on either side give no hits.
    """
    scratch = Scratch(docs.sparkSession)
    pairs = scratch.keep(windows(items, size, item_col, item_text_col).distinct())
    phrases = scratch.keep(pairs.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()))
    index = build(scratch, docs, phrases.select(F.explode("words").alias("word")), id_col, text_col)
    found = exact(index, Phrases(index, phrases))

    covered = found.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
    hits = covered.groupBy("row").agg(F.count("*").alias("n_hit"))
    whose = pairs.join(phrases, "words").select("phrase", F.col("item").cast("string").alias("item")).filter("item is not null").distinct()
    held = found.select("row", "phrase").distinct().join(whose, "phrase").groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))
    result = index.documents.join(hits, "row", "left").join(held, "row", "left")
    none = F.array().cast("array<string>")
    return result.select("id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))
