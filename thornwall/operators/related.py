"""CVEs related to an alert by what they say: an inverted index of description terms, the best k per alert.

A term weighs as many CVEs as there are for each one that has it, so a rare term
weighs much and one that all have weighs 1. Texts with the same terms are one,
on either side, and of CVEs with the same terms only the k smallest ids can be
among the best. The postings of an alert's rarest term give first candidates and
with them a score to beat. A CVE that has none of an alert's rarer terms cannot
score more than the sum of the others: frequent terms whose sum is below that
score need not be looked up. What is left out has no chance, so results are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def terms(text: Column) -> Column:
    """The distinct words of a text in lower case, sorted; null has none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.array_sort(F.array_distinct(words))


class TermIndex:
    """``members``: (class, cve_id), the k smallest ids of each set of terms; ``postings``: (term, class); ``weights``: (term, weight)."""

    def __init__(self, cves: DataFrame, k: int, text: str = "description_en"):
        said = cves.where("cve_id is not null").select("cve_id", terms(F.col(text)).alias("terms"))
        total = said.count()
        known = said.where(F.size("terms") > 0)
        name = F.sha2(F.array_join("terms", " "), 256)
        place = F.row_number().over(Window.partitionBy("class").orderBy("cve_id"))
        self.k = k
        self.members = known.select(name.alias("class"), "cve_id").withColumn("place", place).where(F.col("place") <= k).drop("place")
        classes = known.groupBy(name.alias("class"), "terms").agg(F.count(F.lit(1)).alias("n"))
        self.postings = classes.select("class", "n", F.explode("terms").alias("term"))
        frequency = self.postings.groupBy("term").agg(F.sum("n").alias("cves"))
        self.weights = frequency.select("term", F.call_function("div", F.lit(total), F.col("cves")).alias("weight"))


def _best(index: TermIndex, asked: DataFrame, lookups: DataFrame) -> DataFrame:
    """(query, cve_id, score, place): the best k of the classes that a query's looked-up terms lead to, by all its terms."""
    met = lookups.join(index.postings, "term").select("query", "class").distinct()
    scored = met.join(index.postings, "class").join(asked, ["query", "term"]).groupBy("query", "class").agg(F.sum("weight").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cve_id"))
    return scored.join(index.members, "class").select("query", "cve_id", "score").withColumn("place", place).where(F.col("place") <= index.k)


def related(alerts: DataFrame, index: TermIndex, text: Column, key: str = "alert_id") -> DataFrame:
    """(key, cve_id, score, place): of each alert the k CVEs whose descriptions share most weight with its text.

    Ties go to the smaller id. An alert without words, or with none that a
    description has, has no rows; repeated alerts have theirs each time.
    """
    wanted = alerts.select(key, terms(text).alias("terms")).withColumn("query", F.sha2(F.array_join("terms", " "), 256))
    asked = wanted.select("query", "terms").distinct().select("query", F.explode("terms").alias("term")).join(index.weights, "term")
    rarest = Window.partitionBy("query").orderBy(F.desc("weight"), "term")
    behind = F.sum("weight").over(rarest.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    asked = asked.withColumn("rarity", F.row_number().over(rarest)).withColumn("behind", behind)
    first = _best(index, asked, asked.where("rarity = 1"))
    beat = first.groupBy("query").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
    beat = beat.select("query", F.when(F.col("n") >= index.k, F.col("score")).otherwise(0).alias("beat"))
    lookups = asked.join(beat, "query").where("behind >= beat").select("query", "term")
    return wanted.select(key, "query").join(_best(index, asked, lookups), "query").drop("query")
