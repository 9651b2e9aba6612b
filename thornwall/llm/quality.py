"""Quality rules as a short-circuit cascade.

A rule rejects a document by a few features of its text. On a bounded sample
every rule is tried: how often it rejects. What its features cost is not measured
but declared: the characters and words of the sample times a time per unit that
stands in the code (a feature that declares none counts as free). Rules are then ordered by
rejections per cost; a feature that an earlier rule has computed is free, and
only what earlier rules leave counts as rejected. In the cascade a feature is
computed for documents that are still alive, and never for the others. The
order changes the cost alone: a document stays if no rule rejects it.
DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thornwall.llm.common import SPACE, SPACES, fresh, named

Columns = dict[str, Column]


@dataclass(frozen=True)
class Feature:
    """``cost``, declared: nanoseconds a character, a word, and a word and comparison of a sort; without it, a feature counts as free."""

    build: Callable[[Columns], Column]
    needs: tuple[str, ...] = ()
    cost: tuple[float, float, float] = (0.0, 0.0, 0.0)


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Columns], Column]


def _words(c: Columns) -> Column:
    trimmed = F.trim(c["text"], F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{SPACE}+"))


def _windows(c: Columns) -> Column:
    """(hash, start) of each three-word window, in this order."""
    at = lambda i, k: F.get(c["words"], i + k)
    window = lambda i: F.struct(F.xxhash64(at(i, 0), at(i, 1), at(i, 2)).alias("h"), i.alias("i"))
    return F.when(c["n_words"] >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), (c["n_words"] - 3).cast("int")), window)))


def _repeat_words(c: Columns) -> Column:
    """Words that lie in a window found more than once: in sorted windows, equal hashes are neighbours."""
    s = c["windows"]
    twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
    places = F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))
    return F.coalesce(F.size(F.array_distinct(places)).cast("long"), F.lit(0).cast("long"))


FEATURES: dict[str, Feature] = {
    "words": Feature(_words, (), (25, 60, 0)),
    "n_words": Feature(lambda c: F.size(c["words"]).cast("long"), ("words",)),
    "word_chars": Feature(lambda c: F.length(F.concat_ws("", c["words"])).cast("long"), ("words",), (1, 5, 0)),
    "n_symbols": Feature(lambda c: F.regexp_count(c["text"], F.lit("[#*$%&|<>]")).cast("long"), (), (10, 0, 0)),
    "n_exclaims": Feature(lambda c: (F.length(c["text"]) - F.length(F.replace(c["text"], F.lit("!"), F.lit("")))).cast("long"), (), (3, 0, 0)),
    "lines": Feature(lambda c: F.filter(F.split(c["text"], "\n"), lambda x: F.length(F.trim(x, F.lit(SPACES))) > 0), (), (5, 0, 0)),
    "n_lines": Feature(lambda c: F.size(c["lines"]).cast("long"), ("lines",)),
    "n_dup_lines": Feature(lambda c: (F.size(c["lines"]) - F.size(F.array_distinct(c["lines"]))).cast("long"), ("lines",), (2, 0, 0)),
    "windows": Feature(_windows, ("words", "n_words"), (0, 250, 60)),
    "n_repeat_words": Feature(_repeat_words, ("windows",), (0, 200, 0)),
}

#: The two rules every caller needs, then those of this module: symbols per word, repeated lines, word length, shouting.
BASE = (
    Rule("few_words", ("n_words",), lambda c: c["n_words"] < 50),
    Rule("repeated_words", ("n_words", "n_repeat_words"), lambda c: 100 * c["n_repeat_words"] > 50 * c["n_words"]),
)
RULES = BASE + (
    Rule("symbols", ("n_words", "n_symbols"), lambda c: 10 * c["n_symbols"] > c["n_words"]),
    Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda c: 2 * c["n_dup_lines"] > c["n_lines"]),
    Rule("word_length", ("n_words", "word_chars"), lambda c: (c["word_chars"] < 3 * c["n_words"]) | (c["word_chars"] > 10 * c["n_words"])),
    Rule("exclaims", ("n_words", "n_exclaims"), lambda c: 2 * c["n_exclaims"] > c["n_words"]),
)


@dataclass(frozen=True)
class Step:
    """``cost``: estimated nanoseconds a document; ``rejects``: share of the documents that earlier steps leave."""

    rule: Rule
    cost: float
    rejects: float


def _needed(names: Sequence[str], have: set[str]) -> list[str]:
    """The features to compute, in order of dependence."""
    found: list[str] = []
    for name in names:
        if name not in have and name not in found:
            found += [x for x in _needed(FEATURES[name].needs, have | set(found)) if x not in found]
            found.append(name)
    return found


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text", sample_rows: int = 2000, seed: int = 7) -> list[Step]:
    """The rules in the order of the cascade. About ``sample_rows`` rows are looked at, whole texts of each.

    What comes to the driver is a row per combination of verdicts: at most
    2^rules. Without rows, the rules keep their order.
    """
    rules = list(rules)
    total = docs.count()
    sample = docs.sample(min(1.0, sample_rows / total), seed) if total else docs
    all_features = [n for r in rules for n in r.needs]
    tried, cols = _with_features(sample, text_col, all_features, F.lit(True), {})
    verdict = sum((F.when(r.rejects(cols), F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(rules)), F.lit(0))
    chars = F.length(F.coalesce(named(text_col), F.lit("")))
    words = cols["n_words"] if "n_words" in cols else chars / 6
    seen = tried.select(verdict.alias("v"), chars.alias("c"), words.alias("w"), (words * F.log2(words + 2)).alias("s"))
    seen = seen.groupBy("v").agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.sum("w").alias("w"), F.sum("s").alias("s")).collect()

    n = max(1, sum(r["n"] for r in seen))
    units = [sum(r[k] for r in seen) / n for k in "cws"]
    left, have, steps, bits = {r["v"]: r["n"] for r in seen}, set(), [], {r.name: 1 << k for k, r in enumerate(rules)}
    while rules:
        alive = max(1, sum(left.values()))

        def score(rule: Rule) -> tuple[float, float, float]:
            cost = 1 + sum(a * b for f in _needed(rule.needs, have) for a, b in zip(FEATURES[f].cost, units, strict=True))
            share = sum(c for v, c in left.items() if v & bits[rule.name]) / alive
            return share / cost, cost, share

        best = max(rules, key=lambda r: (score(r)[0], -score(r)[1]))
        _, cost, share = score(best)
        steps.append(Step(best, cost, share))
        have |= set(_needed(best.needs, have))
        left = {v: c for v, c in left.items() if not v & bits[best.name]}
        rules.remove(best)
    return steps


def _with_features(df: DataFrame, text_col: str, names: Sequence[str], when: Column, cols: Columns) -> tuple[DataFrame, Columns]:
    """``df`` with columns for the features, where the condition holds; null text counts as empty."""
    cols = dict(cols)
    for name in _needed(names, set(cols)):
        (own,) = fresh(df, f"_{name}")
        value = FEATURES[name].build(cols | {"text": F.coalesce(named(text_col), F.lit(""))})
        df = df.withColumn(own, F.when(when, value))
        cols[name] = named(own)
    return df, cols


def cascade(docs: DataFrame, steps: Sequence[Step], text_col: str = "text", features: Sequence[str] = ()) -> tuple[DataFrame, Columns]:
    """``docs`` with columns of fresh names, and what they hold: ``kept``, ``rejected_by``, and features.

    ``features`` are computed for all documents, others as long as a document is alive.
    """
    df, cols = _with_features(docs, text_col, features, F.lit(True), {})
    alive, by = F.lit(True), F.lit(None).cast("string")
    for step in steps:
        df, cols = _with_features(df, text_col, step.rule.needs, alive, cols)
        (flag,) = fresh(df, "_alive")
        rejects = F.coalesce(step.rule.rejects(cols), F.lit(False))
        by = F.when(alive & rejects, F.lit(step.rule.name)).otherwise(by)
        df = df.withColumn(flag, F.when(alive, ~rejects).otherwise(F.lit(False)))
        (why,) = fresh(df, "_rejected_by")
        df = df.withColumn(why, by)
        alive, by = named(flag), named(why)
    # The verdict depends on a row number, or the optimizer would push filters on it below the features and repeat them there.
    (row,) = fresh(df, "_row")
    df = df.withColumn(row, F.monotonically_increasing_id())
    return df, cols | {"kept": F.when(named(row) >= 0, alive), "rejected_by": F.when(named(row) >= 0, by)}


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES, features: Sequence[str] = (), sample_rows: int = 2000) -> DataFrame:
    """(id, features..., kept, rejected_by): a row per row of ``docs``, ``rejected_by`` naming the first rule of the cascade.

    Null and empty texts have no words. Rows are judged one by one, so repeated
    rows and null ids are as good as any.
    """
    df, cols = cascade(docs, plan(docs, rules, text_col, sample_rows), text_col, features)
    return df.select(named(id_col).alias("id"), *(cols[f].alias(f) for f in features), cols["kept"].alias("kept"), cols["rejected_by"].alias("rejected_by"))


def keep_good(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows that no rule rejects, with the columns they came with."""
    df, cols = cascade(docs, plan(docs, rules, text_col, sample_rows), text_col)
    return df.filter(cols["kept"]).select(*map(named, docs.columns))
