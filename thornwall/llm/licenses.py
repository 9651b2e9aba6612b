"""Licence scans: identifier tags and notice phrases by Aho-Corasick, licence expressions by shunting-yard.

A text is reduced to lower-case words with one space around each, so that a
phrase is a plain substring and all phrases are found in one pass. After an
identifier tag stands an expression of licences, AND, OR, WITH and brackets; it
is parsed with an operator stack and evaluated against a set of licences that
are permitted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from thornwall.llm.common import named, small_batches

#: Phrases any caller may rely on.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Phrase: label, and how sure the phrase makes it that the text names its licence.
NOTICES = {
    "cc by": ("cc-by", 0.7),
    "general public license": ("gpl", 0.8),
    "all rights reserved": ("reserved", 0.6),
    "cc by nc": ("cc-by-nc", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc by sa": ("cc-by-sa", 0.8),
    "creative commons attribution": ("cc-by", 0.7),
    "mit license": ("mit", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.9),
    "apache license": ("apache", 0.8),
    "apache license version 2 0": ("apache-2.0", 0.9),
    "bsd license": ("bsd", 0.8),
    "redistribution and use in source and binary forms": ("bsd", 0.9),
    "mozilla public license": ("mpl", 0.8),
    "lesser general public license": ("lgpl", 0.8),
    "affero general public license": ("agpl", 0.8),
    "gnu general public license version 3": ("gpl-3.0", 0.9),
    "released into the public domain": ("public-domain", 0.8),
}
TAG = "spdx license identifier"
PERMITTED = frozenset(["mit", "apache-2.0", "bsd-2-clause", "bsd-3-clause", "isc", "unlicense", "cc0-1.0", "cc-by-4.0", "zlib"])

_TABLE = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256))
_TAG = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_TOKEN = re.compile(r"[ \t]*([()]|[A-Za-z0-9.+:-]+)", re.ASCII)
_POWER = {"or": 1, "and": 2, "with": 3}


def normal(text: str | None) -> str:
    """The words, each between single spaces: a phrase with a space at both ends is found where its words stand."""
    words = (text or "").encode().translate(_TABLE).split()
    return " " + b" ".join(words).decode() + " " if words else " "


def parse(line: str) -> list[str] | None:
    """The longest expression the line starts with, in postfix order, or None."""
    out: list[str] = []
    stack: list[str] = []
    best: list[str] | None = None
    operand_next, depth = True, 0
    at = 0
    while match := _TOKEN.match(line, at):
        at, token = match.end(), match[1].lower()
        if token == "(":
            if not operand_next:
                break
            stack.append(token)
            depth += 1
            continue
        if token == ")":
            if operand_next or not depth:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif token in _POWER:
            if operand_next:
                break
            while stack and stack[-1] != "(" and _POWER[stack[-1]] >= _POWER[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
            continue
        else:
            if not operand_next:
                break
            out.append(token)
            operand_next = False
        if not depth and not operand_next:
            best = out + stack[::-1]
    return best


def evaluate(postfix: list[str], permitted: frozenset[str] = PERMITTED) -> bool:
    """Whether the text may be used: AND needs both sides, OR one; an exception (WITH) needs its own entry or the licence's."""
    stack: list[tuple[str, bool]] = []
    for token in postfix:
        if token in _POWER:
            (b, b_ok), (a, a_ok) = stack.pop(), stack.pop()
            both = f"{a} {token} {b}"
            stack.append((both, a_ok and b_ok if token == "and" else a_ok or b_ok if token == "or" else a_ok or both in permitted))
        else:
            stack.append((token, token in permitted))
    return stack[-1][1]


def automaton(phrases) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in phrases:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan_text(text: str | None, phrases: ahocorasick.Automaton, permitted: frozenset[str] = PERMITTED) -> dict:
    words = normal(text)
    hits, at, word, tagged = [], 0, 0, False
    for end, phrase in phrases.iter(words):
        start = end - len(phrase) - 1
        # Longer phrases are reported first, shorter ones start later: the count may have to go back.
        word += words.count(" ", at, start) if start >= at else -words.count(" ", start, at)
        at = start
        if phrase == TAG:
            tagged = True
        else:
            hits.append((NOTICES[phrase][0], phrase, word))
    expressions = []
    if tagged:
        for match in _TAG.finditer(text):
            postfix = parse(match[1])
            if postfix:
                expressions.append((" ".join(postfix), evaluate(postfix, permitted), [t for t in postfix if t not in _POWER]))
    doubt = 1.0
    for phrase in sorted({h[1] for h in hits}):
        doubt *= 1 - NOTICES[phrase][1]
    if expressions:
        doubt *= 0.01
    labels = {h[0] for h in hits} | {name for e in expressions for name in e[2]}
    return {
        "n_words": words.count(" ") - 1,
        "hits": [{"label": label, "phrase": phrase, "word": word} for label, phrase, word in hits],
        "expressions": [{"postfix": postfix, "permitted": ok} for postfix, ok, _ in expressions],
        "labels": sorted(labels),
        "score": 1 - doubt,
    }


_OUT = (
    "n_words long, hits array<struct<label: string, phrase: string, word: long>>, "
    "expressions array<struct<postfix: string, permitted: boolean>>, labels array<string>, score double"
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", permitted: frozenset[str] = PERMITTED) -> DataFrame:
    """(id, n_words, hits, expressions, labels, score): a row per row of ``docs``.

    ``hits`` are all places of phrases, ``word`` counting from 0; ``expressions``
    those after identifier tags, in postfix order. Null and empty texts have no
    words, no hits and score 0. The score is one minus the product of the doubts
    that the phrases found leave.
    """
    rows = docs.select(named(id_col).alias("id"), named(text_col).alias("text"))
    out = T.StructType([rows.schema["id"], *T._parse_datatype_string(_OUT).fields])
    kinds = pa.struct([
        ("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.string()), ("word", pa.int64())]))),
        ("expressions", pa.list_(pa.struct([("postfix", pa.string()), ("permitted", pa.bool_())]))), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
    ])

    small_batches(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton([*NOTICES, TAG])
        for batch in batches:
            found = pa.array([scan_text(t.as_py(), phrases, permitted) for t in batch.column(1)], kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.flatten()], names=["id", *(f.name for f in kinds)])

    return rows.mapInArrow(run, out)
