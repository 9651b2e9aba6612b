"""Phrase collocations by vertical partitioning of the suffixes of all pieces.

A suffix is a word with the words that follow it in its piece, cut to the length
of the longest phrase. Prefixes of suffixes are counted first: single words, and
where a word has more suffixes than one group may hold, it with the next word,
and so on. Prefixes within the budget, sorted by hash, are packed into groups of
one budget. Every group's suffixes go to one task, which builds its subtree
without the others: sorted suffixes, the runs of equal ones being the leaves.
A node's count is the sum of its leaves; those too rare for a phrase stay there.
Prefixes above the budget lie above all subtrees; their counts are known already.

Hashes only say where a suffix goes. Words with one hash share its place, counts
are by the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, named, ranked, running, small_batches

UNKNOWN = "und"
#: Bytes after folding: a line feed ends a piece, a space a word.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0a\x0b\x0c\x0d\x09", b"abcdefghijklmnopqrstuvwxyz" + 10 * b"\n" + b" ")
_SLICE = 4 << 20
_ROW_SUFFIXES = 1 << 16
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slices(text: bytes, depth: int, most: int = _SLICE) -> Iterator[tuple[bytes, int]]:
    """Parts of bounded size, each with the number of words at its end with which the next part begins again.

    Parts end with a piece; a piece longer than a part is cut between words.
    """
    at, size = 0, most
    while at < len(text):
        end = text.rfind(b"\n", at, at + size) + 1 if len(text) - at > size else len(text)
        if end:
            yield text[at:end], 0
            at, size = end, most
            continue
        end = max(text.rfind(b" ", at, at + size), at)
        words = text[at:end].rsplit(None, depth - 1)
        if len(words) < depth:
            size *= 2
            continue
        yield text[at:end], depth - 1
        at, size = at + len(words[0]), most


def _tokens(part: bytes) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of a folded text, and the number of the piece each is in."""
    raw = np.frombuffer(part, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = (raw != 32) & (raw != 10)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw[inside[1:-1]])])
    return words.dictionary_encode(), np.searchsorted(np.flatnonzero(raw == 10), starts)


def _mixed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of prefixes one word longer; the upper 24 bits, which tell languages apart, stay."""
    h = (prefix ^ (word + _MIX)) * _MIX
    h ^= h >> np.uint64(29)
    return (prefix & np.uint64(0xFFFFFF << 40)) | (h * _MIX >> np.uint64(24))


class _Part:
    """The suffixes of one part of a language's text: equal ones once, with their number."""

    def __init__(self, part: bytes, again: int, depth: int, lang: str):
        encoded, piece = _tokens(part)
        codes, self.words = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
        n = len(codes) - again
        base, key = len(self.words) + 1, np.zeros(n, np.int64)
        columns, bound = [], 1
        for d in range(depth):
            column = np.zeros(n, np.int64)  # 0: the piece has ended
            have = max(0, min(n, len(codes) - d))
            column[:have] = np.where(piece[d : d + have] == piece[:have], codes[d : d + have] + 1, 0)
            if bound * base >= 1 << 63:
                key = np.unique(key, return_inverse=True)[1]
                bound = n + 1
            key, bound = key * base + column, bound * base
            columns.append(column)
        _, first, self.counts = np.unique(key, return_index=True, return_counts=True)
        self.columns = [column[first] for column in columns]
        own = xxhash.xxh64_intdigest(lang.encode()) & 0xFFFFFF << 40
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words.to_pylist()), np.uint64, len(self.words))
        self._hashes = np.concatenate([np.zeros(1, np.uint64), hashes])
        self._root = np.full(len(first), own, np.uint64)

    def prefixes(self, heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Of each suffix the hash of the prefix it is dealt by, and that prefix's length.

        ``heavy``: by length, the sorted hashes of prefixes above the budget.
        """
        h = _mixed(self._root, self._hashes[self.columns[0]])
        level = np.ones(len(h), np.int8)
        for d, above in enumerate(heavy):
            if not len(above) or d + 1 == len(self.columns):
                break
            on = (level == d + 1) & (above[np.minimum(np.searchsorted(above, h), len(above) - 1)] == h)
            h = np.where(on, _mixed(h, self._hashes[self.columns[d + 1]]), h)
            level[on] += 1
        return h, level

    def phrase(self, columns: list[int]) -> bytes:
        return b" ".join(self.words[c - 1].as_py() for c in columns if c)


def _parts(batch: pa.RecordBatch, depth: int) -> Iterator[tuple[str, _Part]]:
    langs, texts = batch.column(0).dictionary_encode(), batch.column(1).cast(pa.binary())
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        own = texts.filter(pc.equal(langs.indices, code))
        for part, again in _slices(b"\n".join(own.to_pylist()).translate(_FOLD), depth):
            found = _Part(part, again, depth, lang)
            if len(found.counts):
                yield lang, found


def _text(values: pa.Array) -> pa.Array:
    return values.cast(pa.large_binary()).view(pa.large_string()).cast(pa.string())


def _counter(length: int, heavy: list[np.ndarray], depth: int):
    """Prefixes of one length below heavy ones, counted by part: (lang, phrase, h, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, part in _parts(batch, depth):
                h, level = part.prefixes(heavy)
                here = np.flatnonzero(level == length)
                if not len(here):
                    continue
                # Suffixes are sorted by their words, so equal prefixes are neighbours.
                columns = [column[here] for column in part.columns[:length]]
                new = np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)])
                starts = np.flatnonzero(new)
                counts = np.add.reduceat(part.counts[here], starts)
                if length == 1:
                    phrases = part.words.take(pa.array(columns[0][starts] - 1))
                else:
                    phrases = pa.array([part.phrase([int(c[i]) for c in columns]) for i in starts], pa.large_binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(starts), pa.string()), _text(phrases), pa.array(h[here][starts].view(np.int64)), pa.array(counts, pa.int64())], names=["lang", "phrase", "h", "n"]
                )

    return run


def _router(bounds: np.ndarray, heavy: list[np.ndarray], depth: int):
    """Rows (lang, grp, level, words, suffixes, n): part of a group's suffixes, their words by number."""
    lists = [pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, part in _parts(batch, depth):
                h, level = part.prefixes(heavy)
                place = (np.searchsorted(bounds, h.view(np.int64), "right") - 1) * (depth + 1) + level
                order = np.argsort(place, kind="stable")
                cuts = np.flatnonzero(np.diff(place[order])) + 1
                for one in np.split(order, cuts):
                    for at in range(0, len(one), _ROW_SUFFIXES):
                        rows = one[at : at + _ROW_SUFFIXES]
                        grp, own = divmod(int(place[rows[0]]), depth + 1)
                        used, codes = np.unique(np.stack([column[rows] for column in part.columns], axis=1), return_inverse=True)
                        ends = int(used[0] == 0)
                        words = _text(part.words.take(pa.array(used[ends:] - 1)))
                        values = [words, pa.array(codes.reshape(-1) - ends, pa.int32()), pa.array(part.counts[rows], pa.int32())]
                        columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in values]
                        head = [pa.array([lang], pa.string()), pa.array([grp], pa.int64()), pa.array([own], pa.int32())]
                        yield pa.RecordBatch.from_arrays([*head, *(c.cast(t) for c, t in zip(columns, lists, strict=True))], names=["lang", "grp", "level", "words", "suffixes", "n"])

    return run


def _subtree(depth: int, min_count: int):
    """The nodes of a group's subtree that are frequent: (lang, phrase, words, f)."""

    def flat(table: pa.Table, name: str) -> tuple[pa.Array, np.ndarray]:
        column = table.column(name).combine_chunks()
        return pc.list_flatten(column), pc.list_value_length(column).to_numpy()

    def run(key: tuple, table: pa.Table) -> pa.Table:
        words, per_row = flat(table, "words")
        words = words.dictionary_encode()
        number = words.indices.to_numpy().astype(np.int64)
        codes, wide = flat(table, "suffixes")
        counts, each = flat(table, "n")
        base = np.repeat(np.concatenate([[0], np.cumsum(per_row)[:-1]]), wide)
        codes = codes.to_numpy()
        codes = np.where(codes < 0, 0, number[np.where(codes < 0, 0, codes + base)] + 1).reshape(-1, depth)
        order = np.lexsort(codes.T[::-1])
        codes, level = codes[order], np.repeat(table.column("level").to_numpy(), each)[order]
        # Leaves: runs of equal suffixes. A run that agrees in its first d words is a node of depth d.
        agree = np.cumprod(codes[1:] == codes[:-1], axis=1).astype(bool)
        leaves = np.flatnonzero(np.concatenate([[True], ~agree[:, -1]]))
        totals = np.add.reduceat(counts.to_numpy().astype(np.int64)[order], leaves)
        codes, level = codes[leaves], level[leaves]
        agree = np.concatenate([np.zeros((1, depth), bool), agree[leaves[1:] - 1]])
        found: list[tuple] = []
        for d in range(1, depth + 1):
            starts = np.flatnonzero(~agree[:, d - 1])
            f = np.add.reduceat(totals, starts)
            good = (f >= min_count) & (codes[starts, d - 1] > 0) & (level[starts] <= d)
            for at, n in zip(starts[good], f[good], strict=True):
                found.append((" ".join(words.dictionary[int(c) - 1].as_py() for c in codes[at, :d]), d, int(n)))
        phrases, lengths, f = zip(*found, strict=True) if found else ((), (), ())
        return pa.table({"lang": pa.array([key[0].as_py()] * len(found), pa.string()), "phrase": pa.array(phrases, pa.string()), "words": pa.array(lengths, pa.int32()), "f": pa.array(f, pa.int64())})

    return run


def phrase_counts(
    scratch: Scratch, docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, min_count: int = 10, budget: int = 1 << 20, max_groups: int = 1 << 20
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of up to ``max_words`` words found ``min_count`` times, and (lang, n).

    Overlapping occurrences count, within pieces only. A null language is
    ``und``, a null text empty; repeated rows count as often as they are there.
    ``budget``: suffixes a task holds at a time; it is raised where there would be
    more than ``max_groups`` groups, whose borders every task knows (8 MB at most).
    """
    small_batches(docs)
    rows = docs.select(F.coalesce(named(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    kinds = "lang string, phrase string, h long, n long"
    heavy: list[np.ndarray] = []
    tables: list[DataFrame] = []
    dealt: list[DataFrame] = []
    for length in range(1, max_words + 1):
        counted = rows.mapInArrow(_counter(length, heavy, max_words), kinds).groupBy("lang", "phrase", "h").agg(F.sum("n").alias("n"))
        tables.append(scratch.keep(counted))
        if length == 1:
            totals = scratch.keep(tables[0].groupBy("lang").agg(F.sum("n").alias("n")))
            budget = max(budget, (totals.agg(F.sum("n")).first()[0] or 0) // max_groups)
        # Fewer than max_groups: each has more than max_groups-th of all.
        above = tables[-1].filter(F.col("n") > budget) if length < max_words else tables[-1].limit(0)
        above = np.array([r["h"] for r in above.select("h").distinct().collect()], np.int64).view(np.uint64)
        heavy.append(np.sort(above))
        dealt.append(tables[-1].filter(F.col("n") <= budget) if length < max_words else tables[-1])
        if not len(above):
            break
    packed = dealt[0]
    for table in dealt[1:]:
        packed = packed.union(table)
    packed = running(ranked(scratch, packed.groupBy("h").agg(F.sum("n").alias("n")), "h"), "n", "before")
    bounds = packed.groupBy(F.floor(F.col("before") / budget).alias("grp")).agg(F.min("h").alias("h"))
    bounds = np.sort(np.array([r["h"] for r in bounds.select("h").collect()], np.int64))
    if len(bounds):
        bounds[0] = np.iinfo(np.int64).min
    else:
        bounds = np.array([np.iinfo(np.int64).min])
    suffixes = rows.mapInArrow(_router(bounds, heavy, max_words), "lang string, grp long, level int, words array<string>, suffixes array<int>, n array<int>")
    nodes = suffixes.groupBy("lang", "grp").applyInArrow(_subtree(max_words, min_count), "lang string, phrase string, words int, f long")
    for length, table in enumerate(tables[: max_words - 1], 1):
        # "w" with nothing after it is no phrase of its own.
        over = table.filter((F.col("n") > budget) & (F.col("n") >= min_count) & (F.size(F.split("phrase", " ")) == length))
        nodes = nodes.union(over.select("lang", "phrase", F.lit(length).alias("words"), F.col("n").alias("f")))
    return scratch.keep(nodes), totals


def _parts_of(phrase: Column, words: Column, most: int) -> Column:
    """All (sub) of two words or more that a longer phrase contains."""
    split = F.split(phrase, " ")
    subs = [F.when((words > length) & (words >= at + length), F.array_join(F.slice(split, at + 1, length), " ")) for length in range(2, most) for at in range(most - length + 1)]
    return F.array_distinct(F.array_compact(F.array(*subs))) if subs else F.array().cast("array<string>")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 3, min_count: int = 10, cover_percent: int = 50, top: int = 2000, **options
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut,
    ``n`` all words of the language; score = floor(1000000 a a / (l r)). A phrase
    goes if a longer one that contains it is at least ``cover_percent`` as
    frequent. Ties go by count, then by phrase in byte order. Exact for counts
    below 10^15. Tables without rows or words give no rows.
    """
    scratch = Scratch(docs.sparkSession)
    nodes, totals = phrase_counts(scratch, docs, text_col, lang_col, max_words, min_count, **options)
    found = nodes.filter("words >= 2")
    split = F.split("phrase", " ")
    cuts = [
        F.when(F.col("words") > k, F.struct(F.lit(k).alias("k"), F.array_join(F.slice(split, 1, k), " ").alias("head"), F.array_join(F.slice(split, k + 1, max_words), " ").alias("rest")))
        for k in range(1, max_words)
    ]
    cut = found.select("lang", "phrase", F.col("f").alias("a"), F.inline(F.array_compact(F.array(*cuts))))
    part = nodes.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    cut = cut.join(part, ["lang", "head"]).join(part.toDF("lang", "rest", "r"), ["lang", "rest"])
    whole = {c: F.col(c).cast("decimal(15,0)") for c in ("a", "l", "r")}
    cut = cut.select("lang", "phrase", "a", "k", "l", "r", (whole["a"] * whole["a"] * F.lit(1_000_000).cast("decimal(7,0)")).alias("above"), (whole["l"] * whole["r"]).alias("below"))
    scored = cut.withColumn("score", F.expr("above div below"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("lang", "phrase", "a", "cut.*")
    longer = found.filter("words > 2").select("lang", F.col("f").alias("longer"), F.explode(_parts_of(F.col("phrase"), F.col("words"), max_words)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < cover_percent * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
