"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has bit b set if over half of the document's shingle hashes have
it. Two fingerprints link if they differ in at most ``radius`` bits, and linked
documents form components.

Candidates: every bit position i has a vector m(i) of radius + 1 bits, and for
each non-zero vector v the mask of v keeps the positions where <m(i), v> is odd.
Any ``radius`` positions have vectors that span at most ``radius`` dimensions,
so some v is orthogonal to all of them: under its mask the two fingerprints are
equal. Every pair within the radius thus meets in one of 2^(radius+1) - 1
tables, with certainty (for radius 3: 15 tables of about 34 kept bits).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from thornwall.llm.common import Scratch, named, row_key, small_batches
from thornwall.llm.components import components

SEED = 42
_PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Row b holds the bits of the byte b, highest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The words of about a megabyte of text at a time."""
    at = 0
    while at < len(data):
        cut = _SPACE.search(data, at + _PIECE) if len(data) - at > _PIECE else None
        end = cut.start() if cut else len(data)
        yield data[at:end].lower().split()
        at = end


def simhash(text: str | None, shingle: int = 3) -> int:
    """The fingerprint; zero for a text without words."""
    counts, hashes, carry = np.zeros(64, np.int64), 0, []

    def add(found: list[int]) -> None:
        nonlocal hashes
        columns = np.array(found, dtype=">u8").view(np.uint8).reshape(-1, 8)
        for i in range(8):
            counts[8 * i : 8 * i + 8] += np.bincount(columns[:, i], minlength=256) @ _BITS
        hashes += len(found)

    for words in _pieces((text or "").encode()):
        words = carry + words
        if len(words) >= shingle:
            lengths = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(lengths + 1) - 1
            starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
            joined, of = b" ".join(words), xxhash.xxh64_intdigest
            add([of(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)])
            carry = words[len(words) - shingle + 1 :]
        else:
            carry = words
    if not hashes:
        if not carry:
            return 0
        add([xxhash.xxh64_intdigest(b" ".join(carry), SEED)])
    return int.from_bytes(np.packbits(2 * counts > hashes).tobytes(), "big")


def masks(radius: int = 3, bits: int = 64) -> list[int]:
    """A mask for each non-zero vector of radius + 1 bits."""
    size = 1 << (radius + 1)
    vector = [1 + i % (size - 1) for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (vector[i] & v).bit_count() % 2) for v in range(1, size)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def text_key(id_col: str, text_col: str) -> Column:
    """What tells rows of one id and different texts apart."""
    return row_key(named(id_col), F.sha2(F.coalesce(named(text_col), F.lit("")), 256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, key, fp): a row per row of ``docs``; ``key`` is ``text_key``."""
    rows = docs.select(named(id_col).alias("id"), text_key(id_col, text_col).alias("key"), named(text_col).alias("text"))

    small_batches(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array([signed(simhash(text.as_py(), shingle)) for text in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], names=["id", "key", "fp"])

    out = T.StructType([*rows.select("id", "key").schema.fields, T.StructField("fp", T.LongType())])
    return rows.mapInArrow(run, out)


def _flips(radius: int) -> list[tuple[int, int, int]]:
    """(table, flipped bits, how many): for each table all ways to flip bits that its mask leaves out, up to half the radius, rounded up."""
    from itertools import combinations

    found = []
    for v, mask in enumerate(masks(radius)):
        free = [1 << i for i in range(64) if not mask >> i & 1]
        for n in range(radius - radius // 2 + 1):
            found += [(v, signed(sum(bits)), n) for bits in combinations(free, n)]
    return found


def links(scratch: Scratch, fps: DataFrame, radius: int = 3, crowd: int = 64) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect whatever lies within the radius.

    In a bucket of at most ``crowd`` fingerprints, pairs are compared. A larger
    bucket is covered without pairs: each member names the points z that differ
    from it in up to ceil(radius / 2) of the bucket's free bits. Two members
    within the radius share a z that one of them is at most radius // 2 bits
    from. All that name z are within the radius of a member that near, so
    linking them to one such member is exact, and linear in the members.
    """
    tables = F.array(*[F.struct(F.lit(v).alias("v"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("k")) for v, m in enumerate(masks(radius))])
    keys = fps.select("fp", F.inline(tables))
    shared = scratch.keep(keys.groupBy("v", "k").agg(F.count("*").alias("n")).filter("n > 1"))
    members = scratch.keep(keys.join(shared, ["v", "k"]))

    sparse = members.filter(F.col("n") <= crowd).select("v", "k", "fp")
    other = sparse.withColumnRenamed("fp", "other")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= radius
    pairs = sparse.join(other, (sparse.v == other.v) & (sparse.k == other.k) & (F.col("fp") < F.col("other")) & near)
    pairs = pairs.select(F.col("other").alias("u"), F.col("fp").alias("v"))

    flips = scratch.spark.createDataFrame(_flips(radius), "v int, flip long, far int")
    dense = members.filter(F.col("n") > crowd)
    named_points = dense.join(F.broadcast(flips), "v").select("v", F.col("fp").bitwiseXOR(F.col("flip")).alias("z"), "fp", "far")
    centres = named_points.filter(F.col("far") <= radius // 2).groupBy("v", "z").agg(F.min("fp").alias("centre"))
    stars = named_points.join(centres, ["v", "z"]).filter("fp != centre").select(F.col("fp").alias("u"), F.col("centre").alias("v"))
    return pairs.union(stars).distinct()


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, crowd: int = 64) -> DataFrame:
    """(id, key, fp, component_id, root): a row per row of ``docs``, repeated rows included.

    Null and empty texts have fingerprint zero and link like others; a text of
    fewer words than a shingle counts as one shingle. ``component_id`` is the
    smallest id reachable over links, null ids aside (null if there is no other).
    Equal fingerprints are one node, so copies are never compared with each other.
    Sums by group are stored before they are joined: a join of two shuffled sides
    can be split where one group is large.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(fingerprints(docs, id_col, text_col, shingle))
    classes = rows.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(scratch, links(scratch, classes.select("fp"), radius, crowd))
    placed = classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    placed = scratch.keep(placed)
    least = scratch.keep(placed.groupBy("root").agg(F.min("least").alias("component_id")))
    of = scratch.keep(placed.join(least, "root").select("fp", "component_id", "root"))
    return rows.join(of, "fp").select("id", "key", "fp", "component_id", "root")


def keepers(groups: DataFrame) -> DataFrame:
    """(key): of each component of ``near_groups`` the row of the smallest id, null last."""
    first = F.min(F.struct(F.col("id").isNull().alias("last"), F.col("id").alias("id"), F.col("key").alias("key")))
    return groups.groupBy("root").agg(first.alias("first")).select(F.col("first.key").alias("key"))
