"""The prefix trie of conversations, from their sorted order.

A conversation's path holds a digest of each of its beginnings, in a row. In
sorted order, conversations that share a beginning are neighbours; how many turns
two neighbours share (LCP) makes an edge between them. Edges are taken in
descending depth: a union-find joins the components they touch, and a join makes
the branching node of that depth. Between two joins lies a chain of nodes with
one child each and the same members, laid out on the way.

Every sorted partition makes its own forest. It knows the last path before and
the first one after it, so it knows which of its nodes reach across a border.
Those, the spines at both ends, are what is left of a forest once contracted; all
their figures are sums and minima, merged across partitions by the node's digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, measured, named

_DIGEST = 16
_BATCH = 5000


def numbered(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, nth, digest, chars): the turns of each conversation from 1.

    Turns without a number come first; ties go by role, then by the SHA-256 of
    the text; repeated rows are turns like others. Null roles and texts count as
    empty. Rows without an id belong to no conversation and are left out.
    """
    role, text = F.coalesce(named(role_col).cast("string"), F.lit("")), F.coalesce(named(text_col).cast("string"), F.lit(""))
    turns = conversations.filter(named(id_col).isNotNull()).select(
        named(id_col).cast("long").alias("conv"), named(turn_col).alias("turn"), role.alias("role"), F.sha2(text, 256).alias("sha"), F.char_length(text).cast("long").alias("chars")
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "sha")
    said = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("sha")), 256)
    return turns.select("conv", F.row_number().over(order).alias("nth"), F.unhex(F.left(said, F.lit(2 * _DIGEST))).alias("digest"), "chars")


def with_openings(scratch: Scratch, turns: DataFrame, block: int = 100, most: int = 6) -> DataFrame:
    """(conv, part, nth, digest, chars): each conversation c after it has taken over an opening.

    Its first h turns, h = crc32(c) % ``most``, give way to those of the first
    conversation of its block (c - c % ``block``), as many as that has, if it is
    there. A row of part -1 stands for the conversation itself.
    """
    turns = scratch.keep(turns)
    convs = turns.select("conv").distinct().withColumn("h", (F.crc32(F.col("conv").cast("string")) % most).cast("int"))
    convs = scratch.keep(convs.withColumn("of", F.expr(f"conv - conv % {block}")))
    openings = turns.filter(F.col("nth") < most).select(F.col("conv").alias("of"), "nth", "digest", "chars")
    taken = convs.join(openings, "of").filter("nth <= h").select("conv", F.lit(0).alias("part"), "nth", "digest", "chars")
    own = turns.join(convs.select("conv", "h"), "conv").filter("nth > h").select("conv", F.lit(1).alias("part"), "nth", "digest", "chars")
    there = convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("nth"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("long").alias("chars"))
    return taken.union(own).union(there)


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}


def _mapped(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    arrow = pa.schema([(name, _KINDS[kind]) for name, kind in (part.split() for part in schema.split(", "))])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                yield from zip(*(c.to_pylist() for c in batch.slice(at, _BATCH).columns), strict=True)

    def packed(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in fn(rows(batches)):
            held.append(row)
            size += sum(len(v) for v in row if isinstance(v, bytes | list))
            if len(held) == _BATCH or size > 1 << 22:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return df.mapInArrow(run, schema)


def _paths(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (conv, digest, chars) in order -> (conv, path, chars), 24 bytes a turn."""
    conv, path, sizes = None, bytearray(), []
    for own, digest, chars in rows:
        if own != conv:
            if conv is not None:
                yield conv, bytes(path), sizes
            conv, path, sizes = own, bytearray(), []
        if digest is not None:
            path += hashlib.blake2b(path[-_DIGEST:] + digest, digest_size=_DIGEST).digest()
            sizes.append(chars)
    if conv is not None:
        yield conv, bytes(path), sizes


def shared(a: bytes, b: bytes) -> int:
    """How many beginnings two paths share; a digest covers all before it, so halving finds the last."""
    low, high = 0, min(len(a), len(b)) // _DIGEST
    while low < high:
        middle = (low + high + 1) // 2
        if a[(middle - 1) * _DIGEST : middle * _DIGEST] == b[(middle - 1) * _DIGEST : middle * _DIGEST]:
            low = middle
        else:
            high = middle - 1
    return low


class Forest:
    """The nodes of one run of sorted conversations, by union-find over their edges.

    A component is a run ``low..high`` of conversations whose nodes below ``top``
    are done. ``before`` and ``after``: the turns that the first and the last
    share with their neighbours outside, -1 without such. Figures of a node that
    reaches across a border are this run's share of them.
    """

    def __init__(self, convs: list[int], paths: list[bytes], sizes: list[list[int]], before: int = -1, after: int = -1):
        self.paths, self.sizes, self.before, self.after = paths, sizes, before, after
        n = len(convs)
        self.up, self.high, self.top = list(range(n)), list(range(n)), [len(p) // _DIGEST for p in paths]
        self.count, self.least = [1] * n, list(convs)
        self.children, self.leaves, self.saved = [0] * n, [0] * n, [0] * n
        self.below: list[list[int]] = [[] for _ in range(n)]
        self.nodes: list[list] = []
        by_depth: dict[int, list[int]] = {}
        for i in range(n - 1):
            by_depth.setdefault(shared(paths[i], paths[i + 1]), []).append(i)
        for depth in sorted(by_depth, reverse=True):
            for i in by_depth[depth]:
                self._join(self._find(i), i + 1, depth)
        if n:
            self._raise(0, -1)

    def _find(self, i: int) -> int:
        """The first conversation of a component."""
        root = i
        while self.up[root] != root:
            root = self.up[root]
        while self.up[i] != root:
            self.up[i], i = root, self.up[i]
        return root

    def _join(self, a: int, b: int, depth: int) -> None:
        """Two neighbouring components become (part of) the node of ``depth``; ``b`` is the first of its own."""
        self._raise(a, depth)
        self._raise(b, depth)
        self.up[b], self.high[a] = a, self.high[b]
        self.count[a] += self.count[b]
        self.least[a] = min(self.least[a], self.least[b])
        self.children[a] += self.children[b]
        self.leaves[a] += self.leaves[b]
        self.saved[a] += self.saved[b]
        if len(self.below[a]) < len(self.below[b]):
            self.below[a], self.below[b] = self.below[b], self.below[a]
        self.below[a] += self.below[b]
        self.below[b] = []

    def _raise(self, c: int, depth: int) -> None:
        """Lay out a component's nodes from its top down to just below ``depth``."""
        last = len(self.paths) - 1
        for e in range(self.top[c], depth, -1):
            begins = c > 0 or e > self.before
            across = not begins or (self.high[c] == last and e <= self.after)
            if e:
                self.saved[c] += (self.count[c] - begins) * self.sizes[c][e - 1]
            if not self.children[c] and not across:
                self.leaves[c] = 1
            path = self.paths[c][: e * _DIGEST] if across and not self.children[c] else None
            key = self.paths[c][max(0, e - 1) * _DIGEST : e * _DIGEST]
            for child in self.below[c]:
                self.nodes[child][-1] = len(self.nodes)
            above = self.paths[c][max(0, e - 2) * _DIGEST : (e - 1) * _DIGEST] if e else None
            self.nodes.append([key, e, self.least[c], self.count[c], self.children[c], self.leaves[c], self.saved[c], across, above, path, None])
            self.below[c], self.children[c] = [len(self.nodes) - 1], int(begins)
        self.top[c] = min(self.top[c], depth)

    def rows(self) -> Iterator[tuple]:
        """(key, depth, conv, n, children, leaves, saved, across, above, path, parent); parent is null where it reaches across."""
        for *node, parent in self.nodes:
            up = self.nodes[parent] if parent is not None else None
            yield *node, None if up is None or up[7] else up[2]


_NODES = "key binary, depth int, conv long, n long, children long, leaves long, saved long, across boolean, above binary, path binary, parent long"


def _forests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (run, conv, path, sizes) in order, the paths outside a run with a null conv at its ends -> nodes."""

    def done() -> Iterator[tuple]:
        before = shared(outside[0], paths[0]) if outside[0] is not None else -1
        after = shared(paths[-1], outside[1]) if outside[1] is not None else -1
        yield from Forest(convs, paths, sizes, before, after).rows()

    run, convs, paths, sizes, outside = None, [], [], [], [None, None]
    for own, conv, path, chars in rows:
        if own != run:
            if convs:
                yield from done()
            run, convs, paths, sizes, outside = own, [], [], [], [None, None]
        if conv is None:
            outside[bool(convs)] = path
        else:
            convs.append(conv)
            paths.append(path)
            sizes.append(chars)
    if convs:
        yield from done()


def _ends(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (key, conv) in order -> (key, sha256 of the ids), an id at a time."""
    key, state = None, None
    for own, conv in rows:
        if own != key:
            if key is not None:
                yield key, state.hexdigest()
            key, state = own, hashlib.sha256(str(conv).encode())
        else:
            state.update(f",{conv}".encode())
    if key is not None:
        yield key, state.hexdigest()


def trie(scratch: Scratch, turns: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved, ends_sha256): a row per distinct beginning.

    ``turns``: (conv, part, nth, digest, chars), the row of a turn or, with a null
    digest, of a conversation that may have none. A node is named by its smallest
    member. ``saved`` adds up, over the subtree, (members - 1) times the chars of
    the node's turn. Without conversations there is no node, not even a root.
    A conversation's path is one value (24 bytes a turn).
    """
    turns = turns.repartition("conv").sortWithinPartitions("conv", "part", "nth")
    paths = _mapped(turns.select("conv", "digest", "chars"), _paths, "conv long, path binary, sizes array<long>")
    paths = scratch.keep(paths.orderBy("path", "conv").withColumn("place", F.monotonically_increasing_id()))
    paths = paths.withColumn("run", F.shiftrightunsigned("place", 33))

    ends = paths.select(F.expr(f"substring(path, greatest(length(path) - {_DIGEST - 1}, 1), {_DIGEST})").alias("key"), "conv")
    ends = _mapped(ends.repartition("key").sortWithinPartitions("key", "conv"), _ends, "key binary, ends_sha256 string")

    # A row per run, so that each knows its neighbours.
    each = Window.orderBy("run")
    runs = paths.groupBy("run").agg(F.min_by("path", "place").alias("first"), F.max_by("path", "place").alias("last"))
    runs = scratch.keep(runs.select("run", F.lag("last").over(each).alias("before"), F.lead("first").over(each).alias("after")))
    no = {"conv": F.lit(None).cast("long"), "sizes": F.lit(None).cast("array<bigint>")}
    outside = [
        runs.filter(F.col(side).isNotNull()).select(F.lit(place).cast("long").alias("place"), "run", no["conv"].alias("conv"), F.col(side).alias("path"), no["sizes"].alias("sizes"))
        for side, place in (("before", -1), ("after", (1 << 63) - 1))
    ]
    forest = paths.select("place", "run", "conv", "path", "sizes").union(outside[0]).union(outside[1]).repartition("run").sortWithinPartitions("run", "place")
    nodes = scratch.keep(_mapped(forest.select("run", "conv", "path", "sizes"), _forests, _NODES))

    sums = [F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")]
    merged = nodes.filter("across").groupBy("key", "depth").agg(F.min("conv").alias("conv"), *sums, F.max("above").alias("above"), F.max("path").alias("path"))
    merged = scratch.keep(merged)
    # A childless node that reaches across is a leaf of all nodes above it, which reach across too.
    steps = F.explode(F.sequence(F.lit(0), F.col("depth"))).alias("e")
    leaves = merged.filter("children = 0").select("path", steps).select(F.expr(f"if(e = 0, X'', substring(path, (e - 1) * {_DIGEST} + 1, {_DIGEST}))").alias("key"))
    leaves = leaves.groupBy("key").agg(F.count("*").alias("more"))
    merged = scratch.keep(merged.join(leaves, "key", "left").withColumn("leaves", F.col("leaves") + F.coalesce("more", F.lit(0))).drop("more", "path"))

    shown = ["key", "depth", "conv", "n", "children", "leaves", "saved"]
    inside = nodes.filter("not across")
    known = inside.filter("above is null or parent is not null").select(*shown, "parent")
    names = measured(merged.select(F.col("key").alias("above"), F.col("conv").alias("parent")))
    open_ = inside.filter("above is not null and parent is null").select(*shown, "above").union(merged.select(*shown, "above"))
    rows = known.union(open_.join(names, "above", "left").select(*shown, "parent"))
    nothing = hashlib.sha256().hexdigest()
    return rows.join(ends, "key", "left").select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        "saved",
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )
