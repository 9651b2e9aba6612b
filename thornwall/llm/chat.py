"""Chat formatting with shared beginnings, as a prefix tree.

Conversations that begin with the same turns share those turns' nodes. A node's
turn is formatted once; nodes are laid out depth-first in one sequence, so each
has an interval of it. A node carries its position ids (they count on from its
parent's, as if its conversation stood alone) and the intervals of its ancestors,
which are all that its characters may attend to besides themselves. A conversation
is read back by following its intervals.

Depth-first order needs no walk: each distinct conversation has a path, the
digests of its beginnings in a row. Sorted paths put every subtree in one run;
a node belongs to the first path that passes through it, and (rank of that path,
depth) is the order. Nodes of one owner on a path are neighbours in the sequence,
so a path has one interval per owner.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thornwall.llm.common import Scratch, named, ranked, running, small_batches

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Strings that a template or tokenizer may give a meaning to. None has its first character anywhere else.
CONTROL = (OPEN, CLOSE, "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(map(re.escape, sorted(CONTROL, key=len, reverse=True))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
LEARNED = "assistant"
_BATCH_BYTES = 4 << 20


def escape(text: str) -> str:
    r"""No control string is left: ``\`` is doubled, and ``\.`` stands after a control string's first character."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\." + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: {".": "", "n": "\n"}.get(m[1], m[1]), text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its learned characters are (an empty interval for other roles)."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    begin = len(head) if role == LEARNED else 0
    return head + body + CLOSE + "\n", begin, begin + len(body) if role == LEARNED else 0


def read_turn(segment: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    if not segment.startswith(OPEN) or not segment.endswith(CLOSE + "\n"):
        raise ValueError("not a formatted turn")
    role, _, text = segment[len(OPEN) : -len(CLOSE) - 1].partition("\n")
    return unescape(role), unescape(text)


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 2000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows and, but for a single longer row, four megabytes."""
    held, size = [], 0
    for row in rows:
        own = sum(len(value) for value in row if isinstance(value, str | bytes))
        if held and (len(held) == most or size + own > _BATCH_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
        held.append(row)
        size += own
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        step = max(1, min(2000, _BATCH_BYTES * batch.num_rows // max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, step).columns), strict=True)


def _chained(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (conv, role, text) in order of turns -> one per turn, and one per conversation with its path.

    What is held of a conversation is a digest of 16 bytes a turn.
    """
    conv, path, depth, position, root = None, bytearray(), 0, 0, b""
    for own, role, text in rows:
        if own != conv:
            if conv is not None:
                yield (conv, -1, bytes(path[-16:]), None, root, None, None, None, None, None, bytes(path))
            conv, path, depth, position = own, bytearray(), 0, 0
        segment, begin, end = format_turn(role, text)
        parent = bytes(path[-16:])
        node = hashlib.blake2b(parent + len(role).to_bytes(8, "big") + role.encode() + text.encode(), digest_size=16).digest()
        root = root if depth else node
        path += node
        yield (conv, depth, node, parent or None, root, position, len(segment), segment, begin, end, None)
        depth += 1
        position += len(segment)
    if conv is not None:
        yield (conv, -1, bytes(path[-16:]), None, root, None, None, None, None, None, bytes(path))


_CHAINED = "conv string, depth int, node binary, parent binary, tree binary, position long, length long, segment string, learn_from int, learn_to int, path binary"


def _mapped(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    small_batches(df)
    arrow = pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])
    return df.mapInArrow(lambda batches: _batches(fn(_rows(batches)), arrow), schema)


class Packed:
    """``nodes``: (tree, node, parent, depth, owner, through, start, length, position, segment, learn_from, learn_to);
    ``attends``: (owner, intervals): what the nodes of an owner attend to before themselves,
    each interval with the run of nodes it lies in, (owner, through);
    ``convs``: (conv, owner): whose nodes end a conversation.
    ``through`` counts the conversations of a node. It falls along an owner's run where a
    path leaves, so nodes of one owner and count are in the same conversations.
    """

    def __init__(self, nodes: DataFrame, attends: DataFrame, convs: DataFrame):
        self.nodes, self.attends, self.convs = nodes, attends, convs


def pack(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Packed:
    """The prefix tree of all conversations, laid out.

    Null roles and texts count as empty, turns without a number come last, ties
    go by role and text; repeated rows are turns like others. A null id is a
    conversation of its own. Of a conversation's turns, one at a time is in memory.
    """
    scratch = Scratch(conversations.sparkSession)
    conv = F.coalesce(F.concat(F.lit("v"), named(id_col).cast("string")), F.lit("n"))
    role, text = F.coalesce(named(role_col).cast("string"), F.lit("")), F.coalesce(named(text_col), F.lit(""))
    turns = conversations.select(conv.alias("conv"), named(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    turns = turns.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_last(), "role", "text")
    chained = scratch.keep(_mapped(turns.select("conv", "role", "text"), _chained, _CHAINED))

    steps = chained.filter("depth >= 0")
    ends = chained.filter("depth < 0").select("conv", F.col("node").alias("leaf"), "path")
    leaves = ends.groupBy("leaf").agg(F.first("path").alias("path"), F.min("conv").alias("example"))
    leaves = scratch.keep(ranked(scratch, leaves, "path").select("leaf", "example", "rank"))
    ranks = scratch.keep(ends.select("conv", "leaf").join(leaves, "leaf").select("conv", "rank"))
    owners = steps.select("conv", "node").join(ranks, "conv").groupBy("node").agg(F.min("rank").alias("owner"), F.count("*").alias("through"))

    # Texts are moved once: what is needed for the layout is worked out without them.
    own = ["tree", "parent", "depth", "position", "length"]
    narrow = scratch.keep(steps.groupBy("node").agg(*(F.first(c).alias(c) for c in own)).join(owners, "node"))
    order = ranked(scratch, narrow.select("node", "owner", "depth", "length"), "owner", "depth")
    starts = scratch.keep(narrow.join(running(order, "length", "start").select("node", "start"), "node"))
    segments = steps.groupBy("node").agg(*(F.first(c).alias(c) for c in ["segment", "learn_from", "learn_to"]))
    nodes = scratch.keep(segments.join(starts, "node"))

    # Of each distinct conversation, by one example: the runs it passes before its own nodes.
    places = starts.select("node", "owner", "through", "start", (F.col("start") + F.col("length")).alias("end"))
    example = leaves.select(F.col("example").alias("conv"), F.col("rank").alias("of"))
    passed = steps.select("conv", "node").join(example, "conv").join(places, "node").filter("owner != of")
    before = passed.groupBy("of", "owner", "through").agg(F.min("start").alias("begin"), F.max("end").alias("end"))
    before = before.groupBy("of").agg(F.sort_array(F.collect_list(F.struct("begin", "end", "owner", "through"))).alias("intervals"))
    attends = leaves.select(F.col("rank").alias("owner")).join(before, F.col("owner") == F.col("of"), "left")
    empty = F.array().cast("array<struct<begin:bigint,end:bigint,owner:bigint,through:bigint>>")
    attends = scratch.keep(attends.select("owner", F.coalesce("intervals", empty).alias("intervals")))
    return Packed(nodes, attends, ranks.select("conv", F.col("rank").alias("owner")))


def _digested(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (owner, position, segment, learn_from, learn_to) in order -> one per owner; positions must count on without a gap."""
    owner, state = None, None

    def done() -> tuple:
        turns, all_, learned, learned_chars, chars = state
        return owner, turns, all_.hexdigest(), learned_chars, learned.hexdigest(), chars

    for own, position, segment, begin, end in rows:
        if own != owner:
            if owner is not None:
                yield done()
            owner, state = own, [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
        if position != state[4]:
            raise ValueError("position ids do not count on")
        role, text = read_turn(segment)
        masked = unescape(segment[begin:end])
        state[0] += 1
        state[1].update(f"{role}\n{text}\n".encode())
        state[2].update(masked.encode())
        state[3] += len(masked)
        state[4] += len(segment)
    if owner is not None:
        yield done()


def spans(packed: Packed) -> DataFrame:
    """(of, owner, through, begin, end): all that a distinct conversation reads: what its own nodes attend to, and these."""
    attended = packed.attends.select(F.col("owner").alias("of"), F.inline("intervals"))
    own = packed.nodes.groupBy("owner", "through").agg(F.min("start").alias("begin"), F.max(F.col("start") + F.col("length")).alias("end"))
    columns = ["of", "owner", "through", "begin", "end"]
    return attended.select(columns).union(own.withColumn("of", F.col("owner")).select(columns))


def read_back(packed: Packed) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the laid-out sequence alone.

    A conversation reads the segments that its last node attends to, then its
    own, one after the other; equal conversations are read once. ``conv`` is the
    id as text after a ``v``, or ``n`` for null.
    """
    nodes = packed.nodes.select("owner", "through", "start", "position", "segment", "learn_from", "learn_to")
    found = spans(packed).join(nodes, ["owner", "through"]).filter("start >= begin and start < end")
    found = found.select("of", "start", "position", "segment", "learn_from", "learn_to").repartition("of").sortWithinPartitions("of", "start")
    schema = "owner long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    digests = _mapped(found.select("of", "position", "segment", "learn_from", "learn_to"), _digested, schema)
    return packed.convs.join(digests, "owner").drop("owner")
