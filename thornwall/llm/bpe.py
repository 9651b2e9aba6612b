"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

The last token of a prefix's encoding decides the encoding: it is the one token
ending there that stands next to the last token of what precedes it without
merging across the border. So the encoding of a piece is a walk: each byte leads
to the last token of the longer prefix. Until later bytes decide, several
prefixes can still be the ones the encoding passes through, namely those whose
rest could grow into a token: the open prefixes. Their walks share a beginning;
those tokens are certain and can go out, at the latest after a few thousand
bytes.

The set of open prefixes is the transducer's state. It is named by the longest
rest, which decides all shorter ones, so there are no more states than beginnings
of tokens. A move yields the tokens that may end at the byte, longest first;
which of them stands is looked up by it and the last token before it. Moves and
such pairs are worked out when first met, and kept in tables of bounded size.
"""

from __future__ import annotations

import base64
import contextlib
import ctypes
import gc
import hashlib
import sys
import threading
import types
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thornwall.llm.common import named, small_batches

_PIECE = 1 << 18
_BATCH_CHARS = 1 << 21
_LOOKAHEAD = 4096
_CHUNK = 1 << 16
_NONE = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base 64 and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Vocabulary:
    """Tokens by rank and back, their beginnings, and how each is made by merging."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.starts = {start: n for n, start in enumerate({token[:k] for token in ranks for k in range(len(token))})}
        self.names = list(self.starts)
        # The two tokens each is merged from; -1: not known yet, -2: none.
        self._left, self._right = array("i", [-1]) * len(self.tokens), array("i", [-1]) * len(self.tokens)
        self._rising = True

    def merged(self, piece: bytes) -> list[bytes]:
        """The definition: merge the adjacent pair of lowest rank, the first of equals, until none is a token."""
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (least := min(pairs)) < _NONE:
            at = pairs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], _NONE)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], _NONE)
        return parts

    def halves(self, rank: int) -> tuple[int, int]:
        """The tokens that the last merge makes this one from, -2 for a single byte; LookupError if no merge does."""
        if self._left[rank] == -1:
            token, made = self.tokens[rank], (-2, -2)
            if len(token) > 1:
                if self.merged(token) != [token]:
                    raise LookupError(token)
                at = self._last_merge(token)
                made = self.ranks[token[:at]], self.ranks[token[at:]]
                self._rising &= max(made) < rank
            self._left[rank], self._right[rank] = made
            for half in made:
                if half >= 0:
                    self.halves(half)
        return self._left[rank], self._right[rank]

    def _last_merge(self, token: bytes) -> int:
        """Where the last two parts of a token meet."""
        rank, parts = self.ranks.get, [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [rank(a + b, _NONE) for a, b in zip(parts, parts[1:], strict=False)]
            at = pairs.index(min(pairs))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return len(parts[0])

    def stand(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are next to each other.

        While they are made, the parts on both sides of the border change in the
        order of their ranks. Seen from the end, the later made one is undone
        first; a merge across the border must come before what undid its parts,
        the left one of two equals first. Where tokens are not made of ones of
        lower rank, the merges are carried out.
        """
        for token in (left, right):
            if self._left[token] == -1:
                self.halves(token)
        # What two tokens are made of has been split already, on their own account.
        lefts, rights = self._left, self._right
        tokens, rank, limit, a, b = self.tokens, self.ranks.get, _NONE, left, right
        while self._rising:
            if rank(tokens[a] + tokens[b], _NONE) < limit:
                return False
            left_of, right_of = lefts[b], rights[a]
            if right_of >= 0 and (a > b or left_of < 0):
                limit, a = a, right_of
            elif left_of >= 0:
                limit, b = b + 1, left_of
            else:
                return True
        return self.merged(tokens[left] + tokens[right]) == [tokens[left], tokens[right]]


class Transducer:
    """States: beginnings of tokens, the longest that the bytes so far end with.

    At most ``max_moves`` moves and ``max_pairs`` pairs are kept, and what
    ``max_heads`` beginnings of pieces lead to, so that they are one move; a
    table starts anew when it is full.
    """

    HEAD = 5

    def __init__(self, vocabulary: Vocabulary, max_moves: int = 100_000, max_pairs: int = 150_000, max_heads: int = 50_000):
        self.vocabulary, self.ranks, self.max_moves, self.max_pairs, self.max_heads = vocabulary, vocabulary.ranks, max_moves, max_pairs, max_heads
        self._heads: dict[bytes, tuple[int, tuple[int, ...]]] = {}
        self._root = vocabulary.starts.get(b"", 0) << 8
        self._pairs: dict[int, bool] = {}
        self._moves: dict[int, tuple[int, tuple[tuple[int, int, int], ...]]] = {}

    def merged(self, piece: bytes) -> list[bytes]:
        return self.vocabulary.merged(piece)

    def _stand(self, pair: int) -> bool:
        """Whether both tokens (the left one's rank plus one, 0 for none; the right one's) stay as they are next to each other."""
        if len(self._pairs) >= self.max_pairs:
            self._pairs.clear()
        left, token = pair >> 32, pair & 0xFFFFFFFF
        stands = self._pairs[pair] = not left or self.vocabulary.stand(left - 1, token)
        return stands

    def _move(self, key: int) -> tuple[int, tuple[tuple[int, int, int], ...]]:
        """From a state (upper bits) by a byte (lowest eight): the next state, and (length, rank, as in ``lasts``) of the tokens that may end here."""
        if len(self._moves) >= self.max_moves:
            self._moves.clear()
        rest = self.vocabulary.names[key >> 8] + bytes((key & 0xFF,))
        suffixes = [rest[j:] for j in range(len(rest))]
        outs = tuple((len(s), rank, rank + 1 << 32) for s in suffixes if (rank := self.ranks.get(s)) is not None)
        for _, rank, _ in outs:
            self.vocabulary.halves(rank)
        starts = self.vocabulary.starts
        state = next((starts[s] << 8 for s in suffixes if s in starts), self._root)
        self._moves[key] = state, outs
        return state, outs

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one piece; a piece that is a token is that token."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        try:
            return self._short(piece) if len(piece) <= _LOOKAHEAD else self._long(piece)
        except LookupError:  # a vocabulary whose tokens are not the merges of each other
            return [self.ranks[part] for part in self.merged(piece)]

    def _short(self, piece: bytes) -> list[int]:
        """All bytes, then back over the borders from the end."""
        head = piece[: self.HEAD]
        known = self._heads.get(head)
        if known:
            state, lasts = known[0], list(known[1])
        else:
            lasts = [0]
            state = self._read(head, self._root, lasts)
            if len(self._heads) >= self.max_heads:
                self._heads.clear()
            self._heads[head] = state, tuple(lasts)
        if len(piece) > self.HEAD:
            self._read(piece[self.HEAD :], state, lasts)
        end, tokens, out = len(piece), self.vocabulary.tokens, []
        while end:
            token = (lasts[end] >> 32) - 1
            out.append(token)
            end -= len(tokens[token])
        out.reverse()
        return out

    def _read(self, piece: bytes, state: int, lasts: list[int]) -> int:
        """Append the last token (its rank plus one, shifted) after each byte to ``lasts``; returns the state in the end."""
        moves, pairs, end, append = self._moves, self._pairs, len(lasts), lasts.append
        for byte in piece:
            key = state | byte
            try:
                state, outs = moves[key]
            except KeyError:
                state, outs = self._move(key)
            for length, token, last in outs:
                if length > 1:  # of the tokens that may end here one stands, so if no longer one, the byte
                    pair = lasts[end - length] | token
                    try:
                        if not pairs[pair]:
                            continue
                    except KeyError:
                        if not self._stand(pair):
                            continue
                append(last)
                break
            else:
                raise LookupError(piece)
            end += 1
        return state

    def _long(self, piece: bytes) -> list[int]:
        """As the short way, a part at a time: tokens that are certain after a part go out and are forgotten."""
        out, state, lasts = [], self._root, [0]
        for at in range(0, len(piece), _LOOKAHEAD):
            state = self._read(piece[at : at + _LOOKAHEAD], state, lasts)
            # What the walks of all open prefixes share is certain.
            rest, end = self.vocabulary.names[state >> 8], len(lasts) - 1
            walks = [self._walk(lasts, end - len(rest) + j) for j in range(len(rest) + 1) if rest[j:] in self.vocabulary.starts]
            sure = max(set(walks[0]).intersection(*walks[1:]))
            out += self._emit(lasts, [x for x in walks[-1] if x <= sure])
            lasts = lasts[sure:]
        return out + self._emit(lasts, self._walk(lasts, len(lasts) - 1))

    def _walk(self, lasts: list[int], end: int) -> list[int]:
        """The borders of the encoding of the prefix, from its end down."""
        walk, tokens = [end], self.vocabulary.tokens
        while walk[-1] > 0:
            walk.append(walk[-1] - len(tokens[(lasts[walk[-1]] >> 32) - 1]))
        return walk

    def _emit(self, lasts: list[int], walk: list[int]) -> list[int]:
        return [(lasts[end] >> 32) - 1 for end in walk[-2::-1]]


class Utf8Stream:
    """Bytes in, characters out: a sequence cut off at the end waits for its other bytes."""

    def __init__(self) -> None:
        self._open = b""

    def feed(self, data: bytes) -> str:
        data = self._open + data
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                needs = 2 if lead & 0xE0 == 0xC0 else 3 if lead & 0xF0 == 0xE0 else 4 if lead & 0xF8 == 0xF0 else 1
                keep = back if needs > back else 0
                break
        self._open = data[len(data) - keep :] if keep else b""
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")


class _Pieces(dict):
    """The tokens of pieces met lately, four bytes each: those of the last ``most`` new ones, and of as many before."""

    def __init__(self, transducer: Transducer, most: int):
        super().__init__()
        self.transducer, self.most = transducer, most
        self.before: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        found = self.before.get(piece) or array("i", self.transducer.encode(piece.encode())).tobytes()
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[piece] = found
        return found


class Codec:
    """Encoder and decoder over one vocabulary; pieces of up to 64 characters are remembered, at most twice ``max_pieces``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, max_moves: int = 100_000, max_pairs: int = 150_000, max_pieces: int = 150_000):
        self.vocabulary = Vocabulary(ranks)
        self._pieces = _Pieces(Transducer(self.vocabulary, max_moves, max_pairs), max_pieces)
        # White space as Unicode has it; the pattern's library also counts four separators of ASCII.
        self._split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self._border = regex.compile(r"\P{White_Space}(?=\p{White_Space})")
        self._names = [str(rank) for rank in range(len(self.vocabulary.tokens))]

    def encode(self, text: str) -> np.ndarray:
        """Whole texts, a megabyte at a time: before white space that follows something else, every piece ends."""
        out, at = [], 0
        while at < len(text):
            cut = self._border.search(text, at + _PIECE) if len(text) - at > _PIECE else None
            end = cut.end() if cut else len(text)
            pieces = self._split.findall(text[at:end] if at or cut else text)
            out.append(b"".join(map(self._pieces.__getitem__, pieces)))
            at = end
        return np.frombuffer(b"".join(out), np.int32)

    def decoded(self, ids: np.ndarray) -> Iterator[str]:
        """The text in parts, none of them longer than a few hundred thousand characters."""
        stream, tokens = Utf8Stream(), self.vocabulary.tokens
        for at in range(0, len(ids), _CHUNK):
            yield stream.feed(b"".join(map(tokens.__getitem__, ids[at : at + _CHUNK].tolist())))
        yield stream.close()

    def decode(self, ids: np.ndarray) -> str:
        return "".join(self.decoded(ids))

    def digests(self, ids: np.ndarray) -> tuple[str, str]:
        """SHA-256 of the ids, joined by commas, and of the bytes they decode to; nothing is held whole."""
        said, text, names = hashlib.sha256(), hashlib.sha256(), self._names
        for at in range(0, len(ids), _CHUNK):
            said.update((("," if at else "") + ",".join(map(names.__getitem__, ids[at : at + _CHUNK].tolist()))).encode())
        for part in self.decoded(ids):
            text.update(part.encode())
        return said.hexdigest(), text.hexdigest()


_IDLE_S = 3.0


class _Home(types.ModuleType):
    """Where a Python worker keeps its codec, so that a task finds the moves and pieces of earlier ones.

    Code that comes with a query has no globals that outlive its task; modules
    of the worker do. Without another task for a while, the codec's memory is
    given back, as other stages may need it.
    """

    NAME = "_thornwall_codecs"

    def __init__(self) -> None:
        super().__init__(self.NAME)
        self.lock, self.users, self.key, self.codec = threading.Lock(), 0, None, None

    def take(self, key: tuple, make: Callable[[], Codec]) -> Codec:
        with self.lock:
            if self.key != key:
                self.key, self.codec = key, make()
            self.users += 1
            return self.codec

    def leave(self) -> None:
        with self.lock:
            self.users -= 1
        timer = threading.Timer(_IDLE_S, self.drop)
        timer.daemon = True
        timer.start()

    def drop(self) -> None:
        """Nothing happens while a task has the codec: it is its last task's timer that counts."""
        with self.lock:
            if self.users:
                return
            self.key = self.codec = None
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found) if found else np.zeros(0, np.int32), pa.int32()))


def _parts(batch: pa.RecordBatch, sizes: list[int]) -> Iterator[pa.RecordBatch]:
    """Slices of bounded size; a row is never cut."""
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= _BATCH_CHARS:
            yield batch.slice(begin, i + 1 - begin)
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _run(rows: DataFrame, path: str, pattern: str, step, columns: str, max_pieces: int = 150_000) -> DataFrame:
    small_batches(rows)
    ranks = read_ranks(path)
    shared, key = rows.sparkSession.sparkContext.broadcast(ranks), (path, len(ranks), pattern, max_pieces)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home = sys.modules.setdefault(_Home.NAME, _Home())
        codec = home.take(key, lambda: Codec(shared.value, pattern, max_pieces=max_pieces))
        try:
            for batch in batches:
                for part in _parts(batch, _sizes(batch)):
                    found = step(codec, part.column(1))
                    yield pa.RecordBatch.from_arrays([part.column(0), *found.values()], names=["id", *found])
        finally:
            del codec
            home.leave()

    return rows.mapInArrow(run, f"id {kind}, {columns}")


def _sizes(batch: pa.RecordBatch) -> list[int]:
    import pyarrow.compute as pc

    column = batch.column(1)
    of = pc.binary_length(column) if pa.types.is_string(column.type) else pc.list_value_length(column)
    return [x or 0 for x in of.to_pylist()]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the tokens of each row's whole text; null texts have none."""
    rows = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"))
    return _run(rows, path, pattern, lambda codec, texts: {"ids": _lists([codec.encode(t.as_py()) for t in texts])}, "ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text): bytes that are no UTF-8 become the replacement character; null is empty."""
    rows = tokens.select(named(id_col).alias("id"), F.coalesce(named(ids_col), F.array().cast("array<int>")).alias("ids"))

    def step(codec: Codec, lists: pa.ListArray) -> dict[str, pa.Array]:
        return {"text": pa.array([codec.decode(np.array(x.as_py(), np.int64)) for x in lists], pa.string())}

    return _run(rows, path, pattern, step, "text string")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False, max_pieces: int = 150_000) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256), and ``ids`` if asked for: what each row's text is encoded to, and what that decodes to.

    A null text counts as empty; repeated rows and null ids are rows like others,
    further columns are left out. Texts are encoded and decoded whole, in one
    pass, and only their digests leave the worker. ``max_pieces`` bounds what a
    worker remembers (some 400 bytes each): fewer cost time, never a token.
    """
    rows = docs.select(named(id_col).alias("id"), F.coalesce(named(text_col), F.lit("")).alias("text"))

    def step(codec: Codec, texts: pa.Array) -> dict[str, pa.Array]:
        found = [codec.encode(t.as_py()) for t in texts]
        said = [codec.digests(x) for x in found]
        columns = {"n_tokens": pa.array(map(len, found), pa.int64()), "ids_sha256": pa.array([a for a, _ in said], pa.string()), "decoded_sha256": pa.array([b for _, b in said], pa.string())}
        return columns | ({"ids": _lists(found)} if ids else {})

    return _run(rows, path, pattern, step, "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids, max_pieces)
