"""Byte-level BPE encoding and decoding with public rank files.

Texts of a batch are laid end to end as code points. A table gives each its class
(letter, number, space, other white space, apostrophe, other), and class and next
class give one of nine symbols. A pre-tokeniser over these symbols has eight states,
so a symbol is a function from state to state; functions compose associatively, and
composing them in blocks, then over blocks, gives the state before every character
and thereby all token boundaries, without a regular expression. The slices between
boundaries are looked up in a cache; those not seen before are merged together, all
pieces of a batch at once in numpy.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywind.llm.common import ready_for_python, whole_text

LETTER, NUMBER, OTHER, APOSTROPHE, SPACE, WHITE, END = range(7)

# Symbols: what a character is, given what follows it.
_L, _N, _O, _A1, _A2, _SP, _WL, _WS, _E = range(9)
# States: what the character before has left open.
_FRESH, _IN_L, _IN_N, _IN_O, _LED, _IN_WS, _TAKE1, _TAKE2 = range(8)
_STATES = 8


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """`step[symbol, state]`, the next state, and `starts[symbol, state]`, whether a
    token begins at the character.

    LED is a space that belongs to what follows it. TAKE1 and TAKE2 are an apostrophe
    at the start of a token with one or two letters of a contraction to come.
    """
    step = np.zeros((9, _STATES), np.uint8)
    starts = np.ones((9, _STATES), bool)
    for symbol, run in ((_L, _IN_L), (_N, _IN_N), (_O, _IN_O), (_A1, _IN_O), (_A2, _IN_O)):
        step[symbol] = run
        starts[symbol, [run, _LED]] = False
    for symbol, take in ((_A1, _TAKE1), (_A2, _TAKE2)):
        step[symbol, starts[symbol]] = take
    step[_L, _TAKE1], step[_L, _TAKE2] = _FRESH, _TAKE1
    starts[_L, [_TAKE1, _TAKE2]] = False
    step[_SP] = _LED
    step[_WL] = _FRESH
    step[_WS] = _IN_WS
    starts[_WS, _IN_WS] = False
    step[_E] = _FRESH
    return step, starts


_STEP, _STARTS = _automaton()


@cache
def class_table() -> np.ndarray:
    """The class of every code point. Which are letters, numbers and white space is
    asked of the library whose results are to be met, once per process: a splitter
    that keeps only the class leaves only its characters."""
    points = np.concatenate((np.arange(0xD800), np.arange(0xE000, 0x110000))).astype("<u4")
    everything = points.tobytes().decode("utf-32-le")
    alone = {bytes([k]): k for k in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        keep = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=alone, special_tokens={})
        kept = bytes(keep.encode_ordinary(everything)).decode()
        table[np.frombuffer(kept.encode("utf-32-le"), "<u4")] = kind
    table[ord(" ")], table[ord("'")] = SPACE, APOSTROPHE
    return table


_ONE = np.zeros(128, bool)
_ONE[[ord(c) for c in "stmd"]] = True


def _symbols(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    following = np.append(classes[1:], END)
    blank = (classes == SPACE) | (classes == WHITE)
    before_ink = ~np.isin(following, (SPACE, WHITE, END))
    symbols = np.array([_L, _N, _O, _O, _SP, _WL, _E], np.uint8)[classes]
    symbols[blank & ~before_ink] = _WS
    at = np.flatnonzero(classes == APOSTROPHE)
    if len(at):
        padded = np.concatenate((points, np.zeros(2, points.dtype)))
        first, second = padded[at + 1], padded[at + 2]
        small = np.where(first < 128, first, 0)
        symbols[at[_ONE[small]]] = _A1
        two = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e"))
        two |= (first == ord("l")) & (second == ord("l"))
        symbols[at[two]] = _A2
    return symbols


_BLOCK = 64


def token_starts(symbols: np.ndarray) -> np.ndarray:
    """Whether a token begins at each symbol, by a scan over composed functions."""
    n = len(symbols)
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, _E, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)
    flat = _STEP.ravel()
    # 1. the function of each block: where each state ends up after 64 symbols
    through = np.tile(np.arange(_STATES, dtype=np.uint8), (blocks, 1))
    for column in columns:
        through = flat[(column.astype(np.uint16)[:, None] << 3) + through]
    # 2. functions of blocks composed with those before them, by doubling
    gap = 1
    while gap < blocks:
        earlier = through[:-gap]
        through[gap:] = np.take_along_axis(through[gap:], earlier.astype(np.intp), axis=1)
        gap *= 2
    # 3. the state before each block is known; walk all blocks side by side
    state = np.concatenate(([_FRESH], through[:-1, _FRESH])).astype(np.uint16)
    begins = np.empty((_BLOCK, blocks), bool)
    open_at = _STARTS.ravel()
    for k, column in enumerate(columns):
        place = (column.astype(np.uint16) << 3) + state
        begins[k] = open_at[place]
        state = flat[place].astype(np.uint16)
    return begins.T.ravel()[:n]


def slices(texts: list[str]) -> Iterator[list[bytes]]:
    """The pieces of each text, as UTF-8. Texts are laid end to end, each followed by
    an end symbol that leaves nothing open."""
    if not texts:
        return
    table = class_table()
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    classes = table[points]
    ends = np.cumsum(lengths + 1) - 1
    classes[ends] = END
    begins = token_starts(_symbols(points, classes))
    raw = joined.encode("utf-8", "surrogatepass")
    if len(raw) == len(points):
        places = np.flatnonzero(begins)
        marks = ends
    else:
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.cumsum(width) - width
        places = offsets[begins]
        marks = offsets[ends]
    last = np.searchsorted(places, marks)
    cuts = places.tolist()
    at = 0
    for stop in last.tolist():
        yield [raw[a:b] for a, b in zip(cuts[at:stop], cuts[at + 1 : stop + 1], strict=True)]
        at = stop + 1


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Merges and vocabulary of one rank file.

    The cache has two generations of bounded size: a full one becomes the old one, in
    place of the one before, and pieces that are met again move to the new one.
    """

    CACHE = 100_000
    LONG = 48
    NEVER = np.iinfo(np.int64).max

    def __init__(self, ranks: bytes):
        self.ranks = {
            base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)
        }
        size = max(self.ranks.values()) + 1
        self.size = size
        words: list[bytes] = [b""] * size
        for word, rank in self.ranks.items():
            words[rank] = word
        self.words = words
        self.widths = np.fromiter(map(len, words), np.int64, size)
        self.first = np.cumsum(self.widths) - self.widths
        self.letters = np.frombuffer(b"".join(words), np.uint8)
        self.of_byte = np.array([self.ranks[bytes([k])] for k in range(256)], np.int64)
        keys, merged = [], []
        for word, rank in self.ranks.items():
            for cut in range(1, len(word)):
                left, right = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if left is not None and right is not None:
                    keys.append(left * size + right)
                    merged.append(rank)
        self._tabulate(np.array(keys, np.int64), np.array(merged, np.int64))
        self.pairs = dict(zip(keys, merged, strict=True))
        self.cache: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    SLOTS = 20

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def _tabulate(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Pairs and what they merge to in an open-addressed table: each round puts
        one of the keys that want a slot there, and the others try the next."""
        size = 1 << self.SLOTS
        self.keys = np.full(size, -1, np.int64)
        self.merged = np.full(size, self.NEVER, np.int64)
        at, self.probes = self._slot(keys), 0
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            put = self.keys[at] == keys
            self.merged[at[put]] = merged[put]
            keys, merged, at = keys[~put], merged[~put], (at[~put] + 1) & (size - 1)
            self.probes += 1

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges to, which is its rank too."""
        wanted = left * self.size + right
        at = self._slot(wanted)
        found = np.where(self.keys[at] == wanted, self.merged[at], self.NEVER)
        open_ = np.flatnonzero((self.keys[at] != wanted) & (self.keys[at] >= 0))
        for _ in range(1, self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.SLOTS) - 1)
            here = self.keys[at[open_]]
            hit = here == wanted[open_]
            found[open_[hit]] = self.merged[at[open_[hit]]]
            open_ = open_[~hit & (here >= 0)]
        return found

    def _merge_long(self, piece: bytes) -> list[int]:
        """One piece with a heap: n log n for a piece of n bytes."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, size = self.pairs, self.size
        heap = []
        for k in range(n - 1):
            rank = pairs.get(ids[k] * size + ids[k + 1])
            if rank is not None:
                heap.append((rank, k, ids[k], ids[k + 1]))
        heapq.heapify(heap)
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            j = after[k]
            if ids[k] != left or j >= n or ids[j] != right:
                continue
            ids[k], ids[j] = rank, -1
            after[k] = after[j]
            if after[k] < n:
                before[after[k]] = k
                found = pairs.get(rank * size + ids[after[k]])
                if found is not None:
                    heapq.heappush(heap, (found, k, rank, ids[after[k]]))
            if before[k] >= 0:
                b = before[k]
                found = pairs.get(ids[b] * size + rank)
                if found is not None:
                    heapq.heappush(heap, (found, b, ids[b], rank))
        return [t for t in ids if t >= 0]

    def _merge_together(self, pieces: list[bytes]) -> None:
        """Short pieces side by side: each round merges the lowest, leftmost pair of
        every piece that still has one."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), lengths)
        active = np.arange(len(pieces))
        # rank[k] is that of the pair at k and k + 1, NEVER at the end of a piece
        rank = np.full(len(ids), self.NEVER)
        rank[:-1] = self._rank(ids[:-1], ids[1:])
        rank[np.cumsum(lengths) - 1] = self.NEVER
        while len(active):
            starts = np.flatnonzero(np.append(True, piece[1:] != piece[:-1]))
            least = np.minimum.reduceat(rank, starts)
            done = least == self.NEVER
            if done.any():
                widths = np.diff(np.append(starts, len(ids)))
                final = ids.astype("<u4").tobytes()
                for which, s, w in zip(
                    active[done].tolist(), starts[done].tolist(), widths[done].tolist(), strict=True
                ):
                    self.cache[pieces[which]] = final[4 * s : 4 * (s + w)]
                keep = np.repeat(~done, widths)
                ids, rank = ids[keep], rank[keep]
                active, least, widths = active[~done], least[~done], widths[~done]
                if not len(active):
                    return
                piece = np.repeat(np.arange(len(active)), widths)
            at = np.flatnonzero(rank == least[piece])
            at = at[np.append(True, piece[at[1:]] != piece[at[:-1]])]
            ids[at] = rank[at]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at = at - np.arange(len(at))  # one id has gone before each, of the pieces before
            ids, piece, rank = ids[keep], piece[keep], rank[keep]
            inside = at[at + 1 < len(ids)]
            inside = inside[piece[inside] == piece[inside + 1]]
            rank[at] = self.NEVER
            rank[inside] = self._rank(ids[inside], ids[inside + 1])
            before = at[at > 0] - 1
            before = before[piece[before] == piece[before + 1]]
            rank[before] = self._rank(ids[before], ids[before + 1])

    def learn(self, pieces: set[bytes]) -> None:
        """Put the ids of these pieces into the cache."""
        if len(self.cache) > self.CACHE:
            self.old, self.cache = self.cache, {}
        short = []
        for p in pieces.difference(self.cache):
            known = self.old.get(p)
            if known is not None:
                self.cache[p] = known
                continue
            whole = self.ranks.get(p)
            if whole is not None:
                self.cache[p] = whole.to_bytes(4, "little")
            elif len(p) > self.LONG:
                self.cache[p] = np.array(self._merge_long(p), "<u4").tobytes()
            else:
                short.append(p)
        if short:
            self._merge_together(short)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        cut = list(slices(texts))
        self.learn(set().union(*cut))
        of = self.cache.__getitem__
        return [b"".join(map(of, pieces)) for pieces in cut]

    def ends(self, ids: bytes) -> bytes:
        """Where each token ends in the text's UTF-8, as unsigned 32-bit integers."""
        return np.cumsum(self.widths[np.frombuffer(ids, "<u4")]).astype("<u4").tobytes()

    def decode(self, ids: bytes, ends: bytes) -> bytes:
        """The text's bytes: every token's letters copied to its offsets."""
        tokens = np.frombuffer(ids, "<u4").astype(np.int64)
        if not len(tokens):
            return b""
        stops = np.frombuffer(ends, "<u4").astype(np.int64)
        widths = np.diff(stops, prepend=0)
        source = np.repeat(self.first[tokens] - (stops - widths), widths)
        source += np.arange(stops[-1])
        return self.letters[source].tobytes()


@cache
def _codec(ranks: bytes) -> Codec:
    return Codec(ranks)


#: Characters laid end to end at once; a longer text goes alone.
CHUNK = 500_000


def _chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > CHUNK:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def _binary(name: str) -> T.StructField:
    return T.StructField(name, T.BinaryType())


def _with_columns(batch: pa.RecordBatch, drop: tuple[str, ...], made: dict[str, list[bytes]]):
    """The batch without some columns and with new binary ones."""
    kept = {n: batch.column(n) for n in batch.schema.names if n not in drop}
    return pa.RecordBatch.from_pydict(kept | {n: pa.array(v, pa.binary()) for n, v in made.items()})


def tokenize(
    docs: DataFrame,
    ranks_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    decode: bool = False,
) -> DataFrame:
    """`doc_id`, the columns to carry, `ids`, `ends` and `n_tokens` for every row: the
    ids as little-endian unsigned 32-bit integers, and likewise where each token ends
    in the text's UTF-8; with `decode` also `decoded`, the bytes that these give back.

    A null text is an empty one and has no tokens; so has an empty text. Texts are
    encoded whole and alone: no token spans two of them. Repeated rows are encoded
    alike; an empty table gives no rows. The rank file is read once, on the driver, and
    sent to the tasks. Memory is bounded by an Arrow batch of texts, the results of a
    chunk of it, or of the longest text, and the cache.
    """
    ready_for_python(docs)
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), *[F.col(c) for c in carry], whole_text(text).alias("_text")
    )
    made = ("ids", "ends", *(["decoded"] if decode else []))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            at = 0
            for texts in _chunks(t.as_py() for t in batch.column("_text")):
                ids = codec.encode(texts)
                found = {"ids": ids, "ends": [codec.ends(i) for i in ids]}
                if decode:
                    found["decoded"] = [
                        codec.decode(i, e) for i, e in zip(ids, found["ends"], strict=True)
                    ]
                yield _with_columns(batch.slice(at, len(texts)), ("_text",), found)
                at += len(texts)

    schema = T.StructType(rows.drop("_text").schema.fields + [_binary(n) for n in made])
    return rows.mapInArrow(encode, schema).withColumn(
        "n_tokens", (F.length("ids") / 4).cast("long")
    )


def detokenize(tokens: DataFrame, ranks_path: str) -> DataFrame:
    """The columns of `tokens` and `decoded`, the bytes of each text, from ids and
    retained offsets."""
    ready_for_python(tokens)
    shared = tokens.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in batches:
            pairs = zip(batch.column("ids"), batch.column("ends"), strict=True)
            yield _with_columns(
                batch, (), {"decoded": [codec.decode(i.as_py(), e.as_py()) for i, e in pairs]}
            )

    schema = T.StructType(tokens.schema.fields + [_binary("decoded")])
    return tokens.mapInArrow(decode, schema)
