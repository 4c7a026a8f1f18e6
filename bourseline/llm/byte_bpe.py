"""Byte-level BPE encoding and decoding without a regular expression engine.

Pre-tokenisation works on arrays. Every code point becomes a symbol: its class
(letter, number, white space, other) plus what the next code points say about it. A
symbol is a transition function on eight states; functions compose associatively, so
the state before every code point comes from a blocked prefix scan over a table of
composed functions. Where the next symbol opens a piece, a slice begins. Slices go
through a cache to the pair merging; ids and byte offsets are kept for decoding.

Cases: a null text is an empty text (no ids, no bytes); rows may repeat and stay;
an empty table gives an empty result; only the two named columns are read, so extra
columns cannot clash; texts of any length are scanned in blocks that hand on their
state, and slices of any length are merged with a heap.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1 << 18  # code points scanned at a time
CACHED = 150_000  # slices a worker keeps before it starts anew
LONGEST_CACHED = 64  # code points

# The white space of Unicode, as the published split pattern means it.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The contractions of the published split pattern.
SHORT = "stmd"
LONG = ["re", "ve", "ll"]

# The letters and numbers that Unicode 16.0, the version of the published encoders, has over 15.1, the
# version of Python 3.13's tables.
LETTERS_OF_16 = """1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7
    113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"""
NUMBERS_OF_16 = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"

LETTER, NUMBER, OTHER, GAP = 0, 1, 2, 3
# Symbols beyond the classes: an apostrophe before a contraction of one or two
# letters, the last blank or other white space of a run, white space before more
# white space or the end, and the border between two texts.
TICK1, TICK2, LAST_BLANK, LAST_GAP, MORE_GAP, BORDER = 3, 4, 5, 6, 7, 8

# States: what the code point before has left open.
FRESH, BLANK, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, TAKE1, TAKE2 = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after the symbol, and whether a piece begins at it."""
    if symbol == LETTER:
        if state in (TAKE1, TAKE2):
            return (FRESH if state == TAKE1 else TAKE1), False
        return IN_LETTERS, state not in (IN_LETTERS, BLANK)
    if symbol == NUMBER:
        return IN_NUMBERS, state not in (IN_NUMBERS, BLANK)
    if symbol in (OTHER, TICK1, TICK2):
        if state in (IN_OTHERS, BLANK):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, TICK1: TAKE1, TICK2: TAKE2}[symbol], True
    if symbol == LAST_BLANK:
        return BLANK, True
    if symbol == LAST_GAP:
        return FRESH, True
    if symbol == MORE_GAP:
        return IN_GAP, state != IN_GAP
    return FRESH, False


@lru_cache(maxsize=1)
def _machine() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that symbols compose to: (applied to a state, composed with another, opens a piece)."""
    functions = [tuple(_step(s, y)[0] for s in range(8)) for y in range(9)]
    functions.append(tuple(range(8)))  # the identity, to fill up a block
    known = {}
    for f in functions:
        known.setdefault(f, len(known))
    pending = list(known)
    generators = list(known)
    while pending:
        f = pending.pop()
        for g in generators:
            h = tuple(g[f[s]] for s in range(8))
            if h not in known:
                known[h] = len(known)
                pending.append(h)
    every = list(known)
    composed = np.array([[known[tuple(g[f[s]] for s in range(8))] for g in every] for f in every], dtype=np.uint8 if len(every) < 256 else np.uint16)
    opens = np.array([[_step(s, y)[1] for y in range(9)] for s in range(8)])
    ids = np.array([known[f] for f in functions], dtype=composed.dtype)
    return np.array(every, dtype=np.uint8), composed, opens, ids


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of every code point, by Unicode 16.0."""
    if unicodedata.unidata_version not in ("15.1.0", "16.0.0"):
        raise RuntimeError(f"classes of Unicode 16.0 cannot be made from tables of {unicodedata.unidata_version}")
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for spans, kind in ((LETTERS_OF_16, LETTER), (NUMBERS_OF_16, NUMBER)):
        for span in spans.split():
            first, _, last = span.partition("-")
            out[int(first, 16) : int(last or first, 16) + 1] = kind
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE] = GAP
    return out


def _symbols(codes: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    """Symbols of `codes`; `ahead` holds the two code points after them (-1: the end)."""
    wide = np.concatenate([codes, ahead])
    kinds = np.append(_classes()[np.maximum(wide, 0)], GAP)
    kinds[np.flatnonzero(wide < 0)] = GAP
    n = len(codes)
    symbols = kinds[:n].copy()
    gaps = np.flatnonzero(symbols == GAP)
    last = kinds[gaps + 1] != GAP
    symbols[gaps] = np.where(last, np.where(codes[gaps] == 0x20, LAST_BLANK, LAST_GAP), MORE_GAP)
    ticks = np.flatnonzero(codes == 0x27)
    if len(ticks):
        first, second = wide[ticks + 1], wide[np.minimum(ticks + 2, n + 1)]
        symbols[ticks[np.isin(first, [ord(c) for c in SHORT])]] = TICK1
        for a, b in LONG:
            symbols[ticks[(first == ord(a)) & (second == ord(b))]] = TICK2
    symbols[codes < 0] = BORDER
    return symbols


def _states(functions: np.ndarray, composed: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition: blocks side by side first, then the blocks' totals by the same rule."""
    n = len(functions)
    if n <= 64:
        out = functions.copy()
        for i in range(1, n):
            out[i] = composed[out[i - 1], out[i]]
        return out
    width = 64
    rows = -(-n // width)
    identity = _machine()[3][9]
    grid = np.full(rows * width, identity, dtype=functions.dtype)
    grid[:n] = functions
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)  # one column of the block per line
    k = composed.shape[0]
    flat = composed.ravel()
    for j in range(1, width):
        grid[j] = flat[grid[j - 1].astype(np.intp) * k + grid[j]]
    before = np.empty(rows, dtype=functions.dtype)
    before[0] = identity
    before[1:] = _states(grid[-1], composed)[:-1]
    grid = flat[before.astype(np.intp)[None, :] * k + grid]
    return grid.T.reshape(-1)[:n]


def piece_starts(codes: np.ndarray, state: int = FRESH, ahead: np.ndarray | None = None) -> tuple[np.ndarray, int]:
    """Positions in `codes` where a piece begins (code points below 0 are borders), and the state after them."""
    if not len(codes):
        return np.empty(0, dtype=np.int64), state
    applied, composed, opens, ids = _machine()
    symbols = _symbols(codes, np.array([-1, -1], dtype=np.int64) if ahead is None else ahead)
    after = applied[_states(ids[symbols], composed), state]
    before = np.empty_like(after)
    before[0] = state
    before[1:] = after[:-1]
    return np.flatnonzero(opens[before, symbols]), int(after[-1])


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<i4")


def pieces(texts: list[str]) -> list[list[str]]:
    """The pieces of each text."""
    out: list[list[str]] = []
    for group in _grouped(texts):
        if len(group) == 1 and len(group[0]) > BLOCK:
            out.append(_pieces_of_long(group[0]))
            continue
        # A border after each text: -1 is no code point, so it cannot stand in a text.
        codes = np.concatenate([x for t in group for x in (_code_points(t), np.array([-1], dtype="<i4"))]) if group else np.empty(0, dtype="<i4")
        starts, _ = piece_starts(codes.astype(np.int64))
        ends = np.cumsum([len(t) + 1 for t in group])
        cuts = np.searchsorted(starts, ends)
        low = 0
        for t, end, cut in zip(group, ends.tolist(), cuts.tolist()):
            own = (starts[low:cut] - (end - len(t) - 1)).tolist()
            out.append([t[a:b] for a, b in zip(own, itertools.chain(own[1:], [len(t)]))])
            low = cut
    return out


def _grouped(texts: list[str]) -> Iterator[list[str]]:
    group: list[str] = []
    size = 0
    for t in texts:
        if group and size + len(t) > BLOCK:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t) + 1
    if group:
        yield group


def _pieces_of_long(text: str) -> list[str]:
    state, found = FRESH, []
    for at in range(0, len(text), BLOCK):
        part = _code_points(text[at : at + BLOCK + 2]).astype(np.int64)
        codes, ahead = part[:BLOCK], np.append(part[BLOCK:], [-1, -1])[:2]
        starts, state = piece_starts(codes, state, ahead)
        found.append(starts + at)
    own = np.concatenate(found).tolist()
    return [text[a:b] for a, b in zip(own, itertools.chain(own[1:], [len(text)]))]


class Vocabulary:
    """Ranks of byte sequences, with pair merging through a cache."""

    def __init__(self, path: str) -> None:
        self.ranks: dict[bytes, int] = {}
        with open(path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.cache: dict[str, bytes] = {}
        size = max(self.ranks.values()) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        by_rank: list[bytes] = [b""] * size
        for token, rank in self.ranks.items():
            by_rank[rank] = token
            self.lengths[rank] = len(token)
        self.joined = np.frombuffer(b"".join(by_rank), dtype=np.uint8)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def merge(self, raw: bytes) -> list[int]:
        """Merge the pair of the lowest rank, leftmost first, until no pair has a rank."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return [whole]
        if len(raw) <= LONGEST_CACHED:
            return self._merge_short(raw)
        ranks, n = self.ranks, len(raw)
        end = list(range(1, n + 1))  # end[i]: where the part that begins at i ends
        prior = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(raw[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            alive[j] = 0
            end[i] = stop
            if stop < n:
                prior[stop] = i
                if (r := ranks.get(raw[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if prior[i] >= 0 and (r := ranks.get(raw[prior[i] : stop])) is not None:
                heapq.heappush(heap, (r, prior[i], stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[raw[i : end[i]]])
            i = end[i]
        return out

    def _merge_short(self, raw: bytes) -> list[int]:
        """The same by plain search, which is quicker for short slices."""
        rank = self.ranks.get
        none = len(self.lengths)
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [rank(raw[i : i + 2], none) for i in range(len(raw) - 1)]
        while pairs and (lowest := min(pairs)) < none:
            i = pairs.index(lowest)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return [self.ranks[x] for x in parts]

    def encode(self, slices: list[str]) -> np.ndarray:
        """Ids of a text's slices."""
        cache, packed = self.cache, []
        for s in slices:
            ids = cache.get(s)
            if ids is None:
                ids = np.array(self.merge(s.encode("utf-8")), dtype="<u4").tobytes()
                if len(s) <= LONGEST_CACHED:
                    if len(cache) >= CACHED:
                        cache.clear()
                    cache[s] = ids
            packed.append(ids)
        return np.frombuffer(b"".join(packed), dtype="<u4")

    def offsets(self, ids: np.ndarray) -> np.ndarray:
        """Where each id's bytes begin, and at last where they all end."""
        out = np.zeros(len(ids) + 1, dtype=np.int64)
        np.cumsum(self.lengths[ids], out=out[1:])
        return out

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of the ids, placed by their offsets."""
        out = []
        for at in range(0, len(ids), BLOCK):
            some = ids[at : at + BLOCK]
            own = offsets[at : at + len(some) + 1]
            shift = np.repeat(self.begins[some] - own[:-1], np.diff(own))
            out.append(self.joined[shift + np.arange(own[0], own[-1])].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: `key`, `ids` (little-endian unsigned 32-bit integers) and `offsets`
    (little-endian 64-bit: the byte each id begins at, then the length in bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in sliced(batch, 1):
                ids, offsets = [], []
                for slices in pieces([t or "" for t in part.column(1).to_pylist()]):
                    own = words.encode(slices)
                    ids.append(own.tobytes())
                    offsets.append(words.offsets(own).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())], names=[key, "ids", "offsets"]
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids binary, offsets binary")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """`encoded` with the column `bytes`, which its ids and offsets stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            for part in sliced(batch, 1):
                raw = [
                    words.decode(np.frombuffer(i or b"", dtype="<u4"), np.frombuffer(o or bytes(8), dtype="<i8"))
                    for i, o in zip(part.column(1).to_pylist(), part.column(2).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(raw, pa.binary())], names=[key, "ids", "offsets", "bytes"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids", "offsets").mapInArrow(run, f"`{key}` {kind}, ids binary, offsets binary, bytes binary")


def sliced(batch: pa.RecordBatch, column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in parts whose values of one column hold about `most` bytes, or one longer value."""
    import pyarrow.compute as pc

    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    total = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, base + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
