"""Byte-level BPE encoding and decoding without a regular expression.

Texts are cut where the tokenizer's pattern cuts them. Each code point gets a class; the pattern is a small automaton over
classes, whose transition functions compose associatively. A blocked scan first composes the functions of each block for
every possible state, then scans the blocks' functions, then replays the blocks from their known states, so all texts of
a step are cut together by array operations. The slices are merged once each and kept in a bounded cache. Every token's
byte offset is kept with its id, and decoding copies token bytes to those offsets.

Defined results: a null text counts as empty and has no tokens; empty texts decode to empty bytes; a text of any length is
encoded whole; repeated rows give repeated results; an empty table gives an empty table. Input columns named like an output
column are replaced, all others are kept.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import add_columns, code_points

# Code points with the Unicode property White_Space.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Letters that follow an apostrophe in a contraction, by its length.
ONE_LETTER = ("s", "t", "m", "d")
TWO_LETTERS = ("re", "ve", "ll")

#: Distinct slices kept with their merged ids in each worker; beyond it the cache starts anew, which changes no result.
CACHE_SLICES = 250_000
#: Bytes up to which slices of equal length are merged together; longer ones are merged one by one.
WIDE = 64
#: Code points that a block of the scan holds.
BLOCK = 64

LETTER, NUMBER, OTHER, SPACE, BLANK, SHORT, LONG = range(7)  # symbols; SHORT and LONG are apostrophes of contractions
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_SPACE, AFTER_BLANK, ONE_LEFT, TWO_LEFT = range(8)  # states
SYMBOLS, STATES = 7, 8


@cache
def classes() -> np.ndarray:
    """The symbol of every code point, apostrophes taken as other characters."""
    first = {"L": LETTER, "N": NUMBER}
    out = np.fromiter(
        (first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000
    )
    out[list(WHITE_SPACE)] = BLANK
    out[0x20] = SPACE
    return out


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The state after a code point, and whether a slice begins at it."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return CLOSED, False
    if symbol in (SHORT, LONG):
        if state in (IN_OTHER, AFTER_SPACE):
            return IN_OTHER, False
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    if symbol in (SPACE, BLANK):
        return (AFTER_SPACE if symbol == SPACE else AFTER_BLANK), state not in (AFTER_SPACE, AFTER_BLANK)
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}[symbol]
    return run, state not in (run, AFTER_SPACE)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next state and slice begin, by ``symbol * STATES + state``; symbols from SYMBOLS on begin a text."""
    after, begins = np.zeros((2, 2 * SYMBOLS * STATES), np.uint8)
    for symbol in range(2 * SYMBOLS):
        for state in range(STATES):
            s, b = _step(CLOSED if symbol >= SYMBOLS else state, symbol % SYMBOLS)
            after[symbol * STATES + state] = s
            begins[symbol * STATES + state] = b or symbol >= SYMBOLS
    return after, begins


def _symbols(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Symbols of the code points; ``first`` marks those that begin a text."""
    n = len(codes)
    out = classes()[codes]
    quote = np.flatnonzero(codes == 0x27)
    if len(quote):
        one, two = quote + 1, quote + 2
        in_one = (one < n) & ~first[np.minimum(one, n - 1)]
        a = np.where(in_one, codes[np.minimum(one, n - 1)], 0)
        in_two = in_one & (two < n) & ~first[np.minimum(two, n - 1)]
        b = np.where(in_two, codes[np.minimum(two, n - 1)], 0)
        short = np.isin(a, [ord(c) for c in ONE_LETTER])
        long = np.zeros(len(quote), bool)
        for x, y in TWO_LETTERS:
            long |= (a == ord(x)) & (b == ord(y))
        out[quote[short]] = SHORT
        out[quote[long]] = LONG
    return out


def _states(symbols: np.ndarray) -> np.ndarray:
    """The state before every code point, by a blocked scan over transition functions."""
    after, _ = _tables()
    n = len(symbols)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (blocks, 1))  # each block's function, from the identity
    for column in columns:
        whole = after[column[:, None] * np.uint8(STATES) + whole]
    reach = 1
    while reach < blocks:  # each block's function composed with all before it
        joined = whole.copy()
        joined[reach:] = np.take_along_axis(whole[reach:], whole[:-reach].astype(np.intp), axis=1)
        whole, reach = joined, reach * 2
    state = np.empty(blocks, np.uint8)
    state[0] = CLOSED
    state[1:] = whole[:-1, CLOSED]
    out = np.empty((BLOCK, blocks), np.uint8)
    for i, column in enumerate(columns):
        out[i] = state
        state = after[column * np.uint8(STATES) + state]
    return out.T.reshape(-1)[:n]


def slice_starts(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the slices begin, as places in ``codes``; ``bounds`` are the places of the texts and the end."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    first = np.zeros(n, bool)
    first[bounds[:-1][bounds[:-1] < n]] = True
    symbols = _symbols(codes, first)
    symbols[first] += SYMBOLS
    _, begins = _tables()
    start = begins[symbols * np.uint8(STATES) + _states(symbols)].astype(bool)
    white = np.isin(symbols % SYMBOLS, (SPACE, BLANK))
    # The last white space of several goes with what follows, unless the text ends there.
    last = white[1:-1] & white[:-2] & ~white[2:] & ~first[1:-1] & ~first[2:]
    start[1:-1] |= last
    return np.flatnonzero(start)


@cache
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """All tokens' bytes in order of id, and where each id's bytes begin (one more entry for the end)."""
    ranks = load_ranks(path)
    by_id = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        by_id[i] = token
    return np.frombuffer(b"".join(by_id), np.uint8), np.cumsum([0, *map(len, by_id)])


NO_PAIR = np.int64(1) << 40


@cache
def _pairs(path: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Open-addressing table of token pairs that make a token: keys ``a << 32 | b``, ids, and the longest probe."""
    ranks = load_ranks(path)
    made = [
        (ranks[t[:k]] << 32 | ranks[t[k:]], i)
        for t, i in ranks.items()
        for k in range(1, len(t))
        if t[:k] in ranks and t[k:] in ranks
    ]
    key, value = np.array(made, np.int64).T
    bits = int(len(key) * 4).bit_length()
    keys, ids = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NO_PAIR, np.int64)
    slot, probe = _slot(key, bits), 0
    while len(key):
        probe += 1
        free = keys[slot] < 0
        _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
        put = one[free[one]]
        keys[slot[put]], ids[slot[put]] = key[put], value[put]
        rest = np.ones(len(key), bool)
        rest[put] = False
        key, value, slot = key[rest], value[rest], (slot[rest] + 1) & ((1 << bits) - 1)
    return keys, ids, probe


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    return ((key * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def _look_up(a: np.ndarray, b: np.ndarray, path: str) -> np.ndarray:
    """The id that each pair of ids makes, or NO_PAIR."""
    keys, ids, probe = _pairs(path)
    key = (a << 32 | b).ravel()
    slot = _slot(key, len(keys).bit_length() - 1)
    out = np.where(keys[slot] == key, ids[slot], NO_PAIR)
    open_ = np.flatnonzero((keys[slot] != key) & (keys[slot] >= 0))
    for _ in range(probe - 1):
        if not len(open_):
            break
        slot[open_] = (slot[open_] + 1) & (len(keys) - 1)
        at = keys[slot[open_]]
        hit = at == key[open_]
        out[open_[hit]] = ids[slot[open_[hit]]]
        open_ = open_[~hit & (at >= 0)]
    return out.reshape(a.shape)


def merge_equal(pieces: list[bytes], path: str) -> list[bytes]:
    """Ids of slices of one length, as little-endian 32-bit integers: the first pair of lowest rank is merged until none is left."""
    single = np.array([load_ranks(path)[bytes([i])] for i in range(256)], np.int64)
    ids = single[np.frombuffer(b"".join(pieces), np.uint8).reshape(len(pieces), -1)]
    made = _look_up(ids[:, :-1], ids[:, 1:], path)
    rows = np.arange(len(pieces))
    out: list[bytes] = [b""] * len(pieces)
    while True:
        width = ids.shape[1]
        at = made.argmin(1) if width > 1 else np.zeros(len(ids), np.int64)
        low = made[np.arange(len(ids)), at] if width > 1 else np.full(len(ids), NO_PAIR)
        done = low == NO_PAIR
        if done.any():
            data, step = ids[done].astype("<u4").tobytes(), 4 * width
            for k, row in enumerate(rows[done].tolist()):
                out[row] = data[k * step : k * step + step]
            go = ~done
            ids, made, rows, at, low = ids[go], made[go], rows[go], at[go], low[go]
        if not len(rows):
            return out
        each = np.arange(len(rows))
        ids[each, at] = low
        column = np.arange(width - 1)
        ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
        made = np.take_along_axis(made, column[:-1] + (column[:-1] >= at[:, None]), 1)
        after = np.flatnonzero(at < width - 2)
        made[after, at[after]] = _look_up(low[after], ids[after, at[after] + 1], path)
        before = np.flatnonzero(at > 0)
        made[before, at[before] - 1] = _look_up(ids[before, at[before] - 1], low[before], path)


class Encoder:
    """Encodes arrays of texts; keeps merged slices from one call to the next."""

    def __init__(self, path: str, cache_slices: int = CACHE_SLICES):
        self.path, self.ranks, self.cache_slices = path, load_ranks(path), cache_slices
        self.merged: dict[bytes, bytes] = {}

    def pieces(self, texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """The slices of all texts in order, and how many slices precede each text (one more entry for all)."""
        codes, bounds, raw, byte_at = code_points(texts)
        starts = slice_starts(codes, bounds)
        data, at = raw.tobytes(), byte_at[starts].tolist()
        at.append(len(data))
        return [data[a:b] for a, b in zip(at, at[1:])], np.searchsorted(starts, bounds)

    def __call__(self, texts: pa.Array) -> list[pa.Array]:
        pieces, rows = self.pieces(texts)
        merged, ranks = self.merged, self.ranks
        if len(merged) > self.cache_slices:
            merged.clear()
        by_length: dict[int, list[bytes]] = {}
        for p in set(pieces).difference(merged):
            whole = ranks.get(p)
            if whole is not None:
                merged[p] = whole.to_bytes(4, "little")
            elif len(p) <= WIDE:
                by_length.setdefault(len(p), []).append(p)
            else:
                merged[p] = merge_long(p, ranks)
        for group in by_length.values():
            merged.update(zip(group, merge_equal(group, self.path)))
        packed = [merged[p] for p in pieces]
        ids = np.frombuffer(b"".join(packed), "<u4")
        counts = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
        ends = np.concatenate(([0], np.cumsum(counts)))[rows]
        _, places = _token_bytes(self.path)
        lengths = (places[1:] - places[:-1])[ids]
        offsets = np.cumsum(lengths) - lengths
        first = np.concatenate((offsets, [lengths.sum()]))[ends[:-1]]
        offsets -= np.repeat(first, np.diff(ends))
        n_tokens = np.diff(ends)
        return [pa.array(n_tokens, pa.int64()), _binary(ids, ends), _binary(offsets.astype("<u4"), ends)]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> bytes:
    """As ``merge_equal`` for one slice, with a heap, so that many thousand bytes don't take quadratic time."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = right[i]
        if parts[i] is None or j >= n or parts[j] is None or parts[i] + parts[j] != pair:
            continue
        parts[i], parts[j] = pair, None
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        for a, b in ((left[i], i), (i, right[i])):
            if a >= 0 and b < n and (r := ranks.get(parts[a] + parts[b])) is not None:
                heapq.heappush(heap, (r, a, parts[a] + parts[b]))
    return b"".join([ranks[p].to_bytes(4, "little") for p in parts if p is not None])


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values of 32-bit integers; ``ends`` are their places and the end."""
    return pa.Array.from_buffers(
        pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(values.tobytes())]
    )


def decode_arrays(path: str, ids: np.ndarray, offsets: np.ndarray) -> bytes:
    """The bytes of the tokens, each copied to its offset."""
    if not len(ids):
        return b""
    data, places = _token_bytes(path)
    size = (places[1:] - places[:-1])[ids]
    source = np.repeat(places[ids] - offsets.astype(np.int64), size) + np.arange(int(offsets[-1]) + int(size[-1]))
    return data[source].tobytes()


def decode_columns(ids: pa.Array, offsets: pa.Array, path: str) -> pa.Array:
    return pa.array(
        [
            decode_arrays(path, np.frombuffer(x or b"", "<u4"), np.frombuffer(y or b"", "<u4"))
            for x, y in zip(ids.to_pylist(), offsets.to_pylist())
        ],
        pa.binary(),
    )


DECODED = T.StructField("decoded", T.BinaryType())
ENCODED = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
    T.StructField("offsets", T.BinaryType()),
]


def encode(df: DataFrame, ranks_path: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """``df`` with ``n_tokens``, ``ids`` and ``offsets`` (byte offsets of the tokens), both little-endian unsigned 32-bit integers.

    With ``decoded`` the same worker decodes the ids again, as ``decode`` would, and adds that column too: one Python
    worker for each task then holds what two would.
    """
    if not decoded:
        return add_columns(df, text, ENCODED, None, prepare=lambda: Encoder(ranks_path))

    def prepare():
        encoder = Encoder(ranks_path)

        def both(texts: pa.Array) -> list[pa.Array]:
            made = encoder(texts)
            return [*made, decode_columns(made[1], made[2], ranks_path)]

        return both

    return add_columns(df, text, [*ENCODED, DECODED], None, prepare=prepare)


def decode(df: DataFrame, ranks_path: str, ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """``df`` with ``decoded``, the bytes that ``ids`` stand for; null ids decode to empty bytes."""
    names = [c for c in df.columns if c.lower() != "decoded"]
    inner = df.select(*[df[c].alias(f"c{i}") for i, c in enumerate(names)], df[ids].alias("_ids"), df[offsets].alias("_at"))
    schema = T.StructType([*inner.schema.fields[:-2], DECODED])

    def run(batches):
        for b in batches:
            columns = [b.column(i) for i in range(b.num_columns - 2)]
            made = decode_columns(b.column(b.num_columns - 2), b.column(b.num_columns - 1), ranks_path)
            yield pa.RecordBatch.from_arrays([*columns, made], names=[*b.schema.names[:-2], "decoded"])

    out = inner.mapInArrow(run, schema)
    return out.select(*[out[f"c{i}"].alias(c) for i, c in enumerate(names)], "decoded")
