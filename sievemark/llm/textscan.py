"""Vectorised scanning of UTF-8 text held in Arrow buffers.

A batch of texts is one byte array plus offsets. Words, lines and shingles are
found for the whole batch with numpy, so no Python code runs per word. Every
text is read to its end; batches are cut between texts only. What a scan holds
beside the texts is a few times a chunk, as batches are taken in chunks and
spans are hashed in pieces: a text longer than a chunk is one by itself, and
needs about nine bytes a byte of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

CHUNK_BYTES = 256 << 10
#: Bytes that span_hash sums up at a time.
PIECE = 64 << 10

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 2**64))
_LANE = _rng.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**i (or its inverse) modulo 2**64 for i < n, kept between calls."""
    name = "inv" if inverse else "pow"
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        table = np.full(size, _BASE_INV if inverse else _BASE, dtype=np.uint64)
        table[0] = 1
        have = _powers[name] = np.cumprod(table, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every bit of a 64-bit hash."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _table(word: bool, *spans: tuple[int, int]) -> np.ndarray:
    t = np.full(256, not word)
    for lo, hi in spans:
        t[lo : hi + 1] = word
    return t


#: Letters, digits and everything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after folding A-Z.
ALNUM = _table(True, (0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Everything but [\x20\x09-\x0D].
NONBLANK = _table(False, (0x20, 0x20), (0x09, 0x0D))
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 32


class Texts:
    """Consecutive texts as bytes: data, and offsets with one more entry than texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int = 0):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def whole(column: pa.Array) -> Texts:
    """All texts of a string column; null reads as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if n == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offs, body = column.buffers()
    offsets = np.frombuffer(offs, kind, n + 1 + column.offset)[column.offset :].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def bounded(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in runs of about size bytes of a column, so that what comes of a run is small too."""
    for batch in batches:
        if not batch.num_rows:
            yield batch
            continue
        kind = batch.column(column).type
        if not (pa.types.is_string(kind) or pa.types.is_binary(kind) or pa.types.is_large_string(kind) or pa.types.is_large_binary(kind)):
            raise TypeError(f"column {column} is no text: {kind}")
        offsets = whole(batch.column(column)).offsets
        at, n = 0, batch.num_rows
        while at < n:
            to = min(n, max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1))
            yield batch.slice(at, to - at)
            at = to


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a column in runs of about size bytes; a longer text is a run of its own."""
    t = whole(column)
    at, n = 0, len(t)
    while at < n:
        to = int(np.searchsorted(t.offsets, t.offsets[at] + size, "right")) - 1
        to = min(n, max(at + 1, to))
        lo, hi = t.offsets[at], t.offsets[to]
        yield Texts(t.data[lo:hi], t.offsets[at : to + 1] - lo, at)
        at = to


class Runs:
    """Maximal runs of bytes of a class: start, end (bytes) and the text each is in."""

    def __init__(self, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray, n_docs: int):
        self.starts, self.ends, self.doc = starts, ends, doc
        self.bounds = np.searchsorted(doc, np.arange(n_docs + 1))

    def __len__(self) -> int:
        return len(self.starts)


def words(t: Texts, table: np.ndarray) -> Runs:
    n = len(t.data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return Runs(z, z, z, len(t))
    inside = table[t.data]
    first = np.zeros(n + 1, bool)
    first[t.offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return Runs(starts, ends, np.searchsorted(t.offsets, starts, "right") - 1, len(t))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit rolling hash of data[start:end] for each pair; starts ascend.

    For spans that overlap, and for filters in front of a comparison of bytes: texts that agree in it can be written
    down (long words of two letters in the Thue-Morse order), as for any sum of powers modulo 2**64. Where equal
    hashes decide, word_hash is to be taken. The spans that start in one piece of the data are hashed from sums over it and
    what they reach beyond it; one that reaches far is summed by itself.
    """
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        base = int(starts[lo])
        hi = lo + int(np.searchsorted(starts[lo:], base + PIECE))
        own, far = ends[lo:hi], ends[lo:hi] > base + 2 * PIECE
        if far.any():
            for i in np.flatnonzero(far).tolist():
                out[lo + i] = _long_sum(data[starts[lo + i] : own[i]])
            own = np.where(far, starts[lo:hi], own)
        stop = int(own.max())
        total = np.zeros(stop - base + 1, np.uint64)
        np.multiply(_BYTE_CODE[data[base:stop]], powers(stop - base), out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        begin = starts[lo:hi] - base
        sums = (total[own - base] - total[begin]) * powers(PIECE, True)[begin]
        out[lo:hi] = np.where(far, out[lo:hi], sums) if far.any() else sums
        lo = hi
    return mix(out + (ends - starts).astype(np.uint64))


def _long_sum(data: np.ndarray) -> np.uint64:
    """Sum of the byte codes times base**place, piece by piece."""
    total, lead = 0, 1
    for at in range(0, len(data), PIECE):
        own = data[at : at + PIECE]
        total += lead * int((_BYTE_CODE[own] * powers(len(own))).sum(dtype=np.uint64))
        lead = lead * pow(int(_BASE), len(own), 2**64) % 2**64
    return np.uint64(total % 2**64)


#: For each number of bytes from 0 to 8, what keeps them of a little-endian load.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each pair that is no sum of its bytes: words by two loads, longer spans by XXH3."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    short = np.flatnonzero(size <= 16)
    loads = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(16, np.uint8)]), 8)
    load = lambda at, n: np.ascontiguousarray(loads[at]).view("<u8").ravel() & _KEEP[n]
    n = size[short]
    low, high = load(starts[short], np.minimum(n, 8)), load(starts[short] + np.minimum(n, 8), np.maximum(n - 8, 0))
    out[short] = mix(mix(low + _LANE[0]) ^ mix(high + _LANE[1]) * _LANE[2] ^ n.astype(np.uint64))
    for i in np.flatnonzero(size > 16).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes(), 7)
    return out


def shingles(h: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every k consecutive words of one text, and the index of the first word."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    total = h[at] * _LANE[0]
    for j in range(1, k):
        total = total + h[at + j] * _LANE[j]
    return mix(total + np.uint64(k)), at


def sequence_hash(h: np.ndarray) -> np.uint64:
    """The shingle hash of a whole sequence of at most 63 words."""
    return shingles(h, np.zeros(len(h), np.int8), len(h))[0][0]


def groups(labels: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each stretch of equal labels."""
    if len(labels):
        cuts = np.append(np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(labels)).tolist()
        yield from zip([0, *cuts[:-1]], cuts, strict=True)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
