"""Many patterns looked up in texts at once: one pass over the texts for each length of pattern.

The patterns' rolling hashes, made in tasks, go to every task, which puts a bitmap in front of them. A batch of texts is one array of
characters, and the hashes of all its windows come from one running sum; those that the bitmap and then the sorted
hashes know leave the task as windows with their places. Whether a window is a pattern is decided by a join on its letters.
The patterns' letters never come to the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.graph import written

#: Characters that are summed up at a time.
PIECE = 1 << 18
#: Bytes of patterns' hashes that one pass over the texts looks up, and those of one with its share of the bitmap.
PASS_BYTES, HASH_BYTES = 64 << 20, 40

_BASE = 0xD1342543DE82EF95
_POWERS = np.full(PIECE + 1, _BASE, np.uint64)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS, dtype=np.uint64)
_INVERSE = np.full(PIECE + 1, pow(_BASE, -1, 2**64), np.uint64)
_INVERSE[0] = 1
_INVERSE = np.cumprod(_INVERSE, dtype=np.uint64)


def letters(text: str) -> np.ndarray:
    """The text's characters as numbers, a-z as A-Z."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where((c >= 97) & (c <= 122), c - 32, c)


def window_hashes(c: np.ndarray, size: int) -> np.ndarray:
    """A hash of every window of `size` characters of c, which has PIECE at most."""
    if len(c) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(c) + 1, np.uint64)
    np.cumsum(_mixed(c) * _POWERS[: len(c)], out=total[1:])
    return _spread((total[size:] - total[:-size]) * _INVERSE[: len(c) - size + 1])


def _mixed(c: np.ndarray) -> np.ndarray:
    m = (c.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    return m ^ (m >> np.uint64(33))


def _spread(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def pattern_hashes(patterns: list[str], size: int) -> np.ndarray:
    """A hash of every pattern, of `size` characters each, as window_hashes has it."""
    if size > PIECE // 2:
        raise ValueError(f"patterns have at most {PIECE // 2} characters")
    step = max(1, PIECE // size)
    runs = (patterns[at : at + step] for at in range(0, len(patterns), step))
    return np.concatenate([_spread(_mixed(letters("".join(run)).reshape(len(run), size)) @ _POWERS[:size]) for run in runs])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Patterns (window) -> (size, hash)."""
    for batch in batches:
        by: dict[int, list[str]] = {}
        for w in batch.column("window").to_pylist():
            by.setdefault(len(w), []).append(w)
        for size, own in by.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), size, np.int32)), pa.array(pattern_hashes(own, size).view(np.int64))], names=["size", "hash"])


class _Known:
    """The patterns of one length, given as such or as their hashes: a bitmap of the hashes' first bits, and the hashes in order."""

    def __init__(self, patterns: list[str] | np.ndarray, size: int):
        self.size = size
        self.hashes = np.unique(patterns if isinstance(patterns, np.ndarray) else pattern_hashes(patterns, size))
        self.shift = np.uint64(64 - max(16, (16 * len(self.hashes)).bit_length()))

    @functools.cached_property
    def bits(self) -> np.ndarray:
        """Made where it is used, not sent there."""
        bits = np.zeros(1 << (64 - int(self.shift)), bool)
        bits[(self.hashes >> self.shift).astype(np.int64)] = True
        return bits

    def places(self, c: np.ndarray) -> np.ndarray:
        h = window_hashes(c, self.size)
        at = np.flatnonzero(self.bits[(h >> self.shift).astype(np.int64)])
        found = np.searchsorted(self.hashes, h[at])
        return at[self.hashes[np.minimum(found, len(self.hashes) - 1)] == h[at]]


def _hits(texts: DataFrame, known: list[_Known]) -> DataFrame:
    """(window, ref_id, offset) of all windows of texts (ref_id, text) whose hash a pattern has."""
    shared = texts.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said = batch.column("text").to_pylist()
            bounds = np.cumsum([0, *(len(t or "") for t in said)])
            c = letters("".join(t or "" for t in said))
            starts, sizes = [], []
            for k in shared.value:
                step = PIECE - k.size + 1
                for at in range(0, max(len(c) - k.size + 1, 0), step):
                    found = k.places(c[at : at + PIECE]) + at
                    own = np.searchsorted(bounds, found, "right") - 1
                    found = found[found + k.size <= bounds[own + 1]]  # not across texts
                    starts.append(found)
                    sizes.append(np.full(len(found), k.size))
            if not starts:
                continue
            start, size = np.concatenate(starts), np.concatenate(sizes)
            own = np.searchsorted(bounds, start, "right") - 1
            windows = [c[a : a + n].tobytes().decode("utf-32-le") for a, n in zip(start.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.string()), batch.column("ref_id").take(pa.array(own)), pa.array((start - bounds[own]).astype(np.int32))], names=["window", "ref_id", "offset"])

    return texts.mapInArrow(scan, f"window string, ref_id {texts.schema['ref_id'].dataType.simpleString()}, offset int")


def found_in(patterns: DataFrame, texts: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(window, ref_id, offset): every place of every pattern (window, of A-Z for a-z, not empty) in texts (ref_id, text), in either case.

    The driver has hashes only; if they are more than pass_bytes, the texts are read once for each such part of them.
    """
    own = written(patterns.select("window").distinct())
    passes = -(-own.count() * HASH_BYTES // pass_bytes)
    hashed = own.mapInArrow(_hashed, "size int, hash long")
    texts = texts.select("ref_id", "text")
    out = None
    for i in range(passes):
        part = (hashed if passes == 1 else hashed.where(F.pmod("hash", F.lit(passes)) == i)).toArrow()  # pass_bytes at most
        size, hashes = part.column("size").to_numpy(), part.column("hash").to_numpy().view(np.uint64)
        if not len(size):
            continue
        found = _hits(texts, [_Known(hashes[size == n], n) for n in np.unique(size).tolist()])
        out = found if out is None else out.union(found)
    if out is None:
        return texts.limit(0).select(F.lit("").alias("window"), "ref_id", F.lit(0).alias("offset"))
    return out.join(own, "window", "left_semi").distinct()
