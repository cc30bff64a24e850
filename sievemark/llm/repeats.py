"""Two Bloom filters over a distributed stream of hashes: seen once, seen twice.

Each task reduces its hashes to bit positions and reports, block by block, which
bits were set and which were set more than once. Merging adds these up to two, so
a bit is in the second filter if two different items set it. Every item that
occurs twice has all its bits there; items that occur once get through with a
probability that falls with the filter's size. Nothing is lost: the filter only
says what needs no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import textscan

BLOCK = 20
MAX_BITS = 1 << 29
FLUSH = 1 << 21
_PARTS = pa.schema([("block", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])


def bits_for(items: int, per_item: int = 16, most: int = MAX_BITS) -> int:
    """Filter size: a power of two, bounded. Beyond the bound more items count as suspects; none is lost."""
    return min(most, max(1 << BLOCK, 1 << int(max(1, items) * per_item - 1).bit_length()))


def _positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.uint32), ((h >> np.uint64(32)) & mask).astype(np.uint32)


def _report(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if not found:
        return
    at, n = np.unique(np.concatenate(found), return_counts=True)
    block = (at >> np.uint32(BLOCK)).astype(np.int32)
    for lo, hi in textscan.groups(block):
        own = at[lo:hi] & np.uint32((1 << BLOCK) - 1)
        yield pa.RecordBatch.from_arrays([pa.array([block[lo]], pa.int32()), pa.array([own.tobytes()], pa.binary()), pa.array([own[n[lo:hi] > 1].tobytes()], pa.binary())], schema=_PARTS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, once, twice in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            count = seen.setdefault(block, np.zeros(1 << BLOCK, np.uint8))
            own = np.frombuffer(once, np.uint32)
            count[own] = np.minimum(count[own] + 1, 2)
            count[np.frombuffer(twice, np.uint32)] = 2
    for block, count in seen.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([np.packbits(count > 1, bitorder="little").tobytes()], pa.binary())], names=["block", "twice"])


class SeenTwice:
    """The merged second filter, shared with the executors. Its size is bounded by MAX_BITS / 8 bytes."""

    def __init__(self, bits: int, shared: Broadcast):
        self.bits, self.shared = bits, shared

    def destroy(self) -> None:
        """Frees the filter on the executors, once nothing that uses it is still to run."""
        self.shared.destroy()

    def suspects(self, h: np.ndarray) -> np.ndarray:
        table = self.shared.value
        if not isinstance(table, np.ndarray):
            table = np.frombuffer(table, np.uint8)
        keep = np.ones(len(h), bool)
        for at in _positions(h, self.bits):
            keep &= (table[at >> np.uint32(3)] >> (at & np.uint32(7)).astype(np.uint8)) & np.uint8(1) != 0
        return keep


def build(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int, column: str | None = None) -> SeenTwice:
    """Reads df once. hashes yields arrays of uint64; an item that should count once per row must come once.

    column: the text column that hashes reads, for batches of bounded size.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        size = 0
        for batch in textscan.bounded(batches, column) if column else batches:
            for h in hashes(batch):
                for at in _positions(h, bits):
                    found.append(at)
                    size += len(at)
                if size >= FLUSH:
                    yield from _report(found)
                    found, size = [], 0
        yield from _report(found)

    spark = df.sparkSession
    parts = df.mapInArrow(scan, "block int, once binary, twice binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = parts.repartition(max(1, min(n, bits >> BLOCK)), F.col("block")).mapInArrow(_merge, "block int, twice binary")
    step = 1 << (BLOCK - 3)
    blocks = {row.block: row.twice for row in merged.collect()}
    table = b"".join(blocks.pop(i, None) or bytes(step) for i in range(bits >> BLOCK))
    return SeenTwice(bits, spark.sparkContext.broadcast(table))
