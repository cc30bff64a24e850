"""k-means with Yinyang's group bounds, in whole numbers.

The centroids are grouped once, by their places at the start. Every vector keeps an
upper bound of the distance to its centroid and, for each group, a lower bound of the
distance to the group's other centroids; both move with the centroids. A round first
filters globally: a vector whose upper bound lies below all its lower bounds keeps its
centroid. The upper bound of the others is made exact, and those that pass the filter
now stay too. What is left is filtered by group, and only the centroids of groups
whose lower bound does not lie above are scanned exactly. Bounds are compared with a
margin for rounding; distances that decide are sums of whole numbers, so ties go to
the smaller number of a centroid as in a full scan.

Vectors are packed into shards with their bounds. A round reads a table of shards and
writes the next one, with each shard's sums by centroid beside them; these are summed
by Spark, and what the driver gets is a number for each centroid and component. The table of the round
before the last is deleted.

Defined results. Only vectors of exactly `width` components take part, none of them
null or non-finite; others, and null vectors, are no rows of the result. Scaled
components beyond 2^31 count as 2^31, distances and sums beyond a long as the largest
long. Equal distances go to the smaller centroid; rows that repeat a vec_id are vectors
of their own, and where their hashes tie as seeds, the lesser vector comes first. A null vec_id is
clustered, but is a seed only where no vector has an id. Fewer vectors than centroids: as many centroids. A centroid
without vectors stays. An empty table gives an empty one. Only id and vector are read,
and columns of other names are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm.maxscore import scaled
from sievemark.llm.stage import checkpointed, dropped

#: Vectors of a shard.
SHARD = 4096
#: Components are cut to this, so that sums over a shard fit a long.
MOST = 1 << 31
_LONG = (1 << 63) - 1

_DDL = "ids binary, known binary, v binary, near binary, upper binary, lower binary, sums array<long>, counts array<long>, spread array<decimal(38,0)>"


def grouped(centroids: np.ndarray, groups: int, rounds: int = 5) -> np.ndarray:
    """A group for each centroid: a few rounds of k-means over the centroids themselves."""
    c = centroids.astype(np.float64)
    groups = max(1, min(groups, len(c)))
    middle = c[:groups].copy()
    of = np.zeros(len(c), np.int64)
    for _ in range(rounds):
        of = ((c[:, None, :] - middle[None]) ** 2).sum(axis=2).argmin(axis=1)
        for g in range(groups):
            if (of == g).any():
                middle[g] = c[of == g].mean(axis=0)
    return of


def _square(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of v to one centroid, or to one each: exact, as int64, or in numbers of any size where that is too small."""
    d = v - c
    most = int(np.abs(d).max(initial=0))
    return np.einsum("ij,ij->i", d, d) if most * most * max(v.shape[1], 1) < 1 << 63 else (d.astype(object) ** 2).sum(axis=1)


class _Bounds:
    """A shard's vectors v (int64), their centroid, and bounds of distances (not squared)."""

    def __init__(self, v: np.ndarray, near: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.v, self.near, self.upper, self.lower = v, near, upper, lower

    def scan(self, c: np.ndarray, of: np.ndarray, rows: np.ndarray, groups: np.ndarray) -> None:
        """Scans for each of rows the groups marked for it (rows x groups)."""
        v, start = self.v[rows], self.near[rows]
        most = int(np.abs(v).max(initial=0)) + int(np.abs(c).max(initial=0))
        kind, none = (np.int64, _LONG) if most * most * v.shape[1] < _LONG else (object, 1 << 200)
        squares = np.full((len(rows), len(c)), none, kind)
        for j in range(len(c)):
            # A centroid is scanned with its group; that of the vector so far always is.
            some = np.flatnonzero(groups[:, of[j]] | (start == j))
            if len(some):
                squares[some, j] = _square(v[some], c[j])
        near = squares.argmin(axis=1)  # the first of equals
        every = np.arange(len(rows))
        self.upper[rows] = np.sqrt(squares[every, near].astype(np.float64))
        far = np.where(squares == none, np.inf, np.sqrt(squares.astype(np.float64)))
        far[every, near] = np.inf
        for g in range(self.lower.shape[1]):
            least = far[:, of == g].min(axis=1, initial=np.inf)
            # Of a group that was left out only the former centroid has been measured.
            self.lower[rows, g] = np.where(groups[:, g], least, np.minimum(least, self.lower[rows, g]))
        self.near[rows] = near

    def round(self, c: np.ndarray, of: np.ndarray, drift: np.ndarray) -> int:
        """Follows the centroids to c; drift: how far each has moved. Returns how many vectors were scanned."""
        self.upper = self.upper + drift[self.near]
        for g in range(self.lower.shape[1]):
            self.lower[:, g] -= drift[of == g].max(initial=0.0)
        safe = self.lower * (1 - 1e-9) - 1e-6
        rows = np.flatnonzero(self.upper >= safe.min(axis=1))
        self.upper[rows] = np.sqrt(_square(self.v[rows], c[self.near[rows]]).astype(np.float64)) * (1 + 1e-12)
        rows = rows[self.upper[rows] >= safe[rows].min(axis=1)]
        if len(rows):
            self.scan(c, of, rows, self.upper[rows, None] >= safe[rows])
        return len(rows)


def _shards(vectors: DataFrame, width: int, c: np.ndarray, of: np.ndarray) -> DataFrame:
    """vectors (id, v) packed with the bounds of a full scan."""
    groups = int(of.max()) + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            m = np.clip(v.flatten().to_numpy().reshape(-1, width), -MOST, MOST).astype(np.int64)
            ids, known = batch.column("id").fill_null(0).to_numpy(), batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            for at in range(0, len(m), SHARD):
                own = m[at : at + SHARD]
                b = _Bounds(own, np.zeros(len(own), np.int64), np.zeros(len(own)), np.zeros((len(own), groups)))
                b.scan(c, of, np.arange(len(own)), np.ones((len(own), groups), bool))
                yield _row(ids[at : at + SHARD].tobytes(), known[at : at + SHARD].tobytes(), b, c)

    return vectors.mapInArrow(pack, _DDL)


def _row(ids: bytes, known: bytes, b: _Bounds, c: np.ndarray) -> pa.RecordBatch:
    k, d = c.shape
    sums, counts, spread = np.zeros((k, d), np.int64), np.bincount(b.near, minlength=k), [0] * k
    for j in range(k):
        own = b.v[b.near == j]
        sums[j] = own.sum(axis=0)
        spread[j] = sum(min(x, _LONG) for x in _square(own, c[j]).tolist())
    small = np.abs(b.v).max(initial=0) < 1 << 15
    packed = b.v.astype(np.int16 if small else np.int64).tobytes()
    arrays = [pa.array([x], pa.binary()) for x in (ids, known, packed, b.near.tobytes(), b.upper.tobytes(), b.lower.tobytes())]
    arrays += [pa.array([sums.ravel().tolist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64())), pa.array([[Decimal(x) for x in spread]], pa.list_(pa.decimal128(38, 0)))]
    return pa.RecordBatch.from_arrays(arrays, names=["ids", "known", "v", "near", "upper", "lower", "sums", "counts", "spread"])


def _read(r: dict, width: int) -> _Bounds:
    near = np.frombuffer(r["near"], np.int64).copy()
    v = np.frombuffer(r["v"], np.int16 if len(r["v"]) == 2 * width * len(near) else np.int64).astype(np.int64).reshape(-1, width)
    return _Bounds(v, near, np.frombuffer(r["upper"], np.float64).copy(), np.frombuffer(r["lower"], np.float64).reshape(len(near), -1).copy())


def _followed(shards: DataFrame, width: int, c: np.ndarray, of: np.ndarray, drift: np.ndarray) -> DataFrame:
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.select(["ids", "known", "v", "near", "upper", "lower"]).to_pylist():
                b = _read(r, width)
                b.round(c, of, drift)
                yield _row(r["ids"], r["known"], b, c)

    return shards.mapInArrow(follow, _DDL)


def _totals(shards: DataFrame, column: str) -> list[int]:
    """The sums over all shards of an array column's entries: as many as it has."""
    rows = shards.select(F.posexplode(column).alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    return [int(r["x"]) for r in sorted(rows, key=lambda r: r["at"])]


def seeds(vectors: DataFrame, k: int, salt: int) -> list[list[float]]:
    """The k vectors with the least hashes of `salt:id`, in the hashes' order."""
    h = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    return [r.v for r in vectors.where("id is not null").select(h.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, groups: int | None = None, width: int = 64, scale: int = 1024, salt: int = 3, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that takes part.

    Components become floor(scale * x). rounds times the vectors go to the nearest centroid and centroids to the floor
    of their vectors' means; then the vectors are assigned once more. groups: of centroids, the root of k if not given.
    """
    taken = scaled(vectors, id_column, vector, scale).where(F.size("v") == width)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    first = seeds(taken, k, salt)
    if not first:
        first = [r.v for r in taken.orderBy("v").limit(k).collect()]  # no vector has an id
    if not first:
        return vectors.sparkSession.createDataFrame([], schema)
    c = np.clip(np.array(first, np.float64), -MOST, MOST).astype(np.int64)
    k = len(c)
    of = grouped(c, groups or max(1, round(k**0.5)))
    shards = checkpointed(_shards(taken, width, c, of))
    for _ in range(rounds):
        sums, counts = _totals(shards, "sums"), _totals(shards, "counts")
        now = np.array([[s // n for s in sums[j * width : (j + 1) * width]] if (n := counts[j]) else c[j].tolist() for j in range(k)], np.int64)
        drift = np.sqrt(_square(now, c).astype(np.float64)) * (1 + 1e-9)
        before, shards, c = shards, checkpointed(_followed(shards, width, now, of, drift)), now
        dropped(before)
    spread = _totals(shards, "spread")
    own = np.array([min(x, _LONG) for x in spread], np.int64)
    every = min(sum(spread), _LONG)
    digest = np.array([hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c.tolist()], object)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                b = _read(r, width)
                distance = [min(x, _LONG) for x in _square(b.v, c[b.near]).tolist()]
                ids = pa.array(np.frombuffer(r["ids"], np.int64), mask=~np.frombuffer(r["known"], bool))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(b.near, pa.int32()), pa.array(distance, pa.int64()), pa.array(own[b.near]), pa.array(np.full(len(b.near), every)), pa.array(digest[b.near].tolist(), pa.string())],
                    names=["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
                )

    return shards.select("ids", "known", "v", "near", "upper", "lower").mapInArrow(unpack, schema)


def report(vectors: DataFrame, **how) -> DataFrame:
    return clustered(vectors, **how)
