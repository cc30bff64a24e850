"""Exact top-k by inner product with MaxScore.

A term is a component of the vectors, its posting the impacts of one shard's vectors
in that component. The largest thing a term can add to a query's score within a shard
bounds it. For each query the terms stand in the order of their bounds; the last ones,
whose bounds together stay below the score that the query's k-th best row has so far,
are not essential: no row becomes competitive by them alone. The essential postings
are traversed for all rows of the shard, the others are probed a few at a time, each
time only for rows that what is left can still lift to the k-th best score. What is
left is bounded by the terms' own bounds and by the lengths of both remainders
(Cauchy-Schwarz), whichever is less. Every task merges the shards it sees into one
list of k rows a query, and a window over these lists gives the result.

The queries are a stated set: they go to every task in packed blocks of a bounded
size, one pass over the shards for each block; all rows meet all queries, and rows of
a shard that cannot compete are left early.

Defined results. A vector that is null or has a null or non-finite component takes no
part, neither as query nor as candidate. A component that the shorter of two vectors
lacks counts as zero; an empty vector scores zero. Equal scores go to the smaller id,
rows without an id after all others. Repeated rows are rows of their own: each is a
query with its own list, in which the others with its id may stand; only one row, the
query's own, is left out. Scores beyond a long are given as the nearest long. Fewer than k other rows: all of
them. An empty table, or one without queries, gives an empty result. Only id and
vector are read, and columns of other names are not returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.llm.stage import checkpoint_folder, checkpointed

#: Components of a shard (rows times the longest vector): 2 MB of float64.
SHARD = 1 << 18
#: Bytes of the packed queries that a pass sends to every task.
PASS_BYTES = 32 << 20
#: Terms probed at a time beyond the essential ones.
PROBE = 8
_LONG = (-(1 << 63), (1 << 63) - 1)
_NO_ID = np.iinfo(np.int64).max

_PACKED = pa.schema([("shard", pa.int64()), ("ids", pa.binary()), ("known", pa.binary()), ("width", pa.int32()), ("impacts", pa.binary())])
_PACKED_DDL = "shard long, ids binary, known binary, width int, impacts binary"


def scaled(vectors: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component, for vectors all of whose components are finite."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # floor() gives a long, which a large component leaves; a double of that size is whole already.
    floor = lambda x: F.when(F.abs(x * scale) < float(1 << 53), F.floor(x * scale).cast("double")).otherwise(F.greatest(F.least(x * scale, F.lit(1e300)), F.lit(-1e300)))
    return vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("v")).where("v is not null").where(whole).select("id", F.transform("v", floor).alias("v"))


def _packed(rows: DataFrame) -> DataFrame:
    """rows (id, v) in shards of a bounded size: ids, which ids are known, the longest vector's width, and the impacts."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            v = batch.column("v")
            width = np.diff(v.offsets.to_numpy())
            values, starts = v.values.to_numpy(zero_copy_only=False), v.offsets.to_numpy()
            order = np.argsort(width, kind="stable")  # vectors of like widths share a shard
            ids, known = batch.column("id").fill_null(_NO_ID).to_numpy(), batch.column("id").is_valid().to_numpy(zero_copy_only=False)
            at = 0
            while at < len(order):
                area = (np.arange(at, len(order)) - at + 1) * np.maximum(width[order[at:]], 1)
                to = at + max(1, int(np.searchsorted(area, SHARD, "right")))
                own = order[at:to]
                m = np.zeros((len(own), int(width[own[-1]])))
                for d in np.unique(width[own]).tolist():
                    of = np.flatnonzero(width[own] == d)
                    m[of, :d] = values[starts[own[of], None] + np.arange(d)]
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([ids[own].tobytes()]), pa.array([known[own].tobytes()]), pa.array([m.shape[1]], pa.int32()), pa.array([m.tobytes()])], schema=_PACKED)
                number, at = number + 1, to

    return rows.mapInArrow(pack, _PACKED_DDL)


class Best:
    """The k best (score, id) of a query so far: larger scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.known = k, np.zeros(0), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> float:
        return float(self.score[-1]) if len(self.score) == self.k else -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        score, ids, known = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.known, known])
        at = np.lexsort((ids, ~known, -score))[: self.k]
        self.score, self.id, self.known = score[at], ids[at], known[at]


def maxscore(q: np.ndarray, postings: np.ndarray, top: np.ndarray, bottom: np.ndarray, square: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of one shard that reach `least`; postings: term by row; top, bottom: the terms' largest and smallest impacts; square: of the rows' lengths."""
    bound = np.maximum(q * top, q * bottom)
    order = np.argsort(-bound, kind="stable")
    q, left = q[order], np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0.0]])
    # Terms from place m on cannot lift a row to `least` by themselves; half of the query's length at least is traversed, so that the rest is short.
    length = np.concatenate([np.cumsum((q * q)[::-1])[::-1], [0.0]])
    m = int(np.argmax((left < least) | (left == 0))) if least > -np.inf else len(q)
    if m < len(q):
        m = max(m, int(np.argmax(length <= length[0] / 4)))
    traversed = postings[order[:m]]
    score = q[:m] @ traversed
    rows = np.arange(postings.shape[1])
    if m == len(q):
        at = np.flatnonzero(score >= least)
        return rows[at], score[at]
    rest = square - np.einsum("ij,ij->j", traversed, traversed)
    while True:
        reach = np.minimum(left[m], np.sqrt(length[m] * np.maximum(rest, 0)) * (1 + 1e-9) + 1)
        at = np.flatnonzero(score + reach >= least)
        rows, score, rest = rows[at], score[at], rest[at]
        if m == len(q) or not len(rows):
            return rows, score
        to = min(m + PROBE, len(q))
        probed = postings[order[m:to]][:, rows]
        score = score + q[m:to] @ probed
        rest = rest - np.einsum("ij,ij->j", probed, probed)
        m = to


def _exact(q: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Scores of rows whose sums float64 does not hold, in whole numbers of any size, cut to a long."""
    whole = [int(x) for x in q.tolist()]
    return np.array([min(max(sum(a * int(b) for a, b in zip(whole, row, strict=False)), _LONG[0]), _LONG[1]) for row in m.tolist()], object)


def _searched(shards: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(block, number, query_id, own, vec_id, score): every task's k best rows of each query; queries and shards as _packed gives them."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, list[int], list[Best], list]] = {}
        asked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                if r["block"] not in asked:
                    ids = np.frombuffer(r["q_ids"], np.int64)
                    q = np.frombuffer(r["q_impacts"], np.float64).reshape(len(ids), r["q_width"])
                    asked[r["block"]] = ids, q
                    found[r["block"]] = ids, [], [Best(k) for _ in ids], []
                ids, q = asked[r["block"]]
                best = found[r["block"]][2]
                own = np.frombuffer(r["ids"], np.int64)
                known = np.frombuffer(r["known"], bool)
                m = np.frombuffer(r["impacts"], np.float64).reshape(len(own), r["width"])
                d = min(q.shape[1], m.shape[1])
                most = max(np.abs(m).max(initial=0.0), np.abs(q).max(initial=0.0))
                if most * most * max(d, 1) < float(1 << 53):  # sums of products and of squares are exact
                    postings = np.ascontiguousarray(m[:, :d].T)
                    top, bottom, square = postings.max(axis=1), postings.min(axis=1), np.einsum("ij,ij->j", postings, postings)
                    for one, b in zip(q[:, :d], best, strict=True):
                        rows, score = maxscore(one, postings, top, bottom, square, b.least())
                        if len(rows):
                            b.add(score, own[rows], known[rows])
                else:
                    for one, b in zip(q[:, :d], best, strict=True):
                        b.add(_exact(one, m[:, :d]), own, known)
        for block, (ids, _, best, _) in found.items():
            n = [len(b.id) for b in best]
            q = asked[block][1]
            self_score = [int(x) for one in q for x in _exact(one, one[None])]
            vec = pa.array(np.concatenate([b.id for b in best]), mask=~np.concatenate([b.known for b in best]))
            score = [int(x) for b in best for x in b.score.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(sum(n), block)), pa.array(np.repeat(np.arange(len(ids)), n)), pa.array(np.repeat(ids, n)), pa.array(np.repeat(np.array(self_score, np.int64), n)), vec, pa.array(score, pa.int64())],
                names=["block", "number", "query_id", "own", "vec_id", "score"],
            )

    asked = queries.select(F.col("shard").alias("block"), F.col("ids").alias("q_ids"), F.col("width").alias("q_width"), F.col("impacts").alias("q_impacts"))
    met = shards.select("ids", "known", "width", "impacts").crossJoin(F.broadcast(asked))
    return met.mapInArrow(scan, "block long, number long, query_id long, own long, vec_id long, score long")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector: str = "embedding", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of each query, by the inner product of floor(scale * x).

    queries are rows of vectors. pass_bytes bounds the packed queries that one pass over the vectors sends to every task.
    """
    shards = checkpointed(_packed(scaled(vectors, id_column, vector, scale)))
    packed = _packed(scaled(queries, id_column, vector, scale))
    # Blocks of one partition are numbered from 0; with the partition's number they are numbered over all.
    blocks = checkpointed(packed.withColumn("shard", F.col("shard") + F.spark_partition_id() * F.lit(1 << 40)))
    size, n = blocks.agg(F.sum(F.length("impacts") + F.length("ids") + 64), F.count("*")).first()
    passes = max(1, min(n, -(-(size or 0) // pass_bytes)))
    path = f"{checkpoint_folder(vectors.sparkSession)}/lists-{uuid.uuid4().hex}"
    for i in range(passes):
        own = blocks if passes == 1 else blocks.where(F.pmod(F.xxhash64("shard"), F.lit(passes)) == i)
        _searched(shards, own, k + 1).write.mode("append").parquet(path)
    lists = vectors.sparkSession.read.parquet(path)
    by = Window.partitionBy("block", "number")
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    # One row with the query's id and the score of its vector with itself is the query's own.
    self = (F.col("vec_id") == F.col("query_id")) & (F.col("score") == F.col("own"))
    ranked = lists.withColumn("r", F.row_number().over(by.orderBy(*order))).where(F.col("r") <= k + 1)
    ranked = ranked.withColumn("first_own", F.min(F.when(self, F.col("r"))).over(by)).where("first_own is null or r <> first_own")
    ranked = ranked.withColumn("rank", F.row_number().over(by.orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def report(vectors: DataFrame, every: int = 50, k: int = 5, **how) -> DataFrame:
    """Queries are the rows whose id divides by `every`."""
    return top_k(vectors, vectors.where(F.expr(f"vec_id % {every} = 0")), k, **how)
