"""Shared checkpoint tables, connected components and spanning forests."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Hashable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A checkpoint table has so many files for each core at most, where what it comes from is not larger than FILE_BYTES for each: more only cost their making and listing.
FILES_A_CORE, FILE_BYTES = 8, 128 << 20
#: Links of a file of a link table.
FILE_ROWS = 250_000
#: Up to so many links (some 10 MB) are joined up by one task; more are in rounds over the cluster, with the same result.
FEW_LINKS = 1 << 18


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir, read from the session.

    Only where it is unset on one machine, as in tests, a temporary folder takes its place; on a cluster that is an error.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        folder = sc.getCheckpointDir()
    return folder


def written(df: DataFrame, most_files: int | None = None) -> DataFrame:
    """df written as a table in the shared folder and read from there: cuts lineage, survives lost executors.

    most_files: for tables whose size is known to be small.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    files = max(FILES_A_CORE * spark.sparkContext.defaultParallelism, -(-_read_bytes(df) // FILE_BYTES))
    df.coalesce(min(most_files or 1 << 30, files)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """df dealt over all shuffle partitions: for few bytes with much work for each, which adaptive execution would put into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _read_bytes(df: DataFrame) -> int:
    """What the tables that df comes from have, as Spark reckons; at least their files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(min(int(leaves.apply(i).stats().sizeInBytes()), 1 << 60) for i in range(leaves.size()))


class _Sets:
    """Disjoint sets of nodes, each known by its least one."""

    def __init__(self) -> None:
        self.above: dict[Hashable, Hashable] = {}

    def root(self, x: Hashable) -> Hashable:
        top = x
        while (up := self.above.setdefault(top, top)) != top:
            top = up
        while (up := self.above[x]) != top:
            self.above[x], x = top, up
        return top

    def join(self, a: Hashable, b: Hashable) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)
        return a != b


def connected_components(links: DataFrame, by: tuple[str, ...] = (), few: int = FEW_LINKS) -> DataFrame:
    """links (*by, a, b), any order, repeats allowed -> (*by, node, root): the least node of each linked node's component, within each value of by.

    Up to `few` links are one task's. Beyond, each round hangs every node on the least of its neighbours, first larger then
    smaller ones, so a path shrinks geometrically; the table is never larger than
    twice its first size, and rounds are cut from each other by a written table.
    """
    key = list(by)
    down = lambda df: df.select(*key, F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    state, mark = written(down(links)), None
    if state.count() <= few:
        return _joined_up(state, key)
    while True:
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64(*key, "a", "b").cast("decimal(38,0)"))).first())
        if now == mark or not now[0]:
            return state.select(*key, F.col("a").alias("node"), F.col("b").alias("root")).union(state.select(*key, F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = now
        both = state.union(state.select(*key, "b", "a"))
        least = both.groupBy(*key, "a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = down(both.join(least, [*key, "a"]).where("b > a").select(*key, F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy(*key, "a").agg(F.min("b").alias("m"))
        pairs = F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        state = written(down(large.join(least, [*key, "a"]).select(*key, pairs).select(*key, "e.a", "e.b")), -(-2 * now[0] // FILE_ROWS))


def _joined_up(links: DataFrame, key: list[str]) -> DataFrame:
    """connected_components of few links, in one task."""
    kinds = dict(links.dtypes)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, like = _Sets(), None
        for batch in batches:
            like = batch.schema
            *own, a, b = (batch.column(c).to_pylist() for c in (*key, "a", "b"))
            for k, x, y in zip(zip(*own, strict=True) if key else [()] * batch.num_rows, a, b, strict=True):
                sets.join((*k, x), (*k, y))
        nodes = list(sets.above)
        if nodes:
            roots = [sets.root(x) for x in nodes]
            columns = [pa.array([x[i] for x in nodes], like.field(c).type) for i, c in enumerate(key)]
            columns += [pa.array([x[-1] for x in own], like.field("a").type) for own in (nodes, roots)]
            yield pa.RecordBatch.from_arrays(columns, names=[*key, "node", "root"])

    schema = ", ".join([*(f"{c} {kinds[c]}" for c in key), f"node {kinds['a']}", f"root {kinds['a']}"])
    return links.select(*key, "a", "b").repartition(1).mapInArrow(join, schema)


def _local_forest(links: DataFrame) -> DataFrame:
    """Of each task's links (a, b, weight, ra, rb), in runs of FEW_LINKS, those of a maximum spanning forest over ra and rb: no other can be one of the whole."""
    names = ["a", "b", "weight", "ra", "rb"]

    def forest(run: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(run)
        a, b, w, ra, rb = (t.column(c).to_numpy() for c in names)
        order = np.lexsort((b, a, -w))
        sets = _Sets()
        kept = order[[sets.join(x, y) for x, y in zip(ra[order].tolist(), rb[order].tolist(), strict=True)]]
        return pa.RecordBatch.from_arrays([pa.array(x[kept]) for x in (a, b, w, ra, rb)], names=names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            run.append(batch)
            n += batch.num_rows
            if n >= FEW_LINKS:
                yield forest(run)
                run, n = [], 0
        if n:
            yield forest(run)

    return links.select(*names).mapInArrow(scan, "a long, b long, weight double, ra long, rb long")


def spanning_forest(links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """links (a, b, weight) -> those of a maximum spanning forest, a < b: cut at any weight, it has the components of all links of that weight or more.

    Every task first keeps a forest of its own links. Up to `few` that are left are one task's; while there are more, they go in Boruvka's rounds, in each of
    which every component takes its heaviest link to another one (ties: the least a, then b), components that
    are linked become one, and every task keeps a forest of the links between them.
    """
    own = links.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"), F.col("weight").cast("double").alias("weight")).where("a != b")
    state = written(_local_forest(own.select("*", F.col("a").alias("ra"), F.col("b").alias("rb"))))
    order = F.struct("weight", (-F.col("a")).alias("x"), (-F.col("b")).alias("y"))
    forest = None
    while state.count() > few:
        both = state.union(state.select("a", "b", "weight", "rb", "ra"))
        best = both.groupBy("ra").agg(F.max_by(F.struct("a", "b", "weight", "rb"), order).alias("l")).select("ra", "l.*")
        best = written(best)
        taken = best.select("a", "b", "weight").distinct()
        forest = written(taken if forest is None else forest.union(taken))
        roots = written(connected_components(best.select(F.col("ra").alias("a"), F.col("rb").alias("b")), few=few))
        left, right = roots.select(F.col("node").alias("ra"), F.col("root").alias("na")), roots.select(F.col("node").alias("rb"), F.col("root").alias("nb"))
        moved = state.join(left, "ra").join(right, "rb").where("na != nb")
        moved = moved.groupBy(F.least("na", "nb").alias("ra"), F.greatest("na", "nb").alias("rb")).agg(F.max_by(F.struct("a", "b", "weight"), order).alias("l"))
        state = written(_local_forest(moved.select("l.*", "ra", "rb")))
    rest = _local_forest(state.repartition(1)).select("a", "b", "weight")
    return rest if forest is None else forest.union(rest)


def cut(forest: DataFrame, levels: list[int], few: int = FEW_LINKS) -> DataFrame:
    """forest (a, b, weight) -> (level, node, root): the least node of each linked node's component under the links of at least a level's weight; nodes may also be their own root.

    Up to `few` links are one task's, for all levels. Beyond, levels go from the highest down, each joining up the components of the one
    before it by the links that it adds, so that a link is joined up once.
    """
    levels = sorted(set(levels), reverse=True)
    if forest.count() <= few:
        return _cut(forest, levels)
    state = written(forest.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("root")))
    found, above = [], None
    for level in levels:
        added = forest.where(F.col("weight") >= level) if above is None else forest.where((F.col("weight") >= level) & (F.col("weight") < above))
        left, right = state.select(F.col("node").alias("a"), F.col("root").alias("ra")), state.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = added.select("a", "b") if above is None else added.join(left, "a").join(right, "b").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        joined = connected_components(links, few=few).select(F.col("node").alias("root"), F.col("root").alias("least"))
        state = written(state.join(joined, "root", "left").select("node", F.coalesce("least", "root").alias("root")))
        found.append(state.select(F.lit(level).alias("level"), "node", "root"))
        above = level
    return functools.reduce(DataFrame.union, found)


def _cut(forest: DataFrame, levels: list[int]) -> DataFrame:
    """cut of few links, in one task."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = list(batches)
        if not run:
            return
        a, b, w = (pa.Table.from_batches(run).column(c).to_numpy() for c in ("a", "b", "weight"))
        order = np.argsort(-w, kind="stable")
        a, b, w = a[order], b[order], w[order]
        sets, at = _Sets(), 0
        for level in levels:
            to = int(np.searchsorted(-w, -level, "right"))
            for x, y in zip(a[at:to].tolist(), b[at:to].tolist(), strict=True):
                sets.join(x, y)
            at = to
            nodes = list(sets.above)
            roots = pa.array([sets.root(x) for x in nodes], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), level, np.int32)), pa.array(nodes, pa.int64()), roots], names=["level", "node", "root"])

    return forest.select("a", "b", "weight").repartition(1).mapInArrow(join, "level int, node long, root long")
