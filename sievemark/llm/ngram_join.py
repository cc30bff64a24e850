"""n-gram Jaccard self-join by vertical partitioning.

All n-grams stand in one global order: rare ones first, by a counting sketch over
the whole corpus, then by hash. The order is cut at fixed points into fragments.
Two sets that reach the threshold share one of their first few n-grams in that
order, so only those are looked up, and a filter of what is seen twice keeps
n-grams that no second document has out of the shuffle. For each candidate pair
the overlap is counted in every fragment on its own, and the counts are summed.

Equal sets are one class from the start. In a group of documents with a common
n-gram not all pairs are listed. Bounds on size and position and a bitmap of each
set, which bounds the difference of two sets from below, say which pairs can link.
A group of a few members lists all of these; a larger one, in the first round, a
spanning forest, found by breadth-first search among what is not reached yet, so
that near copies cost a pair per member. When these are verified, the second round
lists every pair of the larger groups that can link and is not connected yet. After that nothing is open: no link that decides a component is
lost. A group too large for a task is dealt in blocks that meet each other.

Defined results. Null, empty or wordless text: an empty set, linked with nothing.
A null doc_id takes part in nothing and has a null component. Rows that repeat a
doc_id with other text count as one document with the largest of the texts; each
row reports its own n_shingles. A pair that just meets the threshold links. Where
n-grams are equally frequent their hashes order them. n_links counts links among those
compared, which connect whatever any links connect, and not all links. Texts are cut
whole, whatever their length. An empty table gives an empty one. Only doc_id and text
are read, and columns of other names are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import repeats, textscan
from sievemark.llm.stage import checkpointed, shuffle_partitions
from sievemark.operators.graph import connected_components

SKETCH_BITS = 22
#: Counters of a cell: a task sums one cell of all tasks' parts, so cells are small.
_CELL = 14
_CELLS = 1 << (SKETCH_BITS - _CELL)
FRAGMENTS = 4
#: Words of 64 bits of a set's bitmap.
BITMAP = 8
#: Members of a group that one task takes together.
GROUP_LIMIT = 100_000
#: Groups of up to so many members list all pairs that can link at once.
SMALL = 12


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text with a word; a text of fewer than k words is one shingle."""
    for t in textscan.chunks(column):
        w = textscan.words(t, textscan.NONBLANK)
        if not len(w):
            continue
        h = textscan.word_hash(textscan.FOLD[t.data], w.starts, w.ends)
        s, at = textscan.shingles(h, w.doc, k)
        cut = np.searchsorted(at, w.bounds)
        for d in range(len(t)):
            lo, hi = w.bounds[d], w.bounds[d + 1]
            if hi - lo >= k:
                yield t.first + d, np.unique(s[cut[d] : cut[d + 1]])
            elif hi > lo:
                yield t.first + d, np.array([textscan.sequence_hash(h[lo:hi])], np.uint64)


def _needed(n: int, num: int, den: int) -> int:
    """How many n-grams of the global order's start a set of n must be looked up by."""
    return n - -(-num * n // den) + 1


def _survey(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, the size n of its set, a digest of it, and a bitmap in which every n-gram flips a bit."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            n = np.zeros(batch.num_rows, np.int64)
            digest: list[bytes | None] = [None] * batch.num_rows
            bits: list[bytes | None] = [None] * batch.num_rows
            for row, u in shingle_sets(batch.column("text"), k):
                n[row], digest[row] = len(u), xxhash.xxh3_128_digest(u.tobytes())
                flips = np.bincount((u >> np.uint64(23)).astype(np.int64) & (64 * BITMAP - 1), minlength=64 * BITMAP) & 1
                bits[row] = np.packbits(flips.astype(np.uint8)).tobytes()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(digest, pa.binary()), pa.array(bits, pa.binary())], names=["doc_id", "n", "digest", "bits"])

    return docs.mapInArrow(scan, "doc_id long, n long, digest binary, bits binary")


_SKETCH = pa.schema([("cell", pa.int32()), ("at", pa.binary()), ("count", pa.binary())])


def _sketch(docs: DataFrame, k: int) -> DataFrame:
    """Each task's part of the counting sketch, in cells; a thin cell as places and counts, a full one as counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SKETCH_BITS, np.uint32)
        wait: list[np.ndarray] = []
        size = 0
        for batch in textscan.bounded(batches):
            for _, u in shingle_sets(batch.column("text"), k):
                wait.append((u & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64))
                size += len(u)
                if size >= 1 << 21:
                    table += np.bincount(np.concatenate(wait), minlength=len(table)).astype(np.uint32)
                    wait, size = [], 0
        if wait:
            table += np.bincount(np.concatenate(wait), minlength=len(table)).astype(np.uint32)
        for cell in range(_CELLS):
            own = np.minimum(table[cell << _CELL : (cell + 1) << _CELL], 65535)
            own = own.astype(np.uint8 if own.max() < 256 else np.uint16)
            at = np.flatnonzero(own)
            if len(at) * 3 < len(own):
                where, count = at.astype(np.uint32).tobytes(), own[at].tobytes()
            else:
                where, count = None, own.tobytes()
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([where], pa.binary()), pa.array([count], pa.binary())], schema=_SKETCH)

    return docs.mapInArrow(scan, "cell int, at binary, count binary")


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for cell, at, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = total.setdefault(cell, np.zeros(1 << _CELL, np.uint32))
            n = len(own) if at is None else len(at) // 4
            own[slice(None) if at is None else np.frombuffer(at, np.uint32)] += np.frombuffer(count, np.uint8 if len(count) == n else np.uint16)
    for cell, own in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([cell], pa.int32()), pa.array([np.minimum(own, 65535).astype(np.uint16).tobytes()], pa.binary())], names=["cell", "count"])


class _Order:
    """The global order of n-grams, from the merged sketch (8 MB at any corpus size)."""

    def __init__(self, shared, cuts: list[int]):
        self.shared, self.cuts = shared, cuts

    def sort(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """u in the global order, and its places in it."""
        count = np.frombuffer(self.shared.value, np.uint16)[(u & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
        place = (count.astype(np.uint64) << np.uint64(48)) | (u >> np.uint64(16))
        at = np.argsort(place, kind="stable")
        return u[at], place[at]

    def fragments(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(place, np.array(self.cuts, np.uint64))


def _order(docs: DataFrame, k: int) -> _Order:
    spark = docs.sparkSession
    n = min(_CELLS, shuffle_partitions(spark))
    merged = _sketch(docs.select("text"), k).repartition(n, F.col("cell")).mapInArrow(_summed, "cell int, count binary")
    table = np.zeros(1 << SKETCH_BITS, np.uint16)
    for row in merged.collect():
        table[row.cell << _CELL : (row.cell + 1) << _CELL] = np.frombuffer(row["count"], np.uint16)
    # Cut so that the fragments hold equally many n-gram occurrences.
    mass = (np.bincount(table, minlength=65536) * np.arange(65536.0)).cumsum()
    cuts = []
    for f in range(1, FRAGMENTS):
        goal = mass[-1] * f / FRAGMENTS
        c = int(np.searchsorted(mass, goal))
        before = mass[c - 1] if c else 0.0
        part = (goal - before) / max(mass[min(c, 65535)] - before, 1.0)
        cuts.append((min(c, 65535) << 48) | min(int(part * 2**48), 2**48 - 1))
    return _Order(spark.sparkContext.broadcast(table.tobytes()), cuts)


def _one_text_an_id(docs: DataFrame, sets: DataFrame) -> DataFrame:
    odd = sets.where("doc_id is not null").groupBy("doc_id").agg(F.count_distinct(F.coalesce("digest", F.lit(b""))).alias("n")).where("n > 1").limit(1)
    if odd.count():
        return docs.groupBy("doc_id").agg(F.max("text").alias("text"))
    return docs


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, max_filter_bits: int = repeats.MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (of the document's class, among those compared) for each row of docs.

    Documents link when den * |intersection| >= num * |union| of their sets of k-word shingles.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    survey = checkpointed(_survey(docs, k))
    sets = survey
    order = _order(docs, k)
    single = _one_text_an_id(docs, sets)
    if single is not docs:
        sets = checkpointed(_survey(single, k))
    # Written, so that both sides of the join are plain shuffles, of which a partition with many copies can be split.
    classes = checkpointed(sets.where("doc_id is not null and n > 0").groupBy("digest").agg(F.min("doc_id").alias("class_id")))
    members = checkpointed(sets.where("doc_id is not null and n > 0").join(classes, "digest").select("doc_id", "class_id", "n", "bits"))
    total, n_docs = members.agg(F.sum("n"), F.count("*")).first()
    real = single.where("doc_id is not null")

    def prefix(u: np.ndarray) -> np.ndarray:
        return order.sort(u)[0][: _needed(len(u), num, den)]

    # Of equal sets one goes on; a filter of their ids lets others pass seldom, which costs time only.
    firsts = members.where("doc_id = class_id").select("class_id").distinct()
    first = repeats.build(firsts, _twofold, repeats.bits_for(firsts.count(), 16))

    def picked(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(first.suspects(textscan.mix(batch.column("doc_id").to_numpy().view(np.uint64)))))

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, u in shingle_sets(picked(batch).column("text"), k):
            yield prefix(u)

    looked_up = (total or 0) * (den - num) // den + (n_docs or 0)
    twice = repeats.build(real, hashes, repeats.bits_for(looked_up, 16, max_filter_bits), "text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in map(picked, textscan.bounded(batches)):
            ids = batch.column("doc_id").to_numpy()
            found, owner, place = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for row, u in shingle_sets(batch.column("text"), k):
                p = prefix(u)
                at = np.flatnonzero(twice.suspects(p))
                found.append(p[at])
                owner.append(np.full(len(at), ids[row]))
                place.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(textscan.signed(np.concatenate(found))), pa.array(np.concatenate(owner)), pa.array(np.concatenate(place))], names=["key", "doc_id", "at"])

    keys = real.mapInArrow(emit, "key long, doc_id long, at long").join(members, "doc_id").where("doc_id = class_id").select("key", F.col("class_id").alias("node"), "n", "at")
    keys = checkpointed(keys)
    first.destroy()
    twice.destroy()
    bits = members.where("doc_id = class_id").select(F.col("class_id").alias("node"), "bits").distinct()
    links = _links(keys, bits, real, order, k, num, den, group_limit)
    order.shared.destroy()
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    linked = checkpointed(connected_components(links).join(degree, "node", "left"))
    out = members.join(linked, F.col("class_id") == F.col("node"), "left")
    out = out.select("doc_id", F.coalesce("root", "class_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))
    rows = survey.select("doc_id", F.col("n").alias("n_shingles"))
    return rows.join(out.distinct(), "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def _pieces(nodes: DataFrame, docs: DataFrame, order: _Order, k: int) -> DataFrame:
    """(node, fragment, part): the sets of the nodes, cut at the global order's fragments."""
    wanted = repeats.build(nodes, _twofold, repeats.bits_for(nodes.count(), 16))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            ids = batch.column("doc_id").to_numpy()
            some = np.flatnonzero(wanted.suspects(textscan.mix(ids.view(np.uint64))))
            if not len(some):
                continue
            batch, ids = batch.take(pa.array(some)), ids[some]
            for row, u in shingle_sets(batch.column("text"), k):
                u, place = order.sort(u)
                at = np.array([0, *order.fragments(place).tolist(), len(u)], np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(FRAGMENTS, ids[row])), pa.array(np.arange(FRAGMENTS, dtype=np.int32)), pa.ListArray.from_arrays(at, pa.array(textscan.signed(u)))], names=["node", "fragment", "part"])

    pieces = checkpointed(docs.mapInArrow(cut, "node long, fragment int, part array<long>"))
    wanted.destroy()
    return pieces


def _verified(pairs: DataFrame, docs: DataFrame, order: _Order, k: int, num: int, den: int) -> DataFrame:
    """pairs (a, b, n_a, n_b): the overlap summed over the fragments, and whether it suffices."""
    pieces = _pieces(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, order, k)
    left = pieces.select(F.col("node").alias("a"), "fragment", F.col("part").alias("part_a"))
    right = pieces.select(F.col("node").alias("b"), "fragment", F.col("part").alias("part_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "n_a", "n_b", F.size(F.array_intersect("part_a", "part_b")).alias("o"))
    both = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("o").alias("o"))
    return checkpointed(both.select("a", "b", (F.col("o") * den >= (F.col("n_a") + F.col("n_b") - F.col("o")) * num).alias("linked")))


class _Group:
    """The members of one group, and which of them can link."""

    def __init__(self, rows: dict[str, np.ndarray], num: int, den: int):
        self.node, self.n, self.at, self.root, self.bits = (rows[c] for c in ("node", "n", "at", "root", "bits"))
        self.num, self.den = num, den

    def near(self, i: np.ndarray | int, j: np.ndarray) -> np.ndarray:
        """Of members i (one, or one for each of j) and j, whether they can link."""
        n, m, num, den = self.n[i], self.n[j], self.num, self.den
        fits = np.minimum(m, n) * den >= np.maximum(m, n) * num
        # The overlap that the threshold asks for, and what can still follow this n-gram.
        fits &= np.minimum(m - self.at[j], n - self.at[i]) * (den + num) >= num * (n + m)
        some = np.flatnonzero(fits)
        one = np.broadcast_to(i, fits.shape)[some]
        apart = np.bitwise_count(self.bits[j[some]] ^ self.bits[one]).sum(axis=1, dtype=np.int64)
        fits[some] = apart * (den + num) <= (den - num) * (self.n[one] + m[some])
        return fits

    def forest(self) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        rest = np.arange(len(self.node))
        while len(rest) > 1:
            queue, rest = [int(rest[0])], rest[1:]
            while queue and len(rest):
                i = queue.pop()
                same = self.root[rest] == self.root[i]
                near = self.near(i, rest) & ~same
                out += [(i, j) for j in rest[near].tolist()]
                queue += rest[near | same].tolist()
                rest = rest[~(near | same)]
        return out

    def open(self) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for i in range(len(self.node) - 1):
            rest = np.flatnonzero(self.root[i + 1 :] != self.root[i]) + i + 1
            out += [(i, j) for j in rest[self.near(i, rest)].tolist()] if len(rest) else []
        return out


def _candidates(held: DataFrame, num: int, den: int, every: bool) -> DataFrame:
    """Pairs (a, b, n_a, n_b) of members of a group that can link; held is sorted by group inside each partition."""

    def pairs(g: _Group, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
        swap = g.node[i] > g.node[j]
        a, b = np.where(swap, j, i), np.where(swap, i, j)
        return pa.RecordBatch.from_arrays([pa.array(g.node[a]), pa.array(g.node[b]), pa.array(g.n[a]), pa.array(g.n[b])], names=["a", "b", "n_a", "n_b"])

    def listed(cols: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        """cols: whole groups, one after the other."""
        change = np.flatnonzero((cols["label"][1:] != cols["label"][:-1]).any(axis=1)) + 1
        bounds = np.array([0, *change.tolist(), len(cols["node"])])
        size = np.repeat(np.diff(bounds), np.diff(bounds))
        number = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        g = _Group(cols, num, den)
        for lag in range(1, SMALL):
            i = np.flatnonzero((number[lag:] == number[:-lag]) & (size[lag:] <= SMALL) & (g.root[lag:] != g.root[:-lag])) if len(number) > lag else np.zeros(0, np.int64)
            i = i[g.near(i, i + lag)] if len(i) else i
            if len(i):
                yield pairs(g, i, i + lag)
        for at in np.flatnonzero(np.diff(bounds) > SMALL):
            own = _Group({c: x[bounds[at] : bounds[at + 1]] for c, x in cols.items()}, num, den)
            met = own.open() if every else own.forest()
            if met:
                yield pairs(own, *(np.array(x, np.int64) for x in zip(*met, strict=True)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {c: batch.column(c).to_numpy() for c in ("node", "n", "at", "root")}
            cols["label"] = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "one", "two")], axis=1)
            cols["bits"] = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint64).reshape(-1, BITMAP)
            if rest is not None:
                cols = {c: np.concatenate([rest[c], x]) for c, x in cols.items()}
            # The last group may go on in the next batch.
            differs = np.flatnonzero((cols["label"] != cols["label"][-1]).any(axis=1))
            cut = int(differs[-1]) + 1 if len(differs) else 0
            if cut:
                yield from listed({c: x[:cut] for c, x in cols.items()})
            rest = {c: x[cut:] for c, x in cols.items()}
        if rest is not None:
            yield from listed(rest)

    return held.mapInArrow(scan, "a long, b long, n_a long, n_b long").distinct()


def _links(keys: DataFrame, bits: DataFrame, docs: DataFrame, order: _Order, k: int, num: int, den: int, group_limit: int) -> DataFrame:
    """Verified links (a, b) that connect what any links connect."""
    n = shuffle_partitions(keys.sparkSession)
    large = checkpointed(keys.groupBy("key").agg(F.count("*").alias("m")).where(F.col("m") > SMALL))
    links = seen = None
    for every in (False, True):
        held = keys.join(large, "key", "left" if links is None else "inner")
        if links is None:
            held = held.withColumn("root", F.col("node"))
        else:
            held = held.join(connected_components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
            held = held.join(held.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key"), "key", "left_semi")
        blocks = F.ceil(F.coalesce("m", F.lit(1)) / group_limit).cast("int")
        dealt = held.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).select("key", "node", "n", "at", "root", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
        dealt = dealt.select("key", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "node", "n", "at", "root").join(bits, "node")
        dealt = dealt.repartition(n, "key", "one", "two").sortWithinPartitions("key", "one", "two", "n", "node")
        pairs = _candidates(dealt, num, den, every)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        new = _verified(checkpointed(pairs), docs, order, k, num, den)
        found = new.where("linked").select("a", "b")
        links = found if links is None else checkpointed(links.union(found))
        seen = new.select("a", "b")
    return links


def _twofold(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    h = textscan.mix(batch.column(0).to_numpy().view(np.uint64))
    yield np.concatenate([h, h])


def report(docs: DataFrame, **how) -> DataFrame:
    return near_duplicates(docs, **how).select("doc_id", "n_shingles", "component_id")
