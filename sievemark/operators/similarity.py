"""Pairs of similar short sequences by seeds, without a join on length.

Of two sequences of n and more letters, the longer of length m, whose identity reaches a
threshold, the shorter has at least k letters that agree at the right offset. It is cut into
blocks, so few that one has r of them: any r places of a block are a seed. n and m alone
decide about blocks and r, so both sides cut alike: the shorter
sequence gives the letters at a seed's places, the longer one those at the same places moved
by every offset, for each n that it can meet. Sequences with a seed in common meet in its group, where their letters at
that offset are compared; only pairs that reach the threshold there leave it.
Contained sequences, which the threshold does not bind, meet through their first letters.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.graph import spread, written

#: Sequences up to this length meet by seeds; longer ones, whose offsets are many, by bands of lengths.
SEEDED = 64
#: Letters by which a contained sequence meets others.
HEAD = 8
#: Rows of seeds that leave a task, or are met, at a time.
ROWS = 1 << 17
#: Pairs that are compared at a time.
PAIRS = 1 << 16
#: Rows of a seed's group that one task compares; larger groups are dealt in blocks.
GROUP = 1 << 16
#: Kinds of letters that the choice of seeds reckons with, and what it costs to compare a pair, in rows of seeds.
LETTERS, COMPARED = 16, 0.01
#: Bits of a letter, and letters of a word, where letters are compared before the pair's identity is: some letters share their bits.
BITS, PACKED = 5, 12
_LOWEST = np.uint64(sum(1 << BITS * i for i in range(PACKED)))
#: A seed's kind: how many letters may differ, whether the pair is of one length, and whether the row is the longer one.
_ALIKE, _LONGER = 1 << 8, 1 << 9

_rng = np.random.Generator(np.random.PCG64(20260727))
_PLACE = _rng.integers(1, 2**63, SEEDED + 1, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def needed(longer: int, least: float) -> int:
    """Matches that a pair needs whose longer sequence has so many letters."""
    return max(1, math.ceil(longer * least / 100 - 1e-9))


@functools.cache
def seeds(shorter: int, longer: int, least: float, others: float = 1e5) -> list[tuple[int, ...]]:
    """The places (from 0, in the shorter sequence) of every seed of a pair of these lengths; none if it cannot reach the threshold.

    others: the rows of seeds that it is worth to save comparing a sequence with all of a length. The more there are, the more letters a seed has.
    """
    need = needed(longer, least)
    if shorter < need:
        return []
    best: tuple[float, int, int] | None = None
    for r in range(1, need + 1):
        # Of fewer than `need` matches, blocks may have r - 1 each.
        blocks = min((need - 1) // (r - 1), shorter) if r > 1 else 1
        size, more = divmod(shorter, blocks)
        n = more * math.comb(size + 1, r) + (blocks - more) * math.comb(size, r) if r > 1 else shorter - need + 1
        cost = n * (1 + others * float(LETTERS) ** -r)
        if best is None or cost < best[0]:
            best = cost, blocks, r
    _, blocks, r = best
    if r == 1:
        return [(p,) for p in range(shorter - need + 1)]
    return [places for i in range(blocks) for places in itertools.combinations(range(shorter * i // blocks, shorter * (i + 1) // blocks), r)]


def _salt(*x: int) -> np.uint64:
    """A number for a kind of seed."""
    h = 0
    for v in x:
        h = ((h ^ v) * 0xBF58476D1CE4E5B9 + 0x94D049BB133111EB) & (1 << 64) - 1
        h ^= h >> 29
    return np.uint64(h)


def _hash(letters: np.ndarray, places: tuple[int, ...], offset: int, salt: np.uint64) -> np.ndarray:
    """For each column of letters one number for those at the places, moved by the offset."""
    h = np.full(letters.shape[1], salt)
    for p in places:
        h += letters[p + offset] * _PLACE[p]
    h ^= h >> np.uint64(31)
    h *= _MIX
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def _packed(letters: np.ndarray, words: int) -> list[np.ndarray]:
    """Each column of letters in words; equal letters have equal bits."""
    bits = np.uint64(BITS)
    low = (letters ^ (letters >> bits) ^ (letters >> bits * np.uint64(2)) ^ (letters >> bits * np.uint64(3))) & np.uint64((1 << BITS) - 1)
    out = [np.zeros(letters.shape[1], np.uint64) for _ in range(words)]
    for i, x in enumerate(low):
        out[i // PACKED] |= x << np.uint64(BITS * (i % PACKED))
    return [x.view(np.int64) for x in out]


def _named(words: int) -> list[str]:
    return [f"w{i}" for i in range(words)]


def _seeded(rows: DataFrame, least: float, heads: list[int], others: float, words: int) -> DataFrame:
    """(key, ord, kind, letters in words): the seeds of rows (ord, sequence) as the shorter and as the longer of a pair.

    A key's last bit says whether the row is the longer one: in the order of this one number the shorter rows of a group come first.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("sequence").to_pylist()
            size = np.array([len(t) for t in texts], np.int64)
            ords = batch.column("ord").to_numpy()
            for n in np.unique(size).tolist():
                own = np.flatnonzero(size == n)
                step = max(1, ROWS // (4 * n))
                for at in range(0, len(own), step):
                    some = own[at : at + step]
                    letters = np.frombuffer("".join(texts[i] for i in some.tolist()).encode("utf-32-le"), np.uint32).reshape(len(some), n).T.astype(np.uint64, order="C")
                    seen, held = [], 0
                    for seed in _keys(letters, n):
                        seen.append(seed)
                        held += len(some)
                        if held >= ROWS:
                            yield _batch(seen, ords[some])
                            seen, held = [], 0
                    if seen:
                        yield _batch(seen, ords[some])

    def _batch(seen: list[tuple[np.ndarray, int, list[np.ndarray]]], ords: np.ndarray) -> pa.RecordBatch:
        kinds = np.repeat(np.array([kind for _, kind, _ in seen], np.int32), len(ords))
        letters = (pa.array(np.concatenate([own[i] for _, _, own in seen])) for i in range(words))
        keys = np.concatenate([key & np.int64(-2) | np.int64(kind >= _LONGER) for key, kind, _ in seen])
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(ords, len(seen))), pa.array(kinds), *letters], names=["key", "ord", "kind", *_named(words)])

    def _keys(letters: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, int, list[np.ndarray]]]:
        nothing = [np.zeros(letters.shape[1], np.int64)] * words
        for k in heads:
            for o in range(n - k + 1):
                yield _hash(letters, tuple(range(k)), o, _salt(k)), _LONGER, nothing
        k = min(n, HEAD)
        yield _hash(letters, tuple(range(k)), 0, _salt(k)), 0, nothing
        if n > SEEDED:
            return
        for shorter in range(needed(n, least), n + 1):
            kind = _LONGER | shorter - needed(n, least) | (_ALIKE if shorter == n else 0)
            for o in range(n - shorter + 1):
                own = _packed(letters[o : o + shorter], words)
                for i, places in enumerate(seeds(shorter, n, least, others)):
                    yield _hash(letters, places, o, _salt(shorter, n, i)), kind, own
        own = _packed(letters, words)
        for longer in range(n, SEEDED + 1):
            if needed(longer, least) > n:
                break
            kind = n - needed(longer, least) | (_ALIKE if n == longer else 0)
            for i, places in enumerate(seeds(n, longer, least, others)):
                yield _hash(letters, places, 0, _salt(n, longer, i)), kind, own

    return rows.mapInArrow(emit, ", ".join(["key long, ord long, kind int", *(f"{w} long" for w in _named(words))]))


def _met(rows: DataFrame, words: int, most: int | None) -> DataFrame:
    """Seeds' rows -> (a, b), a < b, of those that meet under a key and agree there in as many letters as they need.

    Rows whose keys differ in the last bit alone are a group. Of groups with more than `most` rows the rows themselves come out, as (a: their
    ord, no b, key without that bit, kind, words).
    """
    names = ["key", "ord", "kind", *_named(words)]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n, large = 0, None
        for batch in batches:
            new = [batch.column(c).to_numpy() for c in names]
            new[0] = new[0] >> 1
            if large is not None:
                own = int(np.searchsorted(new[0], large, "right"))
                if own:
                    yield _left([x[:own] for x in new])
                    new = [x[own:] for x in new]
            if not len(new[0]):
                continue
            large = None
            held.append(new)
            n += len(new[0])
            if n < ROWS:
                continue
            run = [np.concatenate(x) for x in zip(*held, strict=True)]
            cut = int(np.searchsorted(run[0], run[0][-1]))
            yield from _groups([x[:cut] for x in run])
            last = [x[cut:] for x in run]
            held, n = [last], len(last[0])
            if most is not None and n > most:
                yield _left(last)
                held, n, large = [], 0, run[0][-1]
        if n:
            yield from _groups([np.concatenate(x) for x in zip(*held, strict=True)])

    def _left(run: list[np.ndarray]) -> pa.RecordBatch:
        key, a, *rest = run
        return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()), pa.array(key), *(pa.array(x) for x in rest)], names=["a", "b", *(c for c in names if c != "ord")])

    def _groups(run: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, ords, kind = run[:3]
        if not len(key):
            return
        letters = [x.view(np.uint64) for x in run[3:]]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.append(first, len(key)))
        if most is not None and size.max() > most:
            large = np.repeat(size > most, size)
            yield _left([x[large] for x in run])
            yield from _groups([x[~large] for x in run])
            return
        # Rows of a key stand in order: the shorter ones, each of which meets all the longer ones, are first.
        longer = np.add.reduceat((kind >= _LONGER).astype(np.int64), first)
        short = np.flatnonzero((kind < _LONGER) & (np.repeat(longer, size) > 0))
        group = np.searchsorted(first, short, "right") - 1
        count, start = longer[group], (first + size - longer)[group]
        ends = np.cumsum(count)
        found, met, at = [], 0, 0
        while at < len(short):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - count[at] + PAIRS, "right")))
            some = count[at:to]
            i = np.repeat(short[at:to], some)
            j = np.arange(len(i)) + np.repeat(start[at:to] - (np.cumsum(some) - some), some)
            at = to
            differ = np.zeros(len(i), np.int16)
            for w in letters:
                x = w[i]
                x ^= w[j]
                y = x | x >> np.uint64(1)
                y |= y >> np.uint64(2)
                y |= x >> np.uint64(4)
                y &= _LOWEST
                differ += np.bitwise_count(y)
                kept = np.flatnonzero(differ <= (kind[j] & _ALIKE - 1))
                i, j, differ = i[kept], j[kept], differ[kept]
            a, b = ords[i], ords[j]
            kept = np.where(kind[j] & _ALIKE, a < b, a != b)
            a, b = a[kept], b[kept]
            found.append((np.minimum(a, b), np.maximum(a, b)))
            met += len(a)
            if met >= ROWS:
                yield _once(found)
                found, met = [], 0
        if met:
            yield _once(found)

    def _once(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        none = [pa.nulls(len(new), pa.int64()), pa.nulls(len(new), pa.int32()), *(pa.nulls(len(new), pa.int64()) for _ in range(words))]
        return pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), *none], names=["a", "b", *(c for c in names if c != "ord")])

    schema = ", ".join(["a long, b long, key long, kind int", *(f"{w} long" for w in _named(words))])
    # One number alone is sorted by its bits, without comparing rows of equal keys.
    return spread(rows, F.shiftright("key", 1)).sortWithinPartitions("key").mapInArrow(meet, schema)


def _dealt(rows: DataFrame, group: int) -> DataFrame:
    """Rows of large keys in blocks: every block of a key's shorter rows meets every one of its longer rows under a key of its own."""
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / F.lit(max(1, group // 4))).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("a"), F.col("blocks"))
    each = rows.join(F.broadcast(blocks), "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
    is_long = F.col("kind") >= _LONGER
    key = F.xxhash64("key", F.when(is_long, F.col("other")).otherwise(F.col("own")), F.when(is_long, F.col("own")).otherwise(F.col("other")))
    key = key.bitwiseAND(F.lit(-2).cast("long")).bitwiseOR(is_long.cast("long"))
    return each.select(key.alias("key"), F.col("a").alias("ord"), "kind", *(c for c in rows.columns if c.startswith("w")))


def candidate_pairs(rows: DataFrame, least: float, group: int | None = None) -> DataFrame:
    """(a, b), a < b: pairs of rows (ord, sequence) that have a seed in common and agree at its offset, or lie in one band if one is longer than SEEDED."""
    rows = spread(rows.select(F.col("ord").cast("long").alias("ord"), "sequence").where("sequence <> ''"), "ord")
    n, group = F.length("sequence"), group or GROUP
    count, lengths, most, heads = rows.agg(F.count("*"), F.count_distinct(F.least(n, F.lit(SEEDED))), F.max(n), F.collect_set(F.least(n, F.lit(HEAD)))).first()  # HEAD values at most
    heads, most, others = sorted(heads), most or 0, COMPARED * count / max(lengths, 1)
    words = -(-max(1, min(most, SEEDED)) // PACKED)
    found = written(_met(_seeded(rows, least, heads, others, words), words, group))
    large = written(_dealt(found.where("b is null").select("a", "key", "kind", *_named(words)), group))
    met = found.where("b is not null").select("a", "b").union(_met(large, words, None).select("a", "b"))
    if most > SEEDED:
        reach = F.floor(n / (max(least, 1.0) / 100)).cast("int")
        left = rows.where(reach > SEEDED).select(F.col("ord").alias("a"), n.alias("n"), F.explode(F.sequence(F.greatest(n, F.lit(SEEDED + 1)), F.greatest(reach, F.lit(SEEDED + 1)))).alias("m"))
        right = rows.where(n > SEEDED).select(F.col("ord").alias("b"), n.alias("m"))
        band = left.join(right, "m").where("n < m or a < b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        met = met.union(band)
    return met.distinct()


def similar_pairs(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, identity) for pairs a < b of ord of rows (ord, sequence) with identity of at least `least` per cent.

    Empty sequences are like none. Equal sequences with several ord contain each other. Any row's ord must be its own.
    """
    # Read by the seeds, for what decides about them, and by both sides of the pairs.
    own = written(rows.select(F.col("ord").cast("long").alias("ord"), "sequence"))
    met = candidate_pairs(own, least)
    both = met.join(own.select(F.col("ord").alias("a"), F.col("sequence").alias("sa")), "a").join(own.select(F.col("ord").alias("b"), F.col("sequence").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(_compared(least), "a long, b long, identity double")


def _pairs(batch: pa.RecordBatch, one: str, other: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, letters of one, letters of the other) of a batch's rows, for each pair of lengths; letters stand place by place."""
    columns = [batch.column(c).to_pylist() for c in (one, other)]
    size = np.array([[len(t) for t in texts] for texts in columns], np.int64).reshape(2, -1)
    codes = [np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) for texts in columns]
    first = np.cumsum(size, axis=1) - size
    order = np.lexsort(size)
    cut = np.flatnonzero(np.any(np.diff(size[:, order], axis=1), axis=0)) + 1
    for rows in np.split(order, cut):
        if len(rows):
            yield rows, *(codes[i][first[i, rows] + np.arange(size[i, rows[0]])[:, None]] for i in (0, 1))


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many letters of each column agree."""
    places, n = x.shape
    if n < places:
        return np.count_nonzero(x == y, axis=0)
    out = np.zeros(n, np.uint8 if places < 1 << 8 else np.int64)
    for i in range(places):
        out += x[i] == y[i]
    return out.astype(np.int64)


def _compared(least: float):
    """Rows (a, b, sa, sb) with their identity, as fs.percent_identity has it, where it is at least so much."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            identity = np.zeros(batch.num_rows)
            for rows, x, y in _pairs(batch, "sa", "sb"):
                short, long = (x, y) if len(x) <= len(y) else (y, x)
                n, m = len(short), len(long)
                if n:
                    top = functools.reduce(np.maximum, (_agree(short, long[o : o + n]) for o in range(m - n + 1)))
                    identity[rows] = np.where(top == n, 99.9, top * 100.0 / m)
            kept = np.flatnonzero(identity >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(kept)), batch.column("b").take(pa.array(kept)), pa.array(identity[kept])], names=["a", "b", "identity"])

    return scan


def with_offset(rows: DataFrame) -> DataFrame:
    """rows, of whose columns sequence and anchor are two, with the offset of the one against the other, as fs.best_offset has it; 0 without letters."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offset = np.zeros(batch.num_rows, np.int32)
            for own, x, y in _pairs(batch, "sequence", "anchor"):
                n, m = len(x), len(y)
                best = np.full(len(own), -1)
                for o in range(1 - n, m):
                    lo, hi = max(0, o), min(m, o + n)
                    # The score, then the overlap, then the nearer and the negative offset.
                    value = ((_agree(x[lo - o : hi - o], y[lo:hi]) * (n + m) + hi - lo) * (n + m) + n + m - 1 - abs(o)) * 2 + (o < 0)
                    better = value > best
                    best = np.where(better, value, best)
                    offset[own[better]] = o
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(offset)], names=[*batch.schema.names, "offset"])

    return rows.mapInArrow(scan, ", ".join([*(f"`{c}` {kind}" for c, kind in rows.dtypes), "offset int"]))
