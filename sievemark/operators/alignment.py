"""Alignment of many groups of sequences, each around its centre.

A group's centre is the sequence whose k-mers are the most frequent ones of the group, so no pairs are compared to find it. Every
other one is aligned to the centre on its own, with affine gaps; a batch of pairs is aligned together, row by row of the
table. Where the centre gets gaps, the widest of the group counts: these are summed up by group and place, and every sequence
is then written out on its own. So a group is never one task, however many sequences it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs
from sievemark.operators.graph import written

#: Cells of the tables of pairs that are aligned together.
CELLS = 1 << 22
_FAR = -(1 << 28)


def centres(rows: DataFrame, k: int = 3) -> DataFrame:
    """(group, centre) of rows (group, ord, sequence): the sequence with the largest mean count of its k-mers in the group, the first of equals."""
    grams = rows.select("group", "ord", F.explode(fs.windows(F.col("sequence"), k)).alias("gram"))
    counts = grams.groupBy("group", "gram").agg(F.count("*").alias("n"))
    score = grams.join(counts, ["group", "gram"]).groupBy("group", "ord").agg(F.avg("n").alias("score"))
    own = rows.join(score, ["group", "ord"], "left").select("group", F.struct(F.coalesce("score", F.lit(0.0)).alias("s"), (-F.col("ord")).alias("o"), "sequence").alias("c"))
    return own.groupBy("group").agg(F.max("c").alias("c")).select("group", F.col("c.sequence").alias("centre"))


def aligned_pairs(pairs: list[tuple[str, str]], match: int = 2, mismatch: int = -1, gap_open: int = -4, gap_extend: int = -1, band: int | None = None) -> list[tuple[int, str]]:
    """For each pair (centre, other) of strings of like lengths the score and the edits of a best global alignment: M both, D centre only, I other only.

    A gap of n costs gap_open + (n - 1) * gap_extend. band: how far from the straight line an alignment may go; without it, anywhere.
    Of equal alignments edits from the end prefer M, then D, then I.
    """
    n, m = (max((len(p[i]) for p in pairs), default=0) for i in (0, 1))
    a, b = (np.zeros((len(pairs), w), np.uint32) for w in (n, m))
    for i, (x, y) in enumerate(pairs):
        a[i, : len(x)] = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        b[i, : len(y)] = np.frombuffer(y.encode("utf-32-le"), np.uint32)
    size_a, size_b = np.array([len(x) for x, _ in pairs]), np.array([len(y) for _, y in pairs])
    j = np.arange(m + 1)
    # Best scores that end in both letters, in a gap of the other (D) and in one of the centre (I).
    diagonal = np.full((len(pairs), m + 1), _FAR)
    diagonal[:, 0] = 0
    down = np.full((len(pairs), m + 1), _FAR)
    right = np.where(j > 0, gap_open + (j - 1) * gap_extend, _FAR) + np.zeros((len(pairs), 1), np.int64)
    tables = [(diagonal, down, right)]
    for i in range(1, n + 1):
        top = np.maximum(np.maximum(diagonal, down), right)
        now = np.full((len(pairs), m + 1), _FAR)
        now[:, 1:] = top[:, :-1] + np.where(a[:, i - 1, None] == b, match, mismatch)
        below = np.maximum(np.maximum(diagonal, right) + gap_open, down + gap_extend)
        if band is not None:
            off = np.abs(j[None] - i * size_b[:, None] / np.maximum(size_a[:, None], 1)) > band + 1 + size_b[:, None] / np.maximum(size_a[:, None], 1)
            now[off], below[off] = _FAR, _FAR
        # A gap of the centre may begin at any place to the left: the best start is a running maximum.
        start = np.maximum(now, below) - gap_extend * j
        run = np.maximum.accumulate(start, axis=1)
        side = np.full((len(pairs), m + 1), _FAR)
        side[:, 1:] = run[:, :-1] + gap_open + gap_extend * (j[1:] - 1)
        if band is not None:
            side[off] = _FAR
        diagonal, down, right = now, below, side
        tables.append((diagonal, down, right))
    return [_traced(tables, p, x, y, gap_open, gap_extend) for p, (x, y) in enumerate(pairs)]


def _traced(tables: list, p: int, x: str, y: str, gap_open: int, gap_extend: int) -> tuple[int, str]:
    i, j = len(x), len(y)
    at = lambda t, i, j: int(tables[i][t][p, j])
    best = max(at(t, i, j) for t in range(3))
    state = next(t for t in range(3) if at(t, i, j) == best)
    out = []
    while i or j:
        out.append("MDI"[state])
        value = at(state, i, j)
        if state == 0:
            i, j = i - 1, j - 1
            before = max(at(t, i, j) for t in range(3))
            state = next(t for t in range(3) if at(t, i, j) == before)
        else:
            i, j = (i - 1, j) if state == 1 else (i, j - 1)
            state = next(t for t in range(3) if at(t, i, j) + (gap_extend if t == state else gap_open) == value)
    return best, "".join(reversed(out))


def align(rows: DataFrame, k: int = 3, band: int | None = None, **costs: int) -> DataFrame:
    """(group, ord, sequence, alignment, score) of rows (group, ord, sequence): alignments of a group have one width, and without '-' are the sequences.

    A group's empty sequences are all gaps. Of a column the centre's gaps stand before its letter; letters of others in them stand to the left.
    """
    rows = rows.select("group", F.col("ord").cast("long").alias("ord"), F.coalesce("sequence", F.lit("")).alias("sequence"))
    paired = rows.join(centres(rows, k), "group")
    kind = rows.schema["group"].dataType.simpleString()

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = list(zip(batch.column("centre").to_pylist(), batch.column("sequence").to_pylist(), strict=True))
            order = sorted(range(len(pairs)), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
            found: list = [None] * len(pairs)
            at = 0
            while at < len(order):
                to = at + 1
                while to < len(order) and (to + 1 - at) * (len(pairs[order[to]][0]) + 1) * (max(len(pairs[i][1]) for i in (order[at], order[to])) + 1) * 3 <= CELLS:
                    to += 1
                for i, f in zip(order[at:to], aligned_pairs([pairs[i] for i in order[at:to]], band=band, **costs), strict=True):
                    found[i] = f
                at = to
            gaps = [_inserted(e) for _, e in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("group"), batch.column("ord"), batch.column("sequence"), pa.array([s for s, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string()), pa.array(gaps, pa.list_(pa.struct([("place", pa.int32()), ("n", pa.int32())])))],
                names=["group", "ord", "sequence", "score", "edits", "gaps"],
            )

    edited = written(paired.mapInArrow(edit, f"group {kind}, ord long, sequence string, score long, edits string, gaps array<struct<place:int,n:int>>"))
    widest = edited.select("group", F.explode("gaps").alias("g")).groupBy("group", "g.place").agg(F.max("g.n").alias("n"))
    widest = widest.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("wide"))  # at most one a place of the centre

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_written_out(s, e, {w["place"]: w["n"] for w in wide or ()}) for s, e, wide in zip(*(batch.column(c).to_pylist() for c in ("sequence", "edits", "wide")), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("group", "ord", "sequence")), pa.array(out, pa.string()), batch.column("score")], names=["group", "ord", "sequence", "alignment", "score"])

    full = edited.drop("gaps").join(widest, "group", "left")
    return full.mapInArrow(write, f"group {kind}, ord long, sequence string, alignment string, score long")


def _inserted(edits: str) -> list[dict]:
    """Before which places of the centre (from 0, one beyond its end) the other sequence has letters of its own, and how many."""
    out, place, n = [], 0, 0
    for e in [*edits, "M"]:
        if e == "I":
            n += 1
            continue
        if n:
            out.append({"place": place, "n": n})
        place, n = place + 1, 0
    return out


def _written_out(sequence: str, edits: str, wide: dict[int, int]) -> str:
    letters, out, place, own = iter(sequence), [], 0, []
    for e in [*edits, ""]:
        if e == "I":
            own.append(next(letters))
            continue
        out.append("".join(own).ljust(wide.get(place, 0), "-"))
        place, own = place + 1, []
        if e:
            out.append(next(letters) if e == "M" else "-")
    return "".join(out)
