"""Removal of long repeated byte strings by a sparse suffix array.

Every string of `length` bytes holds an anchor: the least-hashed `gram`-byte piece
inside it, so equal strings have their anchors at the same offset. Only suffixes at
anchors are sorted, about 2 in 150. A filter of what is seen twice keeps anchors
whose gram occurs once out of the shuffle. The others meet by gram; what follows
an anchor and, backwards, what precedes it are ordered by deep-shallow sorting,
and neighbours' common prefixes say for every offset which strings are equal,
byte by byte. A text is then cut by the offsets of its anchors' contexts.

Equal contexts are one from the start, so groups of copies cost one context a
task. A gram with more contexts than group_limit is not sorted in one task: its
strings are counted by digest over the whole cluster instead.

Defined results. Null or empty text: no bytes. Strings never cross rows; rows that
are equal repeat each other, so texts of at least `length` bytes go in all of them.
Which copy comes first does not matter: all go. Of equal hashes in a string the first
is its anchor. Texts of any length are scanned whole, in pieces. An empty table gives
an empty one. Columns with the names of the results are replaced; names that begin
with __ are the operator's own.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import deep_shallow, repeats, textscan
from sievemark.llm.stage import checkpointed, shuffle_partitions, without

GRAM = 48
GROUP_LIMIT = 100_000
#: Bytes of a text whose strings are looked at together, and the bits that tell its places apart.
PIECE = 256 << 10
_PLACE = 20


def anchors(t: textscan.Texts, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor positions in the data of t, and the hashes of their grams; strings are taken a piece at a time."""
    found, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    width = length - gram + 1
    for at in range(0, len(t.data) - length + 1, PIECE):
        data = t.data[at : at + PIECE + length - 1]
        n = len(data) - length + 1
        # Strings that begin here and end in the same text.
        begin = np.arange(at, at + n)
        whole = begin + length <= t.offsets[np.searchsorted(t.offsets, begin, "right")]
        if not whole.any():
            continue
        grams = np.arange(n + width - 1)
        h = textscan.span_hash(data, grams, grams + gram)
        low = (h >> np.uint64(_PLACE) << np.uint64(_PLACE)) | grams.astype(np.uint64)
        have = 1
        while have * 2 <= width:
            low = np.minimum(low[:-have], low[have:])
            have *= 2
        if have < width:
            low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
        place = np.unique((low[whole] & np.uint64((1 << _PLACE) - 1)).astype(np.int64))
        found.append(place + at)
        hashes.append(h[place])
    # A string near the end of a piece may have an anchor that one of the next piece has, too.
    place, first = np.unique(np.concatenate(found), return_index=True)
    return place, np.concatenate(hashes)[first]


def _contexts(t: textscan.Texts, place: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(text, place in it, bytes before the anchor backwards, bytes from the anchor on)."""
    doc = np.searchsorted(t.offsets, place, "right") - 1
    lo = np.maximum(t.offsets[doc], place - (length - gram))
    hi = np.minimum(t.offsets[doc + 1], place + length)
    data = t.data.tobytes()
    for d, p, a, b, base in zip(doc.tolist(), place.tolist(), lo.tolist(), hi.tolist(), t.offsets[doc].tolist(), strict=True):
        yield d, p - base, data[a:p][::-1], data[p:b]


def _context_id(left: bytes, right: bytes) -> bytes:
    x = xxhash.xxh3_128(left)
    x.update(len(left).to_bytes(4, "big"))
    x.update(right)
    return x.digest()


def _reach(left: list[bytes], right: list[bytes], times: np.ndarray, group: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context the largest and least offset before its anchor at which a repeated string starts; -1 for none."""
    n = len(left)
    far, near = np.full(n, -1), np.full(n, -1)
    order_r, same_r = deep_shallow.sort(right, group)
    order_l, same_l = deep_shallow.sort(left, group)
    size_r, size_l = np.fromiter(map(len, right), np.int64, n), np.fromiter(map(len, left), np.int64, n)
    cls_r, cls_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for x in range(length - gram + 1):
        some = np.flatnonzero((size_r >= length - x) & (size_l >= x))
        if not len(some):
            continue
        cls_r[order_r] = np.cumsum(same_r < length - x)
        cls_l[order_l] = np.cumsum(same_l < x)
        key = cls_r[some] * (n + 1) + cls_l[some]
        by = np.argsort(key, kind="stable")
        key = key[by]
        equal = np.zeros(len(key), bool)
        equal[1:] = key[1:] == key[:-1]
        equal[:-1] |= equal[1:]
        found = some[by[equal | (times[some[by]] > 1)]]
        far[found] = x
        near[found[near[found] < 0]] = x
    return far, near


def _resolve(rows: list[tuple[int, bytes, bytes, int]], length: int, gram: int) -> pa.RecordBatch:
    """rows: distinct (gram, left, right) and how often each occurs."""
    g = np.array([r[0] for r in rows], np.int64)
    n = np.array([r[3] for r in rows], np.int64)
    _, group, size = np.unique(g, return_inverse=True, return_counts=True)
    some = np.flatnonzero((size[group] > 1) | (n > 1))
    left, right = [rows[i][1] for i in some], [rows[i][2] for i in some]
    far, near = _reach(left, right, n[some], group[some], length, gram) if len(some) else (np.zeros(0, np.int64),) * 2
    hit = np.flatnonzero(far >= 0)
    return pa.RecordBatch.from_arrays([pa.array([_context_id(left[i], right[i]) for i in hit], pa.binary()), pa.array(far[hit].astype(np.int32)), pa.array(near[hit].astype(np.int32)), *(pa.nulls(len(hit), k) for k in (pa.int64(), pa.binary(), pa.binary(), pa.int64()))], names=_RESOLVED)


_RESOLVED = ["context", "far", "near", "gram", "before", "after", "times"]
_RESOLVED_SCHEMA = "context binary, far int, near int, gram long, before binary, after binary, times long"
_TOGETHER = 4096


def repeated_spans(docs: DataFrame, length: int = 200, gram: int = GRAM, max_filter_bits: int = repeats.MAX_BITS, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(uid, spans array<struct<lo, hi>>): byte spans to remove, by the MD5 of the text. Spans may overlap."""
    texts = docs.select(F.unhex(F.md5("text")).alias("uid"), F.col("text").cast("string").alias("text")).where(F.octet_length("text") >= length)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for t in textscan.chunks(batch.column("text")):
            yield anchors(t, length, gram)[1]

    twice = repeats.build(texts.select("text"), hashes, repeats.bits_for(2 * size // (length - gram), 16, max_filter_bits), "text")

    def suspects(t: textscan.Texts) -> tuple[np.ndarray, np.ndarray]:
        place, h = anchors(t, length, gram)
        keep = twice.suspects(h)
        return place[keep], h[keep]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times: dict[tuple[int, bytes, bytes], int] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            items = iter(times.items())
            while some := list(itertools.islice(items, 4096)):
                (g, a, b), n = zip(*(k for k, _ in some), strict=True), [n for _, n in some]
                yield pa.RecordBatch.from_arrays([pa.array(g, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64())], names=["gram", "before", "after", "times"])

        for batch in textscan.bounded(batches):
            for t in textscan.chunks(batch.column("text")):
                place, h = suspects(t)
                for g, (_, _, a, b) in zip(textscan.signed(h).tolist(), _contexts(t, place, length, gram), strict=True):
                    times[g, a, b] = times.get((g, a, b), 0) + 1
                if len(times) >= 1 << 16:
                    yield from counted()
                    times = {}
        yield from counted()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by gram; groups are put together up to a size, and one that is too large is passed on."""
        ready: list[tuple[int, bytes, bytes, int]] = []
        own: dict[tuple[bytes, bytes], int] = {}
        gram_now, over = None, False

        def passed() -> pa.RecordBatch:
            k = len(own)
            a, b = zip(*own, strict=True)
            return pa.RecordBatch.from_arrays([pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.array([gram_now] * k, pa.int64()), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(list(own.values()), pa.int64())], names=_RESOLVED)

        for batch in batches:
            for g, a, b, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != gram_now:
                    if over and own:
                        yield passed()
                    elif own:
                        ready += [(gram_now, *k, m) for k, m in own.items()]
                    own, gram_now, over = {}, g, False
                    if len(ready) >= _TOGETHER:
                        yield _resolve(ready, length, gram)
                        ready = []
                own[a, b] = own.get((a, b), 0) + n
                if len(own) >= group_limit:
                    over = True
                    yield passed()
                    own = {}
        if over and own:
            yield passed()
        elif own:
            ready += [(gram_now, *k, m) for k, m in own.items()]
        if ready:
            yield _resolve(ready, length, gram)

    n = shuffle_partitions(docs.sparkSession)
    sorted_rows = texts.mapInArrow(contexts, "gram long, before binary, after binary, times long").repartition(n, "gram").sortWithinPartitions("gram")
    resolved = checkpointed(sorted_rows.mapInArrow(resolve, _RESOLVED_SCHEMA))
    reach = resolved.where("context is not null").select("context", "far", "near").union(_counted(resolved.where("context is null"), length))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in textscan.bounded(batches):
            uids = batch.column("uid").to_pylist()
            for t in textscan.chunks(batch.column("text")):
                place, _ = suspects(t)
                fresh = np.array([uids[t.first + d] not in seen for d in range(len(t))])
                seen.update(uids[t.first : t.first + len(t)])
                place = place[fresh[np.searchsorted(t.offsets, place, "right") - 1]] if len(t) else place
                rows = [(_context_id(a, b), uids[t.first + d], p) for d, p, a, b in _contexts(t, place, length, gram)]
                c, u, p = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()), pa.array(u, pa.binary()), pa.array(p, pa.int64())], names=["context", "uid", "at"])

    found = texts.mapInArrow(places, "context binary, uid binary, at long").join(reach, "context")
    span = F.struct((F.col("at") - F.col("far")).alias("lo"), (F.col("at") + length - F.col("near")).alias("hi"))
    return found.groupBy("uid").agg(F.collect_set(span).alias("spans"))


def _counted(hot: DataFrame, length: int) -> DataFrame:
    """The same for groups beyond the limit: every string of every context is counted by digest, with partial sums."""
    rows = hot.groupBy("gram", "before", "after").agg(F.sum("times").alias("times"))
    at = F.explode(F.sequence(F.greatest(F.lit(0), F.lit(length) - F.length("after")), F.length("before"))).alias("x")
    rows = rows.where(F.length("before") + F.length("after") >= length).select("before", "after", "times", at)
    said = F.concat(F.substring("before", F.lit(1), F.col("x")), F.lit(b"\0"), F.substring("after", F.lit(1), F.lit(length) - F.col("x")))
    rows = rows.select("before", "after", "times", "x", F.unhex(F.sha2(said, 256)).alias("said"))
    twice = rows.groupBy("x", "said").agg(F.sum("times").alias("n")).where("n > 1")
    hit = rows.join(twice, ["x", "said"]).groupBy("before", "after").agg(F.max("x").alias("far"), F.min("x").alias("near"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [_context_id(a, b) for a, b in zip(batch.column("before").to_pylist(), batch.column("after").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), batch.column("far"), batch.column("near")], names=["context", "far", "near"])

    return hit.mapInArrow(named, "context binary, far int, near int")


def remove_repeats(docs: DataFrame, length: int = 200, **how) -> DataFrame:
    """docs with kept (the remaining bytes), n_bytes, n_removed and n_spans (maximal removed runs)."""
    docs = without(docs, ["kept", "n_bytes", "n_removed", "n_spans"])
    names = docs.columns
    # Written, so that both sides of the join are plain shuffles: the copies of one text, and null texts, may then be split over tasks.
    spans = checkpointed(repeated_spans(docs, length, **how).select(F.col("uid").alias("__uid"), "spans"))
    joined = docs.join(spans, F.unhex(F.md5("text")) == F.col("__uid"), "left").select(*names, F.col("spans").alias("__spans"))
    schema = docs.select("*", F.lit(b"").alias("kept"), *(F.lit(0).cast("long").alias(x) for x in ("n_bytes", "n_removed", "n_spans"))).schema

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            kept: list[bytes] = []
            count = np.zeros((3, batch.num_rows), np.int64)
            spans = batch.column("__spans").to_pylist()
            for t in textscan.chunks(batch.column("text").cast(pa.string())):
                for d in range(len(t)):
                    raw, row = t.raw(d), t.first + d
                    out, at = [], 0
                    runs: list[list[int]] = []
                    for lo, hi in sorted((x["lo"], x["hi"]) for x in spans[row] or ()):
                        if runs and lo <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], hi)
                        else:
                            runs.append([lo, hi])
                    for lo, hi in runs:
                        out.append(raw[at:lo])
                        at = hi
                    kept.append(b"".join([*out, raw[at:]]))
                    count[:, row] = len(raw), len(raw) - len(kept[-1]), len(runs)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(kept, pa.binary()), *(pa.array(c) for c in count)], names=[*names, "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(cut, schema)


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the remaining bytes."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return remove_repeats(slim, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
