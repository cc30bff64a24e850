"""Line deduplication with two Bloom filters.

First pass: every long line's hash goes into a once-seen and a twice-seen filter
(see repeats). Second pass: only lines that the twice-seen filter suspects are
shuffled, as 16-byte digests, for the exact count and the choice of the keeper.
Third pass: lines of confirmed keys go, except in the keeper.

Defined results. Null or empty text: one empty line, kept. A row without doc_id
never keeps a repeated line, as the keeper is the largest doc_id; it does not
count as a document. Ids are compared in their own type, strings as strings. Rows
that repeat a doc_id are one document for the count, and each keeps its lines if
it is the keeper; so do all lines of one key in it. A text of any length is
scanned whole. Columns named n_lines or n_dropped are replaced; names that begin
with __ are the operator's own. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import repeats, textscan
from sievemark.llm.stage import checkpointed, without

_STRIP = b" \t\n\x0b\x0c\r"
_NEWLINE = textscan._table(True, (0x0A, 0x0A))
#: Confirmed keys are sent to every task up to this many (32 bytes each, in three arrays); more are joined by document.
BROADCAST_KEYS = 1 << 20


class _Lines:
    """The lines of some texts: byte spans, the span of each key, and the key's hash where it is long enough."""

    def __init__(self, t: textscan.Texts, min_chars: int):
        data, n = t.data, len(t)
        breaks = np.flatnonzero(data == 0x0A)
        doc = np.searchsorted(t.offsets, breaks, "right") - 1
        self.count = np.bincount(doc, minlength=n)[:n] + 1 if n else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.count)])
        total = int(self.bounds[-1])
        self.start, self.end = np.empty(total, np.int64), np.empty(total, np.int64)
        head = np.zeros(total, bool)
        head[self.bounds[:-1]] = True
        self.start[head], self.start[~head] = t.offsets[:-1], breaks + 1
        tail = np.zeros(total, bool)
        tail[self.bounds[1:] - 1] = True
        self.end[tail], self.end[~tail] = t.offsets[1:], breaks
        # The key's span: from the first to the last byte that is no white space.
        solid = np.flatnonzero(textscan.NONBLANK[data]) if len(data) else np.zeros(0, np.int64)
        lo, hi = np.searchsorted(solid, self.start), np.searchsorted(solid, self.end)
        some = hi > lo
        self.key_start, self.key_end = self.start.copy(), self.start.copy()
        self.key_start[some], self.key_end[some] = solid[lo[some]], solid[hi[some] - 1] + 1
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        self.long = np.flatnonzero(points[self.key_end] - points[self.key_start] >= min_chars)
        self.folded = textscan.FOLD[data]
        self.doc = np.repeat(np.arange(n), self.count)
        self.hash = textscan.span_hash(self.folded, self.key_start[self.long], self.key_end[self.long]) if len(self.long) else np.zeros(0, np.uint64)

    def digest(self, line: int) -> bytes:
        return xxhash.xxh3_128_digest(self.folded[self.key_start[line] : self.key_end[line]].tobytes())


def _once_a_text(lines: _Lines) -> np.ndarray:
    """Indices into long: the first line of each key in each text."""
    own = textscan.mix(lines.hash + lines.doc[lines.long].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.unique(own, return_index=True)[1]


def repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, max_filter_bits: int = repeats.MAX_BITS) -> DataFrame:
    """(key binary, hash long, keep_doc): keys in at least min_docs documents, and the largest doc_id with it."""
    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for t in textscan.chunks(batch.column("text")):
            lines = _Lines(t, min_chars)
            yield lines.hash[_once_a_text(lines)]

    twice = repeats.build(slim.select("text"), hashes, repeats.bits_for(size // max(1, min_chars + 1), 8, max_filter_bits), "text")

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            for t in textscan.chunks(batch.column("text")):
                lines = _Lines(t, min_chars)
                first = np.sort(_once_a_text(lines))
                first = first[twice.suspects(lines.hash[first])]
                yield _keyed(lines, first, batch.column("doc_id"), t.first, "doc_id")

    found = slim.mapInArrow(suspects, slim.select(F.lit(b"").alias("key"), F.lit(0).cast("long").alias("hash"), "doc_id").schema)
    counted = found.groupBy("key", "hash").agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keep_doc"))
    return counted.where(F.col("n") >= min_docs).select("key", "hash", "keep_doc")


def _keyed(lines: _Lines, at: np.ndarray, owner: pa.Array, first: int, name: str) -> pa.RecordBatch:
    """Digest and hash of long lines (by their number among these), and what their rows have in owner."""
    rows = pa.array(lines.doc[lines.long[at]] + first)
    return pa.RecordBatch.from_arrays([pa.array(map(lines.digest, lines.long[at].tolist()), pa.binary()), pa.array(textscan.signed(lines.hash[at])), owner.take(rows)], names=["key", "hash", name])


class Keepers:
    """Confirmed keys in arrays, ordered by hash; a line's digest is computed only where its hash is among them."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        h = table.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(h)
        self.hash = h[order]
        self.key = np.frombuffer(b"".join(x.as_py() for x in table.column("key")), "V16")[order]
        keep = table.column("keep_doc")
        self.keep = (keep.combine_chunks() if isinstance(keep, pa.ChunkedArray) else keep).take(pa.array(order))

    def gone(self, lines: _Lines, ids: pa.Array) -> np.ndarray:
        """The lines that go; ids: of the texts."""
        h = lines.hash
        lo, hi = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        line, key = [], []
        for i in np.flatnonzero(hi > lo).tolist():
            own = np.frombuffer(lines.digest(int(lines.long[i])), "V16")[0]
            for j in range(lo[i], hi[i]):
                if self.key[j] == own:
                    line.append(int(lines.long[i]))
                    key.append(j)
                    break
        at = np.array(line, np.int64)
        stays = pc.fill_null(pc.equal(ids.take(pa.array(lines.doc[at])), self.keep.take(pa.array(key, pa.int64()))), False)
        return at[~stays.to_numpy(zero_copy_only=False)]


def drop_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, max_filter_bits: int = repeats.MAX_BITS, broadcast_keys: int = BROADCAST_KEYS) -> DataFrame:
    """docs with text rewritten, plus n_lines (before) and n_dropped.

    Keys of at least min_chars code points (stripped, A-Z folded) in at least
    min_docs documents lose their lines except in the largest doc_id.
    """
    docs = without(docs, ["n_lines", "n_dropped"]).withColumn("text", F.col("text").cast("string"))
    gone = checkpointed(repeated_lines(docs, min_chars, min_docs, max_filter_bits))
    names, out = docs.columns, docs.withColumn("n_lines", F.lit(0).cast("long")).withColumn("n_dropped", F.lit(0).cast("long")).schema
    if gone.count() <= broadcast_keys:
        table = docs.sparkSession.sparkContext.broadcast(Keepers(gone.toArrow()))

        def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in textscan.bounded(batches):
                yield _rewrite(batch, names, min_chars, table.value)

        return docs.mapInArrow(rewrite, out)
    # Too many keys to send around: each document is joined with those of its own lines.
    uid = F.struct(F.col("doc_id"), F.xxhash64("text"), F.length("text"))
    slim = docs.select(uid.alias("__uid"), "text")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            for t in textscan.chunks(batch.column("text")):
                lines = _Lines(t, min_chars)
                yield _keyed(lines, np.sort(_once_a_text(lines)), batch.column("__uid"), t.first, "__uid")

    schema = slim.select(F.lit(b"").alias("key"), F.lit(0).cast("long").alias("hash"), "__uid").schema
    own = slim.mapInArrow(keys, schema).join(gone, ["key", "hash"]).groupBy("__uid").agg(F.collect_set(F.struct("key", "hash", "keep_doc")).alias("__gone"))
    joined = docs.withColumn("__uid", uid)
    joined = joined.join(own.withColumnRenamed("__uid", "__own"), F.col("__uid").eqNullSafe(F.col("__own")), "left").drop("__uid", "__own")

    def rewrite_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            yield _rewrite(batch, names, min_chars, Keepers(pa.RecordBatch.from_struct_array(batch.column("__gone").flatten())))

    return joined.mapInArrow(rewrite_own, out)


def _rewrite(batch: pa.RecordBatch, names: list[str], min_chars: int, keepers: Keepers) -> pa.RecordBatch:
    ids, texts = batch.column("doc_id"), batch.column("text")
    new: list[pa.Array] = []
    count = np.zeros((2, batch.num_rows), np.int64)
    for t in textscan.chunks(texts):
        lines = _Lines(t, min_chars)
        own = slice(t.first, t.first + len(t))
        drop = np.zeros(len(lines.start), bool)
        drop[keepers.gone(lines, ids[own])] = True
        count[0, own] = lines.count
        count[1, own] = fewer = np.bincount(lines.doc[drop], minlength=len(t))
        if not fewer.any():
            new.append(texts[own])
            continue
        said: list[bytes | None] = []
        for d, (n, known) in enumerate(zip(fewer.tolist(), texts[own].is_valid().to_pylist(), strict=True)):
            kept = [i for i in range(lines.bounds[d], lines.bounds[d + 1]) if not drop[i]] if n else ()
            said.append(None if not known else b"\n".join(t.data[lines.start[i] : lines.end[i]].tobytes() for i in kept) if n else t.raw(d))
        new.append(pa.array(said, pa.binary()).cast(pa.string()))
    text = pa.concat_arrays(new) if new else texts
    cols = [text if name == "text" else batch.column(name) for name in names]
    return pa.RecordBatch.from_arrays([*cols, *map(pa.array, count)], names=[*names, "n_lines", "n_dropped"])


def report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of what stays."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return drop_lines(slim, **how).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
