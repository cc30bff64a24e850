"""Benchmark decontamination by a prefix-filtered set join.

An item is cut into windows of its consecutive words. A window is the set of its
word shingles; a document contains the window only if it contains all of them, so
looking up one, the rarest in the corpus, is necessary and enough for a candidate.
Its offset fixes where the window would start: positional and length bounds drop
candidates that would begin before or end after the document. What is left is
verified word by word over a window as long as the item's.

Defined results. Null text, of a document or an item, has no words; such items
match nothing. Items with a null id mark words but are not listed. Equal ids are
listed once. Rows with equal texts get equal results, whatever their doc_id. Of
shingles of a window that are equally rare the one with the least hash is looked up,
and of equal ones the first; which it is changes no result. Texts are scanned whole,
whatever their length. Empty tables of either kind give no hits. Columns with the
names of the results are replaced; names that begin with __ are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.llm import repeats, textscan
from sievemark.llm.stage import checkpointed, without

#: An item index up to this size is sent to every task; a larger one is joined.
BROADCAST_BYTES = 64 << 20
_BITMAP = 20


def _scan(column: pa.Array) -> Iterator[tuple[textscan.Texts, textscan.Runs, np.ndarray, np.ndarray]]:
    for t in textscan.chunks(column):
        folded = textscan.FOLD[t.data]
        w = textscan.words(textscan.Texts(folded, t.offsets, t.first), textscan.ALNUM)
        yield t, w, folded, textscan.span_hash(folded, w.starts, w.ends) if len(w) else np.zeros(0, np.uint64)


def _said(folded: np.ndarray, w: textscan.Runs, at: int, n: int) -> bytes:
    return b" ".join(folded[w.starts[i] : w.ends[i]].tobytes() for i in range(at, at + n))


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item_id, said, n, shingles): each distinct window of an item, its words, and its shingle hashes by offset."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            rows: list[tuple] = []
            for t, w, folded, h in _scan(batch.column("text")):
                for d in range(len(t)):
                    lo, hi = int(w.bounds[d]), int(w.bounds[d + 1])
                    n = min(window, hi - lo)
                    for at in range(lo, hi - n + 1 if n else lo):
                        own = textscan.shingles(h[at : at + n], np.zeros(n, np.int8), min(shingle, n))[0]
                        rows.append((t.first + d, _said(folded, w, at, n), n, textscan.signed(own).tolist()))
            row, said, n, own = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(row, pa.int64())), pa.array(said, pa.binary()), pa.array(n, pa.int32()), pa.array(own, pa.list_(pa.int64()))], names=["item_id", "said", "n", "shingles"])

    slim = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(cut, "item_id string, said binary, n int, shingles array<long>").distinct()


def _count_shingles(texts: DataFrame, known: np.ndarray, ks: list[int]) -> dict[int, int]:
    """How often each known shingle occurs in all texts; the answer is as large as the known ones."""
    shared = texts.sparkSession.sparkContext.broadcast(known.tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.frombuffer(shared.value, np.uint64)
        quick = np.zeros(1 << _BITMAP, bool)
        quick[own >> np.uint64(64 - _BITMAP)] = True
        total = np.zeros(len(own), np.int64)
        for batch in textscan.bounded(batches):
            for _, w, _, h in _scan(batch.column("text")):
                for k in ks:
                    s = textscan.shingles(h, w.doc, k)[0]
                    s = s[quick[s >> np.uint64(64 - _BITMAP)]]
                    at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                    total += np.bincount(at[own[at] == s], minlength=len(own))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(textscan.signed(own[some])), pa.array(total[some])], names=["shingle", "n"])

    rows = texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).collect()
    shared.destroy()
    return {r.shingle & (2**64 - 1): r.n for r in rows}


class _Index:
    """Windows by their rarest shingle."""

    def __init__(self, windows: list[tuple[bytes, int, list[int], list[str]]], rarity: dict[int, int]):
        self.windows = [(said, n, items) for said, n, _, items in windows]
        post: dict[int, list[tuple[int, int]]] = {}
        for i, (_, _, own, _) in enumerate(windows):
            _, s, offset = min((rarity.get(s & (2**64 - 1), 0), s & (2**64 - 1), o) for o, s in enumerate(own))
            post.setdefault(s, []).append((i, offset))
        self.keys = np.array(sorted(post), np.uint64)
        self.post = [post[int(s)] for s in self.keys]
        self.quick = np.zeros(1 << _BITMAP, bool)
        self.quick[self.keys >> np.uint64(64 - _BITMAP)] = True

    def find(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.quick[s >> np.uint64(64 - _BITMAP)])
        key = np.minimum(np.searchsorted(self.keys, s[at]), len(self.keys) - 1)
        same = self.keys[key] == s[at]
        return at[same], key[same]


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs with n_words, n_hit (words inside an occurrence of an item's window) and items (ids of items with one)."""
    docs = without(docs, ["n_words", "n_hit", "items"])
    found = checkpointed(item_windows(items, window, shingle))
    texts = docs.select(F.col("text").cast("string").alias("text"))
    ks = sorted({min(shingle, r.n) for r in found.select("n").distinct().collect()})
    size = found.agg(F.sum(F.octet_length("said") + 8 * F.size("shingles") + 64)).first()[0] or 0
    if size > broadcast_bytes:
        return _joined(docs, found, ks)
    names = docs.columns
    schema = docs.withColumn("n_words", F.lit(0).cast("long")).withColumn("n_hit", F.lit(0).cast("long")).withColumn("items", F.array().cast("array<string>")).schema
    windows = [(bytes(r.said), r.n, r.shingles, [x for x in r.items if x is not None]) for r in found.groupBy("said").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"), F.collect_set("item_id").alias("items")).collect()]
    known = np.unique(np.array([s & (2**64 - 1) for _, _, own, _ in windows for s in own], np.uint64))
    index = _Index(windows, _count_shingles(texts, known, ks)) if windows else None
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in textscan.bounded(batches):
            n_words, n_hit = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            items: list[list[str]] = [[] for _ in range(batch.num_rows)]
            for t, w, folded, h in _scan(batch.column("text").cast(pa.string())):
                n_words[t.first : t.first + len(t)] = np.diff(w.bounds)
                hit = np.zeros(len(h), bool)
                own: dict[int, set[str]] = {}
                for k in ks:
                    s, word = textscan.shingles(h, w.doc, k)
                    if index is None or not len(s):
                        continue
                    for at, key in zip(*(x.tolist() for x in index.find(s)), strict=True):
                        d = w.doc[word[at]]
                        for i, offset in index.post[key]:
                            said, n, ids = index.windows[i]
                            start = word[at] - offset
                            if min(shingle, n) == k and start >= w.bounds[d] and start + n <= w.bounds[d + 1] and _said(folded, w, start, n) == said:
                                hit[start : start + n] = True
                                own.setdefault(int(d), set()).update(ids)
                n_hit[t.first : t.first + len(t)] = np.bincount(w.doc[hit], minlength=len(t))[: len(t)]
                for d, ids in own.items():
                    items[t.first + d] = sorted(ids)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(n_words), pa.array(n_hit), pa.array(items, pa.list_(pa.string()))], names=[*names, "n_words", "n_hit", "items"])

    return docs.mapInArrow(mark, schema)


def _joined(docs: DataFrame, found: DataFrame, ks: list[int]) -> DataFrame:
    """For item sets beyond the bound: a fixed-size filter of their shingles goes to the tasks, and what passes is joined."""
    longest = found.agg(F.max("n")).first()[0]
    slim = docs.select(F.struct(F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"), F.coalesce(F.md5("text"), F.lit("")).alias("m")).alias("uid"), F.col("text").cast("string").alias("text"))
    own = found.select("said", "n", F.posexplode("shingles").alias("offset", "shingle")).distinct()

    def twofold(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        h = batch.column(0).to_numpy().view(np.uint64)
        yield np.concatenate([h, h])

    def passing(keys: DataFrame) -> DataFrame:
        known = repeats.build(keys.select("shingle"), twofold, repeats.bits_for(keys.count()))

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in textscan.bounded(batches):
                for t, w, folded, h in _scan(batch.column("text")):
                    for k in ks:
                        s, word = textscan.shingles(h, w.doc, k)
                        at = np.flatnonzero(known.suspects(s))
                        doc = w.doc[word[at]]
                        lo = np.maximum(word[at] - longest, w.bounds[doc])
                        hi = np.minimum(word[at] + longest, w.bounds[doc + 1])
                        near = [_said(folded, w, a, b - a) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays([batch.column("uid").take(pa.array(doc + t.first)), pa.array(textscan.signed(s[at])), pa.array(np.full(len(at), k, np.int32)), pa.array(word[at] - w.bounds[doc]), pa.array(word[at] - lo), pa.array(near, pa.binary()).cast(pa.string())], names=["uid", "shingle", "k", "at", "before", "near"])

        return slim.mapInArrow(emit, "uid struct<h:long,m:string>, shingle long, k int, at long, before long, near string")

    rarity = passing(own.select("shingle").distinct()).groupBy("shingle").agg(F.count("*").alias("often"))
    first = own.join(rarity, "shingle", "left").groupBy("said", "n").agg(F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "shingle", "offset")).alias("f")).select("said", "n", "f.shingle", "f.offset")
    first = checkpointed(first)
    near = F.split("near", " ")
    start = F.col("before") - F.col("offset")
    hits = passing(first.select("shingle").distinct()).join(first, "shingle").where(start >= 0).where(start + F.col("n") <= F.size(near))
    hits = hits.where(F.array_join(F.slice(near, (start + 1).cast("int"), F.col("n")), " ").cast("binary") == F.col("said"))
    hits = checkpointed(hits.select("uid", (F.col("at") - F.col("offset")).alias("start"), "n", "said").distinct())
    marked = hits.select("uid", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("word")).distinct().groupBy("uid").agg(F.count("*").alias("n_hit"))
    named = hits.select("uid", "said").distinct().join(found.select("said", "item_id"), "said").groupBy("uid").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    by_text = marked.join(named, "uid")
    names = docs.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in textscan.bounded(batches):
            n = np.zeros(batch.num_rows, np.int64)
            for t, w, _, _ in _scan(batch.column("text").cast(pa.string())):
                n[t.first : t.first + len(t)] = np.diff(w.bounds)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n)], names=[*names, "n_words"])

    counted = docs.mapInArrow(count, docs.withColumn("n_words", F.lit(0).cast("long")).schema)
    uid = F.struct(F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"), F.coalesce(F.md5("text"), F.lit("")).alias("m"))
    by_text = by_text.select(F.col("uid").alias("__uid"), "n_hit", "items")
    joined = counted.join(by_text, uid == F.col("__uid"), "left")
    return joined.select(*names, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def report(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, a digest of the items' ids, and whether any word is hit."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = contamination(slim, items, **how)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
