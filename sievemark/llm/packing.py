"""Packing into optimal length buckets.

A histogram of lengths is summed over the whole corpus. Dynamic programming over
it chooses the bucket boundaries with the least padding, exactly for every length;
with lines kept in a convex hull a layer takes linear time. Different lengths are at
most as many as the root of twice the corpus's tokens, which bounds the histogram. Inside a bucket documents are numbered
without a global sort (counts per shard give each shard its offset) and cut into
batches whose padded size stays within the token budget.

Defined results. Null or empty text has 0 tokens and goes to the first bucket. A
document longer than the budget is a batch of its own; a text of any length is
counted whole. Equal rows are packed each. Documents of one length stand in the
order of their ids, equal ones in any. Of boundaries with equal padding the
smaller are taken. An empty table gives an empty one. Columns with the names of the
results are replaced; names that begin with __ are the operator's own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.llm import textscan
from sievemark.llm.stage import checkpointed, without

SHARD_ROWS = 50_000


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """docs with n_tokens.

    tokenizer: path, for Spark, of a file of base64 tokens and ranks, for byte-level BPE. Without
    one, every run of letters and digits and every other visible ASCII character counts.
    """
    docs = without(docs, ["n_tokens"]).withColumn("text", F.col("text").cast("string"))
    names = docs.columns
    spark = docs.sparkSession
    # Read where Spark reads, and sent: executors need not see the path. A vocabulary's size is its bound.
    shared = spark.sparkContext.broadcast([tuple(r.value.split()) for r in spark.read.text(tokenizer).where("value != ''").collect()]) if tokenizer else None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value) if shared else None
        for batch in textscan.bounded(batches):
            n = np.zeros(batch.num_rows, np.int64)
            column = batch.column("text").cast(pa.string())
            if encoding:
                n[:] = [len(encoding.encode_ordinary(x)) if x else 0 for x in column.to_pylist()]
            else:
                for t in textscan.chunks(column):
                    folded = textscan.FOLD[t.data]
                    w = textscan.words(textscan.Texts(folded, t.offsets), textscan.ALNUM)
                    marks = np.concatenate([[0], np.cumsum(~textscan.ALNUM[folded] & textscan.NONBLANK[folded])])
                    n[t.first : t.first + len(t)] = np.diff(w.bounds) + marks[t.offsets[1:]] - marks[t.offsets[:-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n)], names=[*names, "n_tokens"])

    return docs.mapInArrow(count, docs.withColumn("n_tokens", F.lit(0).cast("long")).schema)


def _encoding(lines: list[tuple[str, str]]):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most `buckets` boundaries, the largest length last, for the least total padding."""
    order = sorted(range(len(lengths)), key=lengths.__getitem__)
    b = [lengths[i] for i in order]
    total = [0]
    for i in order:
        total.append(total[-1] + counts[i])
    n = len(b)
    none = (total[-1] + 1) * (b[-1] + 1) if b else 0  # more than any padded size
    best = [0] + [none] * n  # least padded size of the first j lengths
    cut: list[np.ndarray] = []
    for _ in range(min(buckets, n)):
        new, from_ = [none] * (n + 1), np.zeros(n + 1, np.int64)
        new[0] = best[0]
        hull: list[int] = []  # cuts i as lines: best[i] - total[i] * x, the best one first
        head = 0
        for j in range(1, n + 1):
            i = j - 1
            if best[i] < none:
                while len(hull) - head >= 2 and (best[hull[-1]] - best[hull[-2]]) * (total[i] - total[hull[-1]]) >= (best[i] - best[hull[-1]]) * (total[hull[-1]] - total[hull[-2]]):
                    hull.pop()
                hull.append(i)
            x = b[j - 1]
            while len(hull) - head >= 2 and best[hull[head + 1]] - total[hull[head + 1]] * x <= best[hull[head]] - total[hull[head]] * x:
                head += 1
            if len(hull) > head:
                k = hull[head]
                new[j], from_[j] = best[k] + x * (total[j] - total[k]), k
        cut.append(from_)
        best = new
        best[0] = 0
    found, j, layer = [], n, len(cut) - 1
    while j > 0:
        found.append(b[j - 1])
        j = int(cut[layer][j])
        layer -= 1
    return found[::-1]


def pack(rows: DataFrame, buckets: int = 8, budget: int = 65_536, length: str = "n_tokens", id_col: str = "doc_id") -> DataFrame:
    """rows with bucket, boundary, batch (numbered inside the bucket), slot and padding."""
    rows = without(rows, ["bucket", "boundary", "batch", "slot", "padding", "__shard", "__cell", "__deal"])
    dealt = F.xxhash64(id_col, length, F.monotonically_increasing_id())
    rows = checkpointed(rows.withColumn("__deal", dealt).withColumn("__cell", F.coalesce(F.col(length), F.lit(0)).cast("long")))
    histogram = rows.groupBy("__cell").agg(F.count("*").alias("n")).collect()  # a row a length
    n_rows = sum(r.n for r in histogram)
    ends = boundaries([r["__cell"] for r in histogram], [r.n for r in histogram], buckets) or [0]
    bucket = F.lit(len(ends) - 1)
    for i in range(len(ends) - 2, -1, -1):
        bucket = F.when(F.col("__cell") <= ends[i], F.lit(i)).otherwise(bucket)
    shards = max(1, -(-n_rows // SHARD_ROWS))
    # Dealt by place too, so that rows that repeat, of one id and length, are not all in one shard; the table is written, so a lost task deals alike.
    marked = rows.withColumn("bucket", bucket).withColumn("__shard", F.pmod("__deal", F.lit(shards)).cast("int"))
    sizes = marked.groupBy("bucket", "__shard").agg(F.count("*").alias("__n"))
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy("bucket").orderBy("__shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    number = F.row_number().over(Window.partitionBy("bucket", "__shard").orderBy(length, id_col)) - 1
    numbered = marked.withColumn("__at", number).join(before, ["bucket", "__shard"]).withColumn("__at", F.col("__at") + F.col("__before"))
    boundary = F.element_at(F.array(*(F.lit(x).cast("long") for x in ends)), F.col("bucket") + 1)
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(boundary, F.lit(1))).cast("long"))
    plain = [c for c in rows.columns if c not in ("__cell", "__deal")]
    return numbered.select(*plain, "bucket", boundary.alias("boundary"), F.floor(F.col("__at") / room).cast("long").alias("batch"), (F.col("__at") % room).cast("long").alias("slot"), (boundary - F.coalesce(F.col(length), F.lit(0))).alias("padding"))


def report(docs: DataFrame, tokenizer: str | None = None, buckets: int = 8, budget: int = 65_536) -> DataFrame:
    """doc_id, n_tokens and the document's place: bucket, boundary, batch, slot, padding."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pack(token_counts(slim, tokenizer).select("doc_id", "n_tokens"), buckets, budget)
