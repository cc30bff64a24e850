"""Which strings begin which others, from their order: a string stands right before those that it begins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.operators.graph import written


def only_relatives(asked: DataFrame, names: DataFrame) -> DataFrame:
    """(said, name) of every string of asked (said) that begins exactly one of names (name), or is begun by it, but not both of several.

    Both are distinct and have no string in common. All strings are dealt by ranges and sorted; going along a range, those that
    begin the present one are a stack, whose height a string's length bounds. What begins a range's first string lies in the
    ranges before, and is found by equality for that one string. Rows are as many as strings.
    """
    strings = asked.select(F.col("said").alias("s"), F.lit(False).alias("is_name")).union(names.select("name", F.lit(True)))
    dealt = written(strings.repartitionByRange("s").withColumn("part", F.spark_partition_id()))
    first = dealt.groupBy("part").agg(F.min("s").alias("first"))  # a row a range
    heads = first.where(F.length("first") > 1).select("part", F.explode(F.transform(F.sequence(F.lit(1), F.length("first") - 1), lambda n: F.left("first", n))).alias("s"))
    open_ = heads.join(dealt.drop("part"), "s").select("part", F.lit(0).alias("kind"), "s", "is_name")
    rows = open_.union(dealt.select("part", F.lit(1).alias("kind"), "s", "is_name"))
    rows = rows.repartition("part").sortWithinPartitions("part", "kind", "s").select("part", "kind", "s", "is_name")
    found = rows.mapInArrow(_relatives, "said string, n long, name string")
    return found.groupBy("said").agg(F.sum("n").alias("n"), F.min("name").alias("name")).where("n = 1").select("said", "name")


def _relatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stack: list[list] = []  # string, is it a name, how many names it is related to, one of them
    now = None

    def closed(keep) -> list[tuple]:
        """Takes what does not begin the next string off the stack."""
        out = []
        while stack and not keep(stack[-1][0]):
            s, is_name, n, name = stack.pop()
            if not is_name and n:
                out.append((s, n, name))
        return out

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["said", "n", "name"])

    for batch in batches:
        out: list[tuple] = []
        for part, kind, s, is_name in zip(*(batch.column(c).to_pylist() for c in ("part", "kind", "s", "is_name")), strict=True):
            if part != now:
                out += closed(lambda x: False)
                now = part
            out += closed(s.startswith)
            entry = [s, is_name, 0, None]
            if kind and is_name:
                for x in stack:
                    if not x[1]:
                        x[2], x[3] = x[2] + 1, s
            elif kind:
                above = [x[0] for x in stack if x[1]]
                entry[2:] = [len(above), above[-1] if above else None]
            stack.append(entry)
        yield batch_of(out)
    yield batch_of(closed(lambda x: False))
