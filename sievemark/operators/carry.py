"""State that runs along the lines of a file, by blocks: no file is one task.

A block's last state is all that the blocks behind it need. These last states, a row a block, are passed on over the
blocks of a file, and rows then take what is the last inside their own block, or else what came before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def carried_forward(rows: DataFrame, by: list[str], block: Column, order: Column, states: dict[str, Column], before: bool = False) -> DataFrame:
    """rows with, under each name of states, the last value that is not null up to the row; before: up to the row before it.

    by: what a sequence of rows has in common; block: which of its blocks a row is in, in their order; order: of rows.
    """
    marked = rows.select("*", block.alias("__block"), order.alias("__order"), *(c.alias(f"__{n}") for n, c in states.items()))
    key = [*by, "__block"]
    last = marked.groupBy(*key).agg(*(F.max_by(F.struct(f"__{n}"), F.when(F.col(f"__{n}").isNotNull(), F.col("__order"))).alias(n) for n in states))
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    start = last.select(*key, *(F.last(n, ignorenulls=True).over(earlier).alias(f"__before_{n}") for n in states))
    inside = Window.partitionBy(*key).orderBy("__order").rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    own = {n: F.coalesce(F.last(f"__{n}", ignorenulls=True).over(inside), F.col(f"__before_{n}")[f"__{n}"]) for n in states}
    return marked.join(start, key).select(*rows.columns, *(c.alias(n) for n, c in own.items()))


def running_sum(rows: DataFrame, by: list[str], block: Column, order: Column, value: Column, name: str) -> DataFrame:
    """rows with the sum of a whole number up to each of them."""
    marked = rows.select("*", block.alias("__block"), order.alias("__order"), value.cast("long").alias("__value"))
    key = [*by, "__block"]
    sums = marked.groupBy(*key).agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*by).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    start = sums.select(*key, F.coalesce(F.sum("__sum").over(earlier), F.lit(0).cast("long")).alias("__before"))
    inside = Window.partitionBy(*key).orderBy("__order")
    return marked.join(start, key).select(*rows.columns, (F.col("__before") + F.sum("__value").over(inside)).alias(name))
