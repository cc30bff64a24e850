"""Deterministic identifiers and duplicates with their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.operators.graph import written


def numbered(rows: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """rows with their number, from 1, in a total order within each group; no group is sorted in one task.

    Rows are dealt by ranges of group and order. Each range numbers its own, behind what the ranges before it hold of
    the group; the dealt rows are written, so that a lost task finds the same ranges again.
    """
    dealt = written(rows.repartitionByRange(*by, *order).withColumn("__part", F.spark_partition_id()))
    sizes = dealt.groupBy(*by, "__part").agg(F.count("*").alias("__n"))  # at most a row a range and a row a group
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    key = [*by, "__part"]
    start = sizes.select(*(F.col(c).alias(f"__own_{c}") for c in key), before.alias("__before"))
    here = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    same = [F.col(c).eqNullSafe(F.col(f"__own_{c}")) for c in key]
    out = dealt.withColumn("__here", here).join(start, same)
    return out.select(*(c for c in rows.columns), (F.col("__here") + F.col("__before")).alias(name))


def assign_ids(rows: DataFrame, protein: str, kind: str, tool: str, sequence: str, strain: str, start: str, tie: str) -> DataFrame:
    """rows with epitope_id {protein}_{kind}_{tool}_{n}.{m}: n numbers sequences, m their occurrences.

    Distinct sequences are numbered within protein and tool, of which there are few, and joined back.
    """
    key = [protein, tool, sequence]
    n = numbered(rows.select(*key).distinct(), [protein, tool], [F.asc(sequence)], "__n").select(*(F.col(c).alias(f"__of_{c}") for c in key), "__n")
    m = F.row_number().over(Window.partitionBy(*key).orderBy(strain, start, tie))
    joined = rows.withColumn("__m", m).join(n, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in key])
    return joined.select(*rows.columns, F.format_string("%s_%s_%s_%d.%d", F.col(protein), F.col(kind), F.col(tool), F.col("__n"), F.col("__m")).alias("epitope_id"))


def deduplicated(rows: DataFrame, by: list[str]) -> DataFrame:
    """(epitope_id, *by, best_score, strains, alleles, n_occurrences): one row a group, partial sums before the shuffle."""
    bag = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|").alias(f"{c}s")
    return rows.groupBy(*by).agg(F.min("epitope_id").alias("epitope_id"), F.max("score").alias("best_score"), bag("strain"), bag("allele"), F.count("*").alias("n_occurrences"))


def first_of(rows: DataFrame, by: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each group in a total order."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__r = 1").drop("__r")
