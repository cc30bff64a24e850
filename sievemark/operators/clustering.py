"""Similarity groups of short sequences at several thresholds, their consensus, and the rules on them.

Sequences are rows (ord, sequence): ord is the place in the input, which decides ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.operators.graph import cut, spanning_forest, spread, written
from sievemark.operators.identifiers import numbered
from sievemark.operators.similarity import similar_pairs, with_offset


def clusters(rows: DataFrame, thresholds: list[int]) -> DataFrame:
    """(threshold, ord, sequence, root, cluster): components at every threshold from one pass over the pairs.

    The pairs are compared once, and a maximum spanning forest of them is cut at each threshold. root is the least ord
    of the component; clusters are numbered in its order.
    """
    spark = rows.sparkSession
    rows = written(rows.select("ord", "sequence"))
    forest = written(spanning_forest(similar_pairs(rows, min(thresholds)).withColumnRenamed("identity", "weight")))
    roots = cut(forest, thresholds).select(F.col("level").alias("threshold"), F.col("node").alias("ord"), "root")
    levels = spark.createDataFrame([(t,) for t in thresholds], "threshold int")
    every = rows.crossJoin(F.broadcast(levels))
    # Read by the numbers and by the rows that get them.
    out = written(every.join(roots, ["threshold", "ord"], "left").withColumn("root", F.coalesce("root", "ord")))
    numbers = numbered(out.select("threshold", "root").distinct(), ["threshold"], [F.asc("root")], "cluster")
    return out.join(numbers, ["threshold", "root"])


def sweep_totals(ruled: DataFrame) -> DataFrame:
    """(threshold, found, ambiguous, examined, passing) of clusters (threshold, consensus, passes) at every threshold, and in all with a null one.

    Clusters whose consensus has an X in either case are ambiguous; the others are examined.
    """
    x = F.contains(F.upper("consensus"), F.lit("X"))
    return ruled.rollup("threshold").agg(F.count("*").alias("found"), F.count_if(x).alias("ambiguous"), F.count_if(~x).alias("examined"), F.count_if(~x & F.col("passes")).alias("passing"))


def rejection_reasons(ruled: DataFrame) -> DataFrame:
    """(threshold, reason, n, place): how many clusters (threshold, reason, passes) gave each reason at each threshold, the most frequent first.

    A cluster counts under each of its reasons. Equal counts stand in the order of the reasons.
    """
    counts = ruled.where("not passes").select("threshold", F.explode(F.split("reason", "; ")).alias("reason")).where("reason <> ''").groupBy("threshold", "reason").agg(F.count("*").alias("n"))
    return numbered(counts, ["threshold"], [F.desc("n"), F.asc("reason")], "place")


def consensus(members: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """members (*key, ord, sequence) -> (*key, consensus) and members with position and alignment.

    Every member is placed against the first longest one; a column goes to its most
    frequent residue, and to X if the first two are level or nothing covers it.
    """
    anchor = members.groupBy(*key).agg(F.max(F.struct(F.length("sequence").alias("n"), (-F.col("ord")).alias("o"), "sequence")).alias("s")).select(*key, F.col("s.sequence").alias("anchor"))
    # Read by the spans, the votes and the alignment: written, so that members are placed once.
    placed = written(with_offset(spread(members.select(*key, "ord", "sequence").join(anchor, key), *key, "ord")).drop("anchor"))
    span = placed.groupBy(*key).agg(F.min("offset").alias("lo"), F.max(F.col("offset") + F.length("sequence")).alias("hi"))
    placed = placed.join(span, key).select(*key, "ord", "sequence", (F.col("offset") - F.col("lo") + 1).alias("position"), (F.col("hi") - F.col("lo")).alias("width"))
    letters = placed.select(*key, "position", F.posexplode(F.split("sequence", "")).alias("i", "residue")).where("residue != ''").select(*key, (F.col("position") + F.col("i")).alias("column"), "residue")
    counts = letters.groupBy(*key, "column", "residue").agg(F.count("*").alias("n"))
    best = counts.groupBy(*key, "column").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "residue")), False), 1, 2).alias("top"))
    voted = best.select(*key, "column", F.when(F.expr("size(top) > 1 and top[0].n = top[1].n"), "X").otherwise(F.col("top")[0].residue).alias("residue"))
    said = voted.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("column", "residue"))).alias("by_column"), F.max("column").alias("last"))
    width = placed.groupBy(*key).agg(F.max("width").alias("width"))
    text = said.join(width, key).select(*key, F.array_join(F.expr("transform(sequence(1, width), c -> coalesce(try_element_at(by_column, c), 'X'))"), "").alias("consensus"))
    aligned = placed.withColumn("alignment", F.rpad(F.concat(F.repeat(F.lit("-"), F.col("position") - 1), "sequence"), F.col("width"), F.lit("-")))
    return text, aligned.drop("width")


def run_statistics(members: DataFrame, text: DataFrame, key: list[str]) -> DataFrame:
    """What a clustering did: (threshold, n_peptides, n_clusters, n_singletons, n_voted, worst, n_ambiguous).

    members (*key, ord, sequence, position) and text (*key, consensus), as consensus gives them; key begins with the
    threshold. n_voted: clusters with a column whose residues differ; worst: the most such columns of one.
    """
    letters = members.select(*key, "position", F.posexplode(F.split("sequence", "")).alias("i", "residue")).where("residue <> ''")
    columns = letters.groupBy(*key, (F.col("position") + F.col("i")).alias("column")).agg((F.min("residue") != F.max("residue")).alias("differ"))
    differ = columns.groupBy(*key).agg(F.count_if("differ").alias("differ"))
    sizes = members.groupBy(*key).agg(F.count("*").alias("n"))
    rows = text.join(sizes, key).join(differ, key)
    return rows.groupBy(key[0]).agg(F.sum("n").alias("n_peptides"), F.count("*").alias("n_clusters"), F.count_if(F.col("n") == 1).alias("n_singletons"), F.count_if(F.col("differ") > 0).alias("n_voted"), F.max("differ").alias("worst"), F.count_if(F.contains(F.upper("consensus"), F.lit("X"))).alias("n_ambiguous"))


def pruned(members: DataFrame) -> DataFrame:
    """Members that say what the consensus says at their place; a place that is no number above 0 is none."""
    at = F.col("position").try_cast("int") if dict(members.dtypes)["position"] == "string" else F.col("position")
    return members.where((at > 0) & (F.substring(F.col("consensus"), at, F.length("sequence")) == F.col("sequence")))


def evaluate_rule(counts: DataFrame, min_mhc_i: int = 1, min_mhc_ii: int = 1, min_bepipred: int = 1, min_epidope: int = 1, both_bcell_tools: bool = True, min_strains: int = 0, reject_ambiguous: bool = True) -> DataFrame:
    """counts (n_mhc_i, n_mhc_ii, n_bepipred, n_epidope, n_strains, n_unresolved, consensus) with reason and passes.

    reject_ambiguous: an X in the consensus, in either case, is a reason.
    """
    few = lambda c, least, name: F.when(F.col(c) < least, F.format_string(f"{name} %d < {least}", F.col(c)))
    b_cell = [few("n_bepipred", min_bepipred, "BepiPred"), few("n_epidope", min_epidope, "EpiDope")]
    if not both_bcell_tools:
        least = min_bepipred + min_epidope
        total = F.col("n_bepipred") + F.col("n_epidope")
        b_cell = [F.when(total < least, F.format_string(f"B-cell %d < {least}", total))]
    ambiguous = [F.when(F.upper("consensus").contains("X"), "consensus contains X")] if reject_ambiguous else []
    reasons = [*ambiguous, few("n_mhc_i", min_mhc_i, "MHC-I"), few("n_mhc_ii", min_mhc_ii, "MHC-II"), *b_cell]
    if min_strains:
        reasons.append(few("n_strains", min_strains, "strains"))
    reasons.append(F.when(F.col("n_unresolved") > 0, F.format_string("%d unresolved members", F.col("n_unresolved"))))
    return counts.withColumn("reason", F.concat_ws("; ", *reasons)).withColumn("passes", F.col("reason") == "")


def pool_passing(rows: DataFrame) -> DataFrame:
    """(consensus, threshold, cluster, n_duplicates): each passing consensus from its tightest threshold."""
    by = Window.partitionBy("consensus").orderBy(F.desc("threshold"), "cluster")
    ranked = rows.where("passes").withColumn("r", F.row_number().over(by)).withColumn("n", F.count("*").over(Window.partitionBy("consensus")))
    return ranked.where("r = 1").select("consensus", "threshold", "cluster", (F.col("n") - 1).alias("n_duplicates"))
