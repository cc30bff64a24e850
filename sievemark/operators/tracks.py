"""Segmentation of score tracks: rows (sequence_id, position, score), positions from 1 without gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def threshold_mask(track: DataFrame, threshold: float) -> DataFrame:
    return track.withColumn("hit", F.col("score") >= threshold)


def runs(track: DataFrame, threshold: float, merge_gap: int = 0) -> DataFrame:
    """(sequence_id, start, stop): maximal runs of hits, interior gaps of up to merge_gap positions taken in."""
    by = Window.partitionBy("sequence_id").orderBy("position")
    hits = track.where(F.col("score") >= threshold).select("sequence_id", "position")
    fresh = F.coalesce(F.col("position") - F.lag("position").over(by) - 1 > max(0, merge_gap), F.lit(True))
    island = F.sum(F.col("fresh").cast("long")).over(by)
    return hits.withColumn("fresh", fresh).withColumn("island", island).groupBy("sequence_id", "island").agg(F.min("position").alias("start"), F.max("position").alias("stop")).drop("island")


def tile_starts(start: Column, stop: Column, length: int, step: int) -> Column:
    last = stop - (length - 1)
    return F.when(last >= start, F.array_union(F.sequence(start, F.greatest(last, start), F.lit(step).cast("long")), F.array(last))).otherwise(F.array().cast("array<long>"))


def pad_start(start: Column, stop: Column, size: Column, length: int) -> Column:
    """First position of a window of `length` centred on a shorter run, kept inside the sequence."""
    short = F.lit(length) - (stop - start + 1)
    return F.greatest(F.lit(1), F.least(start - F.floor(short / 2), size - length + 1))


def windows(found: DataFrame, sizes: DataFrame, length: int, step: int, min_region: int) -> DataFrame:
    """(sequence_id, start, stop): tiles of long runs, and a padded window of each shorter one."""
    if length <= 0 or step <= 0:
        raise ValueError("length and step must be positive")
    run = F.col("stop") - F.col("start") + 1
    starts = F.when(run >= length, tile_starts(F.col("start"), F.col("stop"), length, step)).when((run >= min_region) & (F.col("size") >= length), F.array(pad_start(F.col("start"), F.col("stop"), F.col("size"), length).cast("long"))).otherwise(F.array().cast("array<long>"))
    return found.join(sizes, "sequence_id").select("sequence_id", F.explode(starts).alias("start")).withColumn("stop", F.col("start") + length - 1)


def window_means(found: DataFrame, track: DataFrame) -> DataFrame:
    """found with the mean score of each window, from two look-ups in the running sums (exact decimals)."""
    by = Window.partitionBy("sequence_id").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    sums = track.select("sequence_id", "position", F.sum(F.col("score").cast("decimal(18,2)")).over(by).alias("total"))
    upto = found.join(sums.select("sequence_id", F.col("position").alias("stop"), F.col("total").alias("upto")), ["sequence_id", "stop"])
    before = sums.select("sequence_id", (F.col("position") + 1).alias("start"), F.col("total").alias("before"))
    total = F.col("upto") - F.coalesce("before", F.lit(0).cast("decimal(28,2)"))
    return upto.join(before, ["sequence_id", "start"], "left").select("sequence_id", "start", "stop", (total.cast("double") / (F.col("stop") - F.col("start") + 1)).alias("mean_score"))


def sizes(track: DataFrame) -> DataFrame:
    return track.groupBy("sequence_id").agg(F.max("position").alias("size"))


def residues_to_epitopes(track: DataFrame, threshold: float, length: int, step: int, merge_gap: int, min_region: int) -> DataFrame:
    """The whole chain: mask, runs over gaps, tiles and padded windows, mean of the raw scores."""
    return window_means(windows(runs(track, threshold, merge_gap), sizes(track), length, step, min_region), track)
