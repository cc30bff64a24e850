"""Score-track queries: a user's events in time order are a sequence, their values its scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievemark.operators import providers, tracks
from sievemark.plans.catalog import query, table
from sievemark.plans.q_scalars import _NAMES, names

T, LENGTH, STEP, GAP, LEAST = 40.0, 6, 2, 1, 3


def track(spark: SparkSession, sf_dir: str) -> DataFrame:
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("sequence_id"), F.row_number().over(by).cast("long").alias("position"), F.col("value").alias("score"))


_TRACK = "track as (select user_id as sequence_id, row_number() over (partition by user_id order by ts, event_id) as position, value as score from events)"
_HITS = f"hits as (select *, case when position - lag(position) over w - 1 <= {GAP} then 0 else 1 end as fresh from track where score >= {T} window w as (partition by sequence_id order by position))"
_RUNS = "runs as (select sequence_id, min(position) as start, max(position) as stop from (select *, sum(fresh) over (partition by sequence_id order by position) as island from hits) group by sequence_id, island)"
_SIZES = "sizes as (select sequence_id, max(position) as size from track group by sequence_id)"
_TILES = f"""tiles as (select sequence_id, unnest(range(start, stop - {LENGTH} + 2, {STEP})) as start from runs where stop - start + 1 >= {LENGTH}
 union all select sequence_id, stop - {LENGTH} + 1 from runs where stop - start + 1 >= {LENGTH} and (stop - {LENGTH} + 1 - start) % {STEP} <> 0)"""
_PADS = f"""pads as (select sequence_id, greatest(1, least(start - ({LENGTH} - (stop - start + 1)) // 2, size - {LENGTH} + 1)) as start
 from runs join sizes using (sequence_id) where stop - start + 1 < {LENGTH} and stop - start + 1 >= {LEAST} and size >= {LENGTH})"""
_ALL = "with " + ", ".join([_TRACK, _HITS, _RUNS, _SIZES, _TILES, _PADS])
_MEANS = f"""select f.sequence_id, f.start, f.start + {LENGTH} - 1 as stop, cast(sum(cast(t.score as decimal(18,2))) as double) / {LENGTH} as mean_score
 from (select *, row_number() over () as n from (select * from tiles union all select * from pads)) f join track t on t.sequence_id = f.sequence_id and t.position between f.start and f.start + {LENGTH} - 1 group by f.n, f.sequence_id, f.start"""


@query("residues_to_epitopes", f"{_ALL} {_MEANS}")
def residues_to_epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.residues_to_epitopes(track(spark, sf_dir), T, LENGTH, STEP, GAP, LEAST)


@query("window_mean", f"{_ALL} select sequence_id, count(*) as n, max(mean_score) as best from ({_MEANS}) group by sequence_id")
def window_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residues_to_epitopes(spark, sf_dir).groupBy("sequence_id").agg(F.count("*").alias("n"), F.max("mean_score").alias("best"))


@query("threshold_mask", f"with {_TRACK} select sequence_id, position, score >= {T} as hit from track")
def threshold_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.threshold_mask(track(spark, sf_dir), T).select("sequence_id", "position", "hit")


@query("absorb_gaps", f"with {_TRACK}, {_HITS}, {_RUNS} select sequence_id, start, stop from runs")
def absorb_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.runs(track(spark, sf_dir), T, GAP)


@query("runs", f"with {_TRACK}, {_HITS.replace(f'<= {GAP}', '<= 0')}, {_RUNS} select sequence_id, start, stop from runs")
def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.runs(track(spark, sf_dir), T)


@query("tile", f"{_ALL} select sequence_id, start from tiles")
def tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tracks.runs(track(spark, sf_dir), T, GAP)
    return found.select("sequence_id", F.explode(tracks.tile_starts(F.col("start"), F.col("stop"), LENGTH, STEP)).alias("start"))


@query("pad", f"{_ALL} select sequence_id, start from pads")
def pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = track(spark, sf_dir)
    short = tracks.runs(t, T, GAP).where(F.col("stop") - F.col("start") + 1 < LENGTH)
    return tracks.windows(short, tracks.sizes(t), LENGTH, STEP, LEAST).select("sequence_id", "start")


# A predictor of residues: of each peptide's letters four times their place in the alphabet.
_PREDICTED = f"with {_NAMES}, track as (select ord as sequence_id, position, (ascii(substr(name, cast(position as int), 1)) - 64) * 4.0::double as score from (select ord, name, unnest(range(1, length(name) + 1)) as position from names))"


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = providers.residue_provider(lambda sequence: [(ord(x) - 64) * 4.0 for x in sequence])
    return of(names(spark, sf_dir).select(F.col("ord").alias("sequence_id"), "sequence"))


@query("predicted_residues", f"{_PREDICTED} select sequence_id, position, score from track")
def predicted_residues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted(spark, sf_dir)


@query("predicted_epitopes", f"{', '.join([_PREDICTED, _HITS, _RUNS, _SIZES, _TILES, _PADS])} {_MEANS}")
def predicted_epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.residues_to_epitopes(predicted(spark, sf_dir), T, LENGTH, STEP, GAP, LEAST)
