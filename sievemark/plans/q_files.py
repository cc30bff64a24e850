"""Round trips through the file formats: a table is written in a format to the shared folder and scanned back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.operators.graph import shared_folder
from sievemark.operators.identifiers import numbered
from sievemark.plans.catalog import query, table
from sievemark.plans.q_tracks import _TRACK, track
from sievemark.sources import files


def _path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.format_string("%d %s [%s]", "p_partkey", "p_type", "p_brand").alias("header"), F.regexp_replace(F.upper("p_name"), "[^A-Z]", "").alias("sequence"))


@query("scan_fasta", "select concat(p_partkey, ' ', p_type, ' [', p_brand, ']') as header, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') as sequence from part")
def scan_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    files.sink_fasta(_records(spark, sf_dir), path, width=5)
    return files.scan_fasta(spark, path).select("header", "sequence")


@query("sink_fasta", "select '>' || p_partkey || ' ' || p_type || ' [' || p_brand || ']' as line from part union all select regexp_replace(upper(p_name), '[^A-Z]', '', 'g') from part")
def sink_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    files.sink_fasta(_records(spark, sf_dir), path, width=0)
    return spark.read.text(path).select(F.col("value").alias("line"))


_TSV = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()), T.StructField("p_retailprice", T.DoubleType()), T.StructField("note", T.StringType())])


@query("scan_tsv", "select p_partkey, p_name, p_retailprice, cast(null as varchar) as note from part")
def scan_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    files.sink_tsv(table(spark, sf_dir, "part"), path, _TSV.names)
    return files.scan_tsv(spark, path, _TSV)


@query("sink_tsv", "select p_partkey || chr(9) || p_name || chr(9) || case when p_size > 25 then 'True' else 'False' end as line from part")
def sink_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    files.sink_tsv(table(spark, sf_dir, "part").withColumn("large", F.col("p_size") > 25), path, ["p_partkey", "p_name", "large"])
    return spark.read.text(path).where("value not like 'p_partkey%'").select(F.col("value").alias("line"))


@query("scan_residue_scores", f"with {_TRACK} select cast(sequence_id as varchar) as sequence_id, position, score from track")
def scan_residue_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    files.sink_residue_scores(track(spark, sf_dir), path)
    return files.scan_residue_scores(spark, path)


@query("scan_delimited", "select n_nationkey::varchar as n_nationkey, n_name from nation")
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    rows = table(spark, sf_dir, "nation").select(F.concat(F.col("n_nationkey").cast("string"), F.lit(";"), "n_name").alias("v"), F.col("n_nationkey").alias("k"))
    head = spark.createDataFrame([("made by a tool", -3), ("", -2), ("n_nationkey;n_name", -1)], "v string, k int")
    head.unionByName(rows).coalesce(1).sortWithinPartitions("k").select("v").write.text(path)  # one small report of a tool
    return files.scan_delimited(spark, path, "n_nationkey").select("n_nationkey", "n_name")


@query("scan_sections", "select split_part(r_name, ' ', 1) as sequence_id, position, 'A' as residue, position * 0.5::double as score from region, (select unnest(range(1, 4)) as position)")
def scan_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    said = F.concat(F.lit(">"), "r_name", F.lit("\n1\tA\t0.5\n2\tA\t1.0\n3\tA\t1.5"))
    table(spark, sf_dir, "region").select(said).write.text(path)
    return files.scan_sections(spark, path)


@query("scan_alleles", "select n_name as allele from nation")
def scan_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    table(spark, sf_dir, "nation").select(F.concat("n_name", F.lit("  # note\n\n# comment"))).write.text(path)
    return files.scan_alleles(spark, path).select("allele")


@query("scan_scores", "select s_name as sequence_id, case when s_suppkey % 3 = 0 then null else s_acctbal end as score from supplier")
def scan_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    rows = table(spark, sf_dir, "supplier").select(F.concat_ws(",", "s_name", F.when(F.col("s_suppkey") % 3 == 0, "n/a").otherwise(F.col("s_acctbal").cast("string"))).alias("v"), F.col("s_suppkey").alias("k"))
    spark.createDataFrame([("Header,Intrinsic Score", -1)], "v string, k long").unionByName(rows).coalesce(1).sortWithinPartitions("k").select("v").write.text(path)  # one report of a tool
    return files.scan_scores(spark, path, ["header"], ["intrinsic score"], ("n/a",))


@query("sink_population_input", "select p_brand || chr(9) || array_to_string(list_sort(list(distinct p_type)), ',') as line from part group by p_brand")
def sink_population_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _path(spark)
    files.sink_population_input(table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("peptide")).agg(F.collect_list("p_type").alias("alleles")), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(at, line): a file's lines with their numbers from 1."""
    return numbered(files.numbered_lines(spark, path), [], [F.asc("n")], "at").select("at", "line")


@query("sink_tsv_file", "select 1 as at, 'p_partkey' || chr(9) || 'p_name' || chr(9) || 'note' || chr(9) || 'large' as line union all select row_number() over (order by p_size desc, p_partkey) + 1, p_partkey || chr(9) || p_name || chr(9) || chr(9) || case when p_size > 25 then 'True' else 'False' end from part")
def sink_tsv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with one header, its rows in order."""
    path = _path(spark)
    files.sink_tsv_file(table(spark, sf_dir, "part").withColumn("large", F.col("p_size") > 25).withColumn("down", -F.col("p_size")), ["down", "p_partkey"], path, ["p_partkey", "p_name", "note", "large"])
    return _lines(spark, path)


@query("sink_fasta_file", "with r as (select 2 * row_number() over (order by p_partkey) as n, * from part) select n - 1 as at, '>' || p_partkey || ' ' || p_type as line from r union all select n, upper(p_name) from r")
def sink_fasta_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file, its records in order."""
    path = _path(spark)
    files.sink_fasta_file(table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_partkey", "p_type").alias("header"), F.upper("p_name").alias("sequence")), ["p_partkey"], path, width=0)
    return _lines(spark, path)
