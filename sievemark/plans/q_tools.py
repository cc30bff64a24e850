"""Outputs of tools: tables are written in a tool's own layout to the shared folder and scanned as that tool's."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.operators import records
from sievemark.operators.graph import shared_folder
from sievemark.operators.identifiers import numbered
from sievemark.plans.catalog import query, table
from sievemark.plans.q_groups import _CONSENSUS, consensus_of
from sievemark.plans.q_tracks import _ALL, _MEANS, GAP, LEAST, LENGTH, STEP, T, track
from sievemark.sources import files, tools


def _report(spark: SparkSession, lines: DataFrame, head: list[str] = []) -> str:  # noqa: B006
    """lines (at, line) as one report of a tool, behind the lines of its head: its path."""
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    files.as_one_file(lines.select(F.col("at").cast("long").alias("at"), F.col("line").alias("value")), ["at"], path, head)
    return path


def _cells(sep: str, *columns) -> Column:
    return F.concat_ws(sep, *(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns))


# Binding: order lines; the discount in per cent is the percentile, the part's name the peptide. Some cells are blank.
_BINDING = """b as (select l_orderkey * 10 + l_linenumber as at, concat('HLA-', l_returnflag) as allele, upper(p_name) as peptide, case when l_linenumber % 3 = 0 then 0 else l_linenumber end as start,
 case when l_linenumber % 2 = 0 then l_linenumber + 100 when l_linenumber % 3 = 0 then 0 else l_linenumber + length(p_name) - 1 end as "end", case when l_linenumber % 4 = 0 then 1 else l_linenumber end as seq_num,
 l_discount * 100 as percentile, case when l_linenumber % 5 = 0 then l_discount * 100 else l_tax end as score from lineitem join part on p_partkey = l_partkey)"""


def binding(spark: SparkSession, sf_dir: str) -> str:
    n = F.col("l_linenumber")
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    cells = _cells("\t", F.concat(F.lit("HLA-"), "l_returnflag"), F.when(n % 4 != 0, n), F.when(n % 3 != 0, n), F.when(n % 2 == 0, n + 100), F.lower("p_name"), F.when(n % 5 != 0, F.col("l_tax")), F.col("l_discount") * 100)
    return _report(spark, line.select((F.col("l_orderkey") * 10 + n).alias("at"), cells.alias("line")), ["allele\tseq_num\tstart\tend\tpeptide\tscore\trank"])


@query("scan_binding", f"with {_BINDING} select allele, peptide, start, \"end\", seq_num, coalesce(r_name, '') as sequence_id, percentile, score from b left join region on r_regionkey + 1 = seq_num")
def scan_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1).alias("seq_num"), F.col("r_name").alias("sequence_id"))
    return tools.scan_binding(spark, binding(spark, sf_dir), 100.0, ids)


@query("filter_percentile", f"with {_BINDING} select allele, peptide, start, \"end\", seq_num, percentile, score from b where percentile <= 2")
def filter_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tools.scan_binding(spark, binding(spark, sf_dir), 2.0).drop("sequence_id")


@query("check_binding_header", "select r_name, r_regionkey % 2 = 0 as accepted from region")
def check_binding_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report by region, with a header in several forms, or what a tool writes when it fails."""
    heads = ["allele\tpeptide", "ImportError: no module", "Peptide \tx\t ALLELE", "peptide\tscore", "rank\tpeptide\tAllele"]

    def accepted(r) -> bool:
        try:
            tools.check_binding_header(spark, _report(spark, spark.createDataFrame([(0, r.r_name)], "at long, line string"), [heads[r.r_regionkey]]))
        except ValueError:
            return False
        return True

    found = [(r.r_name, accepted(r)) for r in table(spark, sf_dir, "region").collect()]  # a handful of files
    return spark.createDataFrame(found, "r_name string, accepted boolean")


@query("scan_immunogenicity", "select upper(s_name) as peptide, s_acctbal as score from supplier")
def scan_immunogenicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behind two lines of settings and a blank one; every supplier asked for has a score."""
    supplier = table(spark, sf_dir, "supplier")
    path = _report(spark, supplier.select(F.col("s_suppkey").alias("at"), _cells(",", F.lower("s_name"), F.length("s_name"), "s_acctbal").alias("line")), ["masking: default", "masked variables: [1, 2, 9]", "", "peptide,length,score"])
    return tools.scan_immunogenicity(spark, path, supplier.select(F.col("s_name").alias("peptide")))


@query("scan_antigenicity", "select replace(s_name, ' ', '_') as sequence_id, case when s_suppkey % 3 = 0 then null else s_acctbal end as score from supplier")
def scan_antigenicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("s_suppkey") % 3 == 0, "Sequence too short").otherwise(F.col("s_acctbal").cast("string"))
    name = F.concat(F.lit(">"), F.replace("s_name", F.lit(" "), F.lit("_")), F.lit(" more"))
    path = _report(spark, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("at"), _cells(",", name, F.length("s_name"), score, F.lit("High")).alias("line")), ["Header,Sequence_Length,Intrinsic_Antigenicity_Score,Antigenicity_Category"])
    return tools.scan_antigenicity(spark, path)


@query("scan_allergenicity", "select concat('c', c_custkey) as sequence_id, c_acctbal as score, case c_custkey % 3 when 0 then true when 1 then false else c_acctbal >= 3000 end as allergen from customer")
def scan_allergenicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tool's verdict where there is one, which may differ from what its score says."""
    customer = table(spark, sf_dir, "customer").withColumn("id", F.concat(F.lit("c"), "c_custkey"))
    call = F.when(F.col("c_custkey") % 3 == 0, "Allergen").when(F.col("c_custkey") % 3 == 1, "Non-Allergen")
    path = _report(spark, customer.select(F.col("c_custkey").alias("at"), _cells(",", "id", F.lit(0.1), F.lit(0), F.lit(0), "c_acctbal", call).alias("line")), ["Subject,ML Score,MERCI Score,BLAST Score,Hybrid Score,Prediction"])
    return tools.scan_allergenicity(spark, path, customer.select(F.col("id").alias("sequence_id")), 3000.0)


@query("scan_bepipred", "select cast(user_id as varchar) as sequence_id, row_number() over (partition by user_id order by ts, event_id) as position, value as score from events")
def scan_bepipred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a residue and no positions: the order of the file is all there is."""
    rows = track(spark, sf_dir)
    lines = rows.select((F.col("sequence_id") * 1_000_000 + F.col("position")).alias("at"), _cells(",", "sequence_id", F.lit("M"), "score", F.concat(F.lit(" "), (F.col("score") / 2).cast("string"))).alias("line"))
    return tools.scan_bepipred(spark, _report(spark, lines, ["Accession,Residue,BepiPred-3.0 score,BepiPred-3.0 linear epitope score"]))


@query("scan_epidope", "select cast(user_id as varchar) as sequence_id, row_number() over (partition by user_id order by ts, event_id) as position, value as score from events")
def scan_epidope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A section a sequence, its rows below."""
    rows = track(spark, sf_dir)
    at = F.col("sequence_id") * 1_000_000
    lines = rows.select((at + F.col("position")).alias("at"), _cells("\t", "position", F.lit("A"), "score").alias("line"))
    heads = rows.select("sequence_id").distinct().select(at.alias("at"), F.concat(F.lit(">"), F.col("sequence_id").cast("string"), F.lit(" tail")).alias("line"))
    return tools.scan_epidope(spark, _report(spark, lines.union(heads), ["position/header\taminoacid\tscore"]))


@query("scan_population_report", "select n_name as population, class as mhc_class, n_nationkey + i * 0.25::double as coverage, case when class = 'II' then null else i * 0.5::double end as average_hit, case when class = 'II' then null else n_regionkey::double end as pc90 from nation, (values ('I', 1), ('II', 2), ('combined', 3)) t(class, i)")
def scan_population_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks by class, each with a coverage table, whose summary rows do not count, and a second table with a heading like its."""
    nation = table(spark, sf_dir, "nation")
    tail = "\naverage\t1\t1\t1\nstandard_deviation\t0\t0\t0\n\npopulation/area\thits\tpercent_individuals\tcumulative_coverage\nWorld\t0\t50\t100\n"
    lines = None
    for i, kind in enumerate(("I", "II", "combined"), 1):
        hit = [F.lit(i * 0.5), F.col("n_regionkey")] if kind != "II" else []
        row = F.concat(F.concat_ws("\t", "n_name", F.concat((F.col("n_nationkey") + i * 0.25).cast("string"), F.lit("%")), *(x.cast("string") for x in hit)))
        own = nation.select((F.lit(i * 1000) + F.col("n_nationkey")).alias("at"), row.alias("line"))
        ends = spark.createDataFrame([(i * 1000 - 1, f"class {kind}\npopulation/area\tcoverage\taverage_hit\tpc90"), (i * 1000 + 999 - 500, tail)], "at long, line string")
        own = own.select(F.col("at").cast("long").alias("at"), "line").unionByName(ends)
        lines = own if lines is None else lines.unionByName(own)
    return files.scan_population_report(spark, _report(spark, lines))


_MEMBER_ROWS = f"{_CONSENSUS}, mem as (select dense_rank() over (order by threshold, cluster) as cluster_ord, concat(threshold, '-', cluster, '.1') as cluster_id, t.consensus, a.ord, row_number() over (partition by threshold, cluster order by a.position, a.ord) as member_index, a.position, concat('id', a.ord) as description, a.sequence, rpad(concat(repeat('-', cast(a.position - 1 as int)), a.sequence), cast(a.width as int), '-') as alignment from aligned a join texts t using (threshold, cluster))"


def cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    text, aligned = consensus_of(spark, sf_dir)
    numbers = numbered(text.select("threshold", "cluster", "consensus"), [], [F.asc("threshold"), F.asc("cluster")], "cluster_ord")
    index = F.row_number().over(Window.partitionBy("threshold", "cluster").orderBy("position", "ord"))
    rows = aligned.withColumn("member_index", index).join(numbers, ["threshold", "cluster"])
    return rows.select("cluster_ord", F.concat_ws("-", "threshold", F.concat("cluster", F.lit(".1"))).alias("cluster_id"), "consensus", "member_index", "alignment", "position", F.concat(F.lit("id"), "ord").alias("description"), "sequence")


@query("sink_clusters_csv", f"{_MEMBER_ROWS} select concat(cluster_id, ',Consensus,', consensus, ',-,-,-') as line from (select distinct cluster_id, consensus from mem) union all select concat(cluster_id, ',', member_index, ',', alignment, ',', position, ',', description, ',', sequence) from mem")
def sink_clusters_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    tools.sink_clusters_csv(cluster_members(spark, sf_dir), path)
    return spark.read.text(path).where("value not like 'Cluster.Sub-Cluster%'").select(F.col("value").alias("line"))


@query("scan_cluster_csv", f"{_MEMBER_ROWS} select cluster_id, consensus, cast(member_index as varchar) as member_index, alignment, cast(position as varchar) as position, description, sequence from mem")
def scan_cluster_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    tools.sink_clusters_csv(cluster_members(spark, sf_dir), path)
    return tools.scan_cluster_csv(spark, path).select("cluster_id", "consensus", "member_index", "alignment", "position", "description", "sequence")


@query("sink_iedb_upload", "select concat('>', p_type, '|', p_partkey) as line from part union all select upper(p_name) from part union all select p_name from part")
def sink_iedb_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part")
    tools.sink_iedb_upload(part.select(F.col("p_type").alias("strain"), F.col("p_partkey").cast("string").alias("accession"), F.upper("p_name").alias("sequence")), part.select(F.col("p_name").alias("sequence")), path)
    return spark.read.text([f"{path}/targets", f"{path}/epitopes"]).select(F.col("value").alias("line"))


_SHOWN = "concat('| ', s_suppkey, ' | ', replace(concat(s_name, '|x'), '|', '\\|'), ' | ', rtrim(rtrim(printf('%.6f', s_acctbal), '0'), '.'), ' |')"


@query("sink_markdown", f"select line from (values ('# Suppliers'), (''), ('| s_suppkey | name | s_acctbal |'), ('| ---: | --- | ---: |')) t(line) union all select {_SHOWN} from supplier")
def sink_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat("s_name", F.lit("|x")).alias("name"), "s_acctbal")
    tools.sink_markdown_table(rows, ["s_suppkey"], path, "Suppliers")
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("sink_provenance", "select n_name as term, count(c_custkey) as n, coalesce(array_to_string(list_sort(list(c_custkey) filter (c_custkey is not null)), ','), '') as accessions, cast(null as varchar) as note from nation left join customer on c_nationkey = n_nationkey group by n_name")
def sink_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's term, how many came of it, and which: a JSON object each, read back."""
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    joined = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    tools.sink_provenance(joined.groupBy(F.col("n_name").alias("term")).agg(F.count("c_custkey").alias("n"), F.array_sort(F.collect_list("c_custkey")).alias("accessions"), F.lit(None).cast("string").alias("note")), path)
    back = spark.read.schema("term string, n long, accessions array<long>, note string").json(path)
    return back.select("term", "n", F.array_join("accessions", ",").alias("accessions"), "note")


# The final list: suppliers ranked by balance; those of even keys are called allergens.
_FINAL = "f as (select row_number() over (order by s_acctbal desc, s_suppkey) as rank, s_name as consensus_id, s_suppkey, s_acctbal, s_nationkey from supplier)"


def final(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = numbered(table(spark, sf_dir, "supplier"), [], [F.desc("s_acctbal"), F.asc("s_suppkey")], "rank")
    return supplier.select("rank", F.col("s_name").alias("consensus_id"), F.concat(F.lit("N"), "s_nationkey").alias("protein_label"), F.upper("s_name").alias("sequence"), F.length("s_name").alias("length"), F.col("s_acctbal").alias("antigenicity_score"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey") * 0.5).alias("conservancy_percent"), F.when(F.col("s_suppkey") % 3 != 0, "A:1%|B:2%").alias("conservancy_per_strain"), (F.col("s_suppkey") * 0.25).alias("world_coverage_percent"), (F.col("s_suppkey") % 2 == 0).alias("allergen"))


@query("final_fasta", f"with {_FINAL} select concat('>', consensus_id) as line from f union all select upper(consensus_id) from f")
def final_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    tools.final_fasta(final(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


_NUMBER = "rtrim(rtrim(printf('%.6f', {}), '0'), '.')"


@query("final_report", f"with {_FINAL}, a as (select concat('N', s_nationkey) as protein, count(*) as n from supplier group by 1) select concat('| ', rank, ' | ', consensus_id, ' | N', s_nationkey, ' | ', upper(consensus_id), ' | ', length(consensus_id), ' | ', {_NUMBER.format('s_acctbal')}, ' | ', case when s_suppkey % 3 <> 0 then concat({_NUMBER.format('s_suppkey * 0.5::double')}, '%') else '-' end, ' | ', case when s_suppkey % 3 <> 0 then 'A:1%\\|B:2%' else '-' end, ' | ', {_NUMBER.format('s_suppkey * 0.25::double')}, '% |') as line from f union all select concat('| ', protein, ' | ', n, ' |') from a union all select concat('Candidates left after all stages: **', count(*), '**.') from f")
def final_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the report: the counts, the attrition's rows and the list's."""
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    own = final(spark, sf_dir)
    tools.final_report(spark, own, own.groupBy(F.col("protein_label").alias("protein")).agg(F.count("*").alias("n")), path)
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.where("line like 'Candidates left%' or line like '| %' and line not like '| ---%' and line not like '| rank%' and line not like '| protein |%'")


# Epitopes of score tracks on records: a user's events are a sequence's scores; residues follow from the position.
@query("build_epitopes", f"""{_ALL}, w as ({_MEANS}),
 r as (select w.*, concat('P', sequence_id % 7) as protein, concat('S', sequence_id % 3) as strain, list_reduce(list_transform(range(start, stop + 1), lambda i: chr(cast(65 + i % 7 as int))), lambda a, b: a || b) as peptide from w)
 select concat(protein, '_B_cell_BepiPred_', dense_rank() over (partition by protein order by peptide), '.', row_number() over (partition by protein, peptide order by strain, start, sequence_id)) as epitope_id, protein as protein_label, strain, lpad(cast(sequence_id as varchar), 6, '0') as accession, start, stop as "end", peptide as sequence, mean_score as score from r""")
def build_epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = track(spark, sf_dir)
    letters = F.expr("array_join(transform(sequence(1, int(n)), i -> char(65 + i % 7)), '')")
    own = rows.groupBy("sequence_id").agg(F.max("position").alias("n")).select(F.format_string("P%d|S%d|%06d", F.col("sequence_id") % 7, F.col("sequence_id") % 3, F.col("sequence_id")).alias("header"), letters.alias("sequence"))
    # The predictor cuts the tails of some ids; they are found again.
    named = F.format_string("P%d|S%d|%06d", F.col("sequence_id") % 7, F.col("sequence_id") % 3, F.col("sequence_id"))
    known = rows.select(F.when(F.col("sequence_id") % 2 == 0, F.concat(named, F.lit("#tail"))).otherwise(named).alias("sequence_id"), "position", "score")
    found = records.build_epitopes(known, own, "bepipred", T, LENGTH, STEP, GAP, LEAST)
    return found.select("epitope_id", "protein_label", "strain", "accession", "start", "end", "sequence", "score")


@query("run_cluster", f"{_CONSENSUS}, d as (select threshold, cluster, count(*) filter (k > 1) as differ from (select threshold, cluster, col, count(distinct residue) as k from votes group by all) group by all), n as (select threshold, cluster, count(*) as n from aligned group by all) select threshold, sum(n)::bigint as n_peptides, count(*) as n_clusters, count(*) filter (n = 1) as n_singletons, count(*) filter (differ > 0) as n_voted, max(differ) as worst, count(*) filter (contains(consensus, 'X')) as n_ambiguous from texts join d using (threshold, cluster) join n using (threshold, cluster) group by threshold")
def run_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sievemark.operators import clustering

    text, aligned = consensus_of(spark, sf_dir)
    return clustering.run_statistics(aligned, text, ["threshold", "cluster"])


@query("scan_input_dir", "select concat(r_name, '.', case r_regionkey % 3 when 0 then 'fasta' when 1 then 'FA' else 'faa' end) as file, i as ord, concat(r_name, i) as header, repeat('AC', cast(i as int)) as sequence from region, (select unnest(range(1, 4)) as i)")
def scan_input_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file by region, its ending in either case, beside one that is no sequence file."""
    folder = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    names = [(r.r_name, ("fasta", "FA", "faa")[r.r_regionkey % 3]) for r in table(spark, sf_dir, "region").collect()]  # a handful of files to lay out
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.get(spark._jvm.java.net.URI(folder), spark._jsc.hadoopConfiguration())
    for name, ending in [*names, ("notes", "txt")]:
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.{ending}"))
        out.write(bytearray("".join(f">{name}{i}\n{'ac-' * i}*\n" for i in range(1, 4)), "utf-8"))
        out.close()
    return files.scan_input_dir(spark, folder).select("file", "ord", "header", "sequence")


@query("resolve_column", "with k as (select n_nationkey, 'K' || lpad(cast(n_nationkey as varchar), 2, '0') as key from nation) select key, case n_nationkey % 3 when 0 then key || ' (all)' when 1 then key || ' score' else 'mean ' || key end as found from k")
def resolve_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of columns named after nations: the same name, then one that begins so, then one that has it inside; the first candidate decides."""
    keys = sorted(r[0] for r in table(spark, sf_dir, "nation").select("n_nationkey").collect())  # the columns of a table
    forms = {0: ("{} (all)", "other {} (all)"), 1: ("the {} score", "{} score"), 2: ("mean {}",)}
    have = [form.format(f"K{k:02d}") for k in keys for form in forms[k % 3]]
    wanted = [(f"K{k:02d}", ["none", f"K{k:02d} ALL" if k % 3 == 0 else f"k{k:02d}"]) for k in keys]
    return spark.createDataFrame([(key, files.resolve_column(have, w, "it")) for key, w in wanted], "key string, found string")


@query("sink_residue_scores", "with t as (select user_id, row_number() over (partition by user_id order by ts, event_id) as position from events) select user_id::varchar as sequence_id, count(*) as n, max(position) as last from t group by user_id")
def sink_residue_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    files.sink_residue_scores(track(spark, sf_dir), path)
    rows = spark.read.text(path).where("value not like 'sequence_id%'").select(F.split("value", "\t").alias("c"))
    return rows.groupBy(F.col("c")[0].alias("sequence_id")).agg(F.count("*").alias("n"), F.max(F.col("c")[1].cast("long")).alias("last"))


@query("manifest_fasta", "select p_brand as protein_label, concat('>', p_brand, '|', p_type, '|', p_partkey) as line from part union all select p_brand, upper(p_name) from part")
def manifest_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A FASTA of every protein, its strains in order, and one of every protein and strain."""
    folder = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    part = table(spark, sf_dir, "part")
    records.sink_manifest_fasta(part.select(F.col("p_brand").alias("protein_label"), F.col("p_type").alias("strain"), F.col("p_partkey").cast("string").alias("accession"), F.upper("p_name").alias("sequence")), folder)
    return spark.read.option("basePath", f"{folder}/by_protein").text(f"{folder}/by_protein").select("protein_label", F.col("value").alias("line"))
