"""Filters, joins, aggregates, sets and ranking. The bindings to tables are named at each query."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs
from sievemark.operators import identifiers as ids
from sievemark.operators import records
from sievemark.operators.graph import shared_folder, written
from sievemark.plans.catalog import query, table
from sievemark.plans.q_scalars import folded_sql
from sievemark.sources import tools

# Epitope rows: protein = p_brand, tool = l_returnflag, sequence = p_name, strain = l_linestatus,
# allele = p_type, start = l_linenumber, score = l_quantity.
_E = "e as (select p_brand as protein, l_returnflag as tool, p_name as sequence, l_linestatus as strain, p_type as allele, l_linenumber as start, l_quantity as score, l_orderkey as tie, concat(p_brand, '_B_cell_', l_returnflag, '_', dense_rank() over (partition by p_brand, l_returnflag order by p_name), '.', row_number() over (partition by p_brand, l_returnflag, p_name order by l_linestatus, l_linenumber, l_orderkey)) as epitope_id from lineitem join part on p_partkey = l_partkey)"


def epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = line.select(F.col("p_brand").alias("protein"), F.lit("B_cell").alias("kind"), F.col("l_returnflag").alias("tool"), F.col("p_name").alias("sequence"), F.col("l_linestatus").alias("strain"), F.col("p_type").alias("allele"), F.col("l_linenumber").alias("start"), F.col("l_quantity").alias("score"), F.col("l_orderkey").alias("tie"))
    return ids.assign_ids(rows, "protein", "kind", "tool", "sequence", "strain", "start", "tie")


@query("assign_ids", f"with {_E} select tie, start, epitope_id from e")
def assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epitopes(spark, sf_dir).select("tie", "start", "epitope_id")


@query("dedup_epitopes", f"with {_E} select protein, tool, sequence, min(epitope_id) as epitope_id, max(score) as best_score, array_to_string(list_sort(list(distinct strain)), '|') as strains, array_to_string(list_sort(list(distinct allele)), '|') as alleles, count(*) as n_occurrences from e group by protein, tool, sequence")
def dedup_epitopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids.deduplicated(epitopes(spark, sf_dir), ["protein", "tool", "sequence"])


@query("dedup_sequences", f"select min(doc_id) as doc_id, md5({folded_sql('text')}) as md5 from documents group by 2")
def dedup_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of equal texts, in either case."""
    return table(spark, sf_dir, "documents").groupBy(F.md5(fs.folded(F.col("text"))).alias("md5")).agg(F.min("doc_id").alias("doc_id"))


@query("unique_collapse", "select p_name as sequence, arg_min(p_brand, p_partkey) as first_brand, min(p_partkey) as ord from part group by p_name")
def unique_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("sequence")).agg(F.min_by("p_brand", "p_partkey").alias("first_brand"), F.min("p_partkey").alias("ord"))


@query("unique_tcell", "select p_name as sequence, min(p_partkey) as first_id, array_to_string(list_sort(list(distinct p_type)), '|') as strains from part group by p_name")
def unique_tcell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("sequence")).agg(F.min("p_partkey").alias("first_id"), F.array_join(F.array_sort(F.collect_set("p_type")), "|").alias("strains"))


@query("tool_summary", f"with {_E} select tool, count(*) as n, count(distinct sequence) as n_distinct, min(length(sequence)) as shortest, max(length(sequence)) as longest from e group by tool")
def tool_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epitopes(spark, sf_dir).groupBy("tool").agg(F.count("*").alias("n"), F.count_distinct("sequence").alias("n_distinct"), F.min(F.length("sequence")).cast("long").alias("shortest"), F.max(F.length("sequence")).cast("long").alias("longest"))


_T_CELL = "t as (select case l_linestatus when 'F' then 'mhc_i' else 'mhc_ii' end as source_tool, p_name as sequence, case when l_linenumber % 3 = 0 then '' else p_type end as allele from lineitem join part on p_partkey = l_partkey)"


@query("tcell_summary", f"with {_T_CELL} select source_tool, count(*) as n, count(distinct sequence) as n_peptides, count(distinct case when allele <> '' then allele end) as n_alleles from t group by source_tool")
def tcell_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return records.t_cell_summary(line.select(F.when(F.col("l_linestatus") == "F", "mhc_i").otherwise("mhc_ii").alias("source_tool"), F.col("p_name").alias("sequence"), F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("p_type")).alias("allele")))


# Validation of records: documents as FASTA bodies, blanks, gaps and stops aside.
_BODY = folded_sql("regexp_replace(text, '[ \\t\\n\\r*-]', '', 'g')")
_PROBLEMS = f"""list_filter([case when length(s) < 200 then concat(length(s), ' residues, fewer than 200') end, case when s = '' then 'empty sequence' end,
 case when len(regexp_extract_all(s, '[^{fs.VALID}]')) > 0 then concat('not amino acids: ', array_to_string(list_sort(list_distinct(regexp_extract_all(s, '[^{fs.VALID}]'))), '')) end,
 case when regexp_matches(s, '^[ACGTUN]+$') then 'nucleotides, not amino acids' end], lambda x: x is not null)"""


@query("validate_record", f"select doc_id, unnest({_PROBLEMS}) as problem from (select doc_id, {_BODY} as s from documents)")
def validate_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = fs.folded(F.regexp_replace("text", r"[ \t\n\r*-]", "")).alias("s")
    return table(spark, sf_dir, "documents").select("doc_id", body).select("doc_id", F.explode(records.problems_of(F.col("s"), 200)).alias("problem"))


# Records: parts, their names' letters as sequences, p_brand as protein and p_type as strain.
_LETTERS = "regexp_replace(upper(p_name), '[^A-Z]', '', 'g')"


def part_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(F.concat(F.lit("in/"), key, F.lit(".fasta")).alias("path"), F.col("p_partkey").alias("ord"), key.alias("id"), key.alias("accession"), F.col("p_brand").alias("protein_label"), F.col("p_name").alias("protein_name"), F.col("p_type").alias("strain"), F.regexp_replace(F.upper("p_name"), "[^A-Z]", "").alias("sequence"))


_DUPLICATE = "select concat('in/', p_partkey, '.fasta') as path, cast(p_partkey as varchar) as id, concat('second record of (', p_brand, ', ', p_type, '), which in/', first_value(p_partkey) over w, '.fasta has, in in/', p_partkey, '.fasta') as problem from part window w as (partition by p_brand, p_type order by p_partkey) qualify row_number() over w > 1"


@query("duplicate_pair", _DUPLICATE)
def duplicate_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.find_problems(part_records(spark, sf_dir), 1)


@query("preflight", f"with d as ({_DUPLICATE}) select concat('in/', p_partkey, '.fasta') as path, cast(p_partkey as varchar) as id, p_brand as protein_label, p_type as strain, length({_LETTERS}) as length, '' as warnings, coalesce(problem, '') as problems from part left join d on d.id = cast(p_partkey as varchar)")
def preflight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every record will be read, and whether the manifest would refuse it."""
    return records.described(part_records(spark, sf_dir), 1).withColumn("warnings", F.array_join("warnings", "; ")).withColumn("problems", F.array_join("problems", "; "))


@query("build_manifest", f"select cast(p_partkey as varchar) as accession, p_brand as protein_label, p_type as strain, length({_LETTERS}) as length, md5({_LETTERS}) as md5, concat('in/', p_partkey, '.fasta') as path from part qualify row_number() over (partition by p_brand, p_type order by p_partkey) = 1")
def build_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of records that have been made distinct by pair: any problem left would be an error."""
    rows = ids.first_of(part_records(spark, sf_dir), ["protein_label", "strain"], ["ord"])
    return records.build_manifest(rows, 1).drop("protein_name")


@query("discover_pairs", "select distinct p_brand as protein_label, p_type as strain from part")
def discover_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_brand").alias("protein_label"), F.col("p_type").alias("strain")).distinct()


@query("distinct_project", "select distinct lang, source from documents")
def distinct_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("lang", "source").distinct()


# Scored peptides: orders by segment of their customer; urgent ones are class I, the score is the balance of the segment's first customer.
@query("filter_immunogenic", "with s as (select c_mktsegment as sequence, arg_min(c_acctbal, c_custkey) as immunogenicity from customer group by 1) select o_orderkey, case when o_orderpriority <> '1-URGENT' or immunogenicity > 3000 then 'kept' else 'dropped' end as verdict from orders join customer on c_custkey = o_custkey join s on sequence = c_mktsegment")
def filter_immunogenic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for each distinct peptide; class I rows stay if it is over the limit, strictly, and the others are a table of their own."""
    customer = table(spark, sf_dir, "customer")
    scores = customer.groupBy(F.col("c_mktsegment").alias("sequence")).agg(F.min_by("c_acctbal", "c_custkey").alias("immunogenicity"))
    rows = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("sequence"), F.when(F.col("o_orderpriority") == "1-URGENT", "MHC-I").otherwise("MHC-II").alias("epitope_class"))
    kept, dropped = records.filter_immunogenic(rows, scores, 3000.0)
    return kept.select("o_orderkey", F.lit("kept").alias("verdict")).unionByName(dropped.select("o_orderkey", F.lit("dropped").alias("verdict")))


_SCORED = "documents left join labels using (doc_id)"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query("flag_antigenic", f"select doc_id, coalesce(quality >= 1, false) as antigenic, case when quality is null then 'not scored' else '' end as note from {_SCORED}")
def flag_antigenic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).select("doc_id", F.coalesce(F.col("quality") >= 1, F.lit(False)).alias("antigenic"), F.when(F.col("quality").isNull(), "not scored").otherwise("").alias("note"))


@query("drop_failing_proteins", f"select lang, count(*) filter (coalesce(quality >= 1, false)) as n_kept, count(*) filter (not coalesce(quality >= 1, false)) as n_failing from {_SCORED} group by lang")
def drop_failing_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.coalesce(F.col("quality") >= 1, F.lit(False))
    return scored(spark, sf_dir).groupBy("lang").agg(F.count_if(ok).alias("n_kept"), F.count_if(~ok).alias("n_failing"))


_REFERENCE = f"r as (select doc_id, {folded_sql('text')} as s from documents)"


def _reference(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("ord"), F.col("doc_id").alias("accession"), fs.folded(F.col("text")).alias("sequence"))
    return records.filter_reference(rows)


@query("filter_reference", f"with {_REFERENCE} select doc_id, s as sequence from r where not contains(s, 'X') qualify row_number() over (partition by s order by doc_id) = 1")
def filter_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference(spark, sf_dir)[0].select(F.col("ord").alias("doc_id"), "sequence")


@query("filter_reference_counts", f"with {_REFERENCE}, k as (select count(*) as n, count(*) filter (contains(s, 'X')) as n_ambiguous, count(distinct s) filter (not contains(s, 'X')) as n_kept from r) select n, n_ambiguous, n - n_ambiguous - n_kept as n_repeated, n_kept from k")
def filter_reference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference(spark, sf_dir)[1]


@query("identity_flag", "select l_orderkey, l_linenumber, l_discount * 100 >= 5 as at_risk from lineitem")
def identity_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_discount") * 100 >= 5).alias("at_risk"))


# Screening: candidates = documents; antigenicity = labels.quality, allergenicity = labels.toxic, windows skipped = short text.
_REASONS = "list_filter([case when quality is null then 'antigenicity missing' when quality < 1 then concat('antigenicity ', printf('%.4f', quality::double), ' < 1') end, case when toxic = 1 then 'allergen' end, case when length(text) < 300 then 'NOTE short text' end], lambda x: x is not null)"


def reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.when(F.col("quality").isNull(), "antigenicity missing").when(F.col("quality") < 1, F.format_string("antigenicity %.4f < 1", F.col("quality").cast("double")))
    why = F.array_compact(F.array(low, F.when(F.col("toxic") == 1, "allergen"), F.when(F.length("text") < 300, "NOTE short text")))
    return scored(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", "quality", "toxic", why.alias("reasons"))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.size(F.filter("reasons", lambda r: ~F.startswith(r, F.lit("NOTE ")))) == 0
    return reasons(spark, sf_dir).withColumn("passes", ok).withColumn("reason", F.array_join("reasons", "; "))


_V = f"v as (select doc_id, lang, source, n_chars, quality, toxic, array_to_string({_REASONS}, '; ') as reason, len(list_filter({_REASONS}, lambda r: not starts_with(r, 'NOTE '))) = 0 as passes from {_SCORED})"


@query("combine_screens", f"with {_V} select doc_id, reason, passes from v")
def combine_screens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(spark, sf_dir).select("doc_id", "reason", "passes")


@query("passing_fasta", f"with {_V} select '>' || doc_id as line from v where passes union all select concat(lang, source) from v where passes")
def passing_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What passed the screens as one FASTA file."""
    path = f"{shared_folder(spark)}/tool-{uuid.uuid4().hex}"
    rows = verdicts(spark, sf_dir).select(F.col("doc_id").alias("consensus_id"), F.concat("lang", "source").alias("sequence"), "passes")
    tools.sink_passing_fasta(rows, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("screen_allergen", f"select doc_id, case when toxic = 1 then 'called an allergen' end as strict, case when toxic = 1 then 'NOTE the allergen call is advice only' end as advisory, toxic is null or toxic <> 1 as passes_strict, true as passes_advisory from {_SCORED}")
def screen_allergen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call as a reason to drop, and as a note: only the first fails a candidate."""
    call = F.coalesce(F.col("toxic") == 1, F.lit(False))
    rows = scored(spark, sf_dir).select("doc_id", records.allergen_reason(call).alias("strict"), records.allergen_reason(call, False).alias("advisory"))
    passes = lambda c: (F.coalesce(F.startswith(c, F.lit("NOTE ")), F.lit(True))).alias(f"passes_{c}")
    return rows.select("*", passes("strict"), passes("advisory"))


@query("passes_flag", f"with {_V} select passes, count(*) as n from v group by passes")
def passes_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(spark, sf_dir).groupBy("passes").agg(F.count("*").alias("n"))


@query("passing_only", f"with {_V} select doc_id from v where passes")
def passing_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(spark, sf_dir).where("passes").select("doc_id")


@query("reason_histogram", f"with {_V} select r as reason, count(*) as n from (select unnest(string_split(reason, '; ')) as r from v where reason <> '') group by r")
def reason_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(spark, sf_dir).where("reason <> ''").select(F.explode(F.split("reason", "; ")).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


@query("flagged_final", f"with {_V} select lang, doc_id, count(*) over (partition by lang) as n_flagged from v where toxic = 1")
def flagged_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged rows, a row each, and how many there are; a list of all in one cell would not be bounded."""
    flagged = verdicts(spark, sf_dir).where("toxic = 1").select("lang", "doc_id")
    return flagged.join(flagged.groupBy("lang").agg(F.count("*").alias("n_flagged")), "lang")


@query("final_rank", f"with {_V} select row_number() over (order by n_chars desc nulls last, doc_id) as rank, doc_id, n_chars from v where passes")
def final_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = verdicts(spark, sf_dir).where("passes").select("doc_id", "n_chars")
    return ids.numbered(rows, [], [F.desc_nulls_last("n_chars"), F.asc("doc_id")], "rank")


# Joins. Those of a tool's rows with what was submitted must match: a row without a partner is an error.
@query("join_seqnum", "select l_orderkey, l_linenumber, n_name from lineitem join (select row_number() over (order by n_nationkey) as seq_num, n_name from nation) on seq_num = l_suppkey % 25 + 1")
def join_seqnum(spark: SparkSession, sf_dir: str) -> DataFrame:
    submitted = ids.numbered(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), [], [F.asc("n_nationkey")], "seq_num")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") % 25 + 1).alias("seq_num"))
    return records.must_match(rows, submitted, "seq_num", "rows of no submitted sequence").select("l_orderkey", "l_linenumber", "n_name")


@query("join_resolve_id", "select s_suppkey, concat(lpad(cast(n_nationkey as varchar), 2, '0'), ' ', n_name) as name from supplier join nation on n_nationkey = s_nationkey")
def join_resolve_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers name their nation in full, cut to four letters, or with a tail: each finds it again."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(" "), "n_name").alias("name"))
    said = F.when(F.col("s_suppkey") % 3 == 0, F.left("name", F.lit(4))).when(F.col("s_suppkey") % 3 == 1, F.concat("name", F.lit("|tail"))).otherwise(F.col("name"))
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", said.alias("said"))
    return records.resolved(rows, nation, "said", "name").select("s_suppkey", "name")


@query("join_surrogate", "select s_suppkey, s_name, s_acctbal as score from supplier")
def join_surrogate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tool scores short names; its rows get their suppliers back."""
    submitted = written(records.surrogates(table(spark, sf_dir, "supplier"), "s_suppkey"))
    scores = submitted.select("surrogate", F.col("s_acctbal").alias("score"))
    return records.restored(scores, submitted.select("surrogate", "s_suppkey", "s_name")).select("s_suppkey", "s_name", "score")


# Members of clusters: order lines. Their ids are a part's (l_linenumber = 1), a stranger's with a known sequence (2), one that
# only its form explains (3), or nothing. Parts are epitopes; every part's id stands twice, with two tools, of which the last counts.
_MEMBERS = "m as (select l_orderkey, l_linenumber, case l_linenumber when 1 then concat('part', l_partkey) when 3 then concat('Spike_T_cell_MHCII_', l_partkey, '.1') else '?' end as description, case when l_linenumber <= 2 then p_name else '-' end as sequence from lineitem join part on p_partkey = l_partkey)"
_TOOL = "case p_size % 2 when 0 then 'bepipred' else 'epidope' end"


@query("join_member_epitope", f"with {_MEMBERS}, q as (select p_name, arg_min({_TOOL}, p_partkey) as first_tool, array_to_string(list_sort(list(distinct p_brand)), '|') as strains from part group by p_name) select l_orderkey, l_linenumber, case l_linenumber when 1 then 'mhc_i' when 2 then coalesce(first_tool, '') when 3 then 'mhc_ii' else '' end as source_tool, case l_linenumber when 1 then 'MHC-I' when 2 then 'B' when 3 then 'MHC-II' else '' end as epitope_class, coalesce(strains, '') as strains from m left join q on p_name = sequence")
def join_member_epitope(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, line = table(spark, sf_dir, "part"), table(spark, sf_dir, "lineitem")
    n = F.col("l_linenumber")
    description = F.when(n == 1, F.concat(F.lit("part"), "l_partkey")).when(n == 3, F.format_string("Spike_T_cell_MHCII_%d.1", F.col("l_partkey"))).otherwise("?")
    members = line.join(part, F.col("p_partkey") == F.col("l_partkey")).select("l_orderkey", "l_linenumber", description.alias("description"), F.when(n <= 2, F.col("p_name")).otherwise("-").alias("sequence"))
    row = lambda tool, kind, ord_: part.select(F.concat(F.lit("part"), "p_partkey").alias("epitope_id"), F.col("p_name").alias("sequence"), tool.alias("source_tool"), F.lit(kind).alias("epitope_class"), F.col("p_brand").alias("strains"), ord_.alias("ord"))
    first = row(F.when(F.col("p_size") % 2 == 0, "bepipred").otherwise("epidope"), "B", F.col("p_partkey"))
    epitopes_ = first.unionByName(row(F.lit("mhc_i"), "MHC-I", F.col("p_partkey") + 1_000_000_000))
    return records.members_annotated(members, epitopes_).select("l_orderkey", "l_linenumber", "source_tool", "epitope_class", "strains")


@query("join_strains_by_sequence", f"with {_E}, s as (select sequence, array_to_string(list_sort(list(distinct strain)), '|') as strains from e group by sequence) select epitope_id, strains from e join s using (sequence)")
def join_strains_by_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = epitopes(spark, sf_dir)
    strains = e.groupBy("sequence").agg(F.array_join(F.array_sort(F.collect_set("strain")), "|").alias("strains"))
    return e.join(strains, "sequence").select("epitope_id", "strains")


@query("join_cluster_members", f"with {_V} select doc_id, source from documents where doc_id in (select doc_id from v where passes) and lang <> 'fr'")
def join_cluster_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = verdicts(spark, sf_dir).where("passes").select("doc_id")
    return table(spark, sf_dir, "documents").where("lang <> 'fr'").join(wanted, "doc_id", "left_semi").select("doc_id", "source")


@query("join_screen_lookup", "with l as (select l_orderkey, count(*) as n, sum(cast(l_quantity as decimal(18,2))) as q from lineitem group by 1) select o_orderkey, coalesce(n, 0) as n_lines, cast(coalesce(q, 0) as double) as quantity, coalesce(c_mktsegment, '') as segment, coalesce(n_name, '') as nation from orders left join l on l_orderkey = o_orderkey left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey")
def join_screen_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("q"))
    out = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").join(table(spark, sf_dir, "customer"), F.col("c_custkey") == F.col("o_custkey"), "left").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return out.select("o_orderkey", F.coalesce("n", F.lit(0).cast("long")).alias("n_lines"), F.coalesce(F.col("q").cast("double"), F.lit(0.0)).alias("quantity"), F.coalesce("c_mktsegment", F.lit("")).alias("segment"), F.coalesce("n_name", F.lit("")).alias("nation"))


@query("join_alleles_by_sequence", "with a as (select p_name, array_to_string(list_sort(list(distinct split_part(p_type, '/', 1))), ',') as alleles from part group by p_name) select p_partkey, alleles from part join a using (p_name)")
def join_alleles_by_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    alleles = part.groupBy("p_name").agg(F.array_join(F.array_sort(F.collect_set(F.substring_index("p_type", "/", 1))), ",").alias("alleles"))
    return part.join(alleles, "p_name").select("p_partkey", "alleles")


@query("join_alleles_by_id", "select l_orderkey, coalesce(array_to_string(list_sort(list(distinct p_type) filter (l_linestatus = 'F')), ','), '') as class_i, coalesce(array_to_string(list_sort(list(distinct p_type) filter (l_linestatus <> 'F')), ','), '') as class_ii from lineitem join part on p_partkey = l_partkey group by l_orderkey")
def join_alleles_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    of = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(c, F.col("p_type")))), ",")
    return line.groupBy("l_orderkey").agg(of(F.col("l_linestatus") == "F").alias("class_i"), of(F.col("l_linestatus") != "F").alias("class_ii"))


@query("join_final", f"with {_V}, c as (select source, count(*) as n_target, count(*) filter (quality = 1) as n_matched from {_SCORED} group by source), k as (select lang, count(*) as n_lang from documents group by lang) select doc_id, n_target, n_matched, n_lang, reason from v left join c using (source) left join k using (lang) where passes")
def join_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = scored(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n_target"), F.count_if(F.col("quality") == 1).alias("n_matched"))
    k = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count("*").alias("n_lang"))
    return verdicts(spark, sf_dir).where("passes").join(c, "source", "left").join(k, "lang", "left").select("doc_id", "n_target", "n_matched", "n_lang", "reason")


@query("anti_missing", "select doc_id from documents where doc_id not in (select doc_id from labels)")
def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id")


@query("completeness_keep", "select c_custkey, count(o_orderkey) as n_orders from customer left join orders on o_custkey = c_custkey group by c_custkey")
def completeness_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n_orders"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(n, "c_custkey", "left").select("c_custkey", F.coalesce("n_orders", F.lit(0).cast("long")).alias("n_orders"))


# Aggregates.
@query("attrition", "select r_name as protein, count(distinct n_name) as strains, count(distinct c_custkey) as peptides, count(distinct o_orderkey) as clusters, count(distinct case when o_orderstatus = 'F' then o_orderkey end) as clusters_passing from region left join nation on n_regionkey = r_regionkey left join customer on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by r_name")
def attrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each table is summed before it is joined, so nothing is counted distinct over a fan-out."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    nation = table(spark, sf_dir, "customer").join(orders, "c_custkey", "left").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("c"), F.sum("n").alias("n"), F.sum("f").alias("f"))
    out = table(spark, sf_dir, "region").join(table(spark, sf_dir, "nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left").join(nation, "n_nationkey", "left")
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    return out.groupBy(F.col("r_name").alias("protein")).agg(F.count_distinct("n_name").alias("strains"), zero("c").alias("peptides"), zero("n").alias("clusters"), zero("f").alias("clusters_passing"))


@query("cluster_counts", "select o_custkey, count(*) filter (o_orderpriority = '1-URGENT') as n_urgent, count(*) filter (o_orderpriority = '2-HIGH') as n_high, count(*) filter (o_orderpriority = '3-MEDIUM') as n_medium, count(*) as n_members from orders group by o_custkey")
def cluster_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda p: F.count_if(F.col("o_orderpriority") == p)
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(of("1-URGENT").alias("n_urgent"), of("2-HIGH").alias("n_high"), of("3-MEDIUM").alias("n_medium"), F.count("*").alias("n_members"))


@query("cluster_strains", "select p_brand, count(distinct s) as n_strains, array_to_string(list_sort(list(distinct s)), '|') as strains from (select p_brand, unnest(string_split(p_type, ' ')) as s from part) group by p_brand")
def cluster_strains(spark: SparkSession, sf_dir: str) -> DataFrame:
    exploded = table(spark, sf_dir, "part").select("p_brand", F.explode(F.split("p_type", " ")).alias("s"))
    bag = F.array_sort(F.collect_set("s"))
    return exploded.groupBy("p_brand").agg(F.count_distinct("s").alias("n_strains"), F.array_join(bag, "|").alias("strains"))


@query("inert_components", "select bool_and(l_discount = 0) as discount_inert, bool_and(l_tax = 0) as tax_inert, bool_and(l_quantity = 0) as quantity_inert from lineitem")
def inert_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(*(F.bool_and(F.col(f"l_{c}") == 0).alias(f"{c}_inert") for c in ("discount", "tax", "quantity")))


@query("allele_union", "select p_brand as consensus_id, array_to_string(list_sort(list(distinct p_type)), ',') as alleles from part group by p_brand union all select 'ALL', array_to_string(list_sort(list(distinct p_type)), ',') from part")
def allele_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    bag = F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("alleles")
    return part.groupBy(F.col("p_brand").alias("consensus_id")).agg(bag).union(part.agg(bag).select(F.lit("ALL"), "alleles"))


@query("protein_set_coverage", "select n_name, count(*) as n from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey where r_name = 'EUROPE' and c_mktsegment = 'BUILDING' group by n_name")
def protein_set_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(table(spark, sf_dir, "region").where("r_name = 'EUROPE'"), F.col("r_regionkey") == F.col("n_regionkey"))
    return out.groupBy("n_name").agg(F.count("*").alias("n"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("coverage_pivot", "select n_name, " + ", ".join(f"cast(sum(case when c_mktsegment = '{s}' then cast(c_acctbal as decimal(18,2)) end) as double) as {s.lower()}" for s in _SEGMENTS) + " from customer join nation on n_nationkey = c_nationkey group by n_name")
def coverage_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing class stays null: it is not 0."""
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    wide = joined.groupBy("n_name").pivot("c_mktsegment", _SEGMENTS).agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double"))
    return wide.select("n_name", *(F.col(s).alias(s.lower()) for s in _SEGMENTS))


# Coverage: brands are candidates, their parts' names the members' peptides; types of parts are alleles, with a second chain in some.
_ASKED = """e as (select p_partkey, p_name, p_brand, case p_size % 3 when 0 then 'MHC-I' when 1 then 'MHC-II' else 'B' end as class, p_type as allele from part),
 s as (select p_name, allele from e where class <> 'B'),
 asked as (select distinct p_brand as consensus_id, s.allele from e join s using (p_name) where class <> 'B' union select 'ALL', s.allele from e join s using (p_name) where class <> 'B'),
 bags as (select consensus_id, count(distinct allele) as n_alleles, array_to_string(list_sort(list(distinct allele)), '|') as alleles from asked group by 1)"""


def coverage_asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    kind = F.element_at(F.array(F.lit("MHC-I"), F.lit("MHC-II"), F.lit("B")), (F.col("p_size") % 3 + 1).cast("int"))
    chain = F.when(F.col("p_size") % 2 == 0, F.concat("p_type", F.lit("/second"))).otherwise(F.col("p_type"))
    epitopes_ = part.select(F.col("p_partkey").alias("epitope_id"), F.col("p_name").alias("sequence"), kind.alias("epitope_class"), chain.alias("allele"))
    members = part.select(F.col("p_brand").alias("consensus_id"), F.col("p_partkey").alias("epitope_id"))
    passing = part.groupBy(F.col("p_brand").alias("consensus_id")).agg(F.min("p_name").alias("sequence"))
    return records.coverage_input(passing, members, epitopes_)


@query("population_coverage", f"with {_ASKED} select consensus_id, r_name as population, class as mhc_class, r_regionkey * 10 + length(consensus_id) + i * 0.5::double as coverage, n_alleles, alleles from bags, region, (values ('I', 1), ('II', 2), ('combined', 3)) t(class, i) where not (class = 'II' and r_regionkey = 0)")
def population_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a tool reports of every candidate, and of all together, with the alleles that were asked for; a class it leaves out stays out."""
    asked = written(coverage_asked(spark, sf_dir))
    ids_ = asked.select("consensus_id").union(spark.createDataFrame([("ALL",)], "consensus_id string"))
    kinds = F.broadcast(spark.createDataFrame([("I", 1), ("II", 2), ("combined", 3)], "mhc_class string, i int"))
    reports = ids_.crossJoin(F.broadcast(table(spark, sf_dir, "region"))).crossJoin(kinds).where("not (mhc_class = 'II' and r_regionkey = 0)")  # a report's rows: five populations, three classes
    reports = reports.select("consensus_id", F.col("r_name").alias("population"), "mhc_class", (F.col("r_regionkey") * 10 + F.length("consensus_id") + F.col("i") * 0.5).alias("coverage"), F.lit(None).cast("double").alias("average_hit"), F.lit(None).cast("double").alias("pc90"))
    return records.population_coverage(asked, reports).drop("average_hit", "pc90")


@query("conservancy_min", "select lang, cast(min(q) as double) as least, array_to_string(list_sort(list(concat(source, ':', q, '%'))), '|') as per_source from (select lang, source, 100 * count(*) filter (length(text) >= 1000) // count(*) as q from documents group by lang, source) group by lang")
def conservancy_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.expr("100 * count_if(length(text) >= 1000) div count(*)").alias("q"))
    return share.groupBy("lang").agg(F.min("q").cast("double").alias("least"), F.array_join(F.array_sort(F.collect_list(F.format_string("%s:%d%%", F.col("source"), F.col("q")))), "|").alias("per_source"))


# Sorts, limits and sets.
@query("sort_multi", "select p_partkey, row_number() over (partition by p_brand order by p_type, p_name, p_partkey) as place from part")
def sort_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return ids.numbered(rows, ["p_brand"], [F.asc("p_type"), F.asc("p_name"), F.asc("p_partkey")], "place").select("p_partkey", "place")


@query("sort_desc_score", "select c_custkey, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as place from customer")
def sort_desc_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return ids.numbered(rows, ["c_nationkey"], [F.desc("c_acctbal"), F.asc("c_custkey")], "place").select("c_custkey", "place")


@query("topk_truncate", "select p_brand, array_to_string(list_slice(list_sort(list(distinct p_name)), 1, 8), ';') as first_eight from part group by p_brand")
def topk_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.slice(F.array_sort(F.collect_set("p_name")), 1, 8), ";").alias("first_eight"))


@query("preview_limit", "select doc_id from documents where doc_id not in (select doc_id from labels) order by doc_id limit 10")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anti_missing(spark, sf_dir).orderBy("doc_id").limit(10)


@query("union_all", "select c_custkey as id, c_name as name from customer union all select s_suppkey, s_name from supplier")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return a.unionByName(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")))


@query("intersect_peptides", "select p_name from part join lineitem on l_partkey = p_partkey where l_returnflag = 'A' intersect select p_name from part join lineitem on l_partkey = p_partkey where l_returnflag = 'R'")
def intersect_peptides(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = epitopes(spark, sf_dir)
    return e.where("tool = 'A'").select(F.col("sequence").alias("p_name")).intersect(e.where("tool = 'R'").select("sequence"))


@query("except_missing", "select distinct l_suppkey from lineitem except select s_suppkey from supplier where s_acctbal > 0")
def except_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_suppkey").distinct().join(table(spark, sf_dir, "supplier").where("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left_anti")
