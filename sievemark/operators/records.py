"""Records and tables that must fit: validation, manifests, and joins in which every row has to find its partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs
from sievemark.operators import tracks
from sievemark.operators.graph import written
from sievemark.operators.identifiers import assign_ids, numbered
from sievemark.operators.prefixes import only_relatives

# The tools' names in tables, and in identifiers with the kind of epitope and its class.
TOOLS = {"bepipred": ("B_cell", "BepiPred", "B"), "epidope": ("B_cell", "EpiDope", "B"), "mhc_i": ("T_cell", "MHCI", "MHC-I"), "mhc_ii": ("T_cell", "MHCII", "MHC-II")}
NUCLEOTIDES = "ACGTUN"
#: Rows that an error names.
SHOWN = 10


def problems_of(sequence: Column, min_length: int = 1) -> Column:
    """All that is wrong with an upper-case sequence, in words; an empty one has no further faults."""
    n = F.length(sequence)
    bad = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(sequence, F.lit(f"[^{fs.VALID}]"), 0))), "")
    return F.array_compact(
        F.array(
            F.when(n < min_length, F.format_string(f"%d residues, fewer than {min_length}", n)),
            F.when(n == 0, "empty sequence"),
            F.when(bad != "", F.concat(F.lit("not amino acids: "), bad)),
            F.when(sequence.rlike(f"^[{NUCLEOTIDES}]+$"), "nucleotides, not amino acids"),
        )
    )


def find_problems(records: DataFrame, min_length: int = 50) -> DataFrame:
    """(path, id, problem) of records (path, ord, id, protein_label, strain, sequence): faults of sequences, and second suppliers of a pair."""
    own = records.select("path", "id", F.explode(problems_of(F.col("sequence"), min_length)).alias("problem"))
    # Written, so that a pair with many records is a plain shuffle on both sides, which adaptive execution splits.
    first = written(records.groupBy("protein_label", "strain").agg(F.min_by(F.struct("ord", "path"), F.struct("ord", "path")).alias("f")))
    pairs = records.join(first, [records[c].eqNullSafe(first[c]) for c in ("protein_label", "strain")]).select(*(records[c] for c in records.columns), F.col("f.path").alias("first"), F.col("f.ord").alias("first_ord"))
    pairs = pairs.where("ord > first_ord or (ord = first_ord and path <> first)")
    said = F.format_string("second record of (%s, %s), which %s has, in %s", F.col("protein_label"), F.col("strain"), F.col("first"), F.col("path"))
    return own.unionByName(pairs.select("path", "id", said.alias("problem")))


def must_be_empty(rows: DataFrame, what: str) -> None:
    """An error that names the first of the rows, if there are any."""
    found = rows.limit(SHOWN).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(", ".join(map(str, r)) for r in found))


def build_manifest(records: DataFrame, min_length: int = 50) -> DataFrame:
    """(accession, protein_label, protein_name, strain, length, md5, path) of records without any problem; else an error."""
    must_be_empty(find_problems(records, min_length), "records that cannot be used")
    return records.select("accession", "protein_label", "protein_name", "strain", F.length("sequence").alias("length"), F.md5(F.upper("sequence")).alias("md5"), "path")


def sink_manifest_fasta(records: DataFrame, folder: str) -> None:
    """records (protein_label, strain, accession, sequence): a folder by protein with all its strains in order, and one by protein and strain."""
    header = fs.header_of(F.col("protein_label"), F.col("strain"), F.col("accession"))
    rows = records.select("protein_label", "strain", F.concat(F.lit(">"), header, F.lit("\n"), "sequence").alias("value"))
    rows.repartition("protein_label").sortWithinPartitions("protein_label", "strain").drop("strain").write.partitionBy("protein_label").text(f"{folder}/by_protein")
    rows.repartition("protein_label", "strain").write.partitionBy("protein_label", "strain").text(f"{folder}/by_strain")


def described(records: DataFrame, min_length: int = 50, unknown_strain: str = "unknown strain", unknown_protein: str = "unknown protein") -> DataFrame:
    """(path, id, protein_label, strain, length, warnings, problems): how every record will be read, and what would stop it."""
    found = find_problems(records, min_length).groupBy("path", "id").agg(F.array_sort(F.collect_list("problem")).alias("problems"))
    warnings = F.array_compact(F.array(F.when(F.col("strain") == unknown_strain, "no strain in header or file name"), F.when(F.col("protein_name") == unknown_protein, "no protein name in header or file name")))
    rows = records.select("path", "id", "protein_label", "strain", F.length("sequence").alias("length"), warnings.alias("warnings")).join(found, ["path", "id"], "left")
    return rows.withColumn("problems", F.coalesce("problems", F.array().cast("array<string>")))


def must_match(rows: DataFrame, partners: DataFrame, on: str, what: str) -> DataFrame:
    """An inner join in which each of rows must have a partner; those that have none are an error."""
    must_be_empty(rows.join(partners, on, "left_anti").select(on).distinct().orderBy(on), what)
    return rows.join(partners, on)


def resolved(rows: DataFrame, names: DataFrame, said: str, name: str) -> DataFrame:
    """rows with the name each of their identifiers means: the same, else the only one that begins it or that it begins.

    Identifiers that mean none or several are an error.
    """
    own = names.select(F.col(name)).distinct()
    asked = rows.select(F.col(said).alias("__said")).distinct()
    exact = asked.join(own, F.col("__said") == F.col(name)).select("__said", name)
    rest = asked.join(exact, "__said", "left_anti")
    only = only_relatives(rest.select(F.col("__said").alias("said")), own.select(F.col(name).alias("name"))).select(F.col("said").alias("__said"), F.col("name").alias(name))
    found = exact.union(only)
    must_be_empty(asked.join(found, "__said", "left_anti").orderBy("__said"), "identifiers that match no name or several")
    return rows.join(found, F.col(said) == F.col("__said")).drop("__said")


def surrogates(records: DataFrame, order: str) -> DataFrame:
    """records with a short name s0, s1, ... for a tool that cuts long ones."""
    return numbered(records, [], [F.asc(order)], "__n").withColumn("surrogate", F.concat(F.lit("s"), (F.col("__n") - 1).cast("string"))).drop("__n")


def restored(scores: DataFrame, records: DataFrame) -> DataFrame:
    """A tool's rows with the records of their surrogates; a name that was not submitted is an error."""
    return must_match(scores, records, "surrogate", "names that were not submitted")


def filter_immunogenic(rows: DataFrame, scores: DataFrame, min_score: float = 0.0, enabled: bool = True) -> tuple[DataFrame, DataFrame]:
    """rows kept and dropped: class I peptides stay with a score over the limit, others always.

    scores (sequence, immunogenicity) has a row a distinct peptide; a peptide without one is an error.
    """
    if not enabled or rows.isEmpty():
        return rows, rows.limit(0)
    class_i = rows.where("epitope_class = 'MHC-I'")
    must_be_empty(class_i.join(scores, "sequence", "left_anti").select("sequence").distinct().orderBy("sequence"), "peptides without a score")
    scored = rows.join(scores.select("sequence", "immunogenicity"), "sequence", "left")
    keep = (F.col("epitope_class") != "MHC-I") | (F.col("immunogenicity") > min_score)
    return scored.where(keep), scored.where(~keep)


def filter_reference(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (ord, accession, sequence) without ambiguous residues, the first of equal ones, and (n, n_ambiguous, n_repeated, n_kept)."""
    marked = rows.withColumn("md5", F.md5(F.upper("sequence"))).withColumn("ambiguous", F.contains(F.upper("sequence"), F.lit("X")))
    kept = marked.where("not ambiguous").groupBy("md5").agg(F.min_by(F.struct("ord", "accession", "sequence"), "ord").alias("r")).select("md5", "r.*")
    n = marked.agg(F.count("*").alias("n"), F.count_if("ambiguous").alias("n_ambiguous"), F.count_distinct(F.when(~F.col("ambiguous"), F.col("md5"))).alias("n_kept"))
    return kept, n.select("n", "n_ambiguous", (F.col("n") - F.col("n_ambiguous") - F.col("n_kept")).alias("n_repeated"), "n_kept")


def members_annotated(members: DataFrame, epitopes: DataFrame) -> DataFrame:
    """members (description, sequence, ...) with source_tool, epitope_class and strains.

    A member's row is that of its id, the last of equal ids; else the first with its sequence; else its id itself says
    the tool. strains are those of all rows with the sequence. epitopes: epitope_id, sequence, source_tool,
    epitope_class, strains (one or several between bars), ord.
    """
    own = F.struct("source_tool", "epitope_class")
    by_id = epitopes.groupBy(F.col("epitope_id").alias("description")).agg(F.max_by(own, "ord").alias("by_id"))
    by_sequence = epitopes.where("sequence <> ''").groupBy("sequence").agg(F.min_by(own, "ord").alias("by_sequence"), F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set(F.split(F.coalesce("strains", F.lit("")), r"\|"))), lambda x: x != ""))).alias("strains"))
    # Many members have one description or sequence: written, so that both sides of a join are plain shuffles, whose partitions can be split.
    by_id, by_sequence = written(by_id), written(by_sequence)
    tool = F.regexp_extract(F.trim("description"), fs.EPITOPE_ID, 3)
    said = F.lit(None).cast("struct<source_tool:string,epitope_class:string>")
    for name, (_, token, kind) in TOOLS.items():
        said = F.when(tool == token, F.struct(F.lit(name).alias("source_tool"), F.lit(kind).alias("epitope_class"))).otherwise(said)
    rest = [c for c in members.columns if c not in ("source_tool", "epitope_class", "strains")]
    out = members.select(*rest).join(by_id, "description", "left").join(by_sequence, "sequence", "left").withColumn("__own", F.coalesce("by_id", "by_sequence", said))
    empty = F.lit("")
    return out.select(*rest, F.coalesce("__own.source_tool", empty).alias("source_tool"), F.coalesce("__own.epitope_class", empty).alias("epitope_class"), F.coalesce(F.array_join("strains", "|"), empty).alias("strains"))


def build_epitopes(track: DataFrame, records: DataFrame, tool: str, threshold: float, length: int, step: int, merge_gap: int, min_region: int) -> DataFrame:
    """Epitopes of a tool's score track (sequence_id, position, score) on records (header, sequence), with their identifiers.

    A track's id is resolved to a record's; a track of another length than its sequence is an error.
    """
    own = records.select(fs.record_id(F.col("header")).alias("record"), "header", F.col("sequence").alias("body"))
    ids = resolved(track.select("sequence_id").distinct(), own, "sequence_id", "record")
    known = track.join(ids, "sequence_id").select(F.col("record").alias("sequence_id"), "position", "score")
    sizes = tracks.sizes(known).join(own, F.col("sequence_id") == F.col("record"))
    must_be_empty(sizes.where(F.col("size") != F.length("body")).select("sequence_id", "size", F.length("body")), "tracks of another length than their sequence")
    found = tracks.residues_to_epitopes(known, threshold, length, step, merge_gap, min_region)
    protein, strain, accession = fs.header_parts(F.col("header"))
    rows = found.join(own, F.col("sequence_id") == F.col("record"))
    kind, token, epitope_class = TOOLS[tool]
    rows = rows.select(protein.alias("protein_label"), strain.alias("strain"), accession.alias("accession"), F.lit(tool).alias("source_tool"), F.lit(kind).alias("kind"), F.lit(token).alias("token"), F.lit(epitope_class).alias("epitope_class"), "start", F.col("stop").alias("end"), F.expr("substr(body, int(start), int(stop - start + 1))").alias("sequence"), F.col("mean_score").alias("score"))
    named = assign_ids(rows, "protein_label", "kind", "token", "sequence", "strain", "start", "accession")
    return named.select("epitope_id", "protein_label", "strain", "accession", "source_tool", "epitope_class", "start", "end", F.length("sequence").alias("length"), "sequence", "score")


def drop_failing_proteins(scored: DataFrame, drop_failing: bool = False) -> DataFrame:
    """scored (sequence_id, score, antigenic, ...) as it is: a protein below the threshold is only reported, or with drop_failing an error that names it."""
    if drop_failing:
        must_be_empty(scored.where("not antigenic").select("sequence_id", "score").orderBy("sequence_id"), "proteins below the antigenicity threshold")
    return scored


def t_cell_summary(epitopes: DataFrame) -> DataFrame:
    """(source_tool, n, n_peptides, n_alleles) of binding rows (source_tool, sequence, allele); a missing or empty allele is none."""
    return epitopes.groupBy("source_tool").agg(F.count("*").alias("n"), F.count_distinct("sequence").alias("n_peptides"), F.count_distinct(F.when(F.col("allele") != "", F.col("allele"))).alias("n_alleles"))


def allergen_reason(allergen: Column, drop_on_allergen: bool = True) -> Column:
    """A reason, or only a note where the call is advisory; null for what is no allergen."""
    return F.when(allergen, "called an allergen" if drop_on_allergen else "NOTE the allergen call is advice only")


def allele_length_grid(alleles: DataFrame, lengths: list[int]) -> DataFrame:
    """(allele, length): what a predictor is asked for, every allele at every length; a handful of lengths."""
    return alleles.crossJoin(F.broadcast(alleles.sparkSession.createDataFrame([(n,) for n in lengths], "length int")))


def coverage_input(passing: DataFrame, members: DataFrame, epitopes: DataFrame) -> DataFrame:
    """(consensus_id, sequence, alleles) of passing candidates: all alleles of the peptides of their members, without the second chain.

    Candidates without alleles are left out; if none has any, that is an error.
    """
    t_cell = epitopes.where("epitope_class in ('MHC-I', 'MHC-II')")
    allele = F.when(F.coalesce("allele", F.lit("")) != "", F.substring_index("allele", "/", 1))
    by_sequence = t_cell.groupBy("sequence").agg(F.collect_set(allele).alias("alleles"))
    by_id = t_cell.select("epitope_id", "sequence").distinct()
    own = members.select("consensus_id", "epitope_id").distinct().join(by_id, "epitope_id").join(by_sequence, "sequence")
    bags = own.groupBy("consensus_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("alleles")))).alias("alleles")).where(F.size("alleles") > 0)
    out = passing.select("consensus_id", "sequence").join(bags, "consensus_id")
    if out.isEmpty() and not passing.isEmpty():
        raise ValueError("no candidate leads back to an allele")
    return out


def population_coverage(asked: DataFrame, reports: DataFrame) -> DataFrame:
    """reports (consensus_id, population, mhc_class, coverage, average_hit, pc90) of a tool's runs, one a candidate and one for ALL, with the alleles asked for.

    A class that a report leaves out stays out: no allele of it is not a coverage of 0. Reports of candidates that were
    not asked for are an error, and so are candidates without a report.
    """
    every = asked.select(F.explode("alleles").alias("a")).agg(F.array_sort(F.collect_set("a")).alias("alleles")).select(F.lit("ALL").alias("consensus_id"), "alleles")
    sent = asked.select("consensus_id", "alleles").unionByName(every)
    must_be_empty(sent.join(reports, "consensus_id", "left_anti").select("consensus_id").orderBy("consensus_id"), "candidates without a report")
    rows = must_match(reports, sent, "consensus_id", "reports of unknown candidates")
    return rows.select("consensus_id", "population", "mhc_class", "coverage", "average_hit", "pc90", F.size("alleles").cast("long").alias("n_alleles"), F.array_join("alleles", "|").alias("alleles"))
