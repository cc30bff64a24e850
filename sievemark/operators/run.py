"""One protein from its records and the tools' tables to a ranked list of candidates.

Predictors are plug-ins: their outputs are tables (see sources.tools) or a ScoreProvider.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs
from sievemark.operators import clustering, matching, records
from sievemark.operators.graph import written
from sievemark.operators.identifiers import assign_ids, numbered
from sievemark.operators.providers import ResidueProvider, ScoreProvider, provider, residue_provider  # noqa: F401
from sievemark.sources import tools

@dataclass(frozen=True)
class Settings:
    """How a run decides; what is to be measured by which threshold is the user's to say."""

    track_thresholds: dict[str, float]
    length: int
    step: int = 1
    merge_gap: int = 0
    min_region: int = 1
    sweep: str = "90:50"
    least: dict[str, int] = field(default_factory=lambda: {"min_mhc_i": 1, "min_mhc_ii": 1, "min_bepipred": 1, "min_epidope": 1})
    both_bcell_tools: bool = True
    min_strains: int = 0
    antigenicity: float = 0.5
    drop_failing_proteins: bool = False
    immunogenicity: float = 0.0
    exact_length: int = 9
    allergen_identity: float = 35.0
    drop_on_allergen: bool = False
    conservancy: float = 1.0


def t_cell_epitopes(binding: DataFrame, manifest: DataFrame, tool: str) -> DataFrame:
    """Epitopes of binding rows; seq_num counts the records of manifest (ord, protein_label, strain, accession), and must be one of them."""
    kind, token, epitope_class = records.TOOLS[tool]
    rows = records.must_match(binding, manifest.withColumnRenamed("ord", "seq_num"), "seq_num", "binding rows of no submitted record")
    rows = rows.select("protein_label", "strain", "accession", F.lit(tool).alias("source_tool"), F.lit(kind).alias("kind"), F.lit(token).alias("token"), F.lit(epitope_class).alias("epitope_class"), "start", "end", F.col("peptide").alias("sequence"), "score", "allele")
    named = assign_ids(rows, "protein_label", "kind", "token", "sequence", "strain", "start", "allele")
    return named.drop("kind", "token").withColumn("length", F.length("sequence"))


def candidates(epitopes: DataFrame, protein: str, how: Settings) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clusters with their verdicts, pooled candidates, kept members) of epitopes (epitope_id, sequence, source_tool, epitope_class, strain, ...)."""
    ordered = numbered(epitopes.select("epitope_id", "sequence", "source_tool", "epitope_class", F.col("strain").alias("strains")), [], [F.asc("epitope_id")], "ord")
    ordered = written(ordered)
    unique = ordered.groupBy("sequence").agg(F.min("ord").alias("ord"), F.min_by("epitope_id", "ord").alias("description"))
    members = written(clustering.clusters(unique.select("ord", "sequence"), fs.threshold_sweep(how.sweep)).join(unique.select("ord", "description"), "ord"))
    text, aligned = clustering.consensus(members.select("threshold", "cluster", "ord", "sequence"), ["threshold", "cluster"])
    text = written(text)
    clear = text.where("not contains(consensus, 'X')")
    kept = clustering.pruned(aligned.join(clear, ["threshold", "cluster"])).join(unique.select("ord", "description"), "ord")
    kept = written(records.members_annotated(kept, ordered))
    of = lambda tool: F.count_if(F.col("source_tool") == tool).alias(f"n_{tool}")
    strains = F.size(F.array_distinct(F.flatten(F.collect_set(F.filter(F.split("strains", r"\|"), lambda x: x != ""))))).cast("long").alias("n_strains")
    counts = kept.groupBy("threshold", "cluster").agg(*(of(t) for t in records.TOOLS), strains, F.count_if(F.col("source_tool") == "").alias("n_unresolved"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    names = [*(f"n_{t}" for t in records.TOOLS), "n_strains", "n_unresolved"]
    full = clear.join(counts, ["threshold", "cluster"], "left").select("threshold", "cluster", "consensus", *(zero(c) for c in names))
    ruled = clustering.evaluate_rule(full, both_bcell_tools=how.both_bcell_tools, min_strains=how.min_strains, **how.least)
    ruled = written(ruled.withColumn("consensus_id", F.format_string(f"{protein}_Consensus_%d_%d", F.col("threshold"), F.col("cluster"))))
    pooled = clustering.pool_passing(ruled).join(ruled.select("threshold", "cluster", "consensus_id", *names), ["threshold", "cluster"])
    pooled = written(pooled.select("consensus_id", F.col("consensus").alias("sequence"), "threshold", "cluster", "n_duplicates", *names))
    own = kept.join(pooled.select("consensus_id", "threshold", "cluster"), ["threshold", "cluster"]).select("consensus_id", F.col("description").alias("epitope_id"), "sequence", "source_tool", "epitope_class", "strains")
    return ruled, pooled, own


def screening(pooled: DataFrame, members: DataFrame, how: Settings, antigenicity: ScoreProvider | None = None, allergens: DataFrame | None = None, allergen_set: DataFrame | None = None, proteome: DataFrame | None = None) -> DataFrame:
    """pooled with what every screen says, reason, and passes: no reason but notes.

    allergens (consensus_id, score, allergen) is a tool's table, allergen_set (ref_id, ref_ord, text) and proteome
    (ref_id, text) are references; a screen without its table does not take part.
    """
    asked = pooled.select(F.col("consensus_id").alias("sequence_id"), "sequence")
    scored = matching.screen_antigenicity(asked, how.antigenicity, antigenicity(asked) if antigenicity else None)
    out = pooled.join(scored.select(F.col("sequence_id").alias("consensus_id"), F.col("score").alias("antigenicity_score"), "antigenic", "note"), "consensus_id")
    reasons = [F.nullif(F.col("note"), F.lit(""))]
    if allergens is None:
        out = out.withColumn("allergen_score", F.lit(None).cast("double")).withColumn("allergen", F.lit(False))
    else:
        out = records.must_match(out, allergens.select("consensus_id", F.col("score").alias("allergen_score"), "allergen"), "consensus_id", "candidates without an allergenicity")
        reasons.append(records.allergen_reason(F.col("allergen"), how.drop_on_allergen))
    query = pooled.select(F.col("consensus_id").alias("query_id"), "sequence")
    if allergen_set is not None:
        own = members.select(F.col("consensus_id").alias("query_id"), F.col("epitope_id").alias("member_id"), "sequence")
        homology = matching.allergen_homology(query, own, allergen_set, how.exact_length, how.allergen_identity)
        out = out.join(homology.select(F.col("query_id").alias("consensus_id"), "n_exact", "exact_matches", F.col("percent").alias("allergen_percent"), "exact_risk", "identity_risk", "homology_risk"), "consensus_id")
        reasons.append(F.when(F.col("exact_risk"), F.format_string(f"%d member(s) share an exact {how.exact_length}-mer with an allergen", F.col("n_exact"))))
        reasons.append(F.when(F.col("identity_risk"), F.format_string("NOTE %.1f%% identical to an allergen", F.col("allergen_percent"))))
    if proteome is not None:
        hits = matching.screened(query, proteome, how.exact_length)
        out = out.join(hits.select(F.col("query_id").alias("consensus_id"), "n_matches", F.array_join(F.slice("matches", 1, 20), ";").alias("matches"), "n_skipped"), "consensus_id")
        reasons += matching.autoimmunity_reasons(F.col("n_matches"), F.col("n_skipped"), how.exact_length)
    why = F.array_compact(F.array(*reasons))
    passes = F.size(F.filter(why, lambda r: ~F.startswith(r, F.lit("NOTE ")))) == 0
    return out.withColumn("passes", passes).withColumn("reason", F.array_join(why, "; ")).drop("note")


def attrition(protein: str, epitopes: DataFrame, clusters: DataFrame, screened: DataFrame, final: DataFrame) -> DataFrame:
    """(protein, n_strains, n_b_cell, n_t_cell, n_clusters, n_passing, n_screened, n_final): what each stage left of a protein, a row."""
    kind = F.when(F.col("epitope_class") == "B", "b").otherwise("t")
    found = epitopes.agg(F.count_distinct("strain").alias("n_strains"), *(F.count_distinct(F.when(kind == k, F.col("sequence"))).alias(f"n_{k}_cell") for k in ("b", "t")))
    counts = [clusters.agg(F.count("*").alias("n_clusters"), F.count_if("passes").alias("n_passing")), screened.agg(F.count_if("passes").alias("n_screened")), final.agg(F.count("*").alias("n_final"))]
    for one in counts:  # of a row each
        found = found.crossJoin(one)
    return found.select(F.lit(protein).alias("protein"), "*")


def candidate_run(
    rows: DataFrame, tracks_of: dict[str, DataFrame | ResidueProvider], binding_of: dict[str, DataFrame], how: Settings, rank_by: str = "conservancy_percent", protein_scores: ScoreProvider | None = None,
    immunogenicity: DataFrame | None = None, reference: DataFrame | None = None, coverage: Callable[[DataFrame], DataFrame] | None = None, report: str | None = None, **screens,
) -> dict[str, DataFrame]:
    """All stages over the records of one protein: manifest, antigenicity, epitopes, clusters, members, screening, conservancy, coverage, final and attrition.

    rows (path, ord, id, accession, protein_label, protein_name, strain, sequence) with ord from 1; tracks_of by tool
    (sequence_id, position, score), whose ids are the headers Protein|Strain|Accession, or a provider of residues'
    scores; binding_of by tool as scan_binding gives it. protein_scores scores the records themselves, else the
    built-in scale does. immunogenicity (sequence, immunogenicity) has every class I peptide; of these only those over the limit
    stay. reference (strain, ord, accession, text) takes the records' place in conservation. coverage gives the
    reports of (consensus_id, sequence, alleles) as population_coverage takes them. report: where to write the summary.
    Every stage that a later one reads twice is written.
    """
    manifest = records.build_manifest(rows, how.length)
    proteins = [r[0] for r in rows.select("protein_label").distinct().limit(2).collect()]
    if len(proteins) != 1:
        raise ValueError(f"a run takes the records of one protein, not of {proteins}")
    protein = proteins[0]
    header = fs.header_of(F.col("protein_label"), F.col("strain"), F.col("accession")).alias("header")
    submitted = rows.select(header, "sequence")
    asked = submitted.select(F.col("header").alias("sequence_id"), "sequence")
    scored = matching.screen_antigenicity(asked, how.antigenicity, protein_scores(asked) if protein_scores else None)
    antigenicity = written(records.drop_failing_proteins(scored, how.drop_failing_proteins))
    found = None
    for tool, track in tracks_of.items():
        track = track(asked) if callable(track) else track
        own = records.build_epitopes(track, submitted, tool, how.track_thresholds[tool], how.length, how.step, how.merge_gap, how.min_region).withColumn("allele", F.lit(""))
        found = own if found is None else found.unionByName(own)
    for tool, binding in binding_of.items():
        own = t_cell_epitopes(binding, rows.select("ord", "protein_label", "strain", "accession"), tool).select("epitope_id", "protein_label", "strain", "accession", "source_tool", "epitope_class", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "length", "sequence", "score", "allele")
        found = own if found is None else found.unionByName(own)
    dropped = None
    if immunogenicity is not None:
        kept, dropped = records.filter_immunogenic(written(found), immunogenicity, how.immunogenicity)
        found, dropped = kept.drop("immunogenicity"), dropped
    epitopes = written(found)
    clusters, pooled, members = candidates(epitopes, protein, how)
    screened = written(screening(pooled, members, how, **screens))
    passing = screened.where("passes")
    targets = rows.select("strain", "ord", "accession", F.col("sequence").alias("text"))
    conserved = written(matching.conservancy_run(passing.select(F.col("consensus_id").alias("query_id"), "sequence"), targets, how.conservancy, reference))
    percent = (F.col("fraction") * 100).alias("percent")
    least = conserved.select("query_id", "strain", percent).groupBy(F.col("query_id").alias("consensus_id")).agg(F.min("percent").alias("conservancy_percent"), F.array_join(F.array_sort(F.collect_list(F.concat("strain", F.lit(":"), fs.number_text(F.round("percent", 2)), F.lit("%")))), "|").alias("conservancy_per_strain"))
    full = passing.join(least, "consensus_id", "left").withColumn("protein_label", F.lit(protein)).withColumn("length", F.length("sequence"))
    covered = set_coverage = None
    if coverage is None:
        full = full.withColumn("world_coverage_percent", F.lit(None).cast("double"))
    else:
        own = written(records.coverage_input(passing, members, epitopes))
        covered = written(records.population_coverage(own, coverage(own)))
        world = covered.where("population = 'World' and mhc_class = 'combined'").select("consensus_id", F.col("coverage").alias("world_coverage_percent"))
        full = full.join(world, "consensus_id", "left")
        set_coverage = world.where("consensus_id = 'ALL'").select(F.lit(protein).alias("protein_label"), F.col("world_coverage_percent").alias("coverage"))
    final = written(numbered(full, [], [F.desc_nulls_last(rank_by), F.asc("consensus_id")], "rank"))
    left = attrition(protein, epitopes, clusters, screened, final)
    if report:
        tools.final_report(rows.sparkSession, final, left, report, set_coverage)
    out = {"manifest": manifest, "antigenicity": antigenicity, "epitopes": epitopes, "not_immunogenic": dropped, "clusters": clusters, "members": members, "screening": screened, "conservancy": conserved, "coverage": covered, "final": final, "attrition": left}
    return {name: table for name, table in out.items() if table is not None}
