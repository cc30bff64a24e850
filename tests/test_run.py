import pytest
from pyspark.sql import functions as F

from sievemark.operators import run

BODY = "MKLVDERWYTQQNACDEFGHIKLMNPWWSTVREEKKLDAMNQRSTVW"
SCHEMA = "path string, ord int, id string, accession string, protein_label string, protein_name string, strain string, sequence string"


@pytest.fixture(scope="module")
def records(spark):
    other = BODY.replace("QQNACD", "QQNACD").replace("LDAMN", "LDSMN")
    return spark.createDataFrame([("a.fa", 1, "A1", "A1", "Spike", "spike", "Zaire_x", BODY), ("b.fa", 2, "B1", "B1", "Spike", "spike", "Sudan_x", other)], SCHEMA)


def track(spark, start, stop):
    rows = [(f"Spike|{s}|{a}", i + 1, 0.9 if start <= i + 1 <= stop else 0.1) for s, a in (("Zaire_x", "A1"), ("Sudan_x", "B1")) for i in range(len(BODY))]
    return spark.createDataFrame(rows, "sequence_id string, position long, score double")


def binding(spark, *peptides):
    rows = [("HLA-1", p, BODY.index(p) + 1, BODY.index(p) + len(p), n, "", 0.5, 0.9) for p in peptides for n in (1, 2)]
    return spark.createDataFrame(rows, "allele string, peptide string, start int, end int, seq_num int, sequence_id string, percentile double, score double")


def test_from_records_to_ranks(spark, records):
    how = run.Settings({"bepipred": 0.5, "epidope": 0.5}, length=12, sweep="80:60", antigenicity=0.0)
    piece = "ACDEFGHIKLMNP"
    at = BODY.index(piece) + 1
    out = run.candidate_run(records, {"bepipred": track(spark, at, at + 11), "epidope": track(spark, at + 1, at + 12)}, {"mhc_i": binding(spark, piece[2:11]), "mhc_ii": binding(spark, piece)}, how)
    epitopes = {r.epitope_id: r.sequence for r in out["epitopes"].collect()}
    assert epitopes["Spike_B_cell_BepiPred_1.1"] == piece[:12] and epitopes["Spike_B_cell_EpiDope_1.2"] == piece[1:] and epitopes["Spike_T_cell_MHCII_1.1"] == piece
    final = out["final"].collect()
    assert [(r.rank, r.sequence, r.conservancy_percent, r.conservancy_per_strain) for r in final] == [(1, piece, 100.0, "Sudan_x:100%|Zaire_x:100%")]
    assert final[0].consensus_id.startswith("Spike_Consensus_80_") and (final[0].n_mhc_i, final[0].n_epidope, final[0].n_strains, final[0].n_unresolved) == (1, 1, 2, 0)
    assert out["manifest"].count() == 2 and out["clusters"].where("passes").count() >= 1
    # A part that stands in the proteome fails the candidate; a predictor of one's own decides on antigenicity.
    proteome = spark.createDataFrame([("human", f"WW{piece[2:11]}WW")], "ref_id string, text string")
    screened = run.screening(out["final"].select("consensus_id", "sequence"), out["members"], how, proteome=proteome, antigenicity=run.provider(lambda xs: [float(len(x)) for x in xs])).first()
    assert not screened.passes and screened.n_matches == 1 and screened.antigenicity_score == len(piece) and "9-mer" in screened.reason
    called = spark.createDataFrame([(final[0].consensus_id, 0.9, True)], "consensus_id string, score double, allergen boolean")
    advisory = run.screening(out["final"].select("consensus_id", "sequence"), out["members"], how, allergens=called).first()
    assert advisory.passes and advisory.reason.startswith("NOTE the allergen call")


def test_a_run_refuses_what_does_not_fit(spark, records):
    how = run.Settings({"bepipred": 0.5}, length=12)
    two = records.withColumn("protein_label", F.when(F.col("ord") == 1, "N").otherwise("Spike"))
    with pytest.raises(ValueError, match="one protein"):
        run.candidate_run(two, {}, {}, how)
    stranger = binding(spark, BODY[:9]).withColumn("seq_num", F.lit(7))
    with pytest.raises(ValueError, match="no submitted record"):
        run.candidate_run(records, {}, {"mhc_i": stranger}, how)


def test_every_stage_with_plug_ins(spark, records, tmp_path):
    """Residues predicted by a table function, weak class I peptides dropped, coverage by a tool, and a report."""
    how = run.Settings({"bepipred": 0.5, "epidope": 0.5}, length=12, sweep="80:60", antigenicity=0.0, immunogenicity=0.1)
    piece = "ACDEFGHIKLMNP"
    at = BODY.index(piece)
    of = lambda a, b: run.residue_provider(lambda s: [0.9 if a <= i < b else 0.1 for i in range(len(s))])
    weak = BODY[2:11]
    scores = spark.createDataFrame([(piece[2:11], 0.5), (weak, 0.05)], "sequence string, immunogenicity double")

    def coverage(asked):
        own = asked.select("consensus_id").union(asked.limit(1).select(F.lit("ALL")))
        return own.select("consensus_id", F.lit("World").alias("population"), F.lit("combined").alias("mhc_class"), F.when(F.col("consensus_id") == "ALL", 91.5).otherwise(45.25).alias("coverage"), F.lit(1.0).alias("average_hit"), F.lit(2.0).alias("pc90"))

    path = str(tmp_path / "report.md")
    out = run.candidate_run(records, {"bepipred": of(at, at + 12), "epidope": of(at + 1, at + 13)}, {"mhc_i": binding(spark, piece[2:11], weak), "mhc_ii": binding(spark, piece)}, how, immunogenicity=scores, coverage=coverage, report=path, protein_scores=run.provider(lambda xs: [0.7] * len(xs)))
    assert {r.sequence for r in out["not_immunogenic"].collect()} == {weak} and weak not in {r.sequence for r in out["epitopes"].collect()}
    assert [(r.score, r.antigenic) for r in out["antigenicity"].collect()] == [(0.7, True)] * 2
    final = out["final"].collect()
    assert [(r.rank, r.sequence, r.world_coverage_percent) for r in final] == [(1, piece, 45.25)]
    left = out["attrition"].first()
    assert (left.protein, left.n_strains, left.n_b_cell, left.n_t_cell, left.n_final) == ("Spike", 2, 2, 2, 1)
    said = open(path).read()
    assert f"| 1 | {final[0].consensus_id} | Spike | {piece} |" in said and "45.25% |" in said and "- **Spike**: 91.5%" in said and "| Spike | 2 | 2 | 2 |" in said
    failing = run.Settings({}, length=12, antigenicity=0.8, drop_failing_proteins=True)
    with pytest.raises(ValueError, match="below the antigenicity"):
        run.candidate_run(records, {}, {}, failing, protein_scores=run.provider(lambda xs: [0.7] * len(xs)))
