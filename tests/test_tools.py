import pytest
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs
from sievemark.operators import matching, records
from sievemark.operators import clustering as cl
from sievemark.sources import files, tools


def put(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


MHC_I = "allele\tseq_num\tstart\tend\tlength\tpeptide\tcore\ticore\tscore\trank\n"
MHC_II = "allele\tseq_num\tstart\tend\tlength\tcore_peptide\tpeptide\tic50\tpercentile_rank\tadjusted_rank\n"


def test_binding(spark, tmp_path):
    one = put(tmp_path, "i.tsv", MHC_I + "A1\t1\t3\t11\t9\tacdefghik\tx\tx\t0.5\t2.0\nA2\t2\t\t\t9\tKKKKKKKKK\tx\tx\t\t0.1\nA2\t2\t5\t\t9\tLLLLLLLLL\tx\tx\t\t2.01\n")
    ids = spark.createDataFrame([(1, "first")], "seq_num int, sequence_id string")
    got = rows(tools.scan_binding(spark, one, 2.0, ids), "allele", "peptide", "start", "end", "sequence_id", "percentile", "score")
    assert got == [("A1", "ACDEFGHIK", 3, 11, "first", 2.0, 0.5), ("A2", "KKKKKKKKK", 0, 0, "", 0.1, 0.1)]
    two = put(tmp_path, "ii.tsv", MHC_II + "D\t1\t4\t\t15\tCORE\tPEPTIDE\t0.00\t1.5\t9\n")
    assert rows(tools.scan_binding(spark, two, 2.0), "peptide", "start", "end", "percentile", "score") == [("PEPTIDE", 4, 10, 1.5, 0.0)]
    assert tools.scan_binding(spark, put(tmp_path, "none.tsv", MHC_I), 2.0).count() == 0
    for text in ("ImportError: cannot import name 'files'\n", "", "peptide\tscore\nA\t1\n"):
        with pytest.raises(ValueError, match="no binding table"):
            tools.scan_binding(spark, put(tmp_path, "bad.tsv", text), 2.0)
    with pytest.raises(Exception, match="no number for percentile"):
        tools.scan_binding(spark, put(tmp_path, "word.tsv", MHC_I + "A\t1\t1\t9\t9\tAAAAAAAAA\tx\tx\t1\tweak\n"), 2.0).collect()


def test_immunogenicity(spark, tmp_path):
    path = put(tmp_path, "im.tsv", "masking: default\nmasked variables: [1, 2, 9]\n\npeptide,length,score\nAAAAAAAAA,9,0.12345\nCCCCCCCCC,9,-0.54321\n")
    asked = spark.createDataFrame([("aaaaaaaaa",), (" CCCCCCCCC",), ("",)], "peptide string")
    assert rows(tools.scan_immunogenicity(spark, path, asked), "peptide", "score") == [("AAAAAAAAA", 0.12345), ("CCCCCCCCC", -0.54321)]
    with pytest.raises(ValueError, match="DDDDDDDDD"):
        tools.scan_immunogenicity(spark, path, spark.createDataFrame([("DDDDDDDDD",)], "peptide string"))
    # The word alone in a sentence is no header: it has to be a field.
    with pytest.raises(ValueError, match="no header"):
        tools.scan_immunogenicity(spark, put(tmp_path, "m.tsv", "the peptide list was empty, sorry\n"), asked)


def test_delimited_files_of_different_layout(spark, tmp_path):
    put(tmp_path, "a.csv", "﻿id,score\n\"x, y\",1\n,\n\nz,2,surplus\n")
    put(tmp_path, "b.csv", "id;score;more\nw;3\n")
    got = files.scan_delimited(spark, str(tmp_path))
    assert rows(got.fillna("-"), "id", "score", "more") == [("w", "3", "-"), ("x, y", "1", "-"), ("z", "2", "-")]


def test_antigenicity_and_allergenicity(spark, tmp_path):
    path = put(tmp_path, "a.csv", "Header,Sequence_Length,Intrinsic_Antigenicity_Score,Antigenicity_Category\n>x tail,9,0.69,High\ny,9,Sequence too short,Low\nx,9,-0.42,Low\n")
    assert {r.sequence_id: r.score for r in tools.scan_antigenicity(spark, path).collect()} == {"x": -0.42, "y": None}
    with pytest.raises(Exception, match="no number"):
        tools.scan_antigenicity(spark, put(tmp_path, "b.csv", "Header,Intrinsic_Antigenicity_Score\nx,High\n")).collect()
    with pytest.raises(ValueError):
        files.resolve_column(["Header", "Length"], tools.ANTIGENICITY_SCORE, "score")
    path = put(tmp_path, "g.csv", "Subject,ML Score,MERCI Score,BLAST Score,Hybrid Score,Prediction\n>x,0.9,0,0,0.1,Non-Allergen\ny,0.1,0,0,0.5,Allergen\nz,0,0,0,0.3,\n")
    asked = spark.createDataFrame([("x",), ("y",), ("z",)], "sequence_id string")
    assert rows(tools.scan_allergenicity(spark, path, asked), "sequence_id", "score", "allergen") == [("x", 0.1, False), ("y", 0.5, True), ("z", 0.3, True)]
    with pytest.raises(ValueError, match="missing"):
        tools.scan_allergenicity(spark, path, spark.createDataFrame([("missing",)], "sequence_id string"))


def test_residue_tables(spark, tmp_path):
    path = put(tmp_path, "raw.csv", "Accession,Residue,BepiPred-3.0 score,BepiPred-3.0 linear epitope score\np|q,M,0.5, 0.4\np|q,K,0.25, 0.4\nr,A,1, 0\n")
    assert rows(tools.scan_bepipred(spark, path), "sequence_id", "position", "score") == [("p|q", 1, 0.5), ("p|q", 2, 0.25), ("r", 1, 1.0)]
    path = put(tmp_path, "e.csv", "position/header\taminoacid\tscore\n>Spike|A b\n2\tV\t0.5\n1\tM\t0.25\n\n>N\n1,M,0.75\n")
    assert rows(tools.scan_epidope(spark, path), "sequence_id", "position", "score") == [("N", 1, 0.75), ("Spike|A", 1, 0.25), ("Spike|A", 2, 0.5)]
    flat = put(tmp_path, "f.csv", "#Header\tposition\tscore\nS\t2\t0.5\nS\t1\t0.25\n")
    assert rows(tools.scan_epidope(spark, flat), "sequence_id", "position", "score") == [("S", 1, 0.25), ("S", 2, 0.5)]
    with pytest.raises(Exception, match="before any"):
        tools.scan_epidope(spark, put(tmp_path, "g.csv", "1\tM\t0.5\n>S\n1\tM\t0.5\n")).collect()


def test_population_report(spark, tmp_path):
    text = "class I\npopulation/area\tcoverage\taverage_hit\tpc90\nWorld\t11.53%\t0.12\t0.11\nEast Africa\t5%\naverage\t1\t1\t1\n\npopulation/area\thit\tpercent\tcumulative_coverage\nWorld\t0\t53.77\t100\n\nclass combined\npopulation/area   coverage   average_hit   pc90\nNorth America   74.19%   1.1   x\n"
    got = tools.files.scan_population_report(spark, put(tmp_path, "r.txt", text)).collect()
    assert sorted(tuple(r) for r in got)[0] == ("East Africa", "I", 5.0, None, None)
    assert {(r.population, r.mhc_class): (r.coverage, r.average_hit, r.pc90) for r in got} == {("World", "I"): (11.53, 0.12, 0.11), ("East Africa", "I"): (5.0, None, None), ("North America", "combined"): (74.19, 1.1, None)}
    with pytest.raises(ValueError, match="no population rows"):
        files.scan_population_report(spark, put(tmp_path, "n.txt", "usage: tool\n"))


def test_cluster_table(spark, tmp_path):
    text = "Cluster.Sub-Cluster Number,Peptide Number,Alignment,Position,Description,Peptide\n1.1,Consensus,ACDX,-,-,-\n1.1,1,ACD-,1,a,ACD\n1.1,2,-CDE,2,b,CDE\n2.1,1,KLM,1,c,KLM\n3.1,Consensus,WWW,-,-,-\n"
    got = tools.scan_cluster_csv(spark, put(tmp_path, "c.csv", text)).orderBy("cluster_ord", "member_ord").collect()
    assert [(r.cluster_ord, r.cluster_id, r.consensus, r.member_index, r.sequence) for r in got] == [(1, "1.1", "ACDX", "1", "ACD"), (1, "1.1", "ACDX", "2", "CDE"), (2, "2.1", "KLM", "1", "KLM"), (3, "3.1", "WWW", None, None)]
    tools.sink_clusters_csv(tools.scan_cluster_csv(spark, put(tmp_path, "t.csv", text.replace(",", "\t"))), str(tmp_path / "out"))
    again = tools.scan_cluster_csv(spark, str(tmp_path / "out")).orderBy("cluster_id", "member_ord").collect()
    assert [(r.cluster_id, r.consensus, r.sequence) for r in again] == [("1.1", "ACDX", "ACD"), ("1.1", "ACDX", "CDE"), ("2.1", "KLM", "KLM"), ("3.1", "WWW", None)]


def test_fasta_of_many_blocks(spark, tmp_path):
    put(tmp_path, "b.FA", "noise\n" + "".join(f">r{i} x\nac{'d' * (i % 7)}-\n*\n" for i in range(300)))
    put(tmp_path, "a.fasta", "﻿>first\nAA\n  >second\nCC\n")
    put(tmp_path, "z.txt", ">no\nAA\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500b")
    try:
        got = files.scan_input_dir(spark, str(tmp_path)).orderBy("input_ord").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.input_ord for r in got] == list(range(1, 303))
    assert [(r.file, r.ord, r.header, r.sequence) for r in got[:3]] == [("a.fasta", 1, "first", "AA"), ("a.fasta", 2, "second", "CC"), ("b.FA", 1, "r0 x", "AC")]
    assert [r.header for r in got[2:]] == [f"r{i} x" for i in range(300)]


def test_problems_and_manifest(spark):
    def said(sequence, least=4):
        return spark.createDataFrame([(sequence,)], "s string").select(records.problems_of(F.col("s"), least)).first()[0]

    assert said("") == ["0 residues, fewer than 4", "empty sequence"]
    assert said("AC9?9") == ["not amino acids: 9?"]
    assert said("ACGT") == ["nucleotides, not amino acids"] and said("MKLV") == []
    one = [("a.fasta", 1, "x", "X1", "Spike", "spike", "Zaire", "MKLVMKLV"), ("b.fasta", 2, "y", "Y1", "Spike", "spike", "Sudan", "MKLVMKLW")]
    schema = "path string, ord int, id string, accession string, protein_label string, protein_name string, strain string, sequence string"
    manifest = records.build_manifest(spark.createDataFrame(one, schema), 4)
    assert rows(manifest, "accession", "length") == [("X1", 8), ("Y1", 8)]
    twice = spark.createDataFrame([*one, ("c.fasta", 3, "z", "Z1", "Spike", "spike", "Zaire", "MKLVMKLV")], schema)
    with pytest.raises(ValueError, match="a.fasta has"):
        records.build_manifest(twice, 4)


def test_rows_that_must_match(spark):
    left, right = spark.createDataFrame([(1,), (6,)], "n int"), spark.createDataFrame([(1, "a")], "n int, name string")
    with pytest.raises(ValueError, match="nobody: 6"):
        records.must_match(left, right, "n", "nobody")
    names = spark.createDataFrame([("Spike|Zaire|1",), ("Spike|Zaire|12",), ("N|Sudan|3",)], "name string")
    ask = lambda x: rows(records.resolved(spark.createDataFrame([(x,)], "said string"), names, "said", "name"), "name")
    assert ask("N|Su") == [("N|Sudan|3",)] and ask("N|Sudan|3 tail") == [("N|Sudan|3",)] and ask("Spike|Zaire|1") == [("Spike|Zaire|1",)]
    for bad in ("Spike|Z", "other", "Spike|Zaire|12x"):
        with pytest.raises(ValueError, match="no name or several"):
            ask(bad)


def test_members(spark):
    epitopes = spark.createDataFrame([("a", "ACD", "bepipred", "B", "Zaire", 1), ("a", "ACD", "epidope", "B", "Sudan|Zaire", 2), ("b", "ACD", "mhc_i", "MHC-I", "Reston", 3)], "epitope_id string, sequence string, source_tool string, epitope_class string, strains string, ord int")
    members = spark.createDataFrame([("a", "ACD"), ("cut", "ACD"), ("N_T_cell_MHCII_3.1", "ZZZ"), ("?", "ZZZ")], "description string, sequence string")
    got = {r.description: (r.source_tool, r.epitope_class, r.strains) for r in records.members_annotated(members, epitopes).collect()}
    assert got == {"a": ("epidope", "B", "Reston|Sudan|Zaire"), "cut": ("bepipred", "B", "Reston|Sudan|Zaire"), "N_T_cell_MHCII_3.1": ("mhc_ii", "MHC-II", ""), "?": ("", "", "")}


def test_exact_windows(spark):
    reference = spark.createDataFrame([("one", "MKWVTQQQQ"), ("two", "qqqqqyndyle"), ("three", "WWACDEFWW"), ("four", "ACDEFACDEF"), ("five", "FISALLLFS")], "ref_id string, text string")
    find = lambda q, k: rows(matching.exact_hits(spark.createDataFrame([("q", q)], "query_id string, sequence string"), reference, k), "window", "ref_id", "offset")
    assert find("QYNDYLE", 7) == [("QYNDYLE", "two", 4)]
    assert find("acdef", 5) == [("ACDEF", "four", 0), ("ACDEF", "four", 5), ("ACDEF", "three", 2)]
    assert find("MKWVT", 9) == [("MKWVT", "one", 0)] and find("QQQQMK", 6) == []
    for k in (1, 2, 3, 4, 5, 6):
        for q in ("ACDEFACD", "QQQQQYN", "WW", "LLLFS"):
            wanted = {q[i : i + k] for i in range(len(q) - k + 1)} if len(q) >= k else {q}
            expected = sorted((w, i, a) for w in wanted for i, t in [(r.ref_id, r.text.upper()) for r in reference.collect()] for a in range(len(t)) if t.startswith(w, a))
            assert find(q, k) == expected, (q, k)
    asked = spark.createDataFrame([("x", "FISXLLLFS"), ("y", "QYNDYLE")], "query_id string, sequence string")
    assert rows(matching.screened(asked, reference, 7), "query_id", "n_matches", "matches", "n_skipped") == [("x", 0, [], 3), ("y", 1, ["QYNDYLE@two:5"], 0)]


def test_long_repeats_stay_cheap(spark):
    reference = spark.createDataFrame([("r", "A" * 20_000)], "ref_id string, text string")
    hits = matching.exact_hits(spark.createDataFrame([("q", "A" * 3000)], "query_id string, sequence string"), reference, 50)
    assert hits.count() == 20_000 - 49


def test_rule_switches(spark):
    counts = spark.createDataFrame([(1, 1, 1, 1, 3, 0, "ACxD")], "n_mhc_i int, n_mhc_ii int, n_bepipred int, n_epidope int, n_strains int, n_unresolved int, consensus string")
    assert cl.evaluate_rule(counts).first().reason == "consensus contains X"
    assert cl.evaluate_rule(counts, reject_ambiguous=False).first().passes


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "x string").select(fs.as_float(F.col("x")).alias("nan"), fs.as_float(F.col("x"), -1.0).alias("low"))
    got = df.collect()
    assert [r.low for r in got] == [1.5, -1.0, -1.0] and got[0].nan == 1.5 and got[1].nan != got[1].nan
    assert spark.range(1).select(fs.number_text(F.lit(None).cast("double")).alias("x")).first().x is None
    with pytest.raises(Exception, match="no number for it: abc"):
        spark.range(1).select(files.to_float(F.lit("abc"), "it")).collect()


def test_reports(spark, tmp_path):
    final = spark.createDataFrame([(1, "P_Consensus_60_1.1", "P", "ACD", 3, 0.5, 66.67, "A:66.67%|B:100%", 12.5, True)], "rank int, consensus_id string, protein_label string, sequence string, length int, antigenicity_score double, conservancy_percent double, conservancy_per_strain string, world_coverage_percent double, allergen boolean")
    attrition = spark.createDataFrame([("P", 2, 1)], "protein string, strains int, final_candidates int")
    tools.final_report(spark, final, attrition, str(tmp_path / "r"), spark.createDataFrame([("P", 80.0)], "protein_label string, coverage double"))
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "r")).collect())
    assert "left after all stages: **1**" in text and "Called allergens" in text and "66.67%" in text and "A:66.67%\\|B:100%" in text and "- **P**: 80%" in text
    tools.final_report(spark, final.limit(0), attrition, str(tmp_path / "e"))
    assert "No candidate is left" in "\n".join(r.value for r in spark.read.text(str(tmp_path / "e")).collect())


def test_markdown_of_a_large_table(spark, tmp_path, monkeypatch):
    """Tasks write the lines; none of the table is collected. The query's table is one that grows."""
    from sievemark.plans import catalog, q_tools  # noqa: F401

    monkeypatch.setattr(tools, "markdown_table", lambda df: pytest.fail("collected"))
    rows = spark.range(5000).select((4999 - F.col("id")).alias("n"), F.lit("a|b").alias("name"), (F.col("id") * 0.5).alias("share")).repartition(6)
    tools.sink_markdown_table(rows, ["n"], str(tmp_path / "t"), "Title")
    lines = (tmp_path / "t").read_text().split("\n")
    assert lines[:6] == ["# Title", "", "| n | name | share |", "| ---: | --- | ---: |", "| 0 | a\\|b | 2499.5 |", "| 1 | a\\|b | 2499 |"]
    assert len(lines) == 5005 and lines[-2] == "| 4999 | a\\|b | 0 |"
    found = catalog.QUERIES["sink_markdown"](spark, "/root/testdata/sf0.01")
    assert found.count() == 4 + spark.read.parquet("/root/testdata/sf0.01/supplier.parquet").count()


def test_members_of_one_description_can_be_split(spark):
    """What members are joined with is written first: a join above a grouping is one that adaptive execution cannot split."""
    members = spark.createDataFrame([("?", "AC")] * 20 + [("a", "CD")], "description string, sequence string")
    epitopes = spark.createDataFrame([("a", "AC", "bepipred", "B", "s1", 1)], "epitope_id string, sequence string, source_tool string, epitope_class string, strains string, ord long")
    found = records.members_annotated(members, epitopes)
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.description, r.source_tool, r.strains) for r in found.collect()} == {("?", "bepipred", "s1"), ("a", "bepipred", "")}
