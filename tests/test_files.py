import pytest
from pyspark.sql import types as T

from sievemark.sources import files


def test_fasta(spark, tmp_path):
    (tmp_path / "one.fasta").write_text("﻿noise\n>A1 spike [Zaire]\nac-de\nFG*\n\n>A2 x>y\nKL\n")
    (tmp_path / "two.txt").write_text(">B\nAA\n")
    got = [(r.header, r.sequence) for r in files.scan_input_dir(spark, str(tmp_path)).orderBy("ord").collect()]
    assert got == [("A1 spike [Zaire]", "ACDEFG"), ("A2 x>y", "KL")]


def test_tsv(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.5, True, 'say "hi"'), (2, 1.0, False, None)], "a int, x double, ok boolean, s string")
    files.sink_tsv(df, str(tmp_path / "t"), ["a", "ok", "x", "s", "missing"])
    schema = T.StructType([T.StructField("a", T.IntegerType()), *(T.StructField(c, T.StringType()) for c in ("ok", "x", "s", "missing"))])
    got = sorted(map(tuple, files.scan_tsv(spark, str(tmp_path / "t"), schema).collect()))
    assert got == [(1, "True", "0.5", 'say "hi"', None), (2, "False", "1", None, None)]
    assert files.scan_tsv(spark, str(tmp_path / "none"), schema).count() == 0


def test_columns_and_delimiters():
    assert files.resolve_column(["Peptide Seq", "Rank"], ["peptide"], "peptide") == "Peptide Seq"
    with pytest.raises(ValueError):
        files.resolve_column(["a"], ["score"], "score")
    assert files.sniff("a\tb,c") == "\t" and files.sniff("a;b;c") == ";"


def test_report_and_scores(spark, tmp_path):
    (tmp_path / "r.txt").write_text("class I\npopulation/area\tcoverage\taverage_hit\tpc90\nWorld\t11.53%\t0.12\t0.11\naverage\t1\t1\t1\n\nclass combined\npopulation/area\tcoverage\taverage_hit\tpc90\nWorld\t74.19%\t1.1\t0.4\n")
    got = {(r.population, r.mhc_class): r.coverage for r in files.scan_population_report(spark, str(tmp_path / "r.txt")).collect()}
    assert got == {("World", "I"): 11.53, ("World", "combined"): 74.19}
    (tmp_path / "s.csv").write_text("masking: default\n\nHeader,Score\nx,0.69\ny,n/a\n")
    rows = spark.createDataFrame([("x",), ("z",)], "sequence_id string")
    (tmp_path / "p.csv").write_text("Header,Score\nx,0.69\ny,n/a\n")
    scores = files.scan_scores(spark, str(tmp_path / "p.csv"), ["header"], ["score"], ("n/a",))
    assert {r.sequence_id: r.score for r in scores.collect()} == {"x": 0.69, "y": None}
    with pytest.raises(ValueError):
        files.must_cover(rows, scores, "sequence_id")
    assert files.scan_delimited(spark, str(tmp_path / "s.csv"), "header").count() == 2
