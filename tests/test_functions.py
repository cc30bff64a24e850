import pytest
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs


def value(spark, column, **cols):
    return spark.createDataFrame([tuple(cols.values())], list(cols)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("PHDWTKNITDKIDQ", "PHDWTKNITDKIDA", 13 / 14 * 100),
        ("ACD", "ACDEF", 99.9),
        ("ACD", "ACD", 99.9),
        ("AAAA", "CCCC", 0.0),
        ("", "ACD", 0.0),
        ("CCAAAAC", "GGGGAAAAGGG", 4 / 11 * 100),
        ("AAAAACAAAA", "AAAAAGAAAACCCCCCCCC", 9 / 19 * 100),
    ],
)
def test_percent_identity(spark, a, b, expected):
    assert value(spark, fs.percent_identity("a", "b"), a=a, b=b) == pytest.approx(expected)
    assert value(spark, fs.percent_identity("b", "a"), a=a, b=b) == pytest.approx(expected)


@pytest.mark.parametrize("q, t, expected", [("ACDEF", "XXACDEGXX", 0.8), ("ACDEFGH", "ACD", 3 / 7), ("ACD", "XACDX", 1.0)])
def test_window_identity(spark, q, t, expected):
    assert value(spark, fs.window_identity("q", "t"), q=q, t=t) == pytest.approx(expected)


@pytest.mark.parametrize("text, k, n", [("ACDEFGHIKL", 9, 2), ("ACDEFGH", 9, 1), ("", 9, 0)])
def test_windows(spark, text, k, n):
    assert len(value(spark, fs.windows(F.col("t"), k), t=text)) == n


@pytest.mark.parametrize("peptide, anchor, expected", [("VVQEGVLTAVVIPTKKA", "KKDAPYIVGDVVQEGV", 10), ("AB", "BA", -1), ("CDE", "ABCDE", 2)])
def test_best_offset(spark, peptide, anchor, expected):
    assert value(spark, fs.best_offset("p", "a"), p=peptide, a=anchor) == expected


@pytest.mark.parametrize("x, said", [(0.5, "0.5"), (1.0, "1"), (10.0, "10"), (0.0, "0")])
def test_numbers(spark, x, said):
    assert value(spark, fs.number_text(F.col("x")), x=x) == said


def test_threshold_sweep():
    assert fs.threshold_sweep("90:50") == [90, 80, 70, 60, 50]
    assert fs.threshold_sweep("90:55")[-1] == 55
    assert fs.threshold_sweep(70) == [70]
    for bad in ("90:70:50", "50:90", "0.9", "x", "101"):
        with pytest.raises(ValueError):
            fs.threshold_sweep(bad)


def test_epitope_id_round_trip(spark):
    x = value(spark, F.regexp_extract("i", fs.EPITOPE_ID, 3), i="Spike_B_cell_BepiPred_12.3")
    assert x == "BepiPred"
    assert value(spark, F.regexp_extract("i", fs.EPITOPE_ID, 3), i="junk") == ""


def test_md5_of_every_document(spark, tmp_path):
    import hashlib

    from __spark_entry__ import queries

    texts = ["acDef", "", "Straße", "ünd été", "г-жа Иванова", "ŉ ǰ ﬁ", "ὈΔΥΣΣΕΎς", "日本 x", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.md5 for r in queries()["seq_md5_all"](spark, str(tmp_path)).collect()}
    assert got == {i: None if t is None else hashlib.md5(t.upper().encode()).hexdigest() for i, t in enumerate(texts)}
