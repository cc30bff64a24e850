from pyspark.sql import functions as F

from sievemark.operators import clustering as cl
from sievemark.operators import graph, matching
from sievemark.operators.identifiers import numbered


def rows(spark, sequences):
    return spark.createDataFrame(list(enumerate(sequences)), "ord long, sequence string")


def consensus(spark, sequences):
    members = rows(spark, sequences).withColumn("k", F.lit(1))
    text, aligned = cl.consensus(members, ["k"])
    return text.first().consensus, [r.position for r in aligned.orderBy("ord").collect()]


def test_components_are_transitive(spark):
    out = cl.clusters(rows(spark, ["A" * 12 + "C" * 2, "A" * 7 + "C" * 7, "A" * 2 + "C" * 12]), [50])
    assert {r.root for r in out.collect()} == {0}


def test_substrings_link_below_the_length_ratio(spark):
    pairs = cl.similar_pairs(rows(spark, ["ACDEFGHIKLMNPQRSTVWY", "FGHIK", "WWWWW"]), 90).collect()
    assert [(r.a, r.b, r.identity) for r in pairs] == [(0, 1, 99.9)]


def test_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, graph.connected_components(links).collect()))
    assert {got[i] for i in range(41)} == {0} and got[101] == 100


def test_no_links(spark):
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_consensus(spark):
    assert consensus(spark, ["ACDEF", "ACDEG"])[0] == "ACDEX"
    assert consensus(spark, ["ACDEF", "ACDEG", "ACDEF"])[0] == "ACDEF"
    assert consensus(spark, ["ACDEF", "ACDEG", "ACDEH"])[0] == "ACDEX"
    text, at = consensus(spark, ["KKDAPYIVGDVVQEGV", "VVQEGVLTAVVIPTKKA"])
    assert text == "KKDAPYIVGDVVQEGVLTAVVIPTKKA" and at == [1, 11]


def test_pruning_and_pooling(spark):
    m = spark.createDataFrame([("1", "ACD"), ("2", "CDE"), ("2", "XXX"), ("?", "ACD")], "position string, sequence string").withColumn("consensus", F.lit("ACDEF"))
    assert sorted(r.sequence for r in cl.pruned(m).collect()) == ["ACD", "CDE"]
    pool = spark.createDataFrame([("AC", 90, 1, True), ("AC", 80, 2, True), ("AC", 70, 1, True), ("DD", 90, 3, False)], "consensus string, threshold int, cluster int, passes boolean")
    assert list(map(tuple, cl.pool_passing(pool).collect())) == [("AC", 90, 1, 2)]


def test_rule_reasons(spark):
    counts = spark.createDataFrame([(0, 1, 1, 0, 1, 0, "ACX")], "n_mhc_i int, n_mhc_ii int, n_bepipred int, n_epidope int, n_strains int, n_unresolved int, consensus string")
    row = cl.evaluate_rule(counts).first()
    assert row.reason == "consensus contains X; MHC-I 0 < 1; EpiDope 0 < 1" and not row.passes
    assert "B-cell 1 < 2" in cl.evaluate_rule(counts, both_bcell_tools=False).first().reason


def test_exact_hits(spark):
    refs = spark.createDataFrame([("p", "ACDEFACDEF"), ("q", "WWACDEFWW"), ("r", "MKWVTFIS")], "ref_id string, text string")
    q = spark.createDataFrame([("a", "ACDEF"), ("b", "MKW"), ("c", "FWWMK")], "query_id string, sequence string")
    got = sorted(tuple(r)[:1] + tuple(r)[2:] for r in matching.exact_hits(q, refs, 5).collect())
    assert got == [("a", "p", 0), ("a", "p", 5), ("a", "q", 2), ("b", "r", 0)]


def test_conservancy(spark):
    t = spark.createDataFrame([("Sudan", "XACDEX"), ("Sudan", "ACDEX"), ("Sudan", "WWWWW")], "strain string, text string")
    r = matching.conservancy(spark.createDataFrame([(1, "ACDE")], "query_id int, sequence string"), t, 1.0).first()
    assert (r.n_targets, r.n_matched) == (3, 2)


def test_numbers_over_ranges(spark):
    rows = spark.createDataFrame([(i % 3 if i % 7 else None, (i * 37) % 101, i) for i in range(200)], "g int, k int, i int").repartition(5)
    got = numbered(rows, ["g"], [F.desc("k"), F.asc("i")], "place").collect()
    assert len(got) == 200
    for g in (0, 1, 2, None):
        own = sorted((-r.k, r.i, r.place) for r in got if r.g == g)
        assert [p for _, _, p in own] == list(range(1, len(own) + 1))
    assert numbered(rows.limit(0), [], [F.asc("i")], "place").count() == 0


def test_one_letter_sequences_link_with_what_contains_them(spark):
    pairs = {(r.a, r.b): r.identity for r in cl.similar_pairs(rows(spark, ["ACDEFGHIKL", "D", "CDEFG", "W"]), 90).collect()}
    assert pairs == {(0, 1): 99.9, (0, 2): 99.9, (1, 2): 99.9}
