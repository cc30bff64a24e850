"""Seeded pairs, forests, patterns and placements against brute force."""

import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.functions import sequences as fs
from sievemark.operators import clustering as cl
from sievemark.operators import graph, matching, patterns, placements, similarity


def identity(a, b):
    s, t = sorted((a, b), key=len)
    if not s:
        return 0.0
    if s in t:
        return 99.9
    return max(sum(x == y for x, y in zip(s, t[o:])) for o in range(len(t) - len(s) + 1)) * 100 / len(t)


def peptides(n, low, high, seed, letters="ACDEFGHIKLMNPQRSTVWY"):
    """Random ones, and near copies of some of them: changed, cut and longer ones."""
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 3 == 0 or len(out) < 3:
            out.append("".join(rng.choice(list(letters), int(rng.integers(low, high + 1)))))
            continue
        s = list(out[-1])
        for _ in range(int(rng.integers(0, max(2, len(s) // 2)))):
            s[int(rng.integers(len(s)))] = str(rng.choice(list(letters)))
        s = s[int(rng.integers(0, 2)) :] + list(str(rng.choice(["", "A", "WY"])))
        out.append("".join(s))
    return out


@pytest.mark.parametrize(("least", "low", "high"), [(50, 4, 16), (70, 1, 20), (90, 8, 30), (100, 3, 12), (60, 50, 75)])
def test_similar_pairs(spark, least, low, high):
    texts = [*peptides(120, low, high, least), "", "A", "AC", "ä", "äC𝒜F", "äC𝒜FGH", "äD𝒜F"]
    rows = spark.createDataFrame([(10 * i, s, "x") for i, s in enumerate(texts)], "ord long, sequence string, identity string").repartition(3)
    expected = {(10 * i, 10 * j, p) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if a and b and (p := identity(a, b)) >= least}
    assert {tuple(r) for r in similarity.similar_pairs(rows, least).collect()} == expected
    assert len(expected) > 20 or least == 100


def test_few_pairs_are_compared(spark):
    texts = sorted(set(peptides(3000, 12, 18, 5)))
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, sequence string")
    n = similarity.candidate_pairs(rows, 60).count()
    assert n < 0.01 * len(texts) * (len(texts) - 1) / 2


def test_every_seed_choice_is_necessary_and_sufficient():
    """For each pair of lengths and any places that differ, as many as are allowed, some seed avoids them all."""
    rng = np.random.default_rng(1)
    for longer in range(1, 25):
        for shorter in range(1, longer + 1):
            for least in (50, 65, 80, 100):
                differ = shorter - similarity.needed(longer, least)
                if differ >= 0:
                    found = similarity.seeds(shorter, longer, least)
                    for _ in range(10):
                        bad = set(rng.choice(shorter, differ, replace=False).tolist())
                        assert any(bad.isdisjoint(p) for p in found)


def test_only_similar_pairs_leave_a_seed(spark):
    """What shares a seed by chance, hundreds of times what is alike at 50 %, is neither shuffled nor joined."""
    texts = sorted(set(peptides(2000, 12, 17, 8)))
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, sequence string")
    met, alike = similarity.candidate_pairs(rows, 50).count(), similarity.similar_pairs(rows, 50).count()
    # Equal first letters alone are not compared there.
    assert 200 < alike <= met < 1.5 * alike, (met, alike)


def test_large_groups_of_a_seed(spark):
    """Groups beyond the limit are compared in blocks, with the same pairs; each of these has seeds in common with all others."""
    texts = sorted(set(peptides(150, 8, 14, 4, "AC")))
    rows = spark.createDataFrame(list(enumerate(texts)), "ord long, sequence string")
    whole = {tuple(r) for r in similarity.candidate_pairs(rows, 70).collect()}
    expected = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(texts), 2) if identity(a, b) >= 70}
    assert expected <= whole and len(expected) > 100
    assert {tuple(r) for r in similarity.candidate_pairs(rows, 70, group=20).collect()} == whole


def test_no_pairs_of_nothing(spark):
    empty = spark.createDataFrame([], "ord long, sequence string")
    assert similarity.similar_pairs(empty, 50).count() == 0
    assert cl.clusters(empty, [90, 50]).count() == 0


def parts(links):
    sets = graph._Sets()
    for a, b in links:
        sets.join(a, b)
    return {x: sets.root(x) for x in sets.above}


@pytest.mark.parametrize("few", [0, graph.FEW_LINKS])
def test_components_in_one_task_and_in_rounds(spark, few):
    rng = np.random.default_rng(3)
    links = [(t, int(a), int(b)) for t in (1, 2) for a, b in rng.integers(0, 200, (120, 2))]
    found = graph.connected_components(spark.createDataFrame(links, "t int, a long, b long"), by=("t",), few=few).collect()
    expected = {(t, x, r) for t in (1, 2) for x, r in parts([(a, b) for u, a, b in links if u == t and a != b]).items()}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert graph.connected_components(spark.createDataFrame([], "a long, b long"), few=few).count() == 0


@pytest.mark.parametrize("few", [0, graph.FEW_LINKS])
def test_spanning_forest(spark, few):
    rng = np.random.default_rng(7)
    links = [(int(a), int(b), float(w)) for a, b, w in rng.integers(0, 60, (300, 3))] + [(5, 5, 9.0), (1, 2, 3.0), (2, 1, 3.0)]
    forest = graph.spanning_forest(spark.createDataFrame(links, "a long, b long, weight double").repartition(4), few=few).collect()
    assert len(forest) == len({x for a, b, _ in links for x in (a, b) if a != b}) - len(set(parts([(a, b) for a, b, _ in links if a != b]).values()))
    for least in (0, 20, 40, 59):
        assert parts([(r.a, r.b) for r in forest if r.weight >= least]) == parts([(a, b) for a, b, w in links if a != b and w >= least])
    assert graph.spanning_forest(spark.createDataFrame([], "a long, b long, weight double"), few=few).count() == 0


TEXTS = [("a", "xACDEFGacdefg"), ("b", "ACD"), ("c", None), ("d", ""), ("e", "EFG" + "AAAA" * 9), ("f", "ä𝒜CDe"), ("b", "ACD")]


def places(windows, texts):
    up = lambda s: "".join(c.upper() if "a" <= c <= "z" else c for c in s or "")
    return {(w, i, o) for w in windows for i, t in texts for o in range(len(up(t)) - len(w) + 1) if up(t)[o : o + len(w)] == w}


@pytest.mark.parametrize("pass_bytes", [patterns.PASS_BYTES, 100])
def test_patterns(spark, pass_bytes, monkeypatch):
    windows = ["A", "CD", "EFG", "AAAA", "ACDEFGA", "GE", "𝒜C", "NOT THERE", "A" * 30, "ä"]
    texts = spark.createDataFrame([(*t, "z") for t in TEXTS], "ref_id string, text string, window string").coalesce(1)
    own = spark.createDataFrame([(w,) for w in [*windows, "A"]], "window string")
    found = patterns.found_in(own, texts, pass_bytes).collect()
    assert {tuple(r) for r in found} == places(windows, TEXTS) and len(found) == len(set(found))
    assert patterns.found_in(own.limit(0), texts).count() == 0
    assert patterns.found_in(own, texts.limit(0)).count() == 0


def test_patterns_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("AB"), 5000))
    c = patterns.letters(text)
    known = patterns._Known([text[17:37], text[4980:]], 20)
    assert [i for i in range(4981) if text[i : i + 20] in (text[17:37], text[4980:])] == known.places(c).tolist()
    monkeypatch.setattr(patterns, "PIECE", 64)
    out = []
    for at in range(0, len(c) - 19, 64 - 19):
        out += (known.places(c[at : at + 64]) + at).tolist()
    assert out == known.places(c).tolist()


def test_one_letter_query_in_long_texts(spark):
    """Only hits leave the scan: a query of one letter costs a row a hit, and nothing for what is none."""
    texts = spark.createDataFrame([(i, "CDEFG" * 20_000 + "A") for i in range(3)], "ref_id int, text string")
    found = matching.exact_hits(spark.createDataFrame([(1, "A"), (2, "CDEFGA")], "query_id int, sequence string"), texts, 50)
    assert {tuple(r) for r in found.collect()} == {(1, "A", i, 100_000) for i in range(3)} | {(2, "CDEFGA", i, 99_995) for i in range(3)}


def matches(q, t):
    return max((sum(x == y for x, y in zip(q, t[o:])) for o in range(len(t) - len(q) + 1)), default=0)


def test_best_texts(spark, monkeypatch):
    monkeypatch.setattr(placements, "STEP", 3)
    queries, texts = peptides(40, 3, 12, 11, "ACDEä"), [*peptides(60, 1, 30, 12, "ACDEä"), "", None]
    expected = set()
    for i, q in enumerate(queries):
        best = max(((matches(q, t or ""), -o) for o, t in enumerate(texts)), default=(0, 0))
        if best[0]:
            expected.add((f"q{i}", best[0], -best[1], f"t{-best[1]}"))
    q = spark.createDataFrame([(f"q{i}", s) for i, s in enumerate(queries)] + [("empty", ""), ("none", "QQQ")], "query_id string, sequence string")
    t = spark.createDataFrame([(f"t{i}", i, s, 1) for i, s in enumerate(texts)], "ref_id string, ref_ord int, text string, matches int").repartition(3)
    for size in (placements.PASS_BYTES, 500):
        monkeypatch.setattr(placements, "PASS_BYTES", size)
        assert {tuple(r) for r in placements.best_texts(q, t).collect()} == expected
    assert placements.best_texts(q.limit(0), t).count() == 0


@pytest.mark.parametrize("cells", [placements.CELLS, 40])
def test_conservancy_with_labels(spark, cells, monkeypatch):
    monkeypatch.setattr(placements, "CELLS", cells)
    queries, texts = ["", *peptides(15, 3, 9, 21, "ACDE")], ["", None, *peptides(40, 1, 14, 22, "ACDE")]
    t = [(f"s{i % 3}", f"L{i % 30:02d}", s) for i, s in enumerate(texts)]

    def share(q, s):
        s = s or ""
        return 0.0 if not q or not s else sum(x == y for x, y in zip(q, s)) / len(q) if len(s) < len(q) else matches(q, s) / len(q)

    expected = {}
    for i, q in enumerate(queries):
        for strain in ("s0", "s1", "s2"):
            own = [(share(q, s), label) for st, label, s in t if st == strain]
            hit = sorted(label for p, label in own if p >= 0.5)
            expected[i, strain] = (len(own), len(hit), min(own)[0], max(own)[0], hit, len(hit) / len(own))
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, sequence string")
    frame = spark.createDataFrame(t, "strain string, label string, text string").repartition(3)
    found = {(r.query_id, r.strain): tuple(r)[2:] for r in matching.conservancy(q, frame, 0.5).collect()}
    assert found == expected
    near = matching.nearest_targets(q, spark.createDataFrame([(s, i, x) for i, (s, _, x) in enumerate(t)], "strain string, ref_id int, text string").repartition(2))
    for r in near.collect():
        own = [(-share(queries[r.query_id], x), i) for i, (s, _, x) in enumerate(t) if s == r.strain]
        assert (-r.best, r.ref_id) == min(own)


def test_without_a_reference_nothing_is_clean(spark):
    q = spark.createDataFrame([(1, "ACDE")], "query_id int, sequence string")
    for rows in ([], [("r", "")]):
        none = spark.createDataFrame(rows, "ref_id string, text string")
        with pytest.raises(ValueError, match="no sequences"):
            matching.screened(q, none, 3)


def test_totals_and_reasons(spark):
    rows = spark.createDataFrame([(90, "ACX", False, "consensus contains X"), (90, "AC", True, ""), (90, "AD", False, "a < 1; b < 2"), (50, "AE", False, "b < 2"), (50, "Ax", False, "consensus contains X; b < 2")], "threshold int, consensus string, passes boolean, reason string")
    assert {tuple(r) for r in cl.sweep_totals(rows).collect()} == {(90, 3, 1, 2, 1), (50, 2, 1, 1, 0), (None, 5, 2, 3, 1)}
    assert [tuple(r) for r in cl.rejection_reasons(rows).orderBy("threshold", "place").collect()] == [(50, "b < 2", 2, 1), (50, "consensus contains X", 1, 2), (90, "a < 1", 1, 1), (90, "b < 2", 1, 2), (90, "consensus contains X", 1, 3)]


@pytest.mark.parametrize("sizes", [{}, {"PASS_BYTES": 400}, {"CELLS": 50, "LETTERS_BYTES": 1, "STEP": 4, "RUN": 1, "LABELS": 100}])
def test_placements_of_either_side(spark, sizes, monkeypatch):
    """Queries or texts in the tasks, of one letter to more than a byte counts, with common beginnings: the same places."""
    for name, value in sizes.items():
        monkeypatch.setattr(placements, name, value)
    texts = [*peptides(40, 1, 40, 31, "ACDE"), "A" * 700, "ACDE" * 90, ""]
    for queries in (peptides(30, 1, 25, 32, "ACDE") + ["A" * 300, "A" * 20 + "C", "A" * 20 + "D"], ["ACDA"]):
        q = spark.createDataFrame(list(enumerate(queries)), "query_id int, sequence string")
        t = spark.createDataFrame([(i, i, x) for i, x in enumerate(texts)], "ref_id int, ref_ord int, text string").repartition(2)
        best = {i: max((matches(s, x), -o) for o, x in enumerate(texts)) for i, s in enumerate(queries)}
        found = {r.query_id: (r.matches, -r.ref_id) for r in placements.best_texts(q, t).collect()}
        assert found == {i: b for i, b in best.items() if b[0]}
        share = lambda s, x: sum(a == b for a, b in zip(s, x)) / len(s) if len(x) < len(s) else matches(s, x) / len(s)
        rows = matching.conservancy(q, t.select(F.lit("s").alias("strain"), F.col("ref_id").alias("label"), "text"), 0.5).collect()
        assert {r.query_id: (r.min_identity, r.max_identity, r.matched) for r in rows} == {i: (min(p), max(p), [o for o, v in enumerate(p) if v >= 0.5]) for i, p in ((i, [share(s, x) for x in texts]) for i, s in enumerate(queries))}


def test_identity_of_many_with_many(spark):
    """Some seconds, even where all texts are in one partition; one by one it took a minute."""
    texts = sorted(set(peptides(3000, 11, 17, 41)))
    q = spark.createDataFrame(list(enumerate(texts)), "query_id int, sequence string")
    t = spark.createDataFrame([(i, i, x[3:] + "W" + x[:6]) for i, x in enumerate(texts)], "ref_id int, ref_ord int, text string").coalesce(1)
    start = time.perf_counter()
    assert matching.best_identity(q, t).count() == len(texts)
    assert time.perf_counter() - start < 25


def test_labels_are_not_shuffled(spark):
    """Where all targets go in one pass, a query's labels are whole when they leave the task."""
    q = spark.createDataFrame([(1, "ACDE"), (2, "CDEF")], "query_id int, sequence string")
    t = spark.createDataFrame([("s", "a", "ACDEF"), ("s", "b", "CDEFA")], "strain string, label string, text string")
    found = matching.conservancy(q, t, 0.5)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert {(r.query_id, tuple(r.matched)) for r in found.collect()} == {(1, ("a",)), (2, ("a", "b"))}


def test_members_are_placed_once(spark):
    """Spans, votes and alignment read what was placed, as the expressions of a row have it."""
    texts = [*peptides(60, 1, 20, 51, "ACDEä"), "𝒜CD" * 7]
    members = spark.createDataFrame([(i % 7, i, s) for i, s in enumerate(texts)], "k int, ord int, sequence string")
    _, aligned = cl.consensus(members, ["k"])
    assert "anchor" not in aligned._jdf.queryExecution().optimizedPlan().toString()
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts[::5]], "sequence string, anchor string")
    found = similarity.with_offset(rows).withColumn("expected", fs.best_offset("sequence", "anchor"))
    assert found.where("offset <> expected or expected is null").count() == 0
    both = rows.select(F.lit(1).cast("long").alias("a"), F.lit(2).cast("long").alias("b"), F.col("sequence").alias("sa"), F.col("anchor").alias("sb"))
    compared = both.mapInArrow(similarity._compared(30.0), "a long, b long, identity double").groupBy("identity").count().collect()
    assert set(compared) == set(both.select(fs.percent_identity("sa", "sb").alias("identity")).where("identity >= 30").groupBy("identity").count().collect())


@pytest.mark.parametrize("few", [0, 5, graph.FEW_LINKS])
def test_forest_cut_at_levels(spark, few):
    rng = random.Random(3)
    links = [(a, b, float(rng.choice([50, 55, 60, 70, 75, 90, 95]))) for a, b in zip(range(60), range(1, 61), strict=True) if a % 7] + [(100, 5, 80.0)]
    found = {(r.level, r.node): r.root for r in graph.cut(spark.createDataFrame(links, "a long, b long, weight double").repartition(3), [90, 70, 50], few=few).collect()}
    for level in (90, 70, 50):
        root = {n: n for a, b, _ in links for n in (a, b)}
        for _ in root:
            for a, b, w in links:
                if w >= level:
                    root[a] = root[b] = min(root[a], root[b])
        for node, least in root.items():
            assert found.get((level, node), node) == least
    assert graph.cut(spark.createDataFrame([], "a long, b long, weight double"), [90, 50], few=few).count() == 0


def test_forest_ends_in_one_task_once_few_links_are_left(spark, monkeypatch):
    """400 nodes on a circle and 400 chords: the first round leaves fewer links between components than one task may have."""
    rng = random.Random(4)
    links = [(i, (i + 1) % 400, float(rng.randrange(10_000))) for i in range(400)] + [(*sorted(rng.sample(range(400), 2)), float(rng.randrange(10_000))) for _ in range(400)]
    rounds, joined = [], graph.connected_components
    monkeypatch.setattr(graph, "connected_components", lambda *x, **how: rounds.append(1) or joined(*x, **how))
    forest = graph.spanning_forest(spark.createDataFrame(links, "a long, b long, weight double").repartition(4), few=600).collect()
    assert len(forest) == 399 and len(rounds) == 1


def test_seeds_are_sorted_by_one_number_and_each_group_has_its_shorter_rows_first(spark):
    rows = spark.createDataFrame([(i, "ACDEFGHIKLMN"[: 10 + i % 3]) for i in range(6)], "ord long, sequence string")
    seeded = similarity._seeded(rows, 50, [8], 10.0, 1)
    plan = similarity._met(seeded, 1, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Sort \[key#\d+L ASC NULLS FIRST\], false", plan)
    got = seeded.select("key", "kind").collect()
    assert got and all((r.key & 1) == (r.kind >= similarity._LONGER) for r in got)
    # A group's two kinds of rows differ in the last bit alone.
    assert {r.key >> 1 for r in got if r.key & 1} & {r.key >> 1 for r in got if not r.key & 1}


def test_alignments_do_not_wait_for_the_consensus(spark, monkeypatch):
    from sievemark.plans import q_groups

    members = spark.createDataFrame([(50, 1, 1, "ACDEF"), (50, 1, 2, "CDEF")], "threshold int, cluster long, ord long, sequence string")
    seen, write = [], q_groups.graph.written
    monkeypatch.setattr(q_groups, "sweep_members", lambda *_: members)
    monkeypatch.setattr(q_groups.graph, "written", lambda df, *a: (seen.append(df.columns), write(df, *a))[1])
    got = {(r.ord, r.position, r.alignment, r.member_index) for r in q_groups.cluster_peptides(spark, "").collect()}
    assert got == {(1, 1, "ACDEF", 1), (2, 2, "-CDEF", 2)}
    assert [r.n_disagreeing for r in q_groups.disagreeing_positions(spark, "").collect()] == [0]
    assert not any("consensus" in c for c in seen)


def test_patterns_letters_stay_out_of_the_driver(spark, monkeypatch):
    """The driver gets a hash of each pattern, in parts of a bounded size, not the patterns as rows."""
    frame = type(spark.range(0))
    windows = spark.createDataFrame([(w,) for w in ("CDE", "AC", "QQQQ")], "window string")
    texts = spark.createDataFrame(TEXTS, "ref_id string, text string")
    seen, arrow = [], frame.toArrow

    def rows(*_):
        raise AssertionError("rows were collected")

    for pass_bytes in (patterns.PASS_BYTES, 1):
        with monkeypatch.context() as m:
            m.setattr(frame, "collect", rows)
            m.setattr(frame, "toArrow", lambda df: (seen.append(df.columns), arrow(df))[1])
            found = patterns.found_in(windows, texts, pass_bytes)
        assert {tuple(r) for r in found.collect()} == places(["CDE", "AC", "QQQQ"], TEXTS)
    assert seen and all(c == ["size", "hash"] for c in seen)


def test_allergen_homology_names_the_first_places_of_all_members(spark):
    """As places of every piece in every reference have it, also of pieces with more places than are named."""
    refs = [*peptides(80, 1, 20, 61, "ACD"), "ACDAC" * 9, "", "ACX?ACD"]
    members = [(i % 6, i % 20, s) for i, s in enumerate([*peptides(40, 1, 12, 62, "ACD"), "wwwww", "ACX?A", "acdac", ""])]
    queries = [(i, s) for i, s in enumerate(["ACDAC", "CCC", "DDDDDDD", "AC", "CA", "W", "AAAA"])]
    text = spark.createDataFrame([(f"r{i}", i, x) for i, x in enumerate(refs)], "ref_id string, ref_ord int, text string").repartition(3)
    found = matching.allergen_homology(
        spark.createDataFrame(queries, "query_id int, sequence string"), spark.createDataFrame(members, "query_id int, member_id int, sequence string").repartition(3), text, 3, 40, "ACD"
    )
    for r in found.collect():
        hits, matched, skipped = set(), set(), 0
        for q, m, s in members:
            s = s.upper()
            if q == r.query_id and s:
                for w in [s[i : i + 3] for i in range(len(s) - 2)] or [s]:
                    if set(w) - set("ACD"):
                        skipped += 1
                        continue
                    own = {f"{w}@r{i}:{o + 1}" for _, i, o in places([w], list(enumerate(refs)))}
                    hits |= own
                    matched |= {m} if own else set()
        assert (r.n_exact, r.exact_matches, r.n_skipped) == (len(matched), ";".join(sorted(hits)[:8]), skipped)
        assert r.homology_risk == (r.exact_risk or r.identity_risk) and r.exact_risk == bool(matched)
    assert found.count() == len(queries)


def test_allergen_homology_does_not_join_all_places(spark):
    """A piece that 3,000 references have meets 300 members by its first places."""
    refs = spark.createDataFrame([(i, i, "ACDEF") for i in range(3000)], "ref_id int, ref_ord int, text string")
    members = spark.createDataFrame([(1, i, "ACDEF") for i in range(300)], "query_id int, member_id int, sequence string")
    found = matching.allergen_homology(spark.createDataFrame([(1, "ACDEF")], "query_id int, sequence string"), members, refs, 5, 40)
    assert [(r.n_exact, r.exact_matches) for r in found.collect()] == [(300, ";".join(sorted(f"ACDEF@{i}:1" for i in range(3000))[:8]))]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_labels_of_several_blocks_are_not_shuffled(spark, monkeypatch):
    """A task takes its queries through all blocks of targets, in the order of labels, and their labels are whole there, too."""
    queries, texts = peptides(12, 3, 9, 71, "ACD"), peptides(90, 1, 14, 72, "ACD")
    strains = ["x", "y", "only late", None]
    t = [(strains[2] if i > 85 else strains[i % 2] if i % 9 else None, f"L{i % 40:02d}" if i <= 85 else f"M{i}", s) for i, s in enumerate(texts)]
    q = spark.createDataFrame(list(enumerate(queries)), "query_id int, sequence string")
    frame = spark.createDataFrame(t, "strain string, label string, text string").repartition(3)
    share = lambda s, x: sum(a == b for a, b in zip(s, x)) / len(s) if len(x) < len(s) else matches(s, x) / len(s)
    expected = {}
    for i, s in enumerate(queries):
        for strain in strains:
            own = [(share(s, x), label) for st, label, x in t if st == strain]
            hit = sorted(label for p, label in own if p >= 0.5)
            expected[i, strain] = (len(own), len(hit), min(own)[0], max(own)[0], hit, len(hit) / len(own))
    blocks, held = [], placements._in_order
    monkeypatch.setattr(placements, "_in_order", lambda *x: (blocks.append(b) or b for b in held(*x)))
    for size, labels in ((600, 1 << 25), (600, 100), (1, 1 << 25), (1 << 20, 1 << 25)):
        monkeypatch.setattr(placements, "PASS_BYTES", size)
        monkeypatch.setattr(placements, "LABELS", labels)
        monkeypatch.setattr(placements, "_by_texts", lambda *_: True, raising=False)
        blocks.clear()
        found = matching.conservancy(q, frame, 0.5)
        assert "Aggregate" not in found._jdf.queryExecution().toString()
        assert {(r.query_id, r.strain): tuple(r)[2:] for r in found.collect()} == expected
        assert (len(blocks) > 3) == (size < 1 << 20) and sum(b.num_rows for b in blocks) == len(t)
        said = [b.column("label").to_pylist() for b in blocks]
        assert all(max(a) <= min(b) for a, b in zip(said, said[1:]))
        near = matching.nearest_targets(q, spark.createDataFrame([(s or "z", i, x) for i, (s, _, x) in enumerate(t)], "strain string, ref_id int, text string").repartition(2))
        for r in near.collect():
            assert (-r.best, r.ref_id) == min((-share(queries[r.query_id], x), i) for i, (s, _, x) in enumerate(t) if (s or "z") == r.strain)


def test_labels_are_not_shuffled_beyond_one_pass(spark, monkeypatch):
    monkeypatch.setattr(placements, "PASS_BYTES", 100)
    q = spark.createDataFrame([(1, "ACDE"), (2, "CDEF")], "query_id int, sequence string")
    t = spark.createDataFrame([("s", "b", "ACDEF"), ("s", "c", "WWWW"), ("s", "a", "CDEFA")], "strain string, label string, text string")
    found = matching.conservancy(q, t, 0.5)
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert {(r.query_id, r.n_targets, tuple(r.matched)) for r in found.collect()} == {(1, 3, ("b",)), (2, 3, ("a", "b"))}
