"""The operators against brute force on small fixtures: nulls, empty texts, ties, repeats, empty tables, extra columns."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievemark.llm import decontaminate, deep_shallow, language, line_dedup, line_quality, ngram_join, packing, pseudo_likelihood, suffix_dedup, surrogates, textscan, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, items int, key string"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"wörd{i % 9} of{i}" for i in range(60))
LINE = "This line stands in many documents, word for word, and is long."


def texts():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(300)] + ["the", "of", "Ünd"]
    out = [" ".join(rng.choice(words, n)) for n in (5, 40, 80, 200, 400, 400)]
    out += [out[3], out[3] + " tail", out[4].replace("w1 ", "w2 ", 1), PASSAGE + "\n" + out[1], out[2] + "\n" + PASSAGE, PASSAGE[30:] + " end"]
    out += [f"{LINE}\n{out[i % 3]}\n  {LINE.upper()} \n\nx{i}" for i in range(7)]
    out += [None, "", " \n\t", "one", "One", "a" * 900, "ab" * 500, "the of the of the of the of " * 8]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{i % 3}", len(t or ""), 1, "k") for i, t in enumerate(texts())]
    rows += [rows[0], (None, texts()[3], None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(df, expected):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(expected, key=key)


@pytest.mark.parametrize("how", [{}, {"broadcast_keys": 0}, {"max_filter_bits": 1 << 20}])
def test_line_dedup(docs, rows, empty, how):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    where = collections.defaultdict(set)
    for i, t in rows:
        for line in t.split("\n"):
            if len(key(line)) >= 40 and i is not None:
                where[key(line)].add(i)
    gone = {k: max(v) for k, v in where.items() if len(v) >= 5}
    assert gone
    expected = []
    for i, t in rows:
        kept = [x for x in t.split("\n") if gone.get(key(x), i) == i]
        expected.append((i, t.count("\n") + 1, t.count("\n") + 1 - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    same(line_dedup.report(docs, **how), expected)
    assert line_dedup.report(empty, **how).count() == 0
    assert set(line_dedup.drop_lines(docs, **how).columns) == {*docs.columns, "n_lines", "n_dropped"}


@pytest.mark.parametrize("how", [{}, {"group_limit": 2}])
def test_suffix_dedup(docs, rows, empty, how):
    seen = collections.Counter(b[a : a + 200] for _, t in rows for b in [t.encode()] for a in range(len(b) - 199))
    expected = []
    for i, t in rows:
        b = t.encode()
        covered = np.zeros(len(b) + 1, bool)
        for a in range(len(b) - 199):
            if seen[b[a : a + 200]] > 1:
                covered[a : a + 200] = True
        kept = bytes(c for c, x in zip(b, covered, strict=False) if not x)
        expected.append((i, len(b), int(covered.sum()), int((np.diff(covered.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert sum(r[2] for r in expected)
    same(suffix_dedup.report(docs, **how), expected)
    assert suffix_dedup.report(empty, **how).count() == 0


def test_deep_shallow_sort():
    rng = np.random.default_rng(1)
    strings = [bytes(rng.choice([97, 98, 0], rng.integers(0, 14)).tolist()) for _ in range(300)] + [b"x" * 80 + bytes(rng.choice([97, 98], rng.integers(0, 9)).tolist()) for _ in range(200)]
    group = rng.integers(0, 3, len(strings))
    order, prefix = deep_shallow.sort(strings, group, 16)
    assert [(group[i], strings[i]) for i in order] == sorted((g, s) for g, s in zip(group, strings, strict=True))
    for a, b, n in zip(order[:-1], order[1:], prefix[1:], strict=True):
        assert n == (deep_shallow.common(strings[a], strings[b]) if group[a] == group[b] else -1)


@pytest.mark.parametrize("k, num", [(3, 90), (5, 80)])
@pytest.mark.parametrize("how", [{}, {"group_limit": 13}])
def test_ngram_join(spark, docs, rows, empty, k, num, how):
    extra = [(1000 + i, " ".join(f"z{(j if j % 50 != i else j + 1000 * i)}" for j in range(200)), "en", "s", 1, 1, "k") for i in range(30)]
    docs = docs.union(spark.createDataFrame(extra, SCHEMA))
    rows = rows + [r[:2] for r in extra]
    sets = {}
    for i, t in rows:
        w = WORDS.findall(t.translate(FOLD))
        sets.setdefault(i, frozenset(tuple(w[a : a + k]) for a in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset())
    own = {i: s for i, s in sets.items() if i is not None}
    root = {i: i for i in own}
    for a in sorted(own):
        for b in sorted(own):
            both = len(own[a] & own[b])
            if a < b and both and 100 * both >= num * (len(own[a]) + len(own[b]) - both) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {i: lo if r == hi else r for i, r in root.items()}
    got = [tuple(r) for r in ngram_join.report(docs, k=k, num=num, **how).collect()]
    assert sorted(r for r in got if r[0] is not None) == sorted((i, len(own[i]), root[i]) for i, _ in rows if i is not None)
    assert all(r[2] is None for r in got if r[0] is None) and len(got) == len(rows)
    assert ngram_join.report(empty, k=k, num=num).count() == 0


def test_one_id_with_two_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f g h"), (1, "x y z"), (2, "x y z"), (3, "a b c d e f g h")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.report(df, k=3, num=90).collect())) == [(1, 1, 1), (1, 6, 1), (2, 1, 1), (3, 6, 3)]


@pytest.mark.parametrize("how", [{}, {"broadcast_bytes": 0}])
def test_decontamination(spark, docs, rows, empty, how):
    item_rows = [("i1", PASSAGE), ("i2", " ".join(PASSAGE.split()[20:33])), ("i3", "One"), ("i4", None), ("i5", " ... "), ("i6", "no such words"), ("i1", PASSAGE), (None, "the of the of the of")]
    items = spark.createDataFrame(item_rows, "item_id string, text string")
    windows = collections.defaultdict(set)
    for i, t in item_rows:
        w = ALNUM.findall((t or "").translate(FOLD))
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add(i)
    expected = []
    for i, t in rows:
        w = ALNUM.findall(t.translate(FOLD))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                if own := windows.get(tuple(w[a : a + n])):
                    hit |= set(range(a, a + n))
                    found |= own - {None}
        expected.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    assert sum(r[5] for r in expected) > 3
    same(decontaminate.report(docs, items, **how), expected)
    assert decontaminate.report(empty, items, **how).count() == 0
    none = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.report(docs, none, **how).where("contaminated").count() == 0


def test_line_quality(docs, rows, empty):
    expected = []
    for i, t in rows:
        w = WORDS.findall(t)
        grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        repeated = {a + d for a in range(len(w) - 2) if grams[tuple(w[a : a + 3])] > 1 for d in range(3)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeated), len(w) < 50 or 100 * len(repeated) > 50 * len(w)))
    got = line_quality.line_frequency(docs)
    same(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), expected)
    assert got.where("kept and base_failed").count() == 0
    assert line_quality.line_frequency(empty).count() == 0


def test_depleted_documents_are_rejected(spark):
    lines = "\n".join(f"shared line number {'abc'[i]} with some words to make it long enough to count" for i in range(3))
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(60))
    rows = [(i, lines + "\n" + " ".join(f"u{i}y{j}" for j in range(12)), "h") for i in range(30)] + [(100 + i, own(i), "h") for i in range(10)]
    got = {r.doc_id: r.kept for r in line_quality.line_frequency(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not any(got[i] for i in range(30)) and all(got[100 + i] for i in range(10))


def test_frequent_lines_are_removed(spark):
    rows = [(i, f"Shared line {i}\n\n  own {'xyz'[i % 3] * (i + 1)} \nSHARED LINE 7", "h") for i in range(25)] + [(50, "shared line 1", "h"), (51, None, "h"), (52, "", None), (53, "shared line 1\nb", None), (None, "Shared line 3\nq", "h")]
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string, source string")
    expected = [(i, f"\n  own {'xyz'[i % 3] * (i + 1)} ", 2) for i in range(25)] + [(50, "", 1), (51, None, 0), (52, "", 0), (53, "shared line 1\nb", 0), (None, "q", 1)]
    got = line_quality.without_frequent_lines(docs)
    same(got.select("doc_id", "text", "n_frequent_lines"), [*expected, expected[0]])
    counts = line_quality.line_frequency(docs).select("doc_id", "n_frequent_lines", "frequent_chars")
    same(got.select("doc_id", "n_frequent_lines", "frequent_chars"), [tuple(r) for r in counts.collect()])
    assert got.where("depleted and doc_id = 50").count() == 1 and got.where("depleted and doc_id = 53").count() == 0


def test_boundaries_are_optimal():
    rng = np.random.default_rng(2)
    for _ in range(20):
        lengths = sorted(set(rng.integers(0, 60, 9).tolist()))
        counts = rng.integers(1, 9, len(lengths)).tolist()
        k = int(rng.integers(1, 5))

        def cost(ends):
            return sum(n * min(e for e in ends if e >= x) for x, n in zip(lengths, counts, strict=True))

        import itertools

        best = min(cost((*c, lengths[-1])) for c in itertools.combinations(lengths[:-1], min(k, len(lengths)) - 1))
        assert cost(packing.boundaries(lengths, counts, k)) == best


def test_packing(docs, empty):
    got = packing.report(docs, buckets=3, budget=500).collect()
    assert len(got) == docs.count()
    batches = collections.defaultdict(list)
    for r in got:
        batches[r.bucket, r.batch].append(r)
        assert r.padding == r.boundary - r.n_tokens >= 0
    for own in batches.values():
        assert len(own) == 1 or sum(r.boundary for r in own) <= 500
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert packing.report(empty).count() == 0


def test_toxicity(spark, empty):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(900):
        w = list(rng.choice([f"w{j}" for j in range(200)], 60))
        bad = i % 5 == 0
        if bad:
            w[10], w[12], w[30] = "vile", "rotten", "vile"
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (9000, ""), (9001, None), (None, "vile rotten vile")], "doc_id long, text string")
    label = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.report(docs, label).collect()}
    held = [i for i, _ in rows if got[i].held_out]
    assert 200 < len(held) < 400
    assert sum(got[i].predicted != (i % 5 == 0) for i in held) <= len(held) * 0.02
    assert all(0 <= r.score <= 1 for r in got.values()) and got[9000].predicted == 0 and got[9001].score == got[9000].score
    assert toxicity.report(empty, label).count() == 0
    assert toxicity.report(docs, label.limit(0)).where("predicted = 1").count() == 0


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"a b c{i % 7} " + ("vile" if i % 4 == 0 else "kind")) for i in range(300)], "doc_id long, text string")
    label = docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))
    other = label.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.report(docs, x).collect())) for x in (label, other))
    assert a == b


def test_segments():
    found = toxicity.segments([2, 3, 10, 30], [2.0, 1.0, 2.0, 4.0], -0.25)
    assert [(a, b) for a, b, _ in found] == [(2, 10), (30, 30)]
    assert found[0][2] == pytest.approx(2 + 1 - 6 * 0.25 + 2)


def test_pseudo_likelihood(spark, empty):
    rng = np.random.default_rng(4)
    pattern = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = [(i, " ".join(pattern[(i + j) % 8] for j in range(80))) for i in range(60)] + [(100, None), (101, ""), (102, " ".join(rng.permutation(pattern * 10)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pseudo_likelihood.report(docs, rounds=3).collect()}
    assert got[100].n_tokens == 0 and got[101].log_likelihood == 0 and got[101].mean_log_likelihood is None
    assert got[0].n_tokens == 80 and got[0].mean_log_likelihood > got[102].mean_log_likelihood
    assert pseudo_likelihood.report(empty).count() == 0


@pytest.mark.parametrize("rounds", [1, 2, 3, 8])
def test_every_position_is_a_target_once(rounds):
    place, offsets = np.arange(406, dtype=np.int16) % 37, np.array([0, 400, 400, 406])
    at = np.concatenate([pseudo_likelihood.targets(place, offsets, i, rounds, 8) for i in range(rounds)])
    assert sorted(at.tolist()) == list(range(406))


def plain_log_probability(w, around, place):
    """One word at a time, both softmaxes written out."""
    h = np.tanh(np.concatenate([w["e"][p] for p in around]) @ w["w"] + w["b"])
    out = 0.0
    h = np.append(h, 1.0)
    for logits, own in ((h @ w["c"], place % 64), (h @ w["v"][place % 64], place // 64)):
        p = np.exp(logits.astype(np.float64))
        out += float(np.log(p[own] / p.sum()))
    return out


def test_network_against_one_word_at_a_time():
    rng = np.random.default_rng(8)
    vocabulary = pseudo_likelihood.Vocabulary(np.arange(1, 400, dtype=np.uint64), np.arange(400, 1, -1), np.ones(2048))
    w = pseudo_likelihood.start(vocabulary)
    place, offsets = rng.integers(0, 4096, 300).astype(np.int16), np.array([0, 0, 1, 3, 120, 300])
    around = pseudo_likelihood._around(place, offsets)
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        for i in range(lo, hi):
            assert around[i].tolist() == [int(place[j]) if lo <= j < hi else 4096 for j in (i - 2, i - 1, i + 1, i + 2)]
    expected = [plain_log_probability(w, a, int(p)) for a, p in zip(around, place, strict=True)]
    assert pseudo_likelihood.log_probability(w, around, place) == pytest.approx(expected, abs=1e-4)
    # A small step along the gradient that train_batch takes raises the likelihood by what the gradient says.
    before = {k: v.astype(np.float64) for k, v in w.items()}
    sums = {k: np.full(v.shape, 1e12, np.float32) for k, v in w.items()}
    pseudo_likelihood.train_batch(w, sums, around, place)
    step = {k: w[k] - before[k] for k in w}
    for name, at in (("c", (3, 5)), ("c", (-1, 9)), ("b", (2,)), ("w", (7, 1)), ("v", (int(place[0]) % 64, 4, 6)), ("e", (int(around[5][0]), 3))):
        up, down = ({k: v.copy() for k, v in before.items()} for _ in range(2))
        up[name][at] += 1e-4
        down[name][at] -= 1e-4
        slope = sum(plain_log_probability(up, a, int(p)) - plain_log_probability(down, a, int(p)) for a, p in zip(around, place, strict=True)) / 2e-4 / len(place)
        assert step[name][at] == pytest.approx(slope * pseudo_likelihood.RATE / 1e6, abs=2e-8 + abs(slope) * 2e-9)


def test_equal_texts_have_equal_scores(spark):
    rows = [(i, f"one of the texts {i % 5} that stand here " * (i % 5 + 1), i) for i in range(40)]
    got = pseudo_likelihood.pseudo_likelihood(spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")).collect()
    assert {r.n_tokens for r in got} == {8 * (i + 1) for i in range(5)} and set(got[0].asDict()) == {"doc_id", "text", "n_tokens", "log_likelihood", "mean_log_likelihood"}
    by = collections.defaultdict(set)
    for r in got:
        by[r.text].add(round(r.log_likelihood, 2))
    assert [len(x) for x in by.values()] == [1] * 5


@pytest.mark.parametrize("listed", [10_000, 3000, 0])
def test_words_of_a_shared_place_have_their_own_probability(spark, listed):
    import pyarrow as pa

    rows = [(" ".join(f"w{j}" for j in range(i, 5000, i + 1)),) for i in range(5)] + [(None,), ("",)]
    vocabulary, words = pseudo_likelihood.vocabulary_of(spark.createDataFrame(rows, "text string"), listed=listed)
    assert words.count() == len({w for t, in rows for w in (t or "").split()})
    counts = collections.Counter(w for t, in rows for w in (t or "").split())
    h = next(pseudo_likelihood._hashed(pa.array([" ".join(counts)])))[2]
    place, share, known = vocabulary.look_up(h)
    n = np.array(list(counts.values()))
    assert known.sum() <= listed and known.all() == vocabulary.complete
    share = share + np.where(known, 0.0, np.log(n))
    assert np.exp(share) == pytest.approx(n / np.bincount(place, weights=n)[place])
    if known.all():
        assert len(np.unique(place[n > 1])) > 2048 - 1 and share.min() < 0


def test_rare_words_have_their_own_count(spark, monkeypatch):
    rows = [(i, " ".join(f"w{j}" for j in range(i, 3000, i + 1))) for i in range(6)] + [(10, None), (11, ""), (12, "only here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    every = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.report(docs, rounds=1).collect()}
    build = pseudo_likelihood.vocabulary_of
    monkeypatch.setattr(pseudo_likelihood, "vocabulary_of", lambda texts: build(texts, listed=2500))
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.report(docs, rounds=1).collect()}
    assert len(got) == len(rows) and got == pytest.approx(every, rel=1e-6)


def test_language(spark):
    words = {"en": "the and of to with that this have from".split(), "fr": "le la les des une dans pour avec que".split()}
    rng = np.random.default_rng(6)
    say = lambda x, n: " ".join(rng.choice(words[x], n))
    docs = spark.createDataFrame([(say(x, 50), x) for x in ("en", "fr") for _ in range(20)] + [(None, "en"), ("x", None)], "text string, lang string")
    page = lambda x, said: f"<html lang='{said}'><script>var le la les</script><body>{say(x, 30)}</body></html>"
    rows = [(i, f"http://{x}.example.org/{x}/{i}", page(x, x)) for i, x in enumerate(["en", "fr"] * 20)]
    rows += [(100, "http://fr.example.org/fr/1", "<html lang='fr'></html>"), (101, "http://x.org/", page("fr", "en")), (102, None, None), (103, "no url", "")]
    got = {r.page_id: r for r in language.report(spark.createDataFrame(rows, "page_id long, url string, html string"), docs).collect()}
    assert all(got[i].lang == x for i, x in enumerate(["en", "fr"] * 20))
    assert got[100].lang == "fr" and got[100].text_lang is None and got[101].lang == "fr"
    assert got[102].lang in ("en", "fr") and len(got) == len(rows)
    assert language.report(spark.createDataFrame([], "page_id long, url string, html string"), docs).count() == 0


def identified_plainly(pages, docs):
    """Every count in a dictionary, every page by itself, with all others counted anew."""
    import math

    import pyarrow as pa

    langs = sorted({x for _, x in docs if x})
    cells = {x: collections.Counter(c for t, own in docs if own == x for _, cell, _ in language.trigrams(pa.array([t])) for c in cell.tolist()) for x in langs}
    size = {x: sum(cells[x].values()) + 0.05 * language.CELLS for x in langs}
    seen = []
    for i, url, html in pages:
        cell = [c for _, cell, _ in language.trigrams(pa.array([language.visible(html or "")])) for c in cell.tolist()]
        like = {x: language.TEMPER * sum(math.log((cells[x][c] + 0.05) / size[x]) for c in cell) for x in langs}
        host, domain, suffix, hint = language.address(url or "", set(langs))
        said = language.declared(html or "")
        seen.append({"id": i, "like": like, "guess": max(langs, key=lambda x: (like[x], -langs.index(x))) if cell else None, "host": host, "domain": domain, "suffix": suffix, "hint": hint, "declared": said if said in langs or not said else "?"})
    out = {}
    for p in seen:
        others = [o for o in seen if o is not p and o["guess"]]
        n = collections.Counter(o["guess"] for o in others)
        by = {c: collections.Counter(o["guess"] for o in others if o[c] == p[c]) for c in ("host", "domain", "suffix", "hint", "declared")}
        total = {}
        for x in langs:
            total[x] = p["like"][x] + sum(math.log((by[c][x] + 0.5) / (n[x] + 0.5 * (len(langs) + 2))) for c in ("hint", "declared"))
            every = (sum(by["suffix"].values()) + 0.5) / (sum(n.values()) + 1)
            total[x] += math.log((by["suffix"][x] + 20 * every) / (n[x] + 20))
            share = (n[x] + 1) / (sum(n.values()) + len(langs))
            domain = (by["domain"][x] + 10 * share) / (sum(by["domain"].values()) + 10)
            total[x] += math.log((by["host"][x] + 5 * domain) / (sum(by["host"].values()) + 5))
        best = max(langs, key=lambda x: (total[x], -langs.index(x)))
        out[p["id"]] = (best, p["guess"], 1 / sum(math.exp(v - total[best]) for v in total.values()))
    return out


def test_language_against_plain_counts(spark):
    words = {"en": "the and of to with that this have from".split(), "fr": "le la les des une dans pour avec que".split(), "de": "der die das und mit von für nicht".split()}
    rng = np.random.default_rng(11)
    docs = [(" ".join(rng.choice(words[x], 30)), x) for x in words for _ in range(5)]
    pages = []
    for i in range(60):
        x = ("en", "fr", "de")[rng.integers(3)]
        said = rng.choice([x, x, "xx", ""])
        url = rng.choice([f"https://www.a{rng.integers(3)}.{rng.choice(['com', 'uk', 'fr'])}/{rng.choice([x, 'p'])}/{i}", f"http://{x}.b.org/{i}", "none"])
        pages.append((i, str(url), f"<html{f' lang={said}' if said else ''}><body>{' '.join(rng.choice(words[x], rng.integers(0, 4)))}</body>"))
    pages += [(100, None, None), (101, pages[0][1], pages[0][2])]
    expected = identified_plainly(pages, docs)
    got = language.report(spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(docs, "text string, lang string")).collect()
    assert len(got) == len(pages)
    for r in got:
        lang, guess, sure = expected[r.page_id]
        assert (r.lang, r.text_lang) == (lang, guess) and r.confidence == pytest.approx(sure, abs=2e-4)


def test_markup_takes_linear_time():
    import time

    began = time.time()
    for x in ("<script", "<!--", "<", "<html ", "<meta content-language ", "</script>", "<style></script>"):
        language.visible(x * 60_000)
        language.declared(x * 60_000)
    assert time.time() - began < 10
    assert language.visible("a<script>x</SCRIPT >b<!-- y -->c<p>d</p>&amp;<style>e").split() == ["a", "b", "c", "d", "&", "e"]
    assert language.declared("<html><meta name='x' content='de'><meta property='og:locale' content='fr_FR'>") == "fr"
    assert language.declared("<html data-lang='de'><html class=x lang = 'EN-us'>") == "en"


PRIVATE = "Mail Anna.Bo@mail.example.com or ANNA.BO@MAIL.EXAMPLE.COM, call +1 (613) 555-3280, card 4111 1111 1111 1111, host 10.2.3.4, Mrs Greta Holm and Mr Holm, г-жа Иванова."


@pytest.mark.parametrize("how", [{}, {"broadcast_attempts": -1}])
def test_surrogates(spark, docs, empty, how):
    rows = [(1, PRIVATE), (2, PRIVATE + " again"), (3, "clean text, 12 words, version 3.2"), (4, None), (5, "")]
    rows += [(100 + i, f"10.0.{i % 250}.{i // 250} and 127.{i}.1.1") for i in range(250)]
    got = {r.doc_id: r for r in surrogates.report(spark.createDataFrame(rows, "doc_id long, text string"), **how).collect()}
    t = got[1].text
    for secret in ("Anna", "ANNA", "613", "4111 1111 1111 1111", "10.2.3.4", "Greta", "Иванова"):
        assert secret not in t
    assert got[2].text == t + " again" and got[3].text == rows[2][1] and got[4].text is None and got[5].text == ""
    found = surrogates.entities(t)
    assert [x[2] for x in found] == [x[2] for x in surrogates.entities(PRIVATE)]
    assert found[0][3] == found[1][3], "one address, one surrogate"
    card = next(x[3] for x in found if x[2] == "card")
    assert surrogates._luhn(card) == 0
    new = [x for i in range(250) for x in re.findall(r"[\d.]+\d", got[100 + i].text)]
    old = {x for i in range(250) for x in re.findall(r"[\d.]+\d", rows[5 + i][1])}
    assert len(set(new)) == len(old) and not set(new) & old
    assert surrogates.report(empty, **how).count() == 0


def replaced_plainly(rows, key=surrogates.DEFAULT_KEY):
    """All entities in one dictionary, one round after the other."""
    said = collections.defaultdict(set)
    for _, text in rows:
        for _, _, kind, form, gender in surrogates.mentions(text or ""):
            said[kind, form].add(gender)
    gender = {e: "female" if "female" in g and "male" not in g else "male" if "male" in g and "female" not in g else "any" if g - {""} else "" for e, g in said.items()}
    tries = dict.fromkeys(said, 0)
    while True:
        owners = collections.defaultdict(list)
        for kind, form in said:
            owners[kind, surrogates.surrogate(key, kind, form, tries[kind, form], gender[kind, form])].append(form)
        bad = [(kind, form) for (kind, new), forms in owners.items() for form in forms if (kind, new) in said or form != min(forms)]
        if not bad:
            break
        for e in bad:
            tries[e] += 1
    out = []
    for i, text in rows:
        new = text
        for a, b, kind, form, _ in reversed(surrogates.mentions(text or "")):
            new = new[:a] + surrogates.rendered(kind, text[a:b], surrogates.surrogate(key, kind, form, tries[kind, form], gender[kind, form])) + new[b:]
        out.append((i, new))
    return out


@pytest.mark.parametrize("how", [{}, {"broadcast_attempts": -1}])
def test_surrogates_against_one_dictionary(spark, how):
    rng = np.random.default_rng(9)
    names = ["Holm", "Jane", "Smith", "Ivo", "Kovacs", "Lund"]
    say = lambda: rng.choice([f"_@{'abcdef'[rng.integers(6)]}.io", f"x{rng.integers(30)}@b.io", f"10.0.0.{rng.integers(200)}", f"{rng.choice(['Mr', 'Ms', 'Dr'])} {rng.choice(names)} {rng.choice(names)}", f"Mr {rng.choice(names)}", rng.choice(names), "word", "123-45-67%02d" % rng.integers(99)])
    rows = [(i, ", ".join(str(say()) for _ in range(rng.integers(0, 12)))) for i in range(120)] + [(500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(surrogates.report(docs, **how).select("doc_id", "text"), replaced_plainly(rows))


def test_mentions_of_a_person_keep_together(spark):
    rows = [(1, "Dr Jane Smith met Ms Smith. Jane and SMITH left; Smith's coat stayed, smith stayed. Janet came."), (2, "Ms Jane Lund and Mr Ivo Lund"), (3, "Jane Lund without a title")]
    got = {r.doc_id: r for r in surrogates.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    new = [e.surrogate for e in got[1].entities]
    jane, smith = new[0], new[1]
    assert new == [jane, smith, smith, jane, smith.upper(), smith]
    assert got[1].text == f"Dr {jane} {smith} met Ms {smith}. {jane} and {smith.upper()} left; {smith}'s coat stayed, smith stayed. Janet came."
    assert jane.endswith(("a", "ia", "ine")), "Ms Jane elsewhere says the gender"
    assert got[2].entities[2].surrogate.endswith(("n", "r", "s")) and got[2].entities[1].surrogate == got[2].entities[3].surrogate
    assert got[3].text == rows[2][1]


def test_addresses_without_letters_and_full_ranges(spark):
    rows = [(i, f"_@{c}.io") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    rows += [(100 + a, " ".join(f"192.168.{a}.{b}" for b in range(1, 255))) for a in range(1, 255)]
    got = {r.doc_id: r.text for r in surrogates.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    new = [x for t in got.values() for x in t.split()]
    old = {x for _, t in rows for x in t.split()}
    assert len(set(new)) == len(new) == len(old) and not set(new) & old


def test_full_form_is_an_error(spark):
    rows = [(i, f"_@{c}.io") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    with pytest.raises(ValueError, match="no free surrogate"):
        surrogates.report(spark.createDataFrame(rows, "doc_id long, text string"), max_attempts=1).count()


def test_account_numbers_stay_valid():
    valid = "GB82WEST12345698765432"
    assert surrogates._mod97(valid) == 1
    for i in range(20):
        new = surrogates.surrogate(b"k", "iban", valid, i)
        assert surrogates._mod97(new) == 1 and new[:2] == "GB" and new[4:8].isalpha() and new[8:].isdigit() and new != valid


def test_overlaps_take_linear_time():
    import time

    began = time.time()
    assert len(surrogates.entities(" ".join(f"a{i}@b{i}.org" for i in range(40_000)))) == 40_000
    assert time.time() - began < 5


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    rng = np.random.default_rng(12)
    texts_ = [bytes(rng.choice([97, 98, 99], n).tolist()) for n in (5000, 199, 200, 0, 3000)]
    t = textscan.Texts(np.frombuffer(b"".join(texts_), np.uint8), np.cumsum([0, *map(len, texts_)]))
    whole = suffix_dedup.anchors(t, 200, 48)
    monkeypatch.setattr(suffix_dedup, "PIECE", 301)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.anchors(t, 200, 48), strict=True))
    h = textscan.span_hash(t.data, np.arange(len(t.data) - 47), np.arange(48, len(t.data) + 1)) >> np.uint64(20)
    expected = {min(range(at, at + 153), key=lambda i: (h[i], i)) for lo, hi in zip(t.offsets[:-1], t.offsets[1:], strict=True) for at in range(lo, hi - 199)}
    assert sorted(expected) == whole[0].tolist()


def test_hashes_do_not_depend_on_pieces(monkeypatch):
    data = np.random.default_rng(13).integers(0, 256, 9000).astype(np.uint8)
    starts = np.arange(0, 8000, 7)
    ends = starts + np.random.default_rng(14).integers(0, 1000, len(starts))
    whole = textscan.span_hash(data, starts, ends)
    monkeypatch.setattr(textscan, "PIECE", 64)
    assert (textscan.span_hash(data, starts, ends) == whole).all()
    assert whole[0] == textscan.span_hash(np.concatenate([data[5:9], data]), np.array([4]), ends[:1] + 4)[0]


LONG = 8_000_000


def test_one_very_long_text(spark):
    docs = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.expr(f"array_join(transform(sequence(1, {LONG // 8}), i -> concat('w', 100000 + i % 700001)), ' ')").alias("text"), F.lit("s").alias("source"))
    short = spark.createDataFrame([(2, PASSAGE, "s"), (3, PASSAGE, "s")], "doc_id long, text string, source string")
    docs = docs.union(short).cache()
    items = spark.createDataFrame([("i", PASSAGE)], "item_id string, text string")
    labels = spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, toxic int")
    words = LONG // 8
    first = lambda df: df.where("doc_id = 1").first()
    assert first(packing.report(docs)).n_tokens == words
    assert first(decontaminate.report(docs, items)).n_words == words
    assert 0 <= first(toxicity.report(docs, labels)).score <= 1
    row = first(suffix_dedup.report(docs))
    # The words' numbers begin again after 700,001 of them: what follows is there twice, and so is what it repeats.
    assert row.n_bytes == 8 * words - 1 and row.n_spans == 2 and abs(row.n_removed - 16 * (words - 700_001)) <= 16
    assert first(ngram_join.report(docs, k=3, num=90)).n_shingles == 700_001
    assert first(line_dedup.report(docs)).n_lines == 1
    assert first(pseudo_likelihood.report(docs, rounds=1)).n_tokens == words
    assert first(surrogates.report(docs)).n_entities == 0
    assert first(line_quality.line_frequency(docs)).n_words == words
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://x.org/").alias("url"), F.concat(F.lit("<html lang=en>"), "text").alias("html"))
    assert language.report(pages, docs.withColumn("lang", F.lit("en"))).where("page_id = 1").first().lang == "en"


def test_other_columns_and_ids_of_text_stay(spark):
    lines = f"{LINE}\nown"
    rows = [(f"id{i}", lines if i < 6 else PASSAGE, i, i * 10, "en", f"k{i}") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n int, word int, lang string, key string")
    clash = docs.select("*", *(F.lit("mine").alias(c) for c in ("score", "passages", "n_words", "items", "n_lines", "kept", "n_bytes", "entities", "n_tokens", "bucket", "padding", "log_likelihood", "depleted", "hash", "gram", "uid")))
    items = spark.createDataFrame([("i", PASSAGE)], "item_id string, text string")
    model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), 1.0, 1.0, (0.0, 0.0, 0.0, 0.0))
    outs = {
        "line": line_dedup.drop_lines(clash),
        "join": line_dedup.drop_lines(clash, broadcast_keys=0),
        "contamination": decontaminate.contamination(clash, items),
        "joined": decontaminate.contamination(clash, items, broadcast_bytes=0),
        "toxicity": toxicity.passages(clash, model),
        "suffix": suffix_dedup.remove_repeats(clash),
        "likelihood": pseudo_likelihood.pseudo_likelihood(clash, rounds=1),
        "surrogates": surrogates.pseudonymised(clash),
        "packing": packing.pack(packing.token_counts(clash)),
        "removal": line_quality.without_frequent_lines(clash.withColumn("doc_id", F.substr("doc_id", F.lit(3))), host="lang"),
    }
    for name, df in outs.items():
        got = df.collect()
        assert len(got) == 8 and len({c.lower() for c in df.columns}) == len(df.columns), name
        assert sorted((r.n, r.word, r.key, r.hash, r.gram) for r in got) == [(i, i * 10, f"k{i}", "mine", "mine") for i in range(8)], name
    kept = {r.doc_id: r.text for r in outs["line"].collect()}
    assert [kept[f"id{i}"] for i in range(6)] == ["own"] * 5 + [lines], "the largest id keeps the line"
    assert {r.doc_id: r.text for r in outs["join"].collect()} == kept


def segments_plainly(scores):
    """The best segment, and the same of what is left and right of it."""
    best = max(((sum(scores[a : b + 1]), -a, a, b) for a in range(len(scores)) for b in range(a, len(scores))), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, a, b = best
    return segments_plainly(scores[:a]) + [(a, b, best[0])] + [(x + b + 1, y + b + 1, s) for x, y, s in segments_plainly(scores[b + 1 :])]


def test_segments_against_all_segments():
    rng = np.random.default_rng(15)
    for _ in range(300):
        n = int(rng.integers(1, 25))
        at = sorted(rng.choice(n, int(rng.integers(0, n + 1)), replace=False).tolist())
        score = (rng.random(len(at)) + 0.01).tolist()
        full = [-0.25 - i * 1e-9 for i in range(n)]
        for p, x in zip(at, score, strict=True):
            full[p] = x
        got, expected = toxicity.segments(at, score, -0.25), segments_plainly(full)
        assert [x[:2] for x in got] == [x[:2] for x in expected]
        assert [x[2] for x in got] == pytest.approx([x[2] for x in expected], abs=1e-6)


def test_toxicity_counts_against_plain_ones(spark):
    rng = np.random.default_rng(16)
    rows = [(" ".join(rng.choice(["Vile", "vileness", "wörter", "wörterbuch", "ok", "fine1"], rng.integers(0, 12))), int(rng.integers(2)), int(rng.integers(2))) for _ in range(80)] + [(None, 1, 0), ("", 0, 1)]
    plain = collections.defaultdict(lambda: [0, 0, 0, 0])
    for text, toxic, half in rows:
        tokens = {x for w in ALNUM.findall((text or "").translate(FOLD)) for x in [w, *((k, w[:k]) for k in toxicity.STEMS if len(w) >= k)]}
        for x in tokens:
            plain[x][2 * toxic + half] += 1
    train = spark.createDataFrame(rows, "text string, toxic int, half int").repartition(3)
    got = toxicity._counts(train)
    table = sorted(zip(*(got[c].tolist() for c in ("good0", "good1", "bad0", "bad1")), strict=True))
    assert table == sorted(tuple(map(float, x)) for x in plain.values() if sum(x) >= toxicity.MIN_DOCS and x[2] + x[3] > 0)
    often, total = toxicity._corpus(train.select("text"), got["keys"])
    words = collections.Counter(w for text, _, _ in rows for w in ALNUM.findall((text or "").translate(FOLD)))
    every = collections.Counter({w: n for w, n in words.items()})
    for w, n in words.items():
        for k in toxicity.STEMS:
            if len(w) >= k:
                every[k, w[:k]] += n
    assert total == len(rows) and sorted(often.tolist()) == sorted(float(every[x]) for x, n in plain.items() if sum(n) >= toxicity.MIN_DOCS and n[2] + n[3] > 0)


def pipeline_plainly(rows, scores, passage):
    """rows (doc_id, text) after all stages but packing; scores: of the toxicity stage."""
    rows = [(i, t) for i, t in rows if scores[i] < 0.7]
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    where = collections.defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                where[key(line)].add(i)
    gone = {k: max(v) for k, v in where.items() if len(v) >= 5}
    rows = [(i, t if t is None else "\n".join(x for x in t.split("\n") if gone.get(key(x), i) == i)) for i, t in rows]
    sets = {}
    for i, t in rows:
        w = WORDS.findall((t or "").translate(FOLD))
        sets[i] = frozenset(tuple(w[a : a + 5]) for a in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset()
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                lo, hi = sorted((root[a], root[b]))
                root = {i: lo if r == hi else r for i, r in root.items()}
    rows = [(i, t) for i, t in rows if root[i] == i]
    w = ALNUM.findall(passage.translate(FOLD))
    windows = {tuple(w[a : a + 10]) for a in range(len(w) - 9)}
    said = {i: ALNUM.findall((t or "").translate(FOLD)) for i, t in rows}
    return {i: len(x) for i, x in said.items() if not any(tuple(x[a : a + 10]) in windows for a in range(len(x) - 9))}


def test_pipeline_against_plain_stages(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(17)
    base = texts()
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(300):
        w = list(rng.choice([f"w{j}" for j in range(300)], 60))
        if i % 5 == 0:
            w[10], w[12], w[30], w[40] = "vile", "rotten", "vile", "rotten"
        rows.append((1000 + i, " ".join(w)))
    rows += [(2000, rows[60][1]), (2001, None), (2002, ""), (2003, rows[61][1] + " more")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("i", PASSAGE), ("j", None)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = spark.createDataFrame([(1000 + i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.report(docs, labels).collect()}
    expected = pipeline_plainly(rows, scores, PASSAGE)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 30 < sum(x >= 0.7 for x in scores.values()) and {r.doc_id for r in got} == set(expected) and len(got) == len(expected)
    for r in got:
        assert r.padding == r.boundary - r.n_tokens >= 0 and r.n_tokens >= expected[r.doc_id]
    batches = collections.Counter((r.bucket, r.batch) for r in got)
    assert all(n * r.boundary <= 65_536 for r in got for n in [batches[r.bucket, r.batch]])


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (1, None)], [(1, ""), (2, "")], [(3, "a b c d e f"), (3, "a b c d e f"), (4, "a b c d e f")]])
def test_pipeline_on_odd_tables(spark, tmp_path, rows):
    import corpus_pipeline

    spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    # Rows that repeat an id are one document to the near-duplicate stage, and stay or go together.
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, t in rows if i != 4)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    base = texts()
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(base)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("i", PASSAGE)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(0, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {0, 1, 2, 3, 5} <= got and 6 not in got and 9 not in got and 10 not in got
