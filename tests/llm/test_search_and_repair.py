"""Exact search, clustering and repair of conversations against brute force; words whose rolling hashes agree."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import pytest

from sievemark.llm import conversations, maxscore, ngram_join, pseudo_likelihood, textscan, yinyang

VECTORS = "vec_id long, embedding array<float>, label int, score string, cluster string"


def vectors(n=400, width=64, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(5, width))
    rows = [(int(i), [float(np.float32(x)) for x in (middle[i % 5] + rng.normal(size=width)) / 8], 1, "s", "c") for i in rng.permutation(n)]
    rows += [(r[0] + 1000, r[1], 1, "s", "c") for r in rows[:60]]  # ties
    rows += [rows[0], rows[1], (50, rows[3][1], None, None, None), (None, rows[5][1], None, None, None)]
    odd = [None, [], [0.5] * 3, [0.25] * (width + 9), [0.0] * width, [math.nan] + [0.0] * (width - 1), [math.inf] * width, [None] + [1.0] * (width - 1), [-3000.5] * width, [5e5] * width]
    return rows + [(5000 + 25 * i, v, None, None, None) for i, v in enumerate(odd)]


def whole(rows, scale):
    return [(r[0], [math.floor(scale * x) for x in r[1]]) for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


@pytest.mark.parametrize("pass_bytes", [maxscore.PASS_BYTES, 1])
def test_top_k(spark, pass_bytes, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 64 * 40)
    rows = vectors()
    own = whole(rows, 256)
    expected = collections.Counter()
    for a, (q, v) in enumerate(own):
        if q is not None and q % 50 == 0:
            scores = [(-sum(x * y for x, y in zip(v, w)), c is None, c or 0, c) for b, (c, w) in enumerate(own) if b != a]
            expected.update((q, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:5], 1))
    found = maxscore.report(spark.createDataFrame(rows, VECTORS).repartition(3), pass_bytes=pass_bytes)
    assert collections.Counter(map(tuple, found.collect())) == expected
    assert found.columns == ["query_id", "rank", "vec_id", "score"]


def test_top_k_of_few(spark):
    few = spark.createDataFrame([(0, [1.0, 2.0], 1, "", ""), (50, [3.0, -1.0], 1, "", ""), (7, [-2.0, 0.0], 1, "", "")], VECTORS)
    assert sorted(map(tuple, maxscore.report(few).collect())) == [(0, 1, 50, 65536), (0, 2, 7, -131072), (50, 1, 0, 65536), (50, 2, 7, -393216)]
    assert maxscore.report(few.where("vec_id = 7")).count() == 0
    assert maxscore.report(few.limit(0)).count() == 0


def test_scores_beyond_a_long(spark):
    rows = [(0, [1e30, 0.0], 1, "", ""), (1, [1e30, 1.0], 1, "", ""), (2, [-1e30, 5.0], 1, "", ""), (3, [0.5, 0.5], 1, "", "")]
    found = [tuple(r)[2:] for r in maxscore.report(spark.createDataFrame(rows, VECTORS)).orderBy("rank").collect()]
    assert found == [(1, 2**63 - 1), (3, 2**63 - 1), (2, -(2**63))]


def test_maxscore_leaves_rows_early():
    """What is returned is right for any threshold, and rows that cannot reach it are not."""
    rng = np.random.default_rng(5)
    p, q = rng.integers(-60, 60, (64, 300)).astype(float), rng.integers(-60, 60, 64).astype(float)
    scores = q @ p
    for least in (-np.inf, *np.quantile(scores, [0.0, 0.5, 0.99, 1.0]), scores.max() + 1):
        rows, found = maxscore.maxscore(q, p, p.max(axis=1), p.min(axis=1), (p * p).sum(axis=0), least)
        assert set(np.flatnonzero(scores >= least)) == {r for r, s in zip(rows, found) if s >= least}
        assert (found == scores[rows]).all()


def lloyd(rows, k=8, rounds=10):
    own = [r for r in whole(rows, 1024) if len(r[1]) == 64]
    seeds = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in own if i is not None)[:k]
    c = [v for _, v in seeds]
    square = lambda v, w: sum((x - y) ** 2 for x, y in zip(v, w))
    assign = lambda: [min((square(v, w), j) for j, w in enumerate(c)) for _, v in own]
    for _ in range(rounds):
        near = assign()
        for j in range(len(c)):
            mine = [v for (_, v), (_, n) in zip(own, near) if n == j]
            if mine:
                c[j] = [sum(x) // len(mine) for x in zip(*mine)]
    near = assign()
    inertia = collections.Counter()
    for d, j in near:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, w)).encode()).hexdigest() for w in c]
    return collections.Counter((i, j, d, inertia[j], sum(inertia.values()), digest[j]) for (i, _), (d, j) in zip(own, near))


@pytest.mark.parametrize("groups", [None, 1, 8])
def test_clusters(spark, groups, monkeypatch):
    monkeypatch.setattr(yinyang, "SHARD", 50)
    rows = vectors()
    found = yinyang.report(spark.createDataFrame(rows, VECTORS).repartition(3), groups=groups)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert collections.Counter(map(tuple, found.collect())) == lloyd(rows)


def test_clusters_of_few(spark):
    few = vectors()[:3] + [(9, None, 1, "", ""), (10, [1.0], 1, "", "")]
    assert collections.Counter(map(tuple, yinyang.report(spark.createDataFrame(few, VECTORS)).collect())) == lloyd(few)
    equal = [(i, [0.5] * 64, 1, "", "") for i in range(20)]  # all centroids are one point
    assert collections.Counter(map(tuple, yinyang.report(spark.createDataFrame(equal, VECTORS)).collect())) == lloyd(equal)
    assert yinyang.report(spark.createDataFrame([], VECTORS)).count() == 0


def test_bounds_spare_scans():
    """Most vectors of separated clusters keep their centroid without a scan; the filters change nothing."""
    rng = np.random.default_rng(2)
    v = (rng.integers(0, 6, (500, 1)) * 5000 + rng.integers(-50, 50, (500, 8))).astype(np.int64)
    c = v[[0, 10, 20, 30, 40, 50]]
    of = yinyang.grouped(c, 3)
    b = yinyang._Bounds(v, np.zeros(500, np.int64), np.zeros(500), np.zeros((500, int(of.max()) + 1)))
    b.scan(c, of, np.arange(500), np.ones((500, int(of.max()) + 1), bool))
    scanned = 0
    for _ in range(4):
        now = np.array([v[b.near == j].mean(axis=0) if (b.near == j).any() else c[j] for j in range(6)]).astype(np.int64)
        scanned += b.round(now, of, np.sqrt(((now - c) ** 2).sum(axis=1)) * (1 + 1e-9))
        c = now
        assert (b.near == ((v[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert scanned < 1000


TURNS = "conv_id long, turn long, role string, text string, kind int, part int, audit string"


def turns():
    rng = np.random.default_rng(4)
    said = ["Yes.", "No!", "Really?  ", "a text without stop", " ", "", "\t\n", None, "e. g. this", "ÄÖ!", "x" * 5000 + "."]
    out = []
    for c in range(70):
        n = int(rng.integers(1, 9))
        for t in range(n):
            role = ["user", "assistant"][t % 2] if rng.random() < 0.7 else [None, "", "system", "tool", "user", "assistant", "User"][int(rng.integers(7))]
            out.append((c, None if rng.random() < 0.1 else t + int(rng.integers(3)), role, said[int(rng.integers(len(said)))], 1, 2, "x"))
    out += [(None, t, "user", "Null id.", 1, 2, "x") for t in range(4)] + [(900, 1, "user", "Twice.", 1, 2, "x")] * 5 + [(901, None, "assistant", "No turn.", 1, 2, "x")] * 3
    out += [(902, int(t), "user" if t % 2 else "assistant", f"Long {t % 50}.", 1, 2, "x") for t in range(3000)]
    return out


def rows_after_damage(rows):
    by = collections.defaultdict(list)
    blank = lambda x: " " if x is None else str(x)
    for c, t, role, text, *_ in rows:
        fault = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
        role, text = blank(role), blank(text)
        if fault == 0:
            by[c] += []
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        by[c] += [(t, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return {c: sorted(x, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest())) for c, x in by.items()}


def brute(rows):
    """Dijkstra-free: least (cost, audit, lines) by row and state, insertions to a fixpoint."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    def inserts(states):
        while True:
            new = dict(states)
            for (q, (cost, audit, lines)), x in itertools.product(states.items(), "ua"):
                if (q, x) in step:
                    to, found = step[q, x], (cost + 2, audit + "I", lines + (f"{names[x]}:",))
                    new[to] = min(new.get(to, found), found)
            if new == states:
                return states
            states = new

    seen, count, states = set(), collections.Counter(), inserts({"": (0, "", ())})
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        new = {}

        def put(to, found, new=new):
            new[to] = min(new.get(to, found), found)

        for q, (cost, audit, lines) in states.items():
            put(q, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and (q, role[0]) in step:
                    put(step[q, role[0]], (cost + more, audit + "K", lines + (f"{role}:{text}",)))
                for x, name in names.items():
                    if (q, x) in step:
                        put(step[q, x], (cost + 2 + more, audit + "R", lines + (f"{name}:{text}",)))
        states = inserts(new)
    cost, audit, lines = min(states[q] for q in ("", "a") if q in states)
    known = [t for t, *_ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_conversations(spark):
    rows = turns()
    expected = {(c, *brute(r)) for c, r in rows_after_damage(rows).items()}
    found = conversations.report(spark.createDataFrame(rows, TURNS).repartition(5))
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {tuple(r) for r in found.collect()} == expected
    assert len({len(x[7]) for x in expected}) > 5
    assert conversations.report(spark.createDataFrame([], TURNS)).count() == 0


def test_conversations_of_text_ids(spark):
    rows = [("a b", 0, "user", "Hello.", 1, 2, "x"), ("ä", 1, None, None, 1, 2, "x")]
    found = {tuple(r) for r in conversations.report(spark.createDataFrame(rows, TURNS.replace("conv_id long", "conv_id string"))).collect()}
    assert found == {(c, *brute(r)) for c, r in rows_after_damage(rows).items()}


def test_every_short_conversation():
    """All strings of up to four kinds, against brute force over rows."""
    repairer = conversations.Repairer()
    row = {0: ("system", "A."), 1: ("user", "B."), 2: ("assistant", "C."), 3: ("tool", "D."), 5: ("user", "e"), 6: ("assistant", "f"), 9: ("user", ""), 4: ("system", "g")}
    for n in range(5):
        for kinds in itertools.product(row, repeat=n):
            rows = [(i, row[k][0], row[k][1] and f"{i} {row[k][1]}") for i, k in enumerate(kinds)]
            assert repairer.repair(bytes(kinds)) == brute(rows)[5:7], kinds
    assert len(repairer.vectors) < 200


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_whose_rolling_hashes_agree(spark, n):
    x, y = thue_morse(n, "ab"), thue_morse(n, "ba")
    data, at = np.frombuffer((x + y).encode(), np.uint8), np.array([0, n])
    assert len(set(textscan.span_hash(data, at, at + n).tolist())) == 1
    assert len(set(textscan.word_hash(data, at, at + n).tolist())) == 2
    docs = spark.createDataFrame([(1, x), (2, y), (3, "other text of words"), (4, f"{x} {y} {x} z z"), (5, f"{y} {x} {y} z z")], "doc_id long, text string")
    for k, num in ((3, 90), (5, 80)):
        rows = ngram_join.near_duplicates(docs, k=k, num=num).collect()
        assert {r.doc_id: r.component_id for r in rows} == {i: i for i in range(1, 6)}
    scored = pseudo_likelihood.report(docs, rounds=1)
    assert scored.count() == 5


def test_word_hash():
    """Every length from 0 to 40 bytes, one byte changed, and zero bytes at the end tell spans apart."""
    rng = np.random.default_rng(0)
    spans = {bytes(rng.integers(0, 3, n).astype(np.uint8)) for n in range(41) for _ in range(60)} | {b"\0" * n for n in range(41)}
    data = np.frombuffer(b"".join(spans), np.uint8)
    ends = np.cumsum([len(s) for s in spans])
    h = textscan.word_hash(data, ends - [len(s) for s in spans], ends)
    assert len(set(h.tolist())) == len(spans)
    assert textscan.word_hash(data, np.zeros(0, np.int64), np.zeros(0, np.int64)).size == 0
