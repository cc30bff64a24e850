"""One text that most rows have: right results, and a join whose hot partition is split."""

import hashlib

import numpy as np

from sievemark.llm import suffix_dedup

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
}


def test_copies_of_one_text_are_split(spark):
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(f"{x:08x}" for x in rng.integers(0, 2**32, n))
    hot, own = text(400), [text(60) for _ in range(40)]
    rows = [(i, hot) for i in range(3000)] + [(3000 + i, t) for i, t in enumerate(own)] + [(4000 + i, None) for i in range(500)]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = {(i, len((t or "").encode()), len(hot) if t == hot else 0, int(t == hot), sha(b"" if t == hot else (t or "").encode())) for i, t in rows}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12, "doc_id")
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    try:
        for k, v in SETTINGS.items():
            spark.conf.set(k, v)
        out = suffix_dedup.report(docs)
        got = {tuple(r) for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == expected
    assert "skew=true" in plan


def test_logits_are_held_down_only_where_they_are_large():
    from sievemark.llm import pseudo_likelihood as pl

    rng = np.random.default_rng(5)
    own = rng.integers(0, pl.CLASSES, 50)
    for scale in (1, 100, 1e4):
        x = (rng.standard_normal((50, pl.CLASSES)) * scale).astype(np.float32)
        p = np.exp(np.minimum(x, np.float32(60)))
        p *= (1 / (p @ pl._ONES))[:, None]
        p[np.arange(50), own] -= 1
        before = x.copy()
        assert np.array_equal(pl._error(x, own), p)
        assert scale > 1 or np.array_equal(x, before)
    assert pl._error(np.zeros((0, pl.CLASSES), np.float32), np.zeros(0, np.int64)).shape == (0, pl.CLASSES)


def test_training_writes_into_the_arrays_of_the_steps_before():
    import tracemalloc

    from sievemark.llm import pseudo_likelihood as pl

    rng = np.random.default_rng(5)
    vocabulary = pl.Vocabulary(np.arange(1, 400, dtype=np.uint64), np.arange(400, 1, -1), np.ones(2048))
    steps = [(rng.integers(0, pl._PAD + 1, (n, 2 * pl.WIDTH)).astype(np.int16), rng.integers(0, pl.VOCABULARY, n).astype(np.int16)) for n in (pl.BATCH, 300, 7, pl.BATCH)]
    got = []
    for room in (pl._Room(pl.BATCH), None):
        w, sums = pl.start(vocabulary), {k: np.full(s, 1e-3, np.float32) for k, s in pl._SHAPES.items()}
        tracemalloc.start()
        for around, place in steps:
            pl.train_batch(w, sums, around, place, room)
        got.append((w, tracemalloc.get_traced_memory()[1]))
        tracemalloc.stop()
    # A step of its own takes some megabytes; where they are made anew for each, they cost more than the step's sums.
    assert got[0][1] < 1 << 20 < got[1][1]
    assert all(np.array_equal(got[0][0][k], got[1][0][k]) for k in pl._SHAPES)
    around, place = steps[1]
    assert np.array_equal(pl.log_probability(got[0][0], around, place, pl._Room(64)), pl.log_probability(got[0][0], around, place, pl._Room(64)))
    assert np.allclose(pl.log_probability(got[0][0], around, place, pl._Room(64)), pl.log_probability(got[0][0], around, place), atol=1e-4)
