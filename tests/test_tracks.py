import pytest

from sievemark.operators import tracks


def track(spark, scores):
    return spark.createDataFrame([("s", i + 1, float(x)) for i, x in enumerate(scores)], "sequence_id string, position long, score double")


def spans(spark, scores, length, step=2, gap=0, least=1, threshold=0.5):
    rows = tracks.residues_to_epitopes(track(spark, scores), threshold, length, step, gap, least).collect()
    return sorted((r.start, r.stop) for r in rows)


def hits(pattern):
    return [0.9 if c == "#" else 0.1 for c in pattern]


@pytest.mark.parametrize(
    "pattern, kwargs, expected",
    [
        ("#" * 10, {"length": 6}, [(1, 6), (3, 8), (5, 10)]),
        ("#" * 11, {"length": 6}, [(1, 6), (3, 8), (5, 10), (6, 11)]),
        ("#" * 8, {"length": 6, "step": 1}, [(1, 6), (2, 7), (3, 8)]),
        ("###.###", {"length": 7, "gap": 1}, [(1, 7)]),
        ("###..###", {"length": 3, "gap": 1}, [(1, 3), (6, 8)]),
        (".###", {"length": 3, "gap": 2}, [(2, 4)]),
        ("###.......", {"length": 6, "least": 3}, [(1, 6)]),
        (".......###", {"length": 6, "least": 3}, [(5, 10)]),
        ("##........", {"length": 6, "least": 4}, []),
        ("#####", {"length": 14}, []),
    ],
)
def test_windows(spark, pattern, kwargs, expected):
    assert spans(spark, hits(pattern), **kwargs) == expected


def test_count_of_tiles_and_inclusive_threshold(spark):
    assert len(spans(spark, [0.5] * 42, 14)) == 15


def test_mean_takes_absorbed_positions_in(spark):
    row = tracks.residues_to_epitopes(track(spark, [0.9, 0.9, 0.9, 0.1, 0.9, 0.9, 0.9]), 0.5, 7, 2, 1, 3).first()
    assert row.mean_score == pytest.approx((6 * 0.9 + 0.1) / 7)


def test_bad_sizes_are_errors(spark):
    with pytest.raises(ValueError):
        spans(spark, [0.9], 0)
