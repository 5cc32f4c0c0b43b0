"""Hard negatives against all scores of all anchors."""

import math
import random

import numpy as np
import pytest
from corpus_cases import found  # noqa: F401

from kilnstream.llm import hard_negatives
from kilnstream.llm.hard_negatives import distances, homes, lifted, plant, surviving

SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank int"


def brute(rows, every=100, n_positives=5, n_negatives=10):
    whole = {}
    for vec_id, vector, label in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        made = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        whole[vec_id] = min(made, whole.get(vec_id, made))
    out = []
    for anchor, (label, vector) in whole.items():
        if anchor % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(vector, other, strict=False)), i, own == label)
                        for i, (own, other) in whole.items() if i != anchor)
        for score, positive, _ in [row for row in scores if row[2]][:n_positives]:
            fits = [(-s, i) for s, i, same in scores
                    if not same and 30 * -score <= 100 * -s <= 90 * -score]
            out += [(anchor, positive, n + 1, i, -score, s)
                    for n, (s, i) in enumerate(fits[:n_negatives])]
    return sorted(out, key=repr)


def cloud(n, width, seed, hot=0.0):
    random.seed(seed)
    centres = [[random.gauss(0, 1) for _ in range(width)] for _ in range(8)]
    rows = []
    for i in range(n):
        centre = random.choice(centres)
        vector = centres[0] if random.random() < hot else [c + random.gauss(0, 0.3) for c in centre]
        rows.append((i * 5 + 100 * (i % 2), vector, random.randint(0, 9)))
    return rows


@pytest.mark.parametrize("width, hot, sample, arity, levels", [
    (6, 0.0, 64, 5, 2), (3, 0.4, 4096, 12, 2), (2, 0.0, 10, 2, 4), (5, 0.0, 4096, 12, 0)])
def test_equal_brute_force(spark, found, monkeypatch, width, hot, sample, arity, levels):
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "SEARCH_BLOCK", 7)
    rows = cloud(500, width, width, hot)
    rows += [(7001, None, 1), (None, [1.0] * width, 1), (7002, [1.0] * width, None),
             (7003, [float("nan")] * width, 1), (7004, [float("inf")] * width, 2),
             (7005, [None] * width, 2), (7006, [], 3), (7100, [], 3), (7007, [0.5], 4),
             (7100, [1.0] * width, 1), rows[0], rows[0], (-100, [1.0] * width, 5),
             (7200, [-0.1] * width, 6), (7300, [0.0] * width, 7)]
    frame = spark.createDataFrame([(*row, "own", 5) for row in rows], SCHEMA).repartition(5)
    result = hard_negatives.mine(frame, sample=sample, arity=arity, levels=levels)
    assert result.columns == ["anchor_id", "positive_id", "rank", "negative_id",
                              "positive_score", "negative_score"]
    expected = brute(rows)
    assert len(expected) > 50
    assert found(result) == expected


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty).count() == 0
    lonely = spark.createDataFrame([(100, [1.0], 1, "", 0), (200, [1.0], 2, "", 0)], SCHEMA)
    assert hard_negatives.mine(lonely).count() == 0


def test_large_components_stay_exact(spark, found):
    rows = [(i * 50, [float(2 ** 17 - i), 2.0 ** 18, float(i)], i % 3) for i in range(40)]
    frame = spark.createDataFrame([(*row, "", 0) for row in rows], SCHEMA)
    assert found(hard_negatives.mine(frame)) == brute(rows)


def test_ranges_leave_out_subtrees_and_no_row_of_the_annulus():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (6, 4))
    rows = (centres[rng.integers(0, 6, 900)] + rng.normal(0, 15, (900, 4))).astype(np.int64)
    square = float((rows * rows).sum(axis=1).max()) + 1
    tree = plant(rows[:200], square, 4, 4, 2)
    high_rows = lifted(rows, square)
    ranges = {}

    def seen(node, child, apart):
        for point, column in enumerate(apart.T):
            low, high = ranges.get((node, child, point), (np.inf, -np.inf))
            ranges[node, child, point] = min(low, column.min()), max(high, column.max())

    leaf = homes(tree, high_rows, seen)
    around = np.hstack([rows[:50], np.zeros((50, 1))])
    apart = distances(around, high_rows)
    low = np.sort(apart, axis=1)[:, 10]
    high = np.sort(apart, axis=1)[:, 30]
    own, kept = surviving(tree, ranges, around, low, high)
    pairs = set(zip(own.tolist(), kept.tolist(), strict=True))
    inside = (apart >= low[:, None]) & (apart <= high[:, None])
    assert all((s, leaf[r]) in pairs for s, r in zip(*np.nonzero(inside), strict=True))
    assert len(pairs) < 0.7 * 50 * tree.n_leaves
