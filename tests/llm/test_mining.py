"""Hard negatives against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditweave.llm import hard_negatives
from creditweave.llm.hard_negatives import PRIMES, Residues, best_in_rows, exact_scores, primes_for

VECTORS = "vec_id long, embedding array<double>, label int, uid string, v int, marks string, block string"


@pytest.mark.parametrize(("dim", "largest"), [(1, 1), (7, 300), (64, 146), (64, 2**20), (2500, 200), (3, 2**28)])
def test_scores_are_exact(dim, largest):
    rng = np.random.default_rng(dim)
    a, b = (rng.integers(-largest, largest + 1, (n, dim)) for n in (9, 40))
    a[0], b[0], b[1] = largest, largest, -largest
    got = exact_scores(Residues(a), Residues(b), slice(0, 9))
    assert (got == (a.astype(object) @ b.T.astype(object)).astype(np.int64)).all()


def test_scores_of_nothing():
    assert exact_scores(Residues(np.zeros((2, 0), np.int64)), Residues(np.zeros((3, 0), np.int64)), slice(0, 2)).tolist() == [[0] * 3] * 2
    assert exact_scores(Residues(np.zeros((2, 4), np.int64)), Residues(np.zeros((3, 4), np.int64)), slice(0, 2)).tolist() == [[0] * 3] * 2


def test_primes():
    assert len(set(PRIMES)) == len(PRIMES) and all(p < 256 and all(p % k for k in range(2, p)) for p in PRIMES)
    assert np.prod([float(p) for p in primes_for(2**22)]) > 2**23
    with pytest.raises(OverflowError):
        primes_for(2**62)


def test_best_in_rows_takes_ties_from_the_left():
    least = hard_negatives._LEAST
    scores = np.array([[5, 9, 5, 5, 1, 9], [least] * 6, [least, 2, least, 2, 2, least], [3] * 6])
    rows, columns = best_in_rows(scores, 3)
    assert list(zip(rows.tolist(), columns.tolist(), strict=True)) == [(0, 0), (0, 1), (0, 5), (2, 1), (2, 3), (2, 4), (3, 0), (3, 1), (3, 2)]


def test_hundredths():
    for score in (0, 1, -1, 99, 101, -101, 2**60, -(2**60), 12345678901234567):
        for part in (30, 90):
            assert hard_negatives._hundredths(part, np.array([score]))[0] == part * score // 100


def made_vectors(seed=5, n=420):
    rng = random.Random(seed)
    rows = [(k, [rng.gauss(0.05, 0.4) for _ in range(12)], rng.choice([0, 0, 1, 2, 3])) for k in range(n)]
    for k in range(0, n, 3):  # a third of the rows share one vector
        rows[k] = (k, rows[3][1], rows[k][2])
    rows += [(10, None, 1), (None, rows[0][1], 1), (500, rows[1][1], None), (600, [float("nan")] * 12, 1), (601, [float("inf"), *rows[1][1][1:]], 1), (602, [None] * 12, 1)]
    rows += [(700, [0.5] * 5, 1), (701, [0.5] * 5, 1), (702, [0.4] * 5, 2), (800, [], 1), (801, [], 1), (803, [], 2), (900, [2.5] * 3, 77)]
    return rows


def brute(rows, is_anchor):
    """Rows by position, so that a repeated one is another one."""
    taking = [(i, v, label, [int(np.floor(256 * x)) for x in e]) for i, (v, e, label) in enumerate(rows) if v is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for i, anchor, label, a in taking:
        if not is_anchor(anchor):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), v, j, other) for j, v, other, b in taking if j != i and len(a) == len(b))
        for minus, positive, _, _ in [s for s in scored if s[3] == label][:5]:
            fit = [s for s in scored if s[3] != label and -30 * minus <= -100 * s[0] <= -90 * minus][:10]
            out += [(anchor, positive, k, s[1], -minus, -s[0]) for k, s in enumerate(fit, 1)]
    return sorted(out)


def test_mined_rows(spark):
    rows = made_vectors()
    rows += [rows[20], rows[20], rows[40]]
    frame = spark.createDataFrame([(*r, "u", 1, "m", "b") for r in rows], VECTORS).repartition(5)
    got = hard_negatives.mine(frame, F.col("vec_id") % 20 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = brute(rows, lambda v: v % 20 == 0)
    assert {r[0] for r in want} >= {0, 20, 700} and len(want) > 500
    assert sorted(tuple(r) for r in got.collect()) == want


def test_several_blocks_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", 16)
    rows = made_vectors(6, 200)
    frame = spark.createDataFrame([(*r, "u", 1, "m", "b") for r in rows], VECTORS).repartition(3)
    assert sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % 4 == 0).collect()) == brute(rows, lambda v: v % 4 == 0)


def test_nothing_to_mine(spark):
    frame = spark.createDataFrame([(k, [1.0], 0, "u", 1, "m", "b") for k in range(3)], VECTORS)
    assert hard_negatives.mine(frame.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert hard_negatives.mine(frame, F.col("vec_id") > 9).count() == 0
    assert hard_negatives.mine(frame, F.col("vec_id") % 2 == 0).count() == 0
