import math
import random

import numpy as np
import pytest

from rainledger.llm import whitening
from rainledger.llm.whitening import whitened


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 1, [0]) for i, v in rows], "vec_id long, embedding array<float>, n int, x array<int>").repartition(parts)


def brute(rows, k):
    """By the covariance, in long doubles; vectors as integers by Python's own."""
    own = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in own})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in own:
        c = np.array([(n * x[j] - sums[j]) / n for j in range(d)])
        for j in range(min(k, d)):
            out.setdefault((i, j + 1), []).append((n, sum((n * a - b) ** 2 for a, b in zip(x, sums)), float(c @ vectors[:, j]) / values[j] ** 0.5, values[j] / values.sum()))
    return out


@pytest.mark.parametrize("d,rows,block", [(5, 60, 4096), (20, 400, 7), (20, 21, 4096)])
def test_against_brute_force(spark, monkeypatch, d, rows, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    monkeypatch.setattr(whitening, "FAN", 2)
    dice = np.random.default_rng(d)
    data = [(i, (dice.normal(size=d) * np.linspace(3, 0.5, d) + 100).tolist()) for i in range(rows)]
    data += [(k, data[0][1]) for k in range(rows, rows + 200)]  # one vector in many rows counts once
    data += [(None, data[1][1]), data[2]]
    odd = [(9001, None), (9002, []), (9003, [1.0] * (d - 1)), (9004, [None] + [1.0] * (d - 1)), (9005, [math.nan] * d), (9006, [math.inf] + [0.0] * (d - 1))]
    got = whitened(frame(spark, data + odd, 7)).collect()
    want = brute(data, 16)
    k = min(d, 16)
    assert len(got) == len(data) * k
    own = {}
    for r in got:
        own.setdefault((r.vec_id, r.component), []).append(r)
    assert {x: len(v) for x, v in own.items()} == {x: len(v) for x, v in want.items()}
    sign = {j: np.sign(own[0, j][0].whitened * want[0, j][0][2]) for j in range(1, k + 1)}
    for (i, j), rs in own.items():
        for r, w in zip(rs, want[i, j]):
            assert (r.n, r.deviation) == w[:2]
            assert r.whitened * sign[j] == pytest.approx(w[2], abs=1e-7) and r.explained == pytest.approx(w[3], rel=1e-9)
            assert r.identity_error < 1e-9


def test_flat_directions_have_no_component(spark):
    dice = random.Random(2)
    rows = [(i, [a := dice.random() * 50, a, 7.0, dice.random()]) for i in range(90)]
    got = whitened(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 180 and got[0].identity_error < 1e-6
    assert whitened(frame(spark, [(i, [1.0, 2.0]) for i in range(5)])).collect() == []
    assert whitened(frame(spark, [(1, None)])).collect() == []
    assert whitened(frame(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_far_entries(spark):
    rows = [(0, [3e38, 1.0]), (1, [-3e38, 2.0]), (2, [0.0, 5.0]), (3, [1e12, 1.0])]
    got = whitened(frame(spark, rows)).collect()
    assert len(got) % 4 == 0 and {r.n for r in got} == {4}
    assert all(r.deviation is None for r in got if r.vec_id in (0, 1))


def test_large_offset_keeps_precision(spark):
    dice = np.random.default_rng(1)
    rows = [(i, [1e7 + float(a), 5e6 + float(b)]) for i, (a, b) in enumerate(dice.integers(0, 9, (500, 2)))]
    got = whitened(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and got[0].identity_error < 1e-9
