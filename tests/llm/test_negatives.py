import math

import numpy as np
import pytest

from surveyfold.llm import negatives as op

from .helpers import rows

SCHEMA = "vec_id long, embedding array<float>, label int, tag long, block long, score long, v string"


def plain(table, every=100):
    """Every anchor against every row, by the contract's words."""
    fit = []
    for i, v, label in table:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for n, (i, v, label) in enumerate(fit):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, k) for m, (j, w, k) in enumerate(fit)
                        if m != n and len(w) == len(v))
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            window = [(s, j) for s, j, k in scored if k != label and 30 * -ps <= 100 * -s <= 90 * -ps][:10]
            out += [(i, p, r + 1, j, -ps, -s) for r, (s, j) in enumerate(window)]
    return out


def frame(spark, table):
    return spark.createDataFrame([(*r, 1, 2, 3, "v") for r in table], SCHEMA).repartition(3)


def clustered(seed, n, dims=6, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dims))
    return [(i, (centres[i % 5] * rng.uniform(0.2, 1) + rng.normal(scale=0.2, size=dims)).astype(np.float32).tolist(),
             int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("block_rows", [16, 2048])
def test_against_brute_force_with_awkward_rows(spark, monkeypatch, block_rows):
    monkeypatch.setattr(op, "ZONES", 4)
    monkeypatch.setattr(op, "GROUP", 3)
    table = clustered(block_rows, 420)
    same = table[3][1]
    table += [(500, same, 1), (501, same, 1), (502, same, 2), (503, same, 3), (700, same, 1),         # ties
              (505, None, 1), (600, [0.0] * 6, None), (507, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (508, [math.nan] * 6, 1),
              (509, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0], 2), (None, same, 1), (800, [0.0] * 6, 2), (900, [3e5, -2e5, 0.0, 0.0, 0.0, 1.0], 1),
              (901, [2e5, -1e5, 0.0, 0.0, 0.0, 1.0], 1), (902, [1e5, -1e5, 0.0, 0.0, 0.0, 1.0], 2),
              (1000, [1.0, 2.0], 1), (1001, [1.0, 1.5], 1), (1002, [0.5, 1.0], 2), (1100, [], 1), (1101, [], 1), (1103, [], 2)]
    got = rows(op.hard_negatives(frame(spark, table), block_rows=block_rows))
    assert sorted(got) == sorted(plain(table)) and len(got) > 50


def test_repeated_ids_are_rows_of_their_own(spark):
    table = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.5, 0.0], 2)]
    got = rows(op.hard_negatives(frame(spark, table)))
    assert sorted(got) == sorted(plain(table)) and len(got) == 4


def test_empty_and_without_anchors(spark):
    for table in ([], [(1, [1.0], 1), (2, [1.0], 2)], [(100, [1.0], 1), (1, [1.0], 2)], [(100, [-1.0], 1), (1, [1.0], 1)]):
        got = op.hard_negatives(spark.createDataFrame([(*r, 1, 2, 3, "v") for r in table], SCHEMA))
        assert rows(got) == []
        assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_zone_bounds_hold_and_leave_blocks_out():
    rng = np.random.default_rng(3)
    queries = rng.integers(-300, 300, (20, 5))
    cells = [rng.integers(-50, 50, 5) + rng.integers(0, 9, (30, 5)) for _ in range(12)]
    low, high = (np.array([getattr(c, f)(axis=0) for c in cells]) for f in ("min", "max"))
    least, most = op.bounds(queries, low, high)
    for z, c in enumerate(cells):
        s = queries @ c.T
        assert (s.min(axis=1) >= least[:, z]).all() and (s.max(axis=1) <= most[:, z]).all()
    q = {"rows": queries, "anchor": np.arange(20), "labels": np.zeros(20, int), "low": least.max(axis=1).astype(np.int64),
         "high": np.full(20, op.LONG)}
    need, _ = op.window_needs(q, {"low": low, "high": high, "labels": [{0}, {1}] * 6}, np.full(20, -op.LONG), True)
    assert not need[:, 1::2].any() and 0 < need.sum() < 120
