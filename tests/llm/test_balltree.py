import math

import numpy as np
import pytest

from surveyfold.llm import balltree as op

from .helpers import rows

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank int, shard string"


def table(seed, n=400, dims=6):
    rng = np.random.default_rng(seed)
    out = [(int(i), [float(x) for x in rng.normal(size=dims).astype(np.float32)]) for i in rng.permutation(n)]
    out += [(50, out[3][1]), (50, out[3][1]), (7, out[5][1]), (100, out[0][1])]                # ids and vectors that repeat
    out += [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [float("nan")] * 6), (1150, [float("inf")] * 6)]
    out += [(None, out[0][1]), (1200, [0.5, 0.25]), (1201, [1.0, 1.0]), (1250, []), (1251, [])]
    return [(i, v, 0, 9, 9, "s") for i, v in out]


def model(data, k=5, every=50):
    ok = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v, *_) in enumerate(data)
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, q in ok:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for m, j, c in ok if m != n and len(c) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return out


@pytest.mark.parametrize("shard_rows,block", [(10_000, 512), (40, 3), (7, 1)])
def test_equal_to_all_products(spark, shard_rows, block):
    data = table(shard_rows)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = rows(op.top_k(df, shard_rows=shard_rows, block_queries=block))
    assert sorted(got) == sorted(model(data))


def test_fewer_candidates_than_k_and_ties(spark):
    data = [(0, [1.0, 0.0], 0, 0, 0, ""), (5, [0.0, 1.0], 0, 0, 0, ""), (3, [0.0, 1.0], 0, 0, 0, "")]
    assert rows(op.top_k(spark.createDataFrame(data, SCHEMA)).orderBy("rank")) == [(0, 1, 3, 0), (0, 2, 5, 0)]
    assert rows(op.top_k(spark.createDataFrame(data[:1], SCHEMA))) == []
    assert rows(op.top_k(spark.createDataFrame([], SCHEMA))) == []


def test_very_large_components_do_not_crash(spark):
    data = [(0, [1e30, -1e30], 0, 0, 0, ""), (1, [1e30, 1.0], 0, 0, 0, ""), (2, [1e8, 3.0], 0, 0, 0, "")]
    got = rows(op.top_k(spark.createDataFrame(data, SCHEMA)).orderBy("rank"))
    assert [(r[0], r[2]) for r in got] == [(0, 1), (0, 2)] and got[0][3] == op.LONG


def test_bound_covers_every_row_of_a_node():
    rows_ = np.random.default_rng(1).integers(-900, 900, (700, 9))
    tree = op.build_tree(rows_, leaf=8)
    q = np.random.default_rng(2).integers(-900, 900, (20, 9))
    for lo, hi, c, r in zip(tree["lo"], tree["hi"], tree["centre"], tree["radius"], strict=True):
        best = (q @ rows_[tree["order"][lo:hi]].T).max(axis=1)
        assert (best <= q @ c + np.linalg.norm(q, axis=1) * r + 1e-6).all()


def test_clustered_nodes_are_left_out(monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8)) * 5000
    rows_ = (np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 8)) * 10).astype(np.int64)
    seen = []
    real = op.products
    monkeypatch.setattr(op, "products", lambda q, r: seen.append(len(r) * len(q)) or real(q, r))
    tree, ids = op.build_tree(rows_), np.arange(2000)
    op.search(tree, rows_, ids, ids, rows_[:1], ids[:1], np.array([-op.LONG]), 5)
    assert sum(seen) < 400
