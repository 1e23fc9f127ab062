import random

import numpy as np
import pytest

from surveyfold.llm import minhash as op

from .helpers import DOCS, empty_docs, rows, words


def plain_set(text, size=5):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def plain(table, percent=85):
    """doc_id, n_shingles, component_id, kept by comparing every two rows."""
    sets = [plain_set(t) for _, t in table]
    lead = list(range(len(sets)))

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                lead[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(table):
        least.setdefault(find(i), []).extend([d] if d is not None else [])
    out = []
    for i, (d, _) in enumerate(table):
        c = min(least[find(i)], default=None) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return out


def same(got, table):
    assert sorted(map(repr, rows(got))) == sorted(map(repr, plain(table)))


def test_awkward_rows_against_brute_force(docs):
    same(op.near_duplicates(docs), [(r.doc_id, r.text) for r in docs.collect()])


def family(rng, n, copies, edits):
    """Copies of a text, each with a few words of its own, and copies of some copies."""
    base = [f"w{rng.randrange(5000)}" for _ in range(n)]
    out = [" ".join(base)]
    for _ in range(copies):
        w = (rng.choice(out).split() if rng.random() < 0.5 else list(base))
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 9)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("kept,short,block", [(256, 48, 1000), (40, 4, 10)])
def test_families_against_brute_force(spark, monkeypatch, kept, short, block):
    """Small limits send the families through long lists, blocks and the second step."""
    monkeypatch.setattr(op, "SHORT", short)
    monkeypatch.setattr(op, "BLOCK", block)
    rng = random.Random(kept)
    texts = family(rng, 60, 40, 3) + family(rng, 150, 50, 6) + family(rng, 400, 25, 14) + family(rng, 8, 6, 1)
    passage = " ".join(f"p{i}" for i in range(60))               # shared by texts that are not alike
    texts += [passage + " " + t for t in family(rng, 20, 20, 20)]
    rng.shuffle(texts)
    table = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, *[None] * 9) for i, t in table], DOCS)
    same(op.near_duplicates(df, kept=kept), table)


def test_empty_table_and_schema(spark):
    got = op.near_duplicates(empty_docs(spark))
    assert rows(got) == [] and got.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_ids_of_another_type(spark):
    df = spark.createDataFrame([("b", "one two three four five six"), ("a", "One two three\tfour five six"), ("c", "")], "doc_id string, text string")
    assert sorted(rows(op.near_duplicates(df))) == [("a", 2, "a", True), ("b", 2, "a", False), ("c", 0, "c", True)]


def test_a_threshold_hit_exactly_links(spark):
    """17 of 20 shingles shared is 85 in 100."""
    base = [f"w{i}" for i in range(100)]
    a, b = base[:23], base[:21] + ["x"]                          # 19 and 18 shingles, 17 shared, union 20
    assert len(plain_set(" ".join(a)) & plain_set(" ".join(b))) == 17
    df = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
    assert [r.component_id for r in op.near_duplicates(df).orderBy("doc_id").collect()] == [1, 1]


def test_overlaps_of_thin_and_common_values(monkeypatch):
    monkeypatch.setattr(op, "THIN", 3)
    rng = np.random.default_rng(1)
    values = [np.unique(rng.integers(0, 60, rng.integers(0, 30))) for _ in range(25)]
    got = op.overlaps(np.repeat(np.arange(25), [len(v) for v in values]), np.concatenate(values), 25)
    for i in range(25):
        for j in range(25):
            assert i == j or got[i, j] == len(np.intersect1d(values[i], values[j]))


def test_no_linked_pair_is_dropped_by_the_estimate():
    rng = np.random.default_rng(2)
    for n in (100, 300, 900, 4000):
        for _ in range(60):
            union = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            shared = -(-85 * len(union) // 100)
            own = rng.permutation(union)
            cut = rng.integers(shared, len(union) + 1)
            a, b = np.sort(own[:cut]), np.sort(np.concatenate([own[:shared], own[cut:]]))
            assert op.verdict(a[:256], b[:256], len(a), len(b)) > 0
            both = len(np.intersect1d(a[:256], b[:256]))
            assert both >= max(op.needed(len(a)), op.needed(len(b)))
    assert [op.least_shared(u) for u in (100, 256)] == [85, 218]
    assert op.least_shared(10 ** 7) < op.least_shared(500) < 218
