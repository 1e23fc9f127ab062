import random

import numpy as np
import pytest
import xxhash

from surveyfold.llm import simhash as op
from surveyfold.llm.components import connected_components

from .helpers import empty_docs, rows, words


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def groups(pairs, nodes):
    lead = {n: n for n in nodes}

    def find(x):
        while lead[x] != x:
            x = lead[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        lead[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(docs):
    table = [(r.doc_id, r.text) for r in docs.collect()]
    fp = [plain_fingerprint(t) for _, t in table]
    near = [(i, j) for i in range(len(fp)) for j in range(i) if (fp[i] ^ fp[j]).bit_count() <= 2]
    of = groups(near, range(len(fp)))
    least = {}
    for i, (d, _) in enumerate(table):
        if d is not None:
            least[of[i]] = min(least.get(of[i], d), d)
    want = [(d, f"{fp[i]:016x}", least.get(of[i])) for i, (d, _) in enumerate(table)]
    got = rows(op.near_duplicates(docs).select("doc_id", "fingerprint", "component_id"))
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def clusters(seed, n):
    rng = random.Random(seed)
    out = set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(n):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out | {0, 1, (1 << 64) - 1, 1 << 63})


def brute_pairs(values, budget):
    return {(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= budget}


@pytest.mark.parametrize("most_leaves", [1, 7, 50_000])
@pytest.mark.parametrize("budget", [0, 1, 2, 3])
def test_links_equal_all_pairs(spark, most_leaves, budget):
    values = clusters(budget, 120)
    table = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in op.links(table, budget, most_leaves).collect()]
    found = [(max(p), min(p)) for p in found]
    assert len(found) == len(set(found))              # each link once
    assert set(found) == brute_pairs(values, budget)


def test_trie_walk_in_small_frontiers(monkeypatch):
    monkeypatch.setattr(op, "FRONTIER", 3)
    values = clusters(9, 60)
    arr = np.array(values, dtype=np.uint64)
    n = np.array([len(arr)])
    zero = np.array([0])
    got = {(values[max(i, j)], values[min(i, j)]) for a, b in op.trie_pairs(arr, 2, (zero, n, zero, n, zero, zero))
           for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    assert got == brute_pairs(values, 2)


def test_long_chain_of_links(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (5, 5), (0, 1)]
    out = dict(rows(connected_components(spark.createDataFrame(chain, "a long, b long"))))
    assert len({out[i] for i in range(301)}) == 1 and out[1000] == out[1001] != out[0]
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []


def test_stage_keeps_one_of_each_group(spark, docs):
    kept = op.keep_one(docs)
    assert kept.schema == docs.schema
    want = {r.component_id for r in op.near_duplicates(docs).collect()}
    assert kept.count() == len(want) == len({r.doc_id for r in kept.collect()})
    assert rows(op.keep_one(empty_docs(spark))) == []
