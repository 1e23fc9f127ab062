from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from surveyfold.llm import mixing as op
from surveyfold.llm.common import read

from .helpers import empty_docs, rows, words


def plain_targets(sizes):
    """min(2 size, level * weight) for the level that gives the total, by bisection."""
    weights = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    total = 1.5 * sum(sizes)
    lo, hi = 0.0, 4.0 * max(sizes, default=0) + 1
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(2 * s, mid * w) for s, w in zip(sizes, weights, strict=True)) < total else (lo, mid)
    return [min(2 * s, hi * w) for s, w in zip(sizes, weights, strict=True)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 5, 900, 3], [0, 0, 7], [5], [], [0], list(range(40))])
def test_targets(sizes):
    assert op.targets(sizes) == pytest.approx(plain_targets(sizes), rel=1e-9, abs=1e-6)


def test_tree_gives_exact_sums():
    quotas = [1000, 0, 37, 412]
    out = op.split_tree(quotas, 13, 5)
    assert out.sum(axis=0).tolist() == quotas and (out >= 0).all()
    total = sum(quotas)
    assert out.sum(axis=1).tolist() == [total * (k + 1) // 13 - total * k // 13 for k in range(13)]
    assert (op.split_tree(quotas, 13, 5) == out).all() and (op.split_tree(quotas, 13, 6) != out).any()


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    i = np.arange(n)
    p = op.permuted(i, np.full(n, n), np.full(n, 99, dtype=np.uint64))
    assert sorted(p) == list(range(n))


def test_documents_add_up_to_the_targets(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = op.taken_per_document(op.mix(docs)).collect()
    table = {r.doc_id: r for r in docs.collect()}
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in got:
        assert r["size"] == len(words(table[r.doc_id].text)) and 0 <= r.taken <= 2 * r["size"]
        s = by[table[r.doc_id].source]
        s[0], s[1], s[2] = s[0] + r["size"], s[1] + r.taken, r.target
        assert r.source_size >= r["size"]
    names = sorted(by)
    assert [by[n][2] for n in names] == pytest.approx(plain_targets([by[n][0] for n in names]))
    for n in names:
        assert abs(by[n][1] - by[n][2]) <= max(2, 0.002 * by[n][2])


def test_reruns_agree_however_the_table_is_split(spark, docs):
    one = sorted(map(repr, rows(op.taken_per_document(op.mix(docs.repartition(1))))))
    many = sorted(map(repr, rows(op.taken_per_document(op.mix(docs.repartition(7, "n_chars"))))))
    assert one == many


def test_awkward_rows(spark, docs):
    got = op.taken_per_document(op.mix(docs)).collect()
    assert len(got) == docs.count()
    assert all(r.taken == 0 and r["size"] == 0 for r in got if r.doc_id in (6, 7, 8))
    nulls = [r for r in got if r.doc_id is None]
    assert len(nulls) == 2 and {r["size"] for r in nulls} == {0, 40}
    assert rows(op.mix(empty_docs(spark))) == []


def test_pieces_are_disjoint_within_a_copy(spark, docs):
    seen = defaultdict(list)
    for r in op.mix(docs).filter("words > 0").collect():
        seen[r["__row_tag"], r.copy].append((r.first_word, r.first_word + r.words))
        assert r.shard >= 0
    for spans in seen.values():
        spans.sort()
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_stage_gives_the_words_that_are_taken(spark, docs):
    out = op.mixed_documents(docs)
    assert out.columns == docs.columns
    whole = {(r.doc_id, r.text) for r in docs.collect()}
    taken = sum(r.taken for r in op.taken_per_document(op.mix(docs)).collect())
    got = out.collect()
    assert sum(len(words(r.text)) for r in got) == taken
    for r in got:
        assert r.n_chars == len(r.text) and any(d == r.doc_id and r.text in (t or "") for d, t in whole)
    assert rows(op.mixed_documents(empty_docs(spark))) == []
    assert Fraction(3, 2) == op.SHARE


def test_shards_hold_the_quotas_of_the_tree(spark, monkeypatch):
    monkeypatch.setattr(op, "SHARD_WORDS", 20_000)
    docs = op.tag_rows(read(spark, "/root/testdata/sf0.01", "documents"), "mix-test")
    plans = {s["source"]: s for s in op.plan(op.source_line(docs, 7), 7)}
    runs = op.drawn_runs(op.mix(docs)).join(docs.select(op.ROW, "source"), op.ROW)
    got = {(r.source, r["__shard"]): r["n"] for r in runs.groupBy("source", "__shard").agg({"__words": "sum"}).toDF("source", "__shard", "n").collect()}
    for name, s in plans.items():
        quotas = np.diff(s["shard_ends"], prepend=0)
        assert len(quotas) > 10
        q = s["source_size"] // s["blocks"]
        partial = s["draws"] if s["rest"] else -1                   # the draw that is taken in part
        for shard, quota in enumerate(quotas.tolist()):
            cut = s["shard_ends"][shard] - quota <= partial < s["shard_ends"][shard]
            assert (quota - cut) * q <= got.get((name, shard), 0) <= quota * (q + 1)


def test_tree_of_large_quotas():
    quotas = [10**12, 0, 600_000_000, 3 * 10**12, 5]
    out = op.split_tree(quotas, 64, 7)
    assert out.sum(axis=0).tolist() == quotas and (out >= 0).all()
    total = sum(quotas)
    assert out.sum(axis=1).tolist() == [total * (k + 1) // 64 - total * k // 64 for k in range(64)]
    assert (op.split_tree(quotas, 64, 7) == out).all()
    # a shard's share of a source has the spread of a hypergeometric count
    for k in (0, 3):
        p, n = quotas[k] / total, total / 64
        z = (out[:, k] - n * p) / np.sqrt(n * p * (1 - p) * (1 - 1 / 64))
        assert abs(z.mean()) < 1e-6 and 0.7 < z.std() < 1.3


@pytest.mark.parametrize("urn", [(7, 12, 9), (300, 40, 100), (2000, 5000, 3000), (1, 9, 4), (5, 3, 7)])
def test_large_draws_have_the_hypergeometric_law(urn):
    from math import comb
    good, bad, drawn = urn
    rng = np.random.default_rng(3)
    got = np.bincount([op.large_hypergeometric(rng, *urn) for _ in range(20_000)], minlength=good + 1)
    want = np.array([comb(good, x) * comb(bad, drawn - x) / comb(good + bad, drawn) if 0 <= drawn - x <= bad else 0.0
                     for x in range(good + 1)])
    assert (got[want == 0] == 0).all()
    assert np.abs(np.cumsum(got) / 20_000 - np.cumsum(want)).max() < 0.02


def test_draws_without_choice():
    rng = np.random.default_rng(1)
    assert [op.large_hypergeometric(rng, *u) for u in [(0, 5, 3), (5, 0, 3), (5, 4, 0), (5, 4, 9)]] == [0, 3, 0, 5]


def test_a_shard_is_written_by_several_tasks(spark, monkeypatch):
    docs = read(spark, "/root/testdata/sf0.001", "documents")
    plain = sorted(map(repr, rows(op.mixed_documents(docs))))
    monkeypatch.setattr(op, "TASK_WORDS", 10_000)
    assert op.mix_and_slices(docs)[1] >= 2
    merged = "spark.sql.adaptive.coalescePartitions.enabled"     # of small partitions, as these are
    before = spark.conf.get(merged)
    spark.conf.set(merged, "false")
    try:
        parts = op.mixed_documents(docs).rdd.glom().map(len).collect()
    finally:
        spark.conf.set(merged, before)
    assert sum(n > 0 for n in parts) > 1 and sum(parts) == len(plain)
    assert sorted(map(repr, rows(op.mixed_documents(docs)))) == plain


def test_ids_of_any_type(spark, docs):
    named = docs.selectExpr("concat('p', doc_id) AS doc_id", "text", "source")
    got = op.taken_per_document(op.mix(named)).collect()
    assert len(got) == docs.count() and {r.doc_id for r in got} == {r.doc_id for r in named.collect()}
