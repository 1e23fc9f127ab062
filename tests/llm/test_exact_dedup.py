import hashlib
from collections import defaultdict

from surveyfold.llm import exact_dedup as op

from .helpers import empty_docs, norm, rows


def model(table):
    groups = defaultdict(list)
    for r in table:
        groups[norm(r.text)].append(r)
    out = []
    for text, same in groups.items():
        best = min(same, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for r in same:
            stays = not kept and r is best
            kept |= stays
            out.append((r.doc_id, best.doc_id, len(same), stays, sha))
    return out


def test_rows_equal_the_plain_rule(docs):
    got = rows(op.exact_dedup(docs).drop("__row_tag"))
    assert sorted(map(repr, got)) == sorted(map(repr, model(docs.collect())))


def test_tree_shape_does_not_matter(docs):
    runs = op.digest_runs(docs)
    want = sorted(map(repr, rows(op.merge_tree(runs, fan_in=2, n_runs=2))))
    for fan_in, n in ((2, 13), (3, 27), (16, 200)):
        assert sorted(map(repr, rows(op.merge_tree(runs, fan_in, n)))) == want


def test_one_text_in_very_many_rows_is_one_group(spark):
    many = spark.range(4000).selectExpr("id as doc_id", "'same' as text").repartition(64)
    plan = op.merge_tree(op.digest_runs(many), fan_in=4, n_runs=64)
    assert rows(plan.select("group_size")) == [(4000,)]


def test_stage_keeps_one_row_and_all_columns(spark, docs):
    kept = op.keep_one(docs)
    assert kept.schema == docs.schema
    assert kept.count() == len({norm(r.text) for r in docs.collect()})


def test_empty_table(spark):
    assert rows(op.exact_dedup(empty_docs(spark))) == []
    assert rows(op.keep_one(empty_docs(spark))) == []
