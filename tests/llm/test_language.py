import zlib

import numpy as np
import pytest

from surveyfold.llm import language as op
from surveyfold.llm import queries
from surveyfold.llm.common import read

from .helpers import empty_docs, rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 8, 40])
def test_codewords_are_apart_and_split_the_languages(n):
    code = op.codewords(n)
    assert len({tuple(r) for r in code}) == n
    if n > 1:
        assert all(len(set(c)) == 2 for c in code.T)
        apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert apart >= (1 if n == 2 else 2)


def test_decoding_mends_a_wrong_bit():
    code = op.codewords(4)
    model = op.Model(list("abcd"), code, np.zeros((1, 1)))
    for k in range(4):
        margins = 3.0 * code[k]
        for bit in range(code.shape[1]):
            wrong = margins.copy()
            wrong[bit] = -0.5 * margins[bit]
            assert model.decode(wrong)[0] == k
    assert model.decode(np.zeros(code.shape[1]))[1] < op.AMBIGUOUS


def test_letters_collapse_everything_else():
    assert "".join(map(chr, op.letters("Été 12--b!"))) == " été b "
    assert "".join(map(chr, op.letters(""))).strip() == ""


def test_grams_do_not_depend_on_chunks(monkeypatch):
    model = op.Model(["a", "b"], op.codewords(2), np.random.default_rng(0).random((op.WIDTH + 1, 1)).astype(np.float32))
    text = "some words that are cut somewhere " * 20
    whole = model.margins(text)
    monkeypatch.setattr(op, "CHUNK", 7)
    part = model.margins(text)
    assert whole[1] == part[1] and np.allclose(whole[0], part[0])


def test_held_out_accuracy(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = queries.op1_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = read(spark, SMALL, "documents")
    from pyspark.sql import functions as F
    spoiled = docs.withColumn("lang", F.when(op.is_held_out(), F.lit("xx")).otherwise(F.col("lang")))
    model = op.fit(spoiled)
    assert "xx" not in model.languages


def test_awkward_rows(spark, docs):
    model = op.fit(docs)
    got = op.predict(docs, model)
    table = {(r.doc_id, r.text) for r in docs.collect()}
    assert got.count() == docs.count()
    und = {r.doc_id for r in got.collect() if r.lang_pred == "und"}
    assert und >= {d for d, t in table if not any(c.isalpha() for c in t or "")} - {None}
    assert 1 not in und and 12 not in und
    kept = op.keep_identified(docs, model)
    assert kept.schema == docs.schema
    assert kept.count() == sum(any(c.isalpha() for c in r.text or "") for r in docs.collect())


def test_nothing_to_learn_from(spark):
    none = op.fit(empty_docs(spark))
    assert none.languages == [] and rows(op.predict(empty_docs(spark), none)) == []
    one = spark.createDataFrame([(0, "hello there", "en"), (3, "hi", "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in op.predict(one, op.fit(one)).collect()} == {"en"}
    assert {r.lang_pred for r in op.predict(one, none).collect()} == {"und"}


def test_nothing_learned_keeps_lettered_texts(spark, docs):
    none = op.fit(docs.filter(op.is_held_out()))
    assert none.languages == []
    kept = op.keep_identified(docs, none)
    assert kept.count() == sum(any(c.isalpha() for c in r.text or "") for r in docs.collect()) > 0
