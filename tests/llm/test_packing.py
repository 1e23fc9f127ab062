import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from surveyfold.llm import packing as op
from surveyfold.llm.common import tokenizer

from .helpers import empty_docs, prose, rows

PATH = tokenizer("word_bpe_49k.json")
ODD = ["don't it'S «Straße» ΑΣ. ΑΣ.a ΟΔΟΣ… x—y İstanbul ﬁne é ≠ <|endoftext|> a<|startoftext|>b 12345 ½ ٣٤ 日本語",
       "", " \n\t ", "\x00\x85 Ώx", "ÀÉ! ß? ÿ% Ŀ· ŉx", "a''b it's***'s ***'sé a<| |> b<|", "z z q\x1fr s", "a≠ b.́"]


def plain_ids(texts):
    return [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("known", [0, 5, 400_000])
def test_ids_equal_the_tokenizers_own(monkeypatch, known):
    monkeypatch.setattr(op, "MOST_KNOWN", known)
    monkeypatch.setattr(op, "GATHER_WORDS", 9)
    t = op.WordTokenizer(PATH)
    for texts in (ODD, [prose(i, 30) + "!?" for i in range(40)] + ODD, ODD[::-1]):
        got = []
        for first, f in t.encode(pa.array(texts)):
            assert first == len(got)
            got += [f.ids[a:a + n].tolist() for a, n in zip(f.starts, f.sizes, strict=True)]
        assert got == plain_ids(texts)


def test_hilbert_curve_visits_neighbours():
    for bits, dims in ((2, 2), (3, 2), (2, 3)):
        cells = np.array(np.meshgrid(*[range(1 << bits)] * dims)).reshape(dims, -1).T
        index = op.hilbert_index(cells, bits)
        assert sorted(index) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def check_pieces(table, got, length):
    ids = {}
    for d, t in table:
        ids.setdefault(d, []).append([*plain_ids([t or ""])[0], 2])
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        if len(ids[d]) == 1:                          # ids that do not repeat
            at, own = 0, np.array(ids[d][0], dtype="<u4")
            for r in sorted(pieces, key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(own))
                assert r.ids_crc32 == zlib.crc32(own[at:at + r.length].tobytes())
                at += r.length
            assert at == len(own)
        else:
            assert sum(r.length for r in pieces) == sum(map(len, ids[d]))
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == length or at & (at - 1) == 0     # no padding
    return by_seq


@pytest.mark.parametrize("length", [64, 4096])
def test_every_id_is_in_one_piece(spark, docs, length):
    table = [(r.doc_id, r.text) for r in docs.collect()]
    got = op.pack(docs, PATH, length=length).collect()
    check_pieces(table, got, length)
    assert sorted(map(repr, got)) == sorted(map(repr, op.pack(docs, PATH, length=length).collect()))


def test_ids_come_with_the_pieces(spark, docs):
    for r in op.pack(docs, PATH, with_ids=True).collect():
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32


def test_like_documents_are_neighbours(spark):
    kinds = [("alpha beta gamma delta epsilon", "a"), ("ein zwei drei vier fünf sechs", "b"), ("rojo verde azul negro", "c")]
    table = [(i, " ".join(sorted(kinds[i % 3][0].split() * 8, key=lambda w: hash((w, i)))), kinds[i % 3][1]) for i in range(90)]
    df = spark.createDataFrame(table, "doc_id long, text string, kind string")
    place = {r.doc_id: (r.sequence_id, r.offset) for r in op.pack(df, PATH).collect()}
    order = [table[d][2] for d in sorted(place, key=place.get)]
    assert sum(a != b for a, b in zip(order, order[1:], strict=False)) < 12


def test_empty_table(spark):
    assert rows(op.pack(empty_docs(spark), PATH)) == []
