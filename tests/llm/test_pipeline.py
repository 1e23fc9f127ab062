import importlib
from collections import Counter

import corpus_pipeline as cp
import pytest

from surveyfold.llm import mixing, packing
from surveyfold.llm.common import tokenizer

from .helpers import empty_docs, norm, words
from .test_simhash import groups, plain_fingerprint

SF = "/root/testdata/sf0.001"


def follow(spark, docs, folder):
    out = [docs]
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def plain_survivors(table):
    """Row numbers that stay after language ID, exact and near dedup."""
    left = [k for k, r in enumerate(table) if any(c.isalpha() for c in r.text or "")]
    best = {}
    for k in left:
        r = table[k]
        rank = (-len(r.text), r.doc_id is None, r.doc_id or 0)
        key = norm(r.text)
        if key not in best or rank < best[key][0]:
            best[key] = (rank, k)
    left = [k for _, k in best.values()]
    fp = {k: plain_fingerprint(table[k].text) for k in left}
    near = [(a, b) for i, a in enumerate(left) for b in left[:i] if (fp[a] ^ fp[b]).bit_count() <= 2]
    of = groups(near, left)
    head = {}
    for k in left:
        rank = (table[k].doc_id is None, table[k].doc_id or 0)
        if of[k] not in head or rank < head[of[k]][0]:
            head[of[k]] = (rank, k)
    return [k for _, k in head.values()]


@pytest.mark.parametrize("which", ["driver", "awkward"])
def test_stages_equal_a_plain_run(spark, docs, tmp_path, which):
    given = docs if which == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    tables = follow(spark, given, tmp_path)
    assert len(cp.STAGES) == 5 and cp.ORACLE_SQL is None
    table = given.collect()
    for t in tables[1:-1]:
        assert t.columns == given.columns
    stay = plain_survivors(table)
    seen = lambda r: (r.doc_id, r.text, r.lang, r.source)
    assert Counter(map(seen, tables[3].collect())) == Counter(seen(table[k]) for k in stay)
    mixed = tables[4].collect()
    kept = {}
    for r in tables[3].collect():
        kept.setdefault(r.doc_id, []).append(r)
    by = Counter()
    for r in mixed:
        assert any(r.text in k.text and r.source == k.source for k in kept[r.doc_id])
        by[r.source] += len(words(r.text))
    names = sorted({r.source for r in tables[3].collect()}, key=lambda s: (s is None, s or ""))
    sizes = [sum(len(words(r.text)) for v in kept.values() for r in v if r.source == n) for n in names]
    for n, want in zip(names, mixing.targets(sizes), strict=True):
        assert abs(by[n] - want) <= max(2, 0.01 * want)
    texts = Counter()
    for r in tables[5].collect():
        texts[r.sequence_id] += r.length
    ids = packing.WordTokenizer(tokenizer("word_bpe_49k.json"))
    assert sum(texts.values()) == sum(len(ids.tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed)


def test_run_gives_the_last_stage(spark):
    out = cp.run(spark, SF)
    assert {"doc_id", "sequence_id", "offset", "length", "ids_crc32"} <= set(out.columns) and out.count() > 0


def test_empty_table(spark, tmp_path):
    assert follow(spark, empty_docs(spark), tmp_path)[-1].count() == 0


def test_entry_registers_everything():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert {n for n in entry.oracle_sql() if n.startswith("op")} == {"op2_warc", "op4_exact_dedup", "op8_search", "op12_hard_negatives"}
