import math
import pickle
from collections import Counter

import numpy as np
import pytest

from surveyfold.llm import queries
from surveyfold.llm import toxicity as op
from surveyfold.llm.common import read

from .helpers import empty_docs, rows

MID = "/root/testdata/sf0.1"


def random_index(seed, n, heavy, terms=60):
    rng = np.random.default_rng(seed)
    made = []
    for i in range(n):
        ids = np.sort(rng.choice(terms, rng.integers(0, 8), replace=False))
        w = rng.random(len(ids)) + 0.1
        made.append((1000 + i, int(rng.integers(0, 2)), ids, (w / max(np.sqrt((w * w).sum()), 1e-12)).astype(np.float32)))
    made += [(5000 + i, *made[i % n][1:]) for i in range(min(n, 30))]           # equal examples: ties
    return op.build_index(np.arange(terms, dtype=np.uint64), rng.random(terms) + 0.5, rng.random(terms), made,
                          np.array([2.0, 1.0]), 0.2, heavy), made


@pytest.mark.parametrize("heavy", [0, 7, 60])
@pytest.mark.parametrize("n", [1, 5, 64, 65, 900, 2500])
def test_neighbours_equal_all_cosines(n, heavy, monkeypatch):
    monkeypatch.setattr(op, "ROUNDS", 2)
    monkeypatch.setattr(op, "MOST_POSTINGS", 300)
    index, made = random_index(n, n, heavy)
    order = {int(i): k for k, i in enumerate(index.ids)}
    rng = np.random.default_rng(9)
    found = [(np.sort(rng.choice(60, m, replace=False)), rng.integers(1, 4, m)) for m in (0, 1, 2, 5, 9, 30, 60, 0)]
    terms, w = index.vectors(found)
    near, cos, tells = index.nearest(terms, w, 7)
    for q in range(len(found)):
        v = np.zeros(60)
        v[terms.ids[terms.starts[q]:terms.starts[q] + terms.sizes[q]]] = w[terms.starts[q]:terms.starts[q] + terms.sizes[q]]
        plain = sorted((-round(float((v[ids] * x).sum()), 12), order[d], float((v[ids] * x * index.told[ids]).sum()))
                       for d, _, ids, x in made)
        want = [(i, -s, t) for s, i, t in plain if s < 0][:7]
        assert [i for i in near[q] if i >= 0] == [i for i, _, _ in want]
        assert cos[q][:len(want)] == pytest.approx([c for _, c, _ in want])
        assert tells[q][:len(want)] == pytest.approx([t for _, _, t in want])


def test_blocks_below_the_bound_are_not_read(monkeypatch):
    """A bound takes the heavy parts of a block's examples, not the maxima of its heavy terms:
    block 1 has both heavy terms, but in different examples, so it is out of reach."""
    monkeypatch.setattr(op, "BLOCK", 2)
    monkeypatch.setattr(op, "ROUNDS", 1)
    vectors = [([0, 1], [0.7, 0.7]), ([0, 1, 2], [0.7, 0.7, 0.1]), ([0, 3], [0.7, 0.7]), ([1, 2], [0.7, 0.01])]
    made = [(i, i % 2, np.array(t), np.array(x, dtype=np.float32)) for i, (t, x) in enumerate(vectors)]
    index = op.build_index(np.arange(4, dtype=np.uint64), np.ones(4), np.ones(4), made, np.ones(2), 0.5, heavy=2)
    assert np.flatnonzero(index.slot >= 0).tolist() == [0, 1]
    query = op.Flat.of(np.array([0, 1, 2]), np.array([3])), np.array([0.7, 0.7, 0.1])
    want = index.nearest(*query, 2)
    assert want[0].tolist() == [[1, 0]]
    spoilt = index.weights.copy()
    for e in np.flatnonzero(index.entry_block == 1):
        spoilt[index.entry_first[e]:index.entry_first[e] + index.entry_size[e]] = np.nan
    assert np.isnan(spoilt).any() and not np.isnan(spoilt).all()
    for a, b in zip(want, index._replace(weights=spoilt).nearest(*query, 2), strict=True):
        assert np.array_equal(a, b)
    spoilt[:] = np.nan
    assert not np.array_equal(index._replace(weights=spoilt).nearest(*query, 2)[0], want[0])      # block 0 is read


def plain_scores(docs, toxic, k):
    """Scores by dictionaries: every word of every example, all cosines, all votes."""
    def words(text):
        return Counter("".join(c if c.isalpha() else " " for c in (text or "").lower()).split())
    bags, df = {d: words(t) for d, t in docs}, Counter()
    for d, t in docs:
        df.update(words(t).keys())
    known = {w for d in toxic for w in bags[d]}
    idf = {w: math.log((1 + len(docs)) / (1 + df[w])) + 1 for w in known}
    def unit(bag):
        v = {w: (1 + math.log(n)) * idf[w] for w, n in bag.items() if w in known}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}
    units = {d: {w: float(np.float32(x)) for w, x in unit(bags[d]).items()} for d in toxic}
    n1 = sum(toxic.values())
    n0, told = len(toxic) - n1, {}
    for w in known:
        a = sum(toxic[d] for d in toxic if w in bags[d])
        b = sum(1 - toxic[d] for d in toxic if w in bags[d])
        told[w] = (a * n0 - b * n1) ** 2 / max(n0 * n1 * (a + b) * (n0 + n1 - a - b), 1)
    base = n1 / len(toxic)
    def odds(v, but=None):
        near = sorted(((round(sum(x * u.get(w, 0) for w, x in v.items()), 12), d) for d, u in units.items() if d != but), reverse=True)
        votes = [0.0, 0.0]
        for c, d in near[:k]:
            if c > 0:
                votes[toxic[d]] += sum(x * units[d].get(w, 0) * told[w] for w, x in v.items())
        share = (votes[1] + op.PRIOR_WEIGHT * base) / (sum(votes) + op.PRIOR_WEIGHT)
        return math.log(share / (1 - share))
    fit = [(odds(unit(bags[d]), d), y) for d, y in toxic.items() if bags[d]]
    lo, slope = op.platt(np.array([x for x, _ in fit]), np.array([y for _, y in fit]), np.ones(len(fit)))
    return {d: 1 / (1 + math.exp(-(lo + slope * odds(v)))) if (v := unit(bags[d])) else base for d, _ in docs}


@pytest.mark.parametrize("as_text", [False, True])
def test_scores_equal_plain_ones(spark, as_text):
    """The whole operator against dictionaries; as many neighbours as examples, so order among ties is no matter."""
    rng = np.random.default_rng(4)
    common, vile = [f"w{chr(97 + i)}" for i in range(20)], ["vile", "rot", "Schrott"]
    docs, toxic = [], {}
    for i in range(90):
        text = list(rng.choice(common, rng.integers(1, 40))) + list(rng.choice(vile, 2)) * (i % 4 == 0)
        text += [f"only{chr(97 + i % 26)}{chr(97 + i // 26)}"]
        rng.shuffle(text)
        docs.append((f"d{i}" if as_text else i, " ".join(text) + "!"))
    docs += [(f"d{i}" if as_text else i, t) for i, t in ((900, None), (901, ""), (902, "12 34"), (903, "unseen words"))]
    frame = spark.createDataFrame(docs, f"doc_id {'string' if as_text else 'long'}, text string")
    labels = spark.createDataFrame([(d, int(i % 4 == 0)) for i, (d, _) in enumerate(docs[:90])],
                                   f"doc_id {'string' if as_text else 'long'}, toxic int")
    toxic = {r.doc_id: r.toxic for r in op.labelled(labels).collect()}
    out = op.predict(frame, op.learn(frame, labels, k=500), k=500).collect()
    want = plain_scores(docs, toxic, 500)
    assert {r.doc_id: r.score for r in out} == pytest.approx(want, abs=1e-6)
    assert all(set(r.evidence) <= set(toxic) and len(r.evidence) <= op.EVIDENCE for r in out)


def test_held_out_scores(spark):
    docs, labels = read(spark, MID, "documents"), read(spark, MID, "labels")
    out = queries.op10_toxicity(spark, MID).join(labels, "doc_id", "left").collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    held = [r for r in out if r.held_out and r.toxic is not None]
    hits = [r.toxic for r in held if r.predicted]
    assert sum(hits) / len(hits) > 0.9
    assert sum(hits) / sum(r.toxic for r in held) > 0.6
    assert sum(r.score for r in held) / len(held) == pytest.approx(sum(r.toxic for r in held) / len(held), abs=0.05)


def test_evidence_is_never_held_out(spark):
    learned = op.labelled(read(spark, MID, "labels"))
    from surveyfold.llm.common import is_held_out
    assert learned.filter(is_held_out()).count() == 0


def test_awkward_rows(spark, docs):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, 1, None), (None, 1, 1), (4, 0, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    index = op.learn(docs, labels)
    out = op.predict(docs, index).collect()
    assert len(out) == docs.count() and all(0 <= r.score <= 1 for r in out)
    none = op.learn(docs, labels.limit(0))
    assert {r.score for r in op.predict(docs, none).collect()} == {0.0}
    assert rows(op.predict(empty_docs(spark), none)) == []


def test_every_word_counts(spark):
    """No cap on terms, and no floor that few examples or few labels do not reach."""
    common = "one two six the"
    docs = spark.createDataFrame(
        [(3 * i, f"{common} {'vile rot' if i % 2 else 'kind sun'} only{chr(97 + i % 26)}{'x' * (i // 26)} {' '.join(f'w{chr(97 + i % 5)}{chr(97 + k % 26)}{chr(97 + k // 26)}' for k in range(600))}")
         for i in range(40)] + [(1000, "one")], "doc_id long, text string")
    labels = spark.createDataFrame([(3 * i, 0, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    index = op.learn(docs, labels)
    known = set(index.terms.tolist())
    assert {int(op.word_hashes(w)[0]) for w in ("vile", "rot", "kind", "one", "the")} <= known
    assert int(op.word_hashes("onlya")[0]) in known or int(op.word_hashes("onlyax")[0]) in known      # one example has it
    assert len(known) > 3000
    again = pickle.loads(pickle.dumps(index))
    assert all(np.array_equal(a, b) for a, b in zip(index, again, strict=True))
    assert op.PER_CLASS == 4000


@pytest.mark.parametrize("size", [1, 20, 1 << 15])
def test_texts_cut_together_count_as_alone(size, monkeypatch):
    """Also words that share the look-up's low bits, and texts whose lower case is longer or depends on an end."""
    monkeypatch.setattr(op, "TOGETHER", size)
    monkeypatch.setattr(op, "PROBE_BITS", 3)
    texts = ["", "one two one", "12", "two", "\u0130x two", "\u039f\u03a3", "\u039f\u03a3 \u039f\u03a3", "\ud800 one", "a\x00b unseen", "", "  "]
    bags = [Counter("".join(c if c.isalpha() else " " for c in t.lower()).split()) for t in texts]
    words = sorted({w for b in bags for w in b} - {"unseen"})
    terms = np.sort([op.word_hashes(w)[0] for w in words])
    number = {w: int(np.searchsorted(terms, op.word_hashes(w)[0])) for w in words}
    found = list(op.Vocabulary(terms).counts(texts))
    assert [dict(zip(i.tolist(), n.tolist(), strict=True)) for i, n in found] == [
        {number[w]: n for w, n in b.items() if w in number} for b in bags]
    assert all((np.diff(i) > 0).all() for i, _ in found)
    assert list(op.Vocabulary(terms).counts([])) == []


def test_words_of_a_text():
    a, b = op.word_hashes("Clown, you clown! nwolc"), op.word_hashes("you")
    assert len(a) == 4 and a[0] == a[2] != a[3] and a[1] == b[0]
    assert len(op.word_hashes("12 3")) == 0
