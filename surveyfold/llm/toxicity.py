"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

Terms are the whole words of a text (lower-case letters; every run of other
characters parts two words), known by their 64-bit hash. The vocabulary holds
every word of every example; document frequencies are counted over all
documents. A weight is plain TF-IDF, ``(1 + ln tf) * (ln((1 + N) / (1 + df)) + 1)``,
and vectors are of unit length (a word that no example has cannot match and is
left out of a query's length, which scales all its cosines alike). Examples are
at most ``PER_CLASS`` labelled rows of either label, picked by a hash of the id.

The index stores, for every term and every block of ``BLOCK`` examples, the
postings and the largest weight among them; the ``HEAVY`` commonest terms, in
nearly every block, are columns of a dense matrix. Heavy parts are added up in
single precision, by one matrix product. A block's bound is the largest heavy
part in it and the block maxima of a query's other terms; a query visits the
``ROUNDS`` blocks of the largest bounds first, then those whose bound is not
below the k-th best cosine so far; postings of the others are never read. A
block's postings lie together and are read for all queries that visit it at
once. All that come within the single precision's error of the k-th have their
heavy parts added up again in double, so the k neighbours are exact (weights of
examples are kept in single precision).

Neighbours vote with the part of their cosine that tells labels apart: every
shared word's part of the cosine counts by its phi squared, the share of the
label's variance among the examples that the word explains. That decides how
much a neighbour's vote weighs, never which examples are neighbours. A label's
votes weigh the share it has among all labelled rows over its share among the
examples; a prior of the base rate keeps weak evidence from deciding. The
vote's log-odds are calibrated by a logistic curve, fitted to the examples' own
votes with each left out of its neighbours.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .balltree import packed, unpacked
from .common import bound_batches, is_held_out, text_or_empty, tidy
from .language import letter_table
from .packing import Flat, ranges

PER_CLASS = 4000
BLOCK, HEAVY, NEIGHBOURS, PRIOR_WEIGHT = 256, 512, 100, 0.01
EVIDENCE = 15               # neighbours named, those whose votes weigh most
THRESHOLD = 0.7
PROBE_BITS = 22
BATCH_DOCS = 256
TOGETHER = 1 << 15          # characters of the texts that are cut into words at once
ROUNDS = 4                  # blocks of the first round; the second has all others
MOST_POSTINGS = 1 << 20     # of the queries that are looked up at once (one query alone may have more)
SINGLE = 1e-4               # more than sums of HEAVY products of unit vectors may lose in single precision


# --- terms -------------------------------------------------------------------

def hashes(texts: Sequence[str]) -> Flat:
    """Hashes of all whole words, repeats included, text by text."""
    low = [t.lower() for t in texts]
    points = np.frombuffer(f" {' '.join(low)} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = letter_table()[points]
    edges = np.flatnonzero(is_letter[1:] != is_letter[:-1]) + 1         # a word's first letter, then the end of it
    begin, size = edges[::2], edges[1::2] - edges[::2]
    words = np.diff(np.searchsorted(begin, np.cumsum([0] + [len(t) + 1 for t in low])))
    if not len(begin):
        return Flat.of(np.zeros(0, dtype=np.uint64), words)
    at = np.flatnonzero(is_letter)
    place = (at - np.repeat(begin - 1, size)).astype(np.uint64)         # from 1
    x = points[at] * np.uint64(0x9E3779B97F4A7C15) ^ place * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    h = np.add.reduceat(x ^ x >> np.uint64(32), np.cumsum(size) - size) * np.uint64(0x94D049BB133111EB)
    return Flat.of(h ^ h >> np.uint64(32), words)


def word_hashes(text: str) -> np.ndarray:
    return hashes([text]).ids


def together(texts: Iterable[str]) -> Iterator[list[str]]:
    """Neighbouring texts of at most ``TOGETHER`` characters (a longer one is alone)."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    if group:
        yield group


class Vocabulary:
    """Finds known terms: by their low bits, those that share them by search."""

    def __init__(self, terms: np.ndarray):
        self.terms = terms                       # sorted hashes
        self.mask = np.uint64((1 << PROBE_BITS) - 1)
        low = (terms & self.mask).astype(np.int64)
        self.probe = np.full(1 << PROBE_BITS, -1, dtype=np.int32)
        self.probe[low] = np.arange(len(terms))
        self.probe[low[self.probe[low] != np.arange(len(terms))]] = -2          # several terms

    def counts(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(term numbers ascending, counts) of every text."""
        n = max(len(self.terms), 1)
        for group in together(texts):
            words = hashes(group)
            h, of = words.ids, np.repeat(np.arange(len(group)), words.sizes)
            at = self.probe[(h & self.mask).astype(np.int64)].astype(np.int64)
            search = np.flatnonzero(at == -2)
            at[search] = np.minimum(np.searchsorted(self.terms, h[search]), len(self.terms) - 1)
            known = np.flatnonzero(at >= 0)
            known = known[self.terms[at[known]] == h[known]]
            key = np.sort(of[known] * n + at[known])
            first = np.flatnonzero(np.diff(key, prepend=-1))
            count, cuts = np.diff(first, append=len(key)), np.searchsorted(key[first], np.arange(len(group) + 1) * n)
            term = key[first] % n
            yield from ((term[a:b], count[a:b]) for a, b in itertools.pairwise(cuts))


# --- index -------------------------------------------------------------------

class Index(NamedTuple):
    """The examples' unit vectors: dense columns of the heavy terms, postings of
    the others by (block, term), with block maxima."""

    terms: np.ndarray             # hashes, ascending
    idf: np.ndarray
    told: np.ndarray              # phi squared of term and label among the examples
    slot: np.ndarray              # column of a heavy term, else -1
    dense: np.ndarray             # (blocks, BLOCK, heavy), the last block's missing examples zeros
    entries: np.ndarray           # (terms + 1): entries of term t, one per block that has it
    entry_block: np.ndarray
    entry_max: np.ndarray
    entry_first: np.ndarray       # its postings, which lie by (block, term)
    entry_size: np.ndarray
    having: np.ndarray            # postings of term t
    place: np.ndarray             # of the example in its block, by posting
    weights: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    vote: np.ndarray              # weight of either label's vote
    base_rate: float
    scale: tuple[float, float] = (0.0, 1.0)       # of the log-odds of the vote

    def vectors(self, found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[Flat, np.ndarray]:
        """Unit TF-IDF vectors: term numbers of all documents, and their weights."""
        terms = Flat.of(np.concatenate([x[0] for x in found]), np.array([len(x[0]) for x in found], dtype=np.int64))
        w = (1 + np.log(np.concatenate([x[1] for x in found]))) * self.idf[terms.ids]
        doc = np.repeat(np.arange(len(found)), terms.sizes)
        norm = np.sqrt(np.bincount(doc, weights=w * w, minlength=len(found)))
        return terms, w / np.maximum(norm, 1e-12)[doc]

    def nearest(self, terms: Flat, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(examples, cosines, telling parts), each (documents, k): the k nearest with
        a cosine above zero, best first, ties to the smaller example; -1 where there
        are fewer. The telling part is the cosine with each term's share times ``told``."""
        total = np.add.reduceat(np.append(self.having[terms.ids], 0), terms.starts) * (terms.sizes > 0)
        out, begin = [], 0
        while begin < len(total):
            end = begin + max(1, int(np.searchsorted(np.cumsum(total[begin:]), MOST_POSTINGS, side="right")))
            part = slice(terms.starts[begin], terms.starts[end - 1] + terms.sizes[end - 1])
            out.append(self._nearest(Flat.of(terms.ids[part], terms.sizes[begin:end]), w[part], k))
            begin = end
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _nearest(self, terms: Flat, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, blocks = len(terms.sizes), len(self.dense)
        near, cos, tells = np.full((n, k), -1, dtype=np.int64), np.zeros((n, k)), np.zeros((n, k))
        if not blocks:
            return near, cos, tells
        doc, slot = np.repeat(np.arange(n), terms.sizes), self.slot[terms.ids]
        heavy = np.zeros((n, self.dense.shape[2]))
        heavy[doc[slot >= 0], slot[slot >= 0]] = w[slot >= 0]
        sums = heavy.astype(np.float32) @ self.dense.transpose(0, 2, 1)         # (blocks, n, BLOCK)

        light = np.flatnonzero(slot < 0)
        lo, hi = self.entries[terms.ids[light]], self.entries[terms.ids[light] + 1]
        entry, of = ranges(lo, hi - lo), np.repeat(light, hi - lo)
        block = self.entry_block[entry]
        order = np.argsort(block, kind="stable")      # narrow numbers are sorted by digits
        cuts = np.concatenate([[0], np.cumsum(np.bincount(block, minlength=blocks))])
        entry, of = entry[order], of[order]
        block, owner, weight = block[order].astype(np.int64), doc[of], w[of]
        bound = sums.max(axis=2).T.astype(np.float64)
        bound += np.bincount(owner * blocks + block, weights=weight * self.entry_max[entry], minlength=n * blocks).reshape(n, blocks)
        order = np.argsort(-bound, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(blocks)[None, :], axis=1)

        # a block's postings and sums, of all queries that visit it, fit a processor's cache
        rest, known, kth = np.zeros(sums.shape), np.zeros_like(sums), np.zeros(n)
        posts = []
        for begin, end in ((0, ROUNDS), (ROUNDS, blocks)):
            visit = (place >= begin) & (place < end) & (bound > 0) & (bound >= kth[:, None] - SINGLE)
            for b in np.flatnonzero(visit.any(axis=0)):
                own = np.flatnonzero(visit[:, b])
                base = np.full(n, -1)
                base[own] = np.arange(len(own)) * BLOCK
                base = base[owner[cuts[b]:cuts[b + 1]]]
                seen = np.flatnonzero(base >= 0)
                base, seen = base[seen], seen + cuts[b]
                first, many = (x[entry[seen]].astype(np.int64) for x in (self.entry_first, self.entry_size))
                which = np.repeat(np.arange(len(seen)), many)
                post = (first - np.cumsum(many) + many)[which]
                post += np.arange(len(which))
                cell = base[which]
                cell += self.place[post]
                cosine = weight[seen][which]
                cosine *= self.weights[post]
                found = np.bincount(cell, weights=cosine, minlength=len(own) * BLOCK).reshape(-1, BLOCK)
                rest[b, own], known[b, own] = found, sums[b, own] + found
                posts.append((b, own, cell.astype(np.int32), cosine, which.astype(np.int32), terms.ids[of[seen]]))
            for i in np.flatnonzero(visit.any(axis=1)):
                above = known[:, i][known[:, i] > kth[i]]       # fewer than k of them leave the k-th as it was
                if len(above) >= k:
                    kth[i] = np.partition(above, len(above) - k)[len(above) - k]

        # candidates within the single precision's error of the k-th, heavy parts again in double
        told = np.zeros(self.dense.shape[2])
        told[self.slot[self.slot >= 0]] = self.told[self.slot >= 0]
        number = np.full(sums.shape, -1, dtype=np.int32)
        dense = self.dense.reshape(blocks * BLOCK, self.dense.shape[2])
        for i in range(n):
            e = np.flatnonzero(known[:, i] > (max(SINGLE, kth[i] - 3 * SINGLE) if kth[i] > 2 * SINGLE else 0))
            has = np.flatnonzero(heavy[i])
            both = dense[e][:, has] @ np.stack([heavy[i, has], heavy[i, has] * told[has]], axis=1)
            # cosines of equal examples may differ in the last bit; rounded, ties are ties
            c = np.round(rest[e // BLOCK, i, e % BLOCK] + both[:, 0], 12)
            best = np.lexsort((e, -c))[:k]
            best = best[c[best] > 0]
            near[i, :len(best)], cos[i, :len(best)], tells[i, :len(best)] = e[best], c[best], both[best, 1]
            number[e[best] // BLOCK, i, e[best] % BLOCK] = i * k + np.arange(len(best))
        for b, own, cell, cosine, which, term in posts:
            to = number[b, own].ravel()[cell]
            hit = np.flatnonzero(to >= 0)
            share = self.told[term[which[hit]]]
            tells += np.bincount(to[hit], weights=cosine[hit] * share, minlength=n * k).reshape(n, k)
        return near, cos, tells

    def odds(self, found: list[tuple[np.ndarray, np.ndarray]], k: int, but: np.ndarray | None = None,
             ) -> tuple[np.ndarray, list[np.ndarray]]:
        """Log-odds of every document's vote and the ids of the neighbours that
        weigh most in it, without the example ``but``."""
        near, cos, tells = self.nearest(*self.vectors(found), k + (but is not None))
        if but is not None:
            cos = np.where(self.ids[near] == but[:, None], 0, cos)
            order = np.argsort(-cos, axis=1, kind="stable")[:, :k]
            near, cos, tells = (np.take_along_axis(x, order, 1) for x in (near, cos, tells))
        labels = self.labels[near]
        votes = np.where(cos > 0, tells, 0) * self.vote[labels]
        share = ((votes * labels).sum(axis=1) + PRIOR_WEIGHT * self.base_rate) / (votes.sum(axis=1) + PRIOR_WEIGHT)
        weigh = np.argsort(-votes, axis=1, kind="stable")[:, :EVIDENCE]
        near, cos = np.take_along_axis(near, weigh, 1), np.take_along_axis(cos, weigh, 1)
        return np.log(share / (1 - share)), [self.ids[x[c > 0]] for x, c in zip(near, cos, strict=True)]

    def score(self, found: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS) -> tuple[np.ndarray, list[np.ndarray]]:
        """Calibrated scores and the heaviest voters' ids; no known term gives the base rate."""
        known = np.array([len(x[0]) > 0 for x in found], dtype=bool)
        scores, ids = np.full(len(found), self.base_rate), [self.ids[:0]] * len(found)
        if known.any() and len(self.labels):
            x, voted = self.odds([f for f in found if len(f[0])], k)
            scores[known] = 1 / (1 + np.exp(-(self.scale[0] + self.scale[1] * x)))
            for at, v in zip(np.flatnonzero(known), voted, strict=True):
                ids[at] = v
        return scores, ids


def platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Offset and slope of a logistic curve through (x, y), by Newton steps; the
    slope is held near 1 by a weak prior and never negative."""
    design, w = np.stack([np.ones(len(x)), x], axis=1), np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        grad = design.T @ (weight * (p - y)) + np.array([0.01, 1.0]) * (w - [0.0, 1.0])
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([0.01, 1.0]), grad)
        w = w - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(max(w[1], 0.0))


def build_index(terms: np.ndarray, idf: np.ndarray, told: np.ndarray, examples: list, vote: np.ndarray,
                base_rate: float, heavy: int = HEAVY) -> Index:
    """``examples``: (id, label, term ids, unit weights). Like examples get into
    the same block: they are ordered by their heaviest term. Its size is that of
    the postings and of ``heavy`` columns."""
    examples = sorted(examples, key=lambda e: (int(e[2][np.argmax(e[3])]) if len(e[2]) else -1, e[0]))
    blocks = -(-len(examples) // BLOCK)
    row = np.repeat(np.arange(len(examples), dtype=np.int32), [len(e[2]) for e in examples])
    term = np.concatenate([e[2] for e in examples]).astype(np.int64) if examples else np.zeros(0, dtype=np.int64)
    weight = np.concatenate([e[3] for e in examples]).astype(np.float32) if examples else np.zeros(0, dtype=np.float32)
    having = np.bincount(term, minlength=len(terms))
    common = np.argsort(-having, kind="stable")[:heavy]
    slot = np.full(len(terms), -1, dtype=np.int32)
    slot[common] = np.arange(len(common))

    dense = np.zeros((blocks, BLOCK, len(common)), dtype=np.float32)
    at = slot[term] >= 0
    dense[row[at] // BLOCK, row[at] % BLOCK, slot[term[at]]] = weight[at]
    term, row, weight = term[~at], row[~at], weight[~at]
    block = row.astype(np.int64) // BLOCK
    order = np.lexsort((row, term, block))
    term, row, weight, block = term[order], row[order], weight[order], block[order]
    first = np.flatnonzero(np.diff(block * len(terms) + term, prepend=-1))
    size, largest = np.diff(np.append(first, len(term))), np.maximum.reduceat(weight, first) if len(first) else weight
    order = np.argsort(term[first], kind="stable")              # a term's entries by block
    entries = np.searchsorted(term[first][order], np.arange(len(terms) + 1))
    return Index(terms, idf, told, slot, dense, entries, block[first][order].astype(np.min_scalar_type(blocks)),
                 largest[order], first[order].astype(np.min_scalar_type(len(weight))),
                 size[order].astype(np.min_scalar_type(BLOCK)), np.where(slot < 0, having, 0),
                 (row % BLOCK).astype(np.min_scalar_type(BLOCK - 1)), weight, np.array([e[1] for e in examples], dtype=np.int64),
                 np.array([e[0] for e in examples] + [None], dtype=object)[:-1], vote, base_rate)


# --- learning on Spark -------------------------------------------------------

def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the rows to learn from: not held out, both known. A
    doc_id with several labels is toxic if one of them is."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out())
    return rows.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).filter(F.col("toxic").isin(0, 1))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 11, k: int = NEIGHBOURS) -> Index:
    """The index; without examples of both labels it has none and scores are the base rate.

    Of documents with one id, the example has the greatest text. To the driver
    come two counts, three numbers for every distinct word of the examples, and
    the term vectors of at most ``2 * per_class`` examples.
    """
    bound_batches(docs.sparkSession)
    known = stage_table(labelled(labels), "tox-labels")
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    rank = F.xxhash64(F.lit(seed), "doc_id")
    picked = [known.filter(F.col("toxic") == y).orderBy(rank, "doc_id").limit(per_class) for y in (0, 1)]
    # at most 2 * per_class ids, so the documents need no shuffle
    chosen = F.broadcast(stage_table(picked[0].unionByName(picked[1]), "tox-picked"))
    examples = stage_table(docs.select("doc_id", text_or_empty().alias("text")).join(chosen, "doc_id")
                           .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text")), "tox-examples")
    base = float(totals.get(1, 0) / max(1, sum(totals.values())))
    have = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    if len(have) < 2:
        return build_index(np.zeros(0, dtype=np.uint64), np.zeros(0), np.zeros(0), [], np.ones(2), base)    # nothing to tell apart

    @tidy
    def term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            seen = [np.unique(word_hashes(t)) for t in f["text"]]
            label = np.repeat(f["toxic"].to_numpy(), [len(x) for x in seen])
            term, at = np.unique(np.concatenate(seen), return_inverse=True)
            n = [np.bincount(at[label == y], minlength=len(term)) for y in (0, 1)]
            yield pd.DataFrame({"term": term.view(np.int64), "n0": n[0], "n1": n[1]})

    found = (examples.mapInPandas(term_counts, "term long, n0 long, n1 long")
             .groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    terms = found["term"].to_numpy().view(np.uint64)
    order = np.argsort(terms)
    terms, b, a = (x[order] for x in (terms, found["n0"].to_numpy().astype(float), found["n1"].to_numpy().astype(float)))
    d0, d1 = float(have[0]), float(have[1])
    told = (a * (d0 - b) - b * (d1 - a)) ** 2 / np.maximum(d0 * d1 * (a + b) * (d0 + d1 - a - b), 1.0)
    lookup = docs.sparkSession.sparkContext.broadcast(terms)

    @tidy
    def frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Vocabulary(lookup.value)
        df = np.zeros(len(words.terms) + 1, dtype=np.int64)
        for f in batches:
            for ids, _ in words.counts(f["text"]):
                df[ids] += 1
            df[-1] += len(f)
        hit = np.flatnonzero(df)
        yield pd.DataFrame({"term": hit, "df": df[hit]})

    df = np.zeros(len(terms) + 1)
    seen = (docs.select(text_or_empty().alias("text")).mapInPandas(frequencies, "term int, df long")
            .groupBy("term").agg(F.sum("df").alias("df")).toArrow())
    df[seen["term"].to_numpy()] = seen["df"].to_numpy()
    idf = np.log((1 + df[-1]) / (1 + df[:-1])) + 1
    shared_idf = docs.sparkSession.sparkContext.broadcast(idf)

    @tidy
    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, gain = Vocabulary(lookup.value), shared_idf.value
        for f in batches:
            blobs = []
            for ids, n in words.counts(f["text"]):
                w = (1 + np.log(n)) * gain[ids]
                unit = w / max(np.sqrt((w * w).sum()), 1e-12)
                blobs.append(packed(terms=ids.astype(np.int32), weights=unit.astype(np.float32)))
            yield pd.DataFrame({"doc_id": f["doc_id"], "toxic": f["toxic"], "vector": blobs})

    kind = examples.schema["doc_id"].dataType.simpleString()
    sparse = examples.mapInPandas(vectors, f"doc_id {kind}, toxic int, vector binary").toLocalIterator()
    made = [(r.doc_id, r.toxic, v["terms"], v["weights"]) for r in sparse for v in [unpacked(r.vector)]]
    shares = np.array([1 - base, base]) / np.array([have[0], have[1]]) * sum(have.values())
    index = build_index(terms, idf, told, made, shares / shares[1], base)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    @tidy
    def left_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        words = Vocabulary(own.terms)
        for f in batches:
            for a in range(0, len(f), BATCH_DOCS):
                part = f.iloc[a:a + BATCH_DOCS]
                found = list(words.counts(part["text"]))
                some = np.array([len(x[0]) > 0 for x in found], dtype=bool)
                if some.any():
                    odds, _ = own.odds([x for x in found if len(x[0])], k, part["doc_id"].to_numpy(dtype=object)[some])
                    yield pd.DataFrame({"toxic": part["toxic"].to_numpy()[some], "odds": odds})

    odds = examples.mapInPandas(left_out, "toxic int, odds double").toArrow()     # two numbers per example
    for x in (shared, lookup, shared_idf):
        x.destroy()
    if not odds.num_rows:
        return index
    y = odds["toxic"].to_numpy()
    return index._replace(scale=platt(odds["odds"].to_numpy(), y, shares[y]))


def predict(docs: DataFrame, index: Index, threshold: float = THRESHOLD, k: int = NEIGHBOURS) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (ids of the ``EVIDENCE`` examples whose votes
    weigh most) for every row.

    The score uses the whole text and nothing else. A null or empty text, and
    one without a known term, scores the base rate. Rows that repeat score
    alike; a null doc_id is not held out. An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(index)     # bounded by examples and terms

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        words = Vocabulary(own.terms)
        for f in batches:
            for a in range(0, len(f), BATCH_DOCS):
                part = f.iloc[a:a + BATCH_DOCS]
                scores, voted = own.score(list(words.counts(part["__text"])), k)
                yield pd.DataFrame({"__at": part["__at"].to_numpy(), "score": scores, "evidence": [list(v) for v in voted]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    at = F.to_json(F.struct("doc_id", is_held_out().alias("held_out")))
    out = docs.select(at.alias("__at"), text_or_empty().alias("__text")).mapInPandas(
        run, f"`__at` string, score double, evidence array<{kind}>")
    back = F.from_json("__at", f"doc_id {kind}, held_out boolean").alias("at")
    return out.select(back, "score", "evidence").select(
        "at.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
