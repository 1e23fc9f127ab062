"""MinHash near-dedup by bottom-k sketches of one hash function.

A document's set is its distinct five-word shingles; its sketch is the ``KEPT``
smallest XXH64 values of the set, the whole set where that is not larger.
Documents of equal sets are one class from the start.

*Inverted lists.* Two linked classes share at least ``needed(n)`` retained
values (below), so under any common order of values they share one among the
first ``retained - needed + 1`` of each. Values are ordered by how often they
are retained, rarest first, counted in ``COUNTERS`` slots whatever the input's
size: a passage that many documents share comes last and stays out of the
lists. A list of up to ``SHORT`` classes gives its pairs. A longer one is cut
into blocks of about ``BLOCK`` classes, and a task that gets two blocks with
their sketches counts all overlaps and gives a spanning forest of the links
only, so that a group of n near copies makes n rows and not n * n.

*Union sketch.* Of the ``KEPT`` smallest values of a union, the share found in
both sketches estimates the Jaccard similarity; it is hypergeometric. A pair
is dropped where a linked pair would show so few shared values with a
probability under ``MISS``. Where both sketches hold whole sets the count is
exact and decides.

*Exact Jaccard.* All other pairs that are left are verified on the full
shingle sets of the two texts. Pairs from long lists go in two steps: a
spanning forest of the candidates, then every candidate whose ends are still
in different components.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table, unstage
from .common import bound_batches, tidy
from .components import connected_components

SHINGLE_WORDS, PERCENT = 5, 85
KEPT = 256                   # values of a sketch
MISS = 1e-9                  # chance that the estimate drops a linked pair
COUNTERS = 1 << 18           # slots in which retained values are counted
SHORT, BLOCK = 48, 1000      # classes of a list that gives all its pairs; of a block of a longer one
THIN = 64                    # values in so few sketches of a block are counted pair by pair


# --- sets and sketches -------------------------------------------------------

def shingles(text: str | None, size: int = SHINGLE_WORDS) -> list[bytes]:
    """The shingles, repeats included (fewer words: the whole sequence; no words: none).

    ``bytes.lower`` and ``bytes.split`` know ASCII only, as the contract does.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return []
    line, n = b" ".join(words), max(1, len(words) - size + 1)
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(stops[:n - 1] + 1).tolist()]
    return [line[a:b] for a, b in zip(starts, stops[min(size, len(words)) - 1:].tolist(), strict=True)]


def hashes(found: list[bytes]) -> np.ndarray:
    """Sorted XXH64 values (seed 0) of the distinct shingles."""
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found), dtype=np.uint64, count=len(found)))


@functools.lru_cache(maxsize=1 << 16)
def least_shared(union: int, kept: int = KEPT, percent: int = PERCENT, miss: float = MISS) -> int:
    """Fewest shared values that a linked pair shows among the ``kept`` smallest
    of a union of at most ``union``, but for a chance of ``miss``."""
    both = -(-percent * union // 100)
    if union <= kept:
        return both
    if union > 1 << 20:                                         # as good as the binomial
        union, both = 1 << 20, -(-percent * (1 << 20) // 100)

    def ways(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    chance, low = 0.0, max(0, kept - (union - both))
    for x in range(low, kept + 1):
        chance += math.exp(ways(both, x) + ways(union - both, kept - x) - ways(union, kept))
        if chance > miss:
            return x
    return kept


@functools.lru_cache(maxsize=1 << 16)
def needed(n: int, kept: int = KEPT, percent: int = PERCENT) -> int:
    """Retained values that a class of n shingles shares with any linked one."""
    own = -(-percent * n // 100)
    return max(1, min(own, least_shared(n * 100 // percent, kept, percent)))


def estimate(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> int:
    """Values of both sketches among the ``kept`` smallest of their union."""
    both = np.sort(np.concatenate([a, b]))
    again = both[1:] == both[:-1]
    distinct = np.cumsum(np.concatenate([[True], ~again]))
    return int((again & (distinct[1:] <= kept)).sum())


def verdict(a: np.ndarray, b: np.ndarray, na: int, nb: int, kept: int = KEPT, percent: int = PERCENT) -> int:
    """0: not linked, 1: to be verified, 2: linked."""
    if max(na, nb) <= kept:
        shared = len(np.intersect1d(a, b, assume_unique=True))
        return 2 if 100 * shared >= percent * (na + nb - shared) else 0
    return int(estimate(a, b, kept) >= least_shared((na + nb) * 100 // (100 + percent), kept, percent))


def linked(one: set[bytes], two: set[bytes], percent: int = PERCENT) -> bool:
    shared = len(one & two)
    return shared > 0 and 100 * shared >= percent * (len(one) + len(two) - shared)


def sketches(docs: DataFrame, size: int = SHINGLE_WORDS, kept: int = KEPT) -> DataFrame:
    """(doc_id, text_key, n, digest, values) per row, written down: the set's size,
    a digest of the set and its smallest hash values (as signed numbers)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, parts = [], [], []
            for text in batch.column(2):
                values = hashes(shingles(text.as_py(), size))
                sizes.append(len(values))
                digests.append(hashlib.sha256(values.tobytes()).digest()[:16] if len(values) else None)
                parts.append(values[:kept])
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.uint64), *parts]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["doc_id", "text_key", "n", "digest", "values"])

    bound_batches(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("text_key", T.StringType()),
                           T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("values", T.ArrayType(T.LongType()))])
    source = docs.select("doc_id", F.sha2("text", 256).alias("text_key"), "text")
    return stage_table(source.mapInArrow(run, schema), "minhash-sketches")


# --- inverted lists ----------------------------------------------------------

def retained_counts(classes: DataFrame) -> np.ndarray:
    """How often the retained values of every slot occur (at most COUNTERS rows reach the driver)."""
    slot = F.col("value").bitwiseAND(F.lit(COUNTERS - 1))
    found = classes.select(F.explode("values").alias("value")).groupBy(slot.cast("int").alias("slot")).count().toPandas()
    counts = np.zeros(COUNTERS, dtype=np.int32)
    counts[found["slot"]] = np.minimum(found["count"], (1 << 31) - 1)
    return counts


def prefix_rows(classes: DataFrame, counts: np.ndarray, kept: int = KEPT, percent: int = PERCENT) -> DataFrame:
    """(value, class, n): the rarest retained values of every class, as many as may hold its first shared one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            have = f["values"].map(len).to_numpy()
            if not len(f):
                continue
            flat, row = np.concatenate(f["values"].to_numpy()), np.repeat(np.arange(len(f)), have)
            flat = flat[np.lexsort((flat, counts[flat & (COUNTERS - 1)], row))]
            rank = np.arange(len(flat)) - np.repeat(np.cumsum(have) - have, have)
            most = have - np.array([needed(n, kept, percent) for n in f.n.tolist()]) + 1
            hit = rank < most[row]
            yield pd.DataFrame({"value": flat[hit], "cid": f.cid.to_numpy()[row[hit]], "n": f.n.to_numpy()[row[hit]]})

    return classes.select("cid", "n", "values").mapInPandas(run, "value long, cid long, n long")


def short_pairs(lists: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): the distinct pairs of short lists whose set sizes allow a link."""
    members = (lists.filter(F.col("members") <= SHORT).groupBy("value")
               .agg(F.sort_array(F.collect_list(F.struct("cid", "n"))).alias("all")))
    ones = members.select("all", F.posexplode("all").alias("at", "one"))
    pairs = ones.select("one", F.explode(F.expr("slice(all, at + 2, size(all))")).alias("two"))
    near = 100 * F.least("one.n", "two.n") >= percent * F.greatest("one.n", "two.n")
    return pairs.filter(near).select(F.col("one.cid").alias("a"), F.col("two.cid").alias("b")).distinct()


def judged(pairs: DataFrame, classes: DataFrame, kept: int = KEPT, percent: int = PERCENT) -> DataFrame:
    """(a, b, sure) for the pairs that the union sketch leaves."""
    def end(name: str) -> DataFrame:
        return classes.select(F.col("cid").alias(name), F.col("n").alias(f"n_{name}"), F.col("values").alias(f"values_{name}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            told = np.array([verdict(x.view(np.uint64), y.view(np.uint64), m, n, kept, percent) for x, y, m, n in
                             zip(f.values_a, f.values_b, f.n_a.tolist(), f.n_b.tolist(), strict=True)], dtype=np.int64)
            yield pd.DataFrame({"a": f.a[told > 0], "b": f.b[told > 0], "sure": told[told > 0] == 2})

    return (pairs.join(end("a"), "a").join(end("b"), "b")
            .mapInPandas(run, "a long, b long, sure boolean"))


# --- long lists --------------------------------------------------------------

def overlaps(row: np.ndarray, flat: np.ndarray, m: int) -> np.ndarray:
    """Shared values of every two of m sketches, given as (row, value); the diagonal is not filled."""
    order = np.lexsort((row, flat))
    _, at, times = np.unique(flat[order], return_inverse=True, return_counts=True)
    row, out = row[order], np.zeros((m, m), dtype=np.int32)
    thin = (times[at] > 1) & (times[at] <= THIN)
    thin_at, thin_row = at[thin], row[thin]
    for lag in range(1, int(times[times <= THIN].max(initial=1))):
        same = np.flatnonzero(thin_at[lag:] == thin_at[:-lag])
        np.add.at(out, (thin_row[same], thin_row[same + lag]), 1)
    many = np.flatnonzero(times > THIN)
    slot = np.full(len(times), -1)
    slot[many] = np.arange(len(many))
    for start in range(0, len(many), 4096):
        here = (slot[at] >= start) & (slot[at] < start + 4096)
        held = np.zeros((m, min(4096, len(many) - start)), dtype=np.float32)
        held[row[here], slot[at[here]] - start] = 1
        out += np.triu((held @ held.T).astype(np.int32), 1)
    return out + out.T


def spanning_forest(adjacent: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a graph, from nodes of many neighbours on."""
    left = np.ones(len(adjacent), dtype=bool)
    edges: list[tuple[int, int]] = []
    for root in np.argsort(-adjacent.sum(axis=1), kind="stable").tolist():
        if not left[root]:
            continue
        left[root], work = False, [root]
        while work:
            node = work.pop()
            new = np.flatnonzero(adjacent[node] & left)
            left[new] = False
            edges += [(node, x) for x in new.tolist()]
            work += new.tolist()
    return edges


def block_pairs(f: pd.DataFrame, counts: np.ndarray, kept: int, percent: int) -> pd.DataFrame:
    """(a, b, sure) of two blocks of a list: forests of links and candidates, or,
    where components are known, every candidate between two of them.

    A pair belongs to the list of its first shared value in the common order
    (which both prefixes hold), so one list only looks at it.
    """
    f = f.sort_values("cid").drop_duplicates("cid")
    values, n, cid, own = f["values"].tolist(), f.n.to_numpy(), f.cid.to_numpy(), int(f.value.iloc[0])
    row, flat = np.repeat(np.arange(len(n)), [len(v) for v in values]), np.concatenate(values)
    times, here = counts[flat & (COUNTERS - 1)], counts[own & (COUNTERS - 1)]
    before = (times < here) | (times == here) & (flat < own)
    near = (100 * np.minimum.outer(n, n) >= percent * np.maximum.outer(n, n)) & ~np.eye(len(n), dtype=bool)
    near &= overlaps(row[before], flat[before], len(n)) == 0
    shared = overlaps(row, flat, len(n)) if near.any() else np.zeros(near.shape, dtype=np.int32)
    exact = np.maximum.outer(n, n) <= kept
    sure = near & exact & (100 * shared >= percent * (n[:, None] + n[None, :] - shared))
    x, y = np.nonzero(np.triu(near & ~exact & (shared > 0)))
    if f.component.notna().all():
        apart = f.component.to_numpy()
        x, y = (z[apart[x] != apart[y]] for z in (x, y))
    unions, at = np.unique((n[x] + n[y]) * 100 // (100 + percent), return_inverse=True)
    enough = shared[x, y] >= np.array([least_shared(int(u), kept, percent) for u in unions] + [0])[at]
    unsigned = [v.view(np.uint64) for v in values]
    maybe = np.zeros_like(sure)
    for i, j in zip(x[enough].tolist(), y[enough].tolist(), strict=True):
        maybe[i, j] = maybe[j, i] = verdict(unsigned[i], unsigned[j], int(n[i]), int(n[j]), kept, percent) > 0
    if f.component.notna().all():
        found = [(i, j, False) for i, j in zip(*np.nonzero(np.triu(maybe)), strict=True)]
    else:
        found = [(i, j, True) for i, j in spanning_forest(sure)]
        found += [(i, j, False) for i, j in spanning_forest(sure | maybe) if not sure[i, j]]
    a, b = (np.array([e[k] for e in found], dtype=np.int64) for k in (0, 1))
    return pd.DataFrame({"a": np.minimum(cid[a], cid[b]), "b": np.maximum(cid[a], cid[b]),
                         "sure": np.array([e[2] for e in found], dtype=bool)})


def long_pairs(lists: DataFrame, classes: DataFrame, counts: np.ndarray, components: DataFrame | None = None,
               kept: int = KEPT, percent: int = PERCENT) -> DataFrame:
    """(a, b, sure) from the lists of more than SHORT classes, two blocks at a time."""
    own = lists.filter(F.col("members") > SHORT)
    if components is None:
        own = own.withColumn("component", F.lit(None).cast("long"))
    else:
        own = (own.join(components.select(F.col("node").alias("cid"), "component"), "cid", "left")
               .withColumn("component", F.coalesce("component", "cid")))
        mixed = own.groupBy("value").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
        own = own.join(mixed.select("value"), "value", "left_semi")
    blocks = F.ceil(F.col("members") / BLOCK)
    dealt = (own.withColumn("i", F.pmod(F.xxhash64("cid", "value"), blocks))
             .withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
             .select("value", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "cid", "component"))
    return (dealt.join(classes.select("cid", "n", "values"), "cid").groupBy("value", "i", "j")
            .applyInPandas(lambda f: block_pairs(f, counts, kept, percent), "a long, b long, sure boolean"))


# --- exact Jaccard -----------------------------------------------------------

def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame,
             size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(a, b): the pairs whose full shingle sets are similar enough."""
    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    wanted = classes.select("cid", "text_key").join(ends, "cid", "left_semi")
    texts = stage_table(docs.select(F.sha2("text", 256).alias("text_key"), "text").join(wanted, "text_key")
                        .select("cid", "text").dropDuplicates(["cid"]), "minhash-texts", compression="zstd")

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple[int | None, set[bytes]] = (None, set())      # pairs of one class follow each other
        for f in batches:
            hit = []
            for a, one, two in zip(f.a.tolist(), f.text_a, f.text_b, strict=True):
                if a != last[0]:
                    last = (a, set(shingles(one, size)))
                hit.append(linked(last[1], set(shingles(two, size)), percent))
            yield f.loc[np.array(hit, dtype=bool), ["a", "b"]]

    both = (pairs.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a"))
    return both.mapInPandas(run, "a long, b long")


# --- the operator ------------------------------------------------------------

def class_components(classes: DataFrame, docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT,
                     kept: int = KEPT) -> DataFrame:
    """(node, component) for the classes that are linked with another."""
    counts = retained_counts(classes)
    rows = stage_table(prefix_rows(classes, counts, kept, percent), "minhash-values")
    sizes = rows.groupBy("value").agg(F.count("*").alias("members")).filter("members > 1")
    lists = stage_table(rows.join(sizes, "value"), "minhash-lists")
    # the ids are written first: their size then decides whether the sketches move for this
    ids = stage_table(lists.select("cid").distinct(), "minhash-ids")
    listed = stage_table(classes.join(ids, "cid", "left_semi"), "minhash-listed")
    first = stage_table(judged(short_pairs(lists, percent), listed, kept, percent)
                        .unionByName(long_pairs(lists, listed, counts, None, kept, percent)), "minhash-candidates")
    sure, open_pairs = first.filter("sure").select("a", "b"), first.filter("not sure").select("a", "b").distinct()
    found = sure
    if not open_pairs.isEmpty():
        found = stage_table(sure.union(verified(open_pairs, listed, docs, size, percent)), "minhash-links")
    reach = connected_components(found)
    rest = stage_table(long_pairs(lists, listed, counts, reach, kept, percent).select("a", "b")
                       .join(open_pairs, ["a", "b"], "left_anti"), "minhash-rest")
    if rest.isEmpty():
        return reach
    return connected_components(found.union(stage_table(verified(rest, listed, docs, size, percent), "minhash-more")))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, kept: int = KEPT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept per row.

    Null, empty and blank texts have an empty set and are linked with nothing:
    they are their own component. Rows of equal sets are linked. An id that
    repeats belongs to several rows, each by its own text; ``component_id`` is
    the smallest non-null id of the component (null: it has none). ``kept``: the
    row's id is the component's, so every row with a null id is kept where the
    whole component has none. Empty in, empty out; other columns are not read.
    """
    made = sketches(docs, size, kept)
    rows = stage_table(made.select("doc_id", "n", "digest"), "minhash-rows")
    classes = stage_table(
        made.filter("n > 0").groupBy("digest").agg(
            F.min("text_key").alias("text_key"), F.first("n").alias("n"), F.first("values").alias("values"),
            F.min("doc_id").alias("least_id"))
        .withColumn("cid", F.monotonically_increasing_id()), "minhash-classes")
    unstage(made)                                                # a sketch per class is enough from here
    reach = class_components(classes, docs, size, percent, kept)
    of = classes.select("digest", "cid", "least_id").join(
        reach.select(F.col("node").alias("cid"), "component"), "cid", "left").select(
        "digest", "least_id", F.coalesce("component", "cid").alias("component"))
    least = of.groupBy("component").agg(F.min("least_id").alias("component_id"))
    told = of.join(least, "component").select("digest", "component_id", F.lit(True).alias("told"))
    ids = F.when(F.col("told"), F.col("component_id")).otherwise(F.col("doc_id"))
    return (rows.select("doc_id", "n", "digest").join(told, "digest", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), ids.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
