"""SimHash near-dedup by a binary trie self-join.

Fingerprints are strings of 64 bits, hence leaves of a binary trie. The
self-join walks pairs of trie nodes of equal depth together, starting with
(root, root): a pair's children are visited with the bits in which the two
paths differ added up, and a pair whose sum exceeds the budget is dropped with
everything below it. A node is a range of the sorted fingerprints; a frontier
of node pairs is one set of arrays, and all pairs of a level step at once.

On a cluster the trie is cut below its top levels. The 64 bits are split into
``budget + 1`` blocks; two fingerprints within the budget agree on one block at
least, so the trie is built once per block with that block's bits on top, and
every subtree under a full block is a task's work on its own (the pairs of two
different subtrees differ in the block; another block finds them). A subtree of
more than ``MOST_LEAVES`` leaves is cut again: its next bits name a smaller
subtree, and a fingerprint also visits the smaller subtrees whose name is
within the budget of its own, by name order, so that every pair meets once.
Only distinct fingerprints are joined, so a leaf has at most
``1 + 64 + 64 * 63 / 2`` partners at a budget of 2, however many copies a text has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import ROW, bound_batches, content_key, keep_rows, text_or_empty, tidy
from .components import connected_components

BITS = 64
SHINGLE_WORDS, BUDGET, SEED = 3, 2, 42
MOST_LEAVES = 50_000         # of a subtree; larger ones are cut at SUB_BITS more bits
SUB_BITS = 8
FRONTIER = 1 << 18           # node pairs that step at once
VOTE_CHUNK = 1 << 16
HELD_ROWS = 1 << 18          # rows of whole subtrees that are joined at once


# --- fingerprints ------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The bits set in over half of the shingles' XXH64 (no words: zero).

    ``bytes.lower`` and ``bytes.split`` know ASCII only, as the contract does.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - shingle + 1)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, [line[a:b] for a, b in zip(starts, stops, strict=True)],
                             [seed] * n), dtype="<u8", count=n)
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, VOTE_CHUNK):
        part = hashes[at:at + VOTE_CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * votes > n).tolist()))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS, row_col: str | None = None) -> DataFrame:
    """(doc_id, row tag, fp as a signed 64-bit number) per row, written down."""

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            fps = np.fromiter((fingerprint(t, shingle) for t in f["__text"]), dtype=np.uint64, count=len(f))
            yield pd.DataFrame({"__at": f["__at"], "fp": fps.view(np.int64)})

    bound_batches(docs.sparkSession)
    # only the tag travels with the text: an id column may hold nulls, which
    # pandas would turn into floats
    tag = F.col(row_col) if row_col else F.monotonically_increasing_id()
    packed = F.struct(F.col("doc_id"), tag.alias(ROW))
    source = docs.select(F.to_json(packed).alias("__at"), text_or_empty().alias("__text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = source.mapInPandas(run, "`__at` string, fp long")
    tag_kind = docs.schema[row_col].dataType.simpleString() if row_col else "long"
    back = F.from_json("__at", f"doc_id {kind}, `{ROW}` {tag_kind}")
    return stage_table(out.select(back.alias("at"), "fp").select("at.*", "fp"), "simhash-fingerprints")


# --- the trie join -----------------------------------------------------------

def _halves(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """Where a node's leaves with the bit set begin (leaves are sorted, prefixes equal)."""
    prefix = values[lo] >> (bit + np.uint64(1)) << (bit + np.uint64(1))
    mid = np.searchsorted(values, prefix | (np.uint64(1) << bit))
    return np.clip(mid, lo, hi)


def trie_pairs(values: np.ndarray, budget: int, starts: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Leaf pairs (i, j) within the budget under the start pairs.

    ``values``: sorted unsigned leaves. ``starts``: arrays of equal length, the
    ranges (lo, hi) of either node, the depth that the two nodes have and the
    bits that differ so far. A pair of a node with itself gives each leaf pair
    once. Where both nodes are one leaf the rest of the path is one step.
    """
    stack = [(int(d), *(x[starts[4] == d] for x in (*starts[:4], starts[5]))) for d in np.unique(starts[4])]
    while stack:
        depth, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > FRONTIER:
            half = len(alo) // 2
            for s in (slice(half, None), slice(half)):
                stack.append((depth, alo[s], ahi[s], blo[s], bhi[s], diff[s]))
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        if single.any():
            i, j = alo[single], blo[single]
            hit = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            if hit.any():
                yield i[hit], j[hit]
            alo, ahi, blo, bhi, diff = (x[~single] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo) or depth == BITS:
            continue
        bit = np.uint64(BITS - 1 - depth)
        amid, bmid = _halves(values, alo, ahi, bit), _halves(values, blo, bhi, bit)
        same = (alo == blo) & (ahi == bhi)
        parts = [(alo, amid, blo, bmid, diff, None), (amid, ahi, bmid, bhi, diff, None),
                 (alo, amid, bmid, bhi, diff + 1, None), (amid, ahi, blo, bmid, diff + 1, ~same)]
        kept = []
        for a0, a1, b0, b1, d, only in parts:
            ok = (a1 > a0) & (b1 > b0) & (d <= budget)
            ok &= ~((a1 - a0 == 1) & (a0 == b0) & (a1 == b1))       # a leaf with itself
            if only is not None:
                ok &= only
            kept.append(tuple(x[ok] for x in (a0, a1, b0, b1, d)))
        nxt = tuple(np.concatenate(x) for x in zip(*kept, strict=True))
        if len(nxt[0]):
            stack.append((depth + 1, *nxt))


def subtree_starts(values: np.ndarray, group: np.ndarray, home: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start pairs of many subtrees: each one's home node with itself and with
    the nodes of its visitors.

    Rows are sorted by (group, value); a subtree's rows share their first
    ``top`` bits but for the visitors, each run of which has a name of its own.
    """
    name = values >> (np.uint64(BITS) - top.astype(np.uint64))
    edge = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]) | (name[1:] != name[:-1]), [True]]))
    lo, hi = edge[:-1], edge[1:]
    own = home[lo]
    home_of = np.full(int(group[-1]) + 1, -1)
    home_of[group[lo[own]]] = np.flatnonzero(own)
    node, guest = np.flatnonzero(own & (hi - lo > 1)), np.flatnonzero(~own & (home_of[group[lo]] >= 0))
    a, b = np.concatenate([node, home_of[group[lo[guest]]]]), np.concatenate([node, guest])
    return lo[a], hi[a], lo[b], hi[b], top[lo[a]], np.bitwise_count(name[lo[a]] ^ name[lo[b]]).astype(np.int64)


def rotate(values: np.ndarray, shift: int) -> np.ndarray:
    """Left rotation, so that a block's bits come first."""
    if shift % BITS == 0:
        return values
    return values << np.uint64(shift) | values >> np.uint64(BITS - shift)


def blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of the budget + 1 blocks."""
    ends = [BITS * k // (budget + 1) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def links(distinct: DataFrame, budget: int = BUDGET, most_leaves: int = MOST_LEAVES) -> DataFrame:
    """(a, b) for every two distinct fingerprints (column fp) within the budget."""
    turned = []
    for number, (start, width) in enumerate(blocks(budget)):
        rot = F.shiftleft("fp", start).bitwiseOR(F.shiftrightunsigned("fp", BITS - start)) if start else F.col("fp")
        turned.append(distinct.select(F.lit(number).alias("block"), rot.alias("rot"))
                      .withColumn("name", F.shiftrightunsigned("rot", BITS - width)))
    leaves = turned[0]
    for t in turned[1:]:
        leaves = leaves.unionByName(t)
    # subtrees that are too large for one task, with the bits that cut them
    large = stage_table(leaves.groupBy("block", "name").count().filter(F.col("count") > most_leaves)
                        .select("block", "name", F.lit(True).alias("large")), "simhash-large")
    widths = F.create_map(*[F.lit(x) for k, (_, w) in enumerate(blocks(budget)) for x in (k, w)])
    placed = leaves.join(large, ["block", "name"], "left").withColumn("width", widths[F.col("block")])
    top = F.expr(f"cast(shiftrightunsigned(rot, {BITS} - width - {SUB_BITS}) & {(1 << SUB_BITS) - 1} as int)")
    sub = F.when(F.col("large"), top).otherwise(F.lit(0))
    # the sub-names of a large subtree that are within the budget and not above its own
    masks = F.array(*[F.lit(m) for m in range(1 << SUB_BITS) if m.bit_count() <= budget])
    near = F.when(F.col("large"), F.filter(F.transform(masks, lambda m: m.bitwiseXOR(F.col("sub"))),
                                           lambda s: s <= F.col("sub"))).otherwise(F.array(F.lit(0)))
    visits = (placed.withColumn("sub", sub).withColumn("at", F.explode(near))
              .select("block", "name", "at", "rot", (F.col("at") == F.col("sub")).alias("home"),
                      (F.col("width") + F.when(F.col("large"), SUB_BITS).otherwise(0)).alias("top")))

    cuts = blocks(budget)

    def pairs(f: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Links of whole subtrees, given sorted by (block, name, at, unsigned rot)."""
        block = int(f.block.iloc[0])
        values = f.rot.to_numpy().view(np.uint64)
        keys = [f[c].to_numpy() for c in ("name", "at")]
        group = np.concatenate([[0], np.cumsum(np.any([k[1:] != k[:-1] for k in keys], axis=0))])
        order = np.lexsort((values, group))
        values, home, top = values[order], f.home.to_numpy()[order], f.top.to_numpy()[order].astype(np.int64)
        starts = subtree_starts(values, group, home, top)
        # visitors of one subtree are the home leaves of another, so a value may
        # stand in several groups: a node's range is searched inside its group
        for x, y in grouped_pairs(values, group, starts):
            x, y = rotate(x, BITS - cuts[block][0]), rotate(y, BITS - cuts[block][0])
            new = np.ones(len(x), dtype=bool)       # an earlier block that agrees as well has found the pair
            for start, width in cuts[:block]:
                new &= rotate(x ^ y, start) >> np.uint64(BITS - width) != 0
            if new.any():
                yield pd.DataFrame({"a": x[new].view(np.int64), "b": y[new].view(np.int64)})

    def grouped_pairs(values, group, starts):
        plain = values[1:] >= values[:-1]
        if plain.all():
            spans = [(0, len(values))]
        else:                                       # only where subtrees were cut
            cut = np.concatenate([[0], np.flatnonzero(~plain) + 1, [len(values)]])
            spans = list(zip(cut[:-1], cut[1:], strict=True))
        for lo, hi in spans:
            inside = (starts[0] >= lo) & (starts[1] <= hi) & (starts[2] >= lo) & (starts[3] <= hi)
            part = tuple(x[inside] - lo * (k < 4) for k, x in enumerate(starts))
            own = values[lo:hi]
            for i, j in trie_pairs(own, budget, part):
                yield own[i], own[j]

    @tidy
    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def whole(last: bool) -> Iterator[pd.DataFrame]:
            f = pd.concat(held, ignore_index=True)
            held.clear()
            if not len(f):
                return
            block = f.block.to_numpy()
            ends = [*(np.flatnonzero(block[1:] != block[:-1]) + 1), len(f)]
            if not last:                            # the last subtree may go on in the next batch
                keys = [f[c].to_numpy() for c in ("block", "name", "at")]
                end = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
                end = int(end[-1]) if len(end) else 0
                held.append(f.iloc[end:])
                ends = [*(e for e in ends if e < end), *([end] if end else [])]
            for a, b in zip([0, *ends], ends, strict=False):
                yield from pairs(f.iloc[a:b])

        for f in batches:
            held.append(f)
            if sum(map(len, held)) > HELD_ROWS:
                yield from whole(False)
        if held:
            yield from whole(True)

    return (visits.repartition(F.col("block"), F.col("name"), F.col("at"))
            .sortWithinPartitions("block", "name", "at").mapInPandas(join, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, budget: int = BUDGET,
                    row_col: str | None = None) -> DataFrame:
    """doc_id, fingerprint, component_id, row tag and kept for every row.

    A text without words (null and empty too) has fingerprint zero and is
    linked like any other. Rows that repeat share a component. A null doc_id is
    never a component's id unless the component has no other; of the rows that
    carry the smallest id one is kept. An empty table gives no rows; columns
    other than doc_id and text are not read.
    """
    prints = fingerprints(docs, shingle, row_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col(ROW).alias("tag")))
    distinct = stage_table(prints.groupBy("fp").agg(first.alias("least")), "simhash-distinct")
    found = stage_table(links(distinct.select("fp"), budget), "simhash-links")
    labels = connected_components(found)
    merged = distinct.join(labels, distinct.fp == labels.node, "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    merged = stage_table(merged, "simhash-merged")
    heads = stage_table(merged.groupBy("component").agg(F.min("least").alias("head")), "simhash-heads")
    by_print = stage_table(merged.join(heads, "component").select(F.col("fp").alias("print"), "head"), "simhash-groups")
    return prints.join(by_print, prints.fp == by_print["print"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head.id").alias("component_id"), (F.col("head.tag") == F.col(ROW)).alias("kept"), ROW)


def keep_one(docs: DataFrame, shingle: int = SHINGLE_WORDS, budget: int = BUDGET) -> DataFrame:
    """One row of each group of near copies, all columns as they came."""
    named = docs.select("doc_id", "text", content_key().alias(ROW))
    return keep_rows(docs, near_duplicates(named, shingle, budget, row_col=ROW), "simhash")
