"""Exact inner-product search: a ball tree per shard, searched by branch and bound.

Vectors are turned into integers, ``floor(256 x)`` per component. Rows are
dealt to shards of at most about ``SHARD_ROWS`` by a hash of the id; a task
builds its shard's ball tree: a node is split at the median along the axis
between two far points, and keeps its centre, radius and range of rows. The
inner product of a query ``q`` with any row of a node is at most
``q . centre + |q| * radius``.

Queries go to the shards in blocks (the query set is a stated one, so every
block meets every shard). A block first meets one shard, which gives every
query a k-th score to start from; that score goes with the block to all other
shards, where nodes are taken in the order of their bounds, per query until
the bound is below the k-th score so far. Scores are exact integers; bounds
are widened by more than their rounding error.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import stage_table
from .common import ROW, bound_batches, shuffle_partitions, tag_rows, tidy

K, EVERY = 5, 50
SHARD_ROWS, BLOCK_QUERIES, LEAF_ROWS = 4096, 256, 64
LIMIT = 1 << 20              # up to here sums of products are exact in float64
LONG = (1 << 63) - 1


def integer_vector(col: str) -> Column:
    """floor(256 x) as long; null where the vector, or a component, is null or not finite."""
    x = lambda v: v.cast("double")
    fine = F.forall(col, lambda v: v.isNotNull() & ~F.isnan(x(v)) & (F.abs(x(v)) < float("inf")))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(col, lambda v: F.greatest(F.floor(x(v) * 256), F.lit(-LONG))))


# --- one shard ---------------------------------------------------------------

def build_tree(rows: np.ndarray, leaf: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """A ball tree over ``rows``: their order, and per node its range of that
    order, children (-1: a leaf), centre and radius."""
    order = np.arange(len(rows))
    lo, hi, kids, centres, radii, work = [0], [len(rows)], [(-1, -1)], [], [], [0]
    points = rows.astype(np.float64)
    while work:
        node = work.pop()
        a, b = lo[node], hi[node]
        if b - a <= leaf:
            continue
        own = points[order[a:b]]
        one = own[np.argmax(((own - own.mean(axis=0)) ** 2).sum(axis=1))]
        two = own[np.argmax(((own - one) ** 2).sum(axis=1))]
        order[a:b] = order[a:b][np.argsort(own @ (two - one), kind="stable")]
        mid = (a + b) // 2
        kids[node] = (len(lo), len(lo) + 1)
        work += kids[node]
        lo += [a, mid]
        hi += [mid, b]
        kids += [(-1, -1)] * 2
    for a, b in zip(lo, hi, strict=True):
        own = points[order[a:b]]
        centres.append(own.mean(axis=0))
        radii.append(np.sqrt(((own - centres[-1]) ** 2).sum(axis=1).max()))
    return {"order": order, "lo": np.array(lo), "hi": np.array(hi), "kids": np.array(kids),
            "centre": np.array(centres), "radius": np.array(radii)}


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, (queries, rows); beyond 64 bits the nearest long."""
    if max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0)) <= LIMIT:
        return (queries.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    wide = queries.astype(object) @ rows.astype(object).T
    return np.clip(wide, -LONG, LONG).astype(np.int64)


def search(tree: dict[str, np.ndarray], rows: np.ndarray, ids: np.ndarray, tags: np.ndarray,
           queries: np.ndarray, query_tags: np.ndarray, least: np.ndarray, k: int) -> list[tuple[np.ndarray, ...]]:
    """Per query (scores, ids, tags) of its k best rows of this shard, its own
    row left out, best first; rows that score below ``least`` may be missing.

    Nodes are taken by their largest bound over the queries that still need them.
    """
    n = len(queries)
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    best = [(np.zeros(0, np.int64),) * 3 for _ in range(n)]
    kth = least.copy()

    def bounds(node: int, which: np.ndarray) -> np.ndarray:
        centre, radius = tree["centre"][node], tree["radius"][node]
        value = queries[which].astype(np.float64) @ centre + norms[which] * radius
        return value + 1 + 1e-9 * (np.abs(value) + norms[which] * (np.linalg.norm(centre) + radius))

    everyone = np.arange(n)
    first = bounds(0, everyone)
    heap = [(-float(first.max()), 0, everyone, first)]
    while heap:
        _, node, which, bound = heapq.heappop(heap)
        need = bound >= kth[which]
        which = which[need]
        if not len(which):
            continue
        left, right = tree["kids"][node]
        if left >= 0:
            for child in (left, right):
                b = bounds(child, which)
                ok = b >= kth[which]
                if ok.any():
                    heapq.heappush(heap, (-float(b[ok].max()), int(child), which[ok], b[ok]))
            continue
        at = tree["order"][tree["lo"][node]:tree["hi"][node]]
        score = products(queries[which], rows[at])
        for q, s in zip(which.tolist(), score, strict=True):
            hit = np.flatnonzero((s >= kth[q]) & (tags[at] != query_tags[q]))
            if len(hit):
                have = [np.concatenate([x, y]) for x, y in zip(best[q], (s[hit], ids[at[hit]], tags[at[hit]]), strict=True)]
                top = np.lexsort((have[2], have[1], -have[0]))[:k]
                best[q] = tuple(x[top] for x in have)
                if len(top) == k:
                    kth[q] = max(kth[q], best[q][0][-1])
    return best


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(data)))


# --- on Spark ----------------------------------------------------------------

def top_k(table: DataFrame, k: int = K, every: int = EVERY, id_col: str = "vec_id", vector_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query, exact.

    Queries are the rows whose id is divisible by ``every``; candidates all
    rows but the query's own, so a row that repeats it is one. Rows with a null
    id, a null vector, or a null or non-finite component take no part. Vectors
    of different lengths do not meet. Ties go to the smaller id. Fewer than k
    candidates: all of them. Empty in, empty out; other columns are not read.
    """
    spark = table.sparkSession
    bound_batches(spark)
    vectors = tag_rows(table.select(F.col(id_col).cast("long").alias("id"), integer_vector(vector_col).alias("v"))
                       .filter("id is not null and v is not null"), "search-vectors")
    sizes = {r.dims: (r.n, r.q) for r in vectors.groupBy(F.size("v").alias("dims")).agg(
        F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("q")).collect()}    # a row per length
    shards = {d: -(-n // shard_rows) for d, (n, _) in sizes.items()}
    blocks = {d: -(-q // block_queries) for d, (_, q) in sizes.items()}
    schema = "query_id long, query_tag long, vec_id long, tag long, score long"
    if not sizes or not any(blocks.values()):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    per_dims = lambda m: F.create_map(*[F.lit(x).cast("long") for kv in m.items() for x in kv])[F.size("v").cast("long")]

    def numbered(part: DataFrame, count: dict[int, int], name: str) -> DataFrame:
        """Rows dealt evenly: the vectors' length and a number below ``count`` in one key."""
        return part.withColumn(name, F.pmod(F.xxhash64(ROW), per_dims(count)) + F.shiftleft(F.size("v").cast("long"), 32))

    def tree_of(f: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(f.v.to_numpy()) if len(f.v.iloc[0]) else np.zeros((len(f), 0), np.int64)
        data = packed(rows=rows, ids=f.id.to_numpy(), tags=f[ROW].to_numpy(), **build_tree(rows))
        return pd.DataFrame({"shard": f.shard.iloc[:1], "tree": [data]})

    def block_of(f: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(f.v.to_numpy()) if len(f.v.iloc[0]) else np.zeros((len(f), 0), np.int64)
        return pd.DataFrame({"block": f.block.iloc[:1],
                             "queries": [packed(rows=rows, ids=f.id.to_numpy(), tags=f[ROW].to_numpy())]})

    trees = stage_table(numbered(vectors, shards, "shard").groupBy("shard")
                        .applyInPandas(tree_of, "shard long, tree binary"), "search-trees")
    asked = stage_table(numbered(vectors.filter(F.col("id") % every == 0), blocks, "block").groupBy("block")
                        .applyInPandas(block_of, "block long, queries binary"), "search-queries")

    @tidy
    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            for number, tree, block, seed in zip(f.block, f.tree, f.queries, f.seed, strict=True):
                t, q = unpacked(tree), unpacked(block)
                least = np.full(len(q["ids"]), -LONG, dtype=np.int64)
                if seed is not None:
                    known = unpacked(seed)
                    at = {x: y for x, y in zip(known["tags"].tolist(), known["kth"].tolist(), strict=True)}
                    least = np.array([at.get(x, -LONG) for x in q["tags"].tolist()], dtype=np.int64)
                found = search(t, t["rows"], t["ids"], t["tags"], q["rows"], q["tags"], least, k)
                n = [len(x[0]) for x in found]
                yield pd.DataFrame({"query_id": np.repeat(q["ids"], n), "query_tag": np.repeat(q["tags"], n),
                                    "vec_id": np.concatenate([x[1] for x in found]), "tag": np.concatenate([x[2] for x in found]),
                                    "score": np.concatenate([x[0] for x in found]), "block": number})

    dims = F.shiftright("block", 32)
    count = F.create_map(*[F.lit(x).cast("long") for kv in shards.items() for x in kv])[dims]
    first = F.pmod(F.col("block"), count) + F.shiftleft(dims, 32)
    tasks = shuffle_partitions(spark)

    def meet(pairs: DataFrame) -> DataFrame:
        # a fixed number of tasks: the blobs are few, and coalescing would undo the spread
        return (pairs.repartition(tasks, "shard").join(trees.repartition(tasks, "shard"), "shard")
                .select("block", "queries", "seed", "tree").mapInPandas(visit, schema + ", block long"))

    opening = stage_table(meet(asked.withColumn("shard", first).withColumn("seed", F.lit(None).cast("binary"))), "search-first")

    def kth_of(f: pd.DataFrame) -> pd.DataFrame:
        full = f.groupby("query_tag").score.agg(["size", "min"])
        full = full[full["size"] >= k]
        return pd.DataFrame({"block": f.block.iloc[:1], "seed": [packed(
            tags=full.index.to_numpy(np.int64), kth=full["min"].to_numpy(np.int64))]})

    seeds = opening.groupBy("block").applyInPandas(kth_of, "block long, seed binary")
    rest = (asked.join(seeds, "block", "left")
            .withColumn("shard", F.explode(F.transform(F.sequence(F.lit(0).cast("long"), count - 1),
                                                       lambda x: x + F.shiftleft(dims, 32))))
            .filter(F.col("shard") != first))
    both = opening.unionByName(stage_table(meet(rest), "search-rest"))
    order = W.partitionBy("query_tag").orderBy(F.desc("score"), "vec_id", "tag")
    return (both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
