"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

Vectors are turned into integers, ``floor(256 x)`` per component. A vector's
direction is projected to a few dimensions, mapped to a grid, and rows are
range-sorted by the Hilbert index of their cell; every ``BLOCK_ROWS`` rows of
that order become one block, a row of a Parquet table that holds the packed
vectors beside the block's zone map: the least and the largest value of every
dimension, and its labels. The zone columns are read without the vectors.

A *window* is an anchor with a range of scores and a side of the label (the
anchor's own, or another). Interval arithmetic on a zone map bounds the inner
products of an anchor with all rows of a block from both sides, so the blocks
that a window must read are chosen before any vector is: its range, and the
k-th score that it already has, must meet the block's bounds, and the block
must have a fitting label. Every window first reads the one block of the
largest bound out of a share of the zone maps, for a k-th score to start from.

Positives are the best rows of an open window on the own label; each positive
then gives the window of its negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import stage_table
from .balltree import LONG, integer_vector, packed, products, unpacked
from .common import ROW, bound_batches, tidy
from .packing import hilbert_index

EVERY, SHIFT_EVERY, LABELS = 100, 7, 10
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
BLOCK_ROWS, RANGE_BLOCKS = 2048, 8
GROUP, ZONES = 128, 512      # anchors of a group, zone maps of a chunk
CURVE_DIMS, CURVE_BITS = 6, 8
NONE = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def narrow(rows: np.ndarray) -> np.ndarray:
    """The same numbers in the smallest signed type that holds them."""
    most = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))))
    return rows.astype(next((t for t in (np.int8, np.int16, np.int32) if most <= np.iinfo(t).max), np.int64))


def matrix(vectors: list[np.ndarray]) -> np.ndarray:
    return np.stack(vectors) if len(vectors[0]) else np.zeros((len(vectors), 0), np.int64)


def curve_keys(rows: np.ndarray) -> np.ndarray:
    """Hilbert index of each vector's direction (a null vector: the middle cell)."""
    x = rows.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
    y = x / np.where(norm > 0, norm, 1) @ np.random.default_rng(1).standard_normal((x.shape[1], CURVE_DIMS))
    cell = (1 / (1 + np.exp(-1.702 * y)) * (1 << CURVE_BITS)).astype(np.int64)
    return hilbert_index(np.clip(cell, 0, (1 << CURVE_BITS) - 1), CURVE_BITS)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of every query with any row of every zone,
    widened by more than their rounding error."""
    up, down = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    slack = 1 + 1e-9 * (np.abs(queries.astype(np.float64)) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def window_needs(q: dict[str, np.ndarray], z: dict[str, np.ndarray], kth: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(needed, upper bound) of every window and zone."""
    least, most = bounds(q["rows"], z["low"], z["high"])
    at = q["anchor"]
    own = np.array([[int(x) in labels for labels in z["labels"]] for x in q["labels"]], dtype=bool).reshape(len(q["labels"]), -1)
    several = np.array([len(labels) > 1 for labels in z["labels"]], dtype=bool)
    fits = own if same else several[None, :] | ~own
    need = fits[at] & (most[at] >= np.maximum(q["low"], kth)[:, None]) & (least[at] <= q["high"][:, None])
    return need, most[at]


def read_windows(q: dict[str, np.ndarray], b: dict[str, np.ndarray], which: np.ndarray, kth: np.ndarray,
                 same: bool, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, row of the block) of the k best fitting rows that each asked window may still need."""
    scores = products(q["rows"], b["rows"])
    found = []
    for w in which.tolist():
        a = q["anchor"][w]
        s = scores[a]
        hit = np.flatnonzero((s >= max(q["low"][w], kth[w])) & (s <= q["high"][w])
                             & ((b["labels"] == q["labels"][a]) == same) & (b["tags"] != q["tags"][a]))
        best = hit[np.lexsort((b["tags"][hit], b["ids"][hit], -s[hit]))[:k]]
        found.append((np.full(len(best), w), best))
    return tuple(np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in (0, 1))


# --- on Spark ----------------------------------------------------------------

def ordered_vectors(table: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(id, label, v, tag, dims, curve) of the rows that take part, written down."""
    number = F.col(label_col).cast("long")
    label = F.when(F.col(id_col) % SHIFT_EVERY == 0, (number + 1) % LABELS).otherwise(number)
    rows = (table.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), integer_vector(vector_col).alias("v"),
                         F.monotonically_increasing_id().alias(ROW))
            .filter("id is not null and label is not null and v is not null"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            f["dims"] = f.v.map(len)
            f["curve"] = np.int64(0)
            for _, part in f.groupby("dims"):
                f.loc[part.index, "curve"] = curve_keys(matrix(part.v.tolist()))
            yield f

    return stage_table(rows.mapInPandas(run, f"id long, label long, v array<long>, `{ROW}` long, dims long, curve long"),
                       "negatives-vectors")


def candidate_blocks(vectors: DataFrame, total: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per block in Hilbert order: block, dims, low, high, labels, data; written down."""

    def block_of(f: pd.DataFrame, number: int) -> pd.DataFrame:
        rows = matrix(f.v.tolist())
        data = packed(rows=narrow(rows), ids=f.id.to_numpy(), labels=f.label.to_numpy(), tags=f[ROW].to_numpy())
        return pd.DataFrame({"block": [number], "dims": [rows.shape[1]], "low": [rows.min(axis=0)], "high": [rows.max(axis=0)],
                             "labels": [np.unique(f.label.to_numpy())], "data": [data]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = TaskContext.get().partitionId() << 32, None
        for f in batches:
            held = f if held is None else pd.concat([held, f], ignore_index=True)
            while len(held):
                size = int((held.dims == held.dims.iloc[0])[:block_rows].cumprod().sum())
                if size == len(held) and size < block_rows:
                    break                                        # the block may go on in the next batch
                yield block_of(held[:size], number)
                number, held = number + 1, held[size:].reset_index(drop=True)
        if held is not None and len(held):
            yield block_of(held, number)

    parts = -(-total // (block_rows * RANGE_BLOCKS))
    ordered = vectors.repartitionByRange(parts, "dims", "curve", ROW).sortWithinPartitions("dims", "curve", ROW)
    return stage_table(ordered.mapInPandas(run, "block long, dims long, low array<long>, high array<long>, "
                                                "labels array<long>, data binary"), "negatives-blocks")


def zone_chunks(blocks: DataFrame, chunks: dict[int, int]) -> DataFrame:
    """The zone maps alone, packed by chunk of about ZONES blocks, written down."""
    def pack(f: pd.DataFrame) -> pd.DataFrame:
        width = max(map(len, f.labels))
        return pd.DataFrame({"dims": f.dims.iloc[:1], "chunk": f.chunk.iloc[:1], "zones": [packed(
            low=matrix(f.low.tolist()), high=matrix(f.high.tolist()), block=f.block.to_numpy(),
            count=f.labels.map(len).to_numpy(), labels=np.array([np.pad(x, (0, width - len(x))) for x in f.labels]))]})

    zones = blocks.select("block", "dims", "low", "high", "labels").withColumn(
        "chunk", F.pmod(F.xxhash64("block"), per_length(chunks)))
    return stage_table(zones.groupBy("dims", "chunk").applyInPandas(pack, "dims long, chunk long, zones binary"), "negatives-zones")


def per_length(of: dict[int, int]):
    return F.create_map(*[F.lit(x).cast("long") for kv in of.items() for x in kv])[F.col("dims")]


def grouped_windows(asked: DataFrame) -> DataFrame:
    """Windows (id, label, v, tag, dims, window, low, high) packed by group of anchors, written down."""
    def pack(f: pd.DataFrame) -> pd.DataFrame:
        tags, first, at = np.unique(f[ROW].to_numpy(), return_index=True, return_inverse=True)
        rows = matrix(f.v.iloc[first].tolist())
        return pd.DataFrame({"dims": f.dims.iloc[:1], "grp": f.grp.iloc[:1], "queries": [packed(
            rows=rows, tags=tags, labels=f.label.to_numpy()[first], anchor=at, window=f.window.to_numpy(),
            low=f.low.to_numpy(), high=f.high.to_numpy())]})

    return stage_table(asked.groupBy("dims", "grp").applyInPandas(pack, "dims long, grp long, queries binary"), "negatives-windows")


def best_in_windows(groups: DataFrame, blocks: DataFrame, zones: DataFrame, chunks: dict[int, int],
                    k: int, same: bool) -> DataFrame:
    """(tag, window, id, row, score): for every window a superset of its k best rows, written down."""

    def starts(data: dict[str, np.ndarray], seed: bytes | None) -> np.ndarray:
        kth = np.full(len(data["window"]), -LONG, dtype=np.int64)
        if seed is not None:
            known = unpacked(seed)
            kth[known["at"]] = known["kth"]
        return kth

    def choose(first: bool):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in batches:
                for dims, grp, queries, seed, zone in zip(f.dims, f.grp, f.queries, f.seed, f.zones, strict=True):
                    q, z = unpacked(queries), unpacked(zone)
                    z["labels"] = [set(x[:n].tolist()) for x, n in zip(z["labels"], z["count"].tolist(), strict=True)]
                    need, most = window_needs(q, z, starts(q, seed), same)
                    if first:                                    # of the needed blocks that of the largest bound
                        best = np.where(need, most, -np.inf).argmax(axis=1)
                        need &= np.arange(need.shape[1]) == best[:, None]
                    which = np.flatnonzero(need.any(axis=0))
                    yield pd.DataFrame({"block": z["block"][which], "dims": dims, "grp": grp,
                                        "asked": [packed(which=np.flatnonzero(need[:, i])) for i in which]})
        return run

    def read(first: bool):
        @tidy
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in batches:
                for dims, grp, queries, seed, asked, data in zip(f.dims, f.grp, f.queries, f.seed, f.asked, f.data, strict=True):
                    q, b, kth = unpacked(queries), unpacked(data), None
                    kth = starts(q, seed)
                    w, row = read_windows(q, b, unpacked(asked)["which"], kth, same, k)
                    score = products(q["rows"], b["rows"])[q["anchor"][w], row]
                    if first:
                        yield pd.DataFrame({"dims": dims, "grp": grp, "at": w, "score": score})
                    else:
                        yield pd.DataFrame({"tag": q["tags"][q["anchor"][w]], "window": q["window"][w], "id": b["ids"][row],
                                            "row": b["tags"][row], "score": score})
        return run

    def visit(asking: DataFrame, first: bool, schema: str) -> DataFrame:
        chosen = (asking.join(zones, ["dims", "chunk"])
                  .mapInPandas(choose(first), "block long, dims long, grp long, asked binary"))
        return (chosen.join(blocks.select("block", "data"), "block").join(groups_seeded if not first else unseeded, ["dims", "grp"])
                .mapInPandas(read(first), schema))

    unseeded = groups.withColumn("seed", F.lit(None).cast("binary"))
    opening = stage_table(visit(unseeded.withColumn("chunk", F.pmod("grp", per_length(chunks))), True,
                                "dims long, grp long, at long, score long"), "negatives-opening")

    def kth_of(f: pd.DataFrame) -> pd.DataFrame:
        full = f.groupby("at").score.agg(["size", "min"])        # one block a window: k rows of it at most
        full = full[full["size"] == k]
        return pd.DataFrame({"dims": f.dims.iloc[:1], "grp": f.grp.iloc[:1], "seed": [packed(
            at=full.index.to_numpy(np.int64), kth=full["min"].to_numpy(np.int64))]})

    seeds = opening.groupBy("dims", "grp").applyInPandas(kth_of, "dims long, grp long, seed binary")
    groups_seeded = stage_table(groups.join(seeds, ["dims", "grp"], "left"), "negatives-seeds")
    everywhere = groups_seeded.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), per_length(chunks) - 1)))
    return stage_table(visit(everywhere, False, "tag long, window long, id long, row long, score long"), "negatives-found")


def hard_negatives(table: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, exact.

    Anchors are the rows whose id is divisible by ``every``. Rows with a null id
    or label, a null vector, or a null or non-finite component take no part.
    Vectors of different lengths do not meet. An id that repeats belongs to
    several rows: each anchors on its own, and each is a candidate of the other.
    Ties go to the smaller id. A negative positive score leaves an empty window.
    Scores beyond 64 bits count as the nearest long. Anchors without a positive
    or positives without a negative give no row. Empty in, empty out; other
    columns are not read.
    """
    spark = table.sparkSession
    bound_batches(spark)
    vectors = ordered_vectors(table, id_col, label_col, vector_col)
    anchors = vectors.filter(F.col("id") % every == 0)
    sizes = vectors.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("a")).collect()
    if not any(r.a for r in sizes):
        return spark.createDataFrame([], NONE)
    blocks = candidate_blocks(vectors, sum(r.n for r in sizes), block_rows)
    held = {r.dims: r.n for r in blocks.groupBy("dims").agg(F.count("*").alias("n")).collect()}    # a row per length
    chunks = {d: -(-n // ZONES) for d, n in held.items()}
    zones = zone_chunks(blocks, chunks)
    shares = {r.dims: max(1, -(-r.a // GROUP)) for r in sizes}
    asked = anchors.withColumn("grp", F.pmod(F.xxhash64(ROW), per_length(shares))).select("id", "label", "v", ROW, "dims", "grp")
    everything = asked.withColumns({"window": F.col(ROW), "low": F.lit(-LONG), "high": F.lit(LONG)})
    found = best_in_windows(grouped_windows(everything), blocks, zones, chunks, positives, True)
    order = W.partitionBy("tag").orderBy(F.desc("score"), "id", "row")
    best = stage_table(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= positives)
                       .select(F.col("tag").alias(ROW), F.col("id").alias("positive_id"), F.col("row").alias("window"),
                               F.col("score").alias("positive_score")), "negatives-positives")

    def share(percent: int):                                    # exact in decimals: the product may pass 64 bits
        return F.col("positive_score").cast("decimal(20,0)") * percent / 100
    windows = (asked.join(best, ROW).withColumns({"low": F.ceil(share(low)).cast("long"), "high": F.floor(share(high)).cast("long")})
               .filter("low <= high").drop("positive_id", "positive_score"))
    if windows.isEmpty():
        return spark.createDataFrame([], NONE)
    near = best_in_windows(grouped_windows(windows), blocks, zones, chunks, negatives, False)
    order = W.partitionBy("tag", "window").orderBy(F.desc("score"), "id", "row")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return (ranked.withColumnRenamed("tag", ROW).join(best, [ROW, "window"]).join(anchors.select(ROW, F.col("id").alias("anchor_id")), ROW)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
