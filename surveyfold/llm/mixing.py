"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The words of a source form one line, its documents in a seeded random order.
The line is cut into equal blocks; a source whose target is ``r`` times its
size draws ``r * blocks`` of them: every block ``floor(r)`` times and a seeded
random subset, without repetition, once more. What is left below one block is
taken from the front of the next block of the permutation.

Output shards get their share of each source from a splitting tree: at a node
the draws of all sources are split between the left and the right half of the
shards by one multivariate hypergeometric draw of the left half's size. So
every shard has its exact size, and its sources vary as in a shuffle of all
draws. A draw's place in its source's permutation says which shard it is in;
inside a shard the pieces are ordered by a seeded hash.

The driver holds one row per source (name, size, quota) and the shard quotas,
at most ``MAX_SHARDS`` numbers per source; no document or block comes to it.
Shards of more than ``TASK_WORDS`` words are written by several tasks, each a
range of the shard's shuffled order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import stage_table
from .common import ROW, bound_batches, tag_rows, text_or_empty, tidy

WEIGHTS = (3, 1, 2)          # by source in code-point order, repeating
SHARE = Fraction(3, 2)       # of all sizes
MOST = 2                     # times a source's size
BLOCK_WORDS, LEAST_BLOCKS, LEAST_WORDS = 4096, 1000, 256
SHARD_WORDS, MAX_SHARDS = 1 << 22, 4096
TASK_WORDS = 1 << 23         # of one shard in one task
EXACT_DRAWS = 10**9          # from here on NumPy draws no hypergeometric numbers
MOST_QUOTAS = 1 << 22        # shard quotas of all sources, which tasks get by broadcast
ORDER_BITS = 12              # leading bits of the random order that group a source's rows
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: list[int], weights=WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> list[float]:
    """Words wanted of each source (given in order): shares by weight, none above
    ``most`` times its size, the excess given to the others by weight until it fits."""
    left = share * sum(sizes)
    out: list[Fraction | None] = [None] * len(sizes)
    open_ = list(range(len(sizes)))
    while open_:
        total = sum(weights[i % len(weights)] for i in open_)
        part = {i: left * weights[i % len(weights)] / total for i in open_}
        over = [i for i in open_ if part[i] > most * sizes[i]]
        for i in over or open_:
            out[i] = Fraction(most * sizes[i]) if over else part[i]
        if not over:
            break
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if out[i] is None]
    return [float(x) for x in out]


def log_factorial_step(n: int, d: int) -> float:
    """log((n + d)!) - log(n!), without the loss of subtracting two large numbers."""
    if min(n, n + d) < 1 << 20:
        return math.lgamma(n + d + 1) - math.lgamma(n + 1)
    return d * math.log(n) + (n + d + 0.5) * math.log1p(d / n) - d + (1 / (n + d) - 1 / n) / 12


def large_hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` balls of an urn of any size are good.

    Ratio of uniforms under the table mountain hat for log-concave counts
    (Stadlober 1989), with probabilities relative to the mode's.
    """
    if not good or not bad or not drawn or drawn == good + bad:
        return good if drawn == good + bad else drawn if not bad else 0
    total = good + bad
    least, most = max(0, drawn - bad), min(drawn, good)
    mode = (drawn + 1) * (good + 1) // (total + 2)
    share = good / total
    spread = drawn * share * (1 - share) * ((total - drawn) / max(1, total - 1))
    hat = 2 * math.sqrt(2 / math.e) * math.sqrt(spread + 0.5) + 3 - 2 * math.sqrt(3 / math.e)
    middle = drawn * good // total                       # exact: a double has no room for the place
    offset = drawn * good % total / total + 0.5
    while True:
        u, v = 1.0 - rng.random(), rng.random()
        at = middle + math.floor(offset + hat * (v - 0.5) / u)
        if not least <= at <= most:
            continue
        d = at - mode
        log_odds = -(log_factorial_step(mode, d) + log_factorial_step(good - mode, -d)
                     + log_factorial_step(drawn - mode, -d) + log_factorial_step(bad - drawn + mode, d))
        if 2 * math.log(u) <= log_odds:
            return at


def split_draw(rng: np.random.Generator, quota: np.ndarray, drawn: int) -> np.ndarray:
    """A multivariate hypergeometric draw, source by source where the urn is large."""
    left = int(quota.sum())
    if left < EXACT_DRAWS:
        return rng.multivariate_hypergeometric(quota, drawn, method="marginals")
    out = np.zeros_like(quota)
    for k, own in enumerate(quota.tolist()):
        left -= own
        draw = rng.hypergeometric if own + left < EXACT_DRAWS else lambda *urn: large_hypergeometric(rng, *urn)
        out[k] = draw(own, left, drawn) if drawn else 0
        drawn -= int(out[k])
    return out


def split_tree(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Draws of each source in each shard: an array (shards, sources)."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)
    total = sum(quotas)
    ends = [total * k // shards for k in range(shards + 1)]
    work = [(0, shards, np.array(quotas, dtype=np.int64))]
    while work:
        lo, hi, quota = work.pop()
        if hi - lo == 1:
            out[lo] = quota
            continue
        mid = (lo + hi) // 2
        rng = np.random.default_rng([seed, lo, hi])
        left = split_draw(rng, quota, ends[mid] - ends[lo])
        work += [(lo, mid, left), (mid, hi, quota - left)]
    return out


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of range(n): a 4-round Feistel network over the next
    even power of two, walked until the value is below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    n, out = n.astype(np.uint64), i.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo]
        left, right = out[todo] >> h, out[todo] & m
        for r in range(4):
            f = (right + k + np.uint64(0x9E3779B97F4A7C15 * (r + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            f *= np.uint64(0x94D049BB133111EB)
            f ^= f >> np.uint64(32)
            left, right = right, left ^ (f & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def source_line(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, row tag, source, size and the document's first word on its source's line.

    The running sum is taken inside (source, leading bits of the random order)
    and over those groups, so no task gets a whole source.
    """
    text = text_or_empty()
    given = ROW in docs.columns
    # the order follows from the row itself; the tag, which depends on how the
    # table is split, only orders rows that are equal in id and text
    sizes = docs.select("doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                        F.xxhash64(F.lit(seed), "doc_id", text).alias("u"), *([ROW] if given else []))
    sizes = stage_table(sizes, "mix-sizes") if given else tag_rows(sizes, "mix-sizes")
    rows = sizes.withColumn("g", F.shiftrightunsigned("u", 64 - ORDER_BITS))
    groups = rows.groupBy("source", "g").agg(F.sum("size").alias("n"))
    before = groups.select(
        F.col("source").alias("s"), F.col("g").alias("h"),
        (F.sum("n").over(W.partitionBy("source").orderBy("g")) - F.col("n")).alias("before"))
    inside = W.partitionBy("source", "g").orderBy("u", ROW).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(before, rows.source.eqNullSafe(before.s) & (rows.g == before.h)).select(
        "doc_id", ROW, "u", "source", "size", (F.col("before") + F.col("inside")).alias("start"))


def plan(line: DataFrame, seed: int) -> list[dict]:
    """One entry per source: size, target, blocks, draws and where its draws go."""
    found = line.groupBy("source").agg(F.sum("size").alias("size")).collect()   # a row per source
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    sizes = [r["size"] for r in found]
    out = []
    for k, (row, target) in enumerate(zip(found, targets(sizes), strict=True)):
        size = row["size"]
        # about LEAST_BLOCKS at least, unless they would be shorter than LEAST_WORDS
        blocks = max(1, min(size // LEAST_WORDS, max(LEAST_BLOCKS, size // BLOCK_WORDS)))
        draws = Fraction(target) / size * blocks if size else Fraction(0)
        out.append({"source": row.source, "k": k, "source_size": size, "target": target, "blocks": blocks,
                    "draws": int(draws), "rest": round((draws - int(draws)) * size / blocks)})
    words = sum(sizes)
    shards = max(1, min(MAX_SHARDS, -(-words // SHARD_WORDS), MOST_QUOTAS // max(1, len(out))))
    ends = np.cumsum(split_tree([s["draws"] + (s["rest"] > 0) for s in out], shards, seed), axis=0)
    for s in out:
        s["shard_ends"] = ends[:, s["k"]]
    return out


PLAN_SCHEMA = ("source string, k int, source_size long, target double, blocks long, draws long, "
               "rest long")
PIECE_SCHEMA = ("doc_id string, `__row_tag` long, size long, source_size long, target double, copy long, "
                "first_word long, words long, shard long, place long")


def place_pieces(placed: DataFrame, shard_ends: list[np.ndarray], seed: int) -> DataFrame:
    """A row per drawn run of a document's words (none drawn: one row of no words).

    A document's words meet ``words / block + 1`` blocks; a task holds the
    blocks of one Arrow batch at a time.
    """

    def bound(i, size, blocks):
        q, r = size // blocks, size % blocks
        return i * q + np.minimum(i, r)

    def holder(pos, size, blocks):
        q, r = size // blocks, size % blocks
        wide = r * (q + 1)
        return np.where(pos < wide, pos // (q + 1), r + (pos - wide) // np.maximum(q, 1))

    shared = placed.sparkSession.sparkContext.broadcast(shard_ends)     # MOST_QUOTAS numbers at most

    def pieces(f: pd.DataFrame) -> pd.DataFrame:
        f = f.reset_index(drop=True)
        some = f[f["size"] > 0]
        start, size, total, blocks = (some[c].to_numpy(np.int64) for c in ("start", "size", "source_size", "blocks"))
        first, last = holder(start, total, blocks), holder(start + size - 1, total, blocks)
        n = last - first + 1
        at = np.repeat(np.arange(len(some)), n)
        block = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        lo = np.maximum(bound(block, total[at], blocks[at]), start[at])
        hi = np.minimum(bound(block + 1, total[at], blocks[at]), (start + size)[at])
        draws, k = some.draws.to_numpy(np.int64)[at], some.k.to_numpy(np.uint64)[at]
        front = bound(block, total[at], blocks[at]) + some.rest.to_numpy(np.int64)[at]
        rows = []
        for copy in range(MOST):
            key = (k + np.uint64(seed)) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(copy)
            draw = copy * blocks[at] + permuted(block, blocks[at], key)
            words = np.where(draw < draws, hi, np.where(draw == draws, np.minimum(hi, front), lo)) - lo
            hit = np.flatnonzero(words > 0)
            rows.append(pd.DataFrame({"row": at[hit], "copy": copy, "first_word": (lo - start[at])[hit],
                                      "words": words[hit], "draw": draw[hit]}))
        drawn = pd.concat(rows)
        drawn["index"] = some.index.to_numpy()[drawn.row.to_numpy()]
        shard = np.zeros(len(drawn), dtype=np.int64)
        kinds = f.k.to_numpy()[drawn["index"].to_numpy()]
        for kind in np.unique(kinds):
            own = np.flatnonzero(kinds == kind)
            shard[own] = np.searchsorted(shared.value[kind], drawn.draw.to_numpy()[own], side="right")
        drawn["shard"] = shard
        out = f.drop(columns=["blocks", "draws", "rest", "k"]).merge(
            drawn.set_index("index").drop(columns=["row", "draw"]), how="left", left_index=True, right_index=True)
        place = pd.util.hash_pandas_object(out[["u", "copy", "first_word"]], index=False)
        out["place"] = place.to_numpy().view(np.int64)
        for c in ("copy", "first_word", "words"):
            out[c] = out[c].fillna(0).astype(np.int64)
        out["shard"] = out["shard"].fillna(-1).astype(np.int64)
        return out[["doc_id", "__row_tag", "size", "source_size", "target", "copy", "first_word", "words", "shard", "place"]]

    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            yield pieces(f)

    # as text an id of any type, null or not, goes through unchanged
    kind = placed.schema["doc_id"].dataType
    return (placed.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(run, PIECE_SCHEMA)
            .withColumn("doc_id", F.col("doc_id").cast(kind)))


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix as pieces: which words of which document go to which shard and place.

    A null or empty text has size 0: it is in the result with no words taken.
    A null source is a source of its own, the last. Rows that repeat are
    documents of their own. An empty table gives no rows. What is taken depends
    on ``seed``, ids, sources and texts only, so reruns agree however the table
    is split into files and tasks. Ids may be of any type that a cast to text keeps.
    """
    return mix_and_slices(docs, seed)[0]


def mix_and_slices(docs: DataFrame, seed: int = 7) -> tuple[DataFrame, int]:
    """The mix as pieces, and the power of two of tasks that a shard needs."""
    spark = docs.sparkSession
    bound_batches(spark)
    line = stage_table(source_line(docs, seed), "mix-line")
    sources = plan(line, seed)
    plans = [tuple(s[c.split()[0]] for c in PLAN_SCHEMA.split(", ")) for s in sources]
    table = spark.createDataFrame(plans, PLAN_SCHEMA).withColumnRenamed("source", "s")
    placed = line.join(table, line.source.eqNullSafe(table.s)).select(
        "doc_id", ROW, "u", "size", "start", "k", "source_size", "target", "blocks", "draws", "rest")
    shards = len(sources[0]["shard_ends"]) if sources else 1
    tasks = math.ceil(sum(s["target"] for s in sources) / shards / TASK_WORDS)
    return place_pieces(placed, [s["shard_ends"] for s in sources], seed), max(0, tasks - 1).bit_length()


def taken_per_document(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("doc_id", ROW, "size", "source_size", "target").agg(
        F.sum("words").alias("taken")).drop(ROW)


def word_slice(text: pd.Series, first: pd.Series, words: pd.Series) -> pd.Series:
    """The text from a word on, over a number of words, white space between them kept."""
    import re
    word = re.compile(WORD)
    out = []
    for t, a, n in zip(text, first, words, strict=True):
        begin = end = 0
        for k, m in enumerate(word.finditer(t)):
            if k == a:
                begin = m.start()
            if k == a + n - 1:
                end = m.end()
                break
        out.append(t[begin:end])
    return pd.Series(out, dtype=str)


def drawn_runs(pieces: DataFrame) -> DataFrame:
    """Adjoining pieces of one copy that go to the same shard, as one run."""
    copies = W.partitionBy(ROW, "copy").orderBy("first_word")
    ends = F.col("first_word") + F.col("words")
    new = ((F.coalesce(F.lag(ends).over(copies), F.lit(-1)) != F.col("first_word"))
           | (F.lag("shard").over(copies) != F.col("shard")))
    return (pieces.filter("words > 0").withColumn("new", new.cast("int"))
            .withColumn("run", F.sum("new").over(copies))
            .groupBy(ROW, "copy", "run")
            .agg(F.min("first_word").alias("__first"), F.sum("words").alias("__words"), F.first("size").alias("__size"),
                 F.first("shard").alias("__shard"), F.min_by("place", "first_word").alias("__place"))
            .drop("copy", "run"))


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` as the mix takes them, all columns kept: a row per drawn run of words.

    Adjoining pieces of one copy are one run again if they go to the same shard;
    a run that is the whole text keeps it as it was, other rows get the words
    drawn. A shard's rows are in its shuffled order, together in one partition or,
    beyond ``TASK_WORDS`` words, in one for each range of that order.
    """
    tagged = tag_rows(docs, "mix-docs")
    pieces, bits = mix_and_slices(tagged, seed)
    runs = drawn_runs(pieces)
    cut = F.pandas_udf(word_slice, "string")
    whole = F.col("__words") == F.col("__size")
    out = tagged.join(runs, ROW)
    text = F.when(whole, F.col("text")).otherwise(
        cut(F.when(whole, F.lit("")).otherwise(F.col("text")), F.when(whole, 0).otherwise(F.col("__first")),
            F.when(whole, 0).otherwise(F.col("__words"))))
    n_chars = {"n_chars": F.char_length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return (out.withColumn("text", text).withColumns(n_chars)
            .repartition("__shard", *([F.shiftright("__place", 64 - bits)] if bits else []))
            .sortWithinPartitions("__shard", "__place")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
