"""Exact dedup: tree-merge of sorted digest runs.

Every partition of the input is a run of digests. In each of
``ceil(log_fanin(runs))`` binomial rounds, groups of ``fan_in`` runs exchange
rows so that one base-``fan_in`` digit of the run number becomes that digit of
the digest's bucket; a run is sorted by digest and the runs that meet are
merged, each digest keeping its best row and its count. After the last round
all rows of a digest have met, and no node of the tree has received more than
``fan_in`` rows of one digest: a text that a third of all documents share is
one row per run from the first round on.

Two texts are merged only where the SHA-256, the length and an independent
64-bit hash of the normalised text agree.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table
from .common import ASCII_SPACE, ROW, content_key, keep_rows, shuffle_partitions, text_or_empty

KEY = ("digest", "norm_bytes", "witness")


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                row_col: str | None = None) -> DataFrame:
    """(doc_id, digest, norm_bytes, witness, n_chars, run, row tag) per row, written down.

    ``row_col`` names a unique tag that the rows already have.
    """
    text = text_or_empty(text_col)
    tag = F.col(row_col) if row_col else F.monotonically_increasing_id()
    table = docs.select(F.col(id_col).alias("doc_id"), tag.alias(ROW),
                        F.translate(text, ASCII_SPACE, "").alias("norm"),
                        F.char_length(text).alias("n_chars"))
    return stage_table(table.select(
        "doc_id", ROW,
        F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("digest"),
        F.octet_length("norm").alias("norm_bytes"),
        F.xxhash64("norm").alias("witness"),
        "n_chars", F.spark_partition_id().alias("run")), "exact-digests")


def merge_tree(runs: DataFrame, fan_in: int = 16, n_runs: int | None = None) -> DataFrame:
    """(digest key, best struct, group_size), one row per distinct text.

    ``best`` orders by most code points, then smallest id (nulls last), then
    row tag, and is a minimum at every level.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    n_runs = n_runs or shuffle_partitions(runs.sparkSession)
    rounds = max(1, math.ceil(math.log(n_runs, fan_in) - 1e-9))
    width = fan_in ** rounds
    state = runs.select(
        (F.col("run") % width).cast("long").alias("node"), *KEY,
        F.struct((-F.col("n_chars")).alias("neg_chars"), F.col("doc_id").isNull().alias("no_id"),
                 F.col("doc_id").alias("keep_id"), F.col(ROW).alias("keep_row")).alias("best"),
        F.lit(1).cast("long").alias("group_size"))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(width))
    for level in range(rounds):
        unit = fan_in ** level
        digit = F.floor(F.col("node") / unit) % fan_in
        wanted = F.floor(bucket / unit) % fan_in
        state = (state.withColumn("node", F.col("node") + (wanted - digit) * unit)
                 .groupBy("node", *KEY)
                 .agg(F.min("best").alias("best"), F.sum("group_size").alias("group_size")))
    return state.drop("node")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fan_in: int = 16, row_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, row tag.

    A null text counts as empty, so null, empty and blank texts are one group.
    Of rows that repeat (same id, same text) exactly one is kept; a null id
    loses to any other at equal length. An empty table gives an empty result;
    columns other than id and text are not read.
    """
    runs = digest_runs(docs, id_col, text_col, row_col)
    # written down, so that the join below exchanges both sides and a digest
    # with very many rows can be split by the adaptive skew join
    groups = stage_table(merge_tree(runs, fan_in), "exact-groups")
    return runs.join(groups, list(KEY)).select(
        "doc_id", F.col("best.keep_id").alias("keep_id"), "group_size",
        (F.col("best.keep_row") == F.col(ROW)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), ROW)


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they came."""
    named = docs.select("doc_id", "text", content_key().alias(ROW))
    return keep_rows(docs, exact_dedup(named, row_col=ROW), "exact")
