"""Helpers that the operators share: reading a table, row tags, null-safe ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table

# Tag columns carry a prefix no input column is expected to have; a clash is
# renamed away in ``tag_rows``.
ROW = "__row_tag"

# fixed values: the ASCII white space that the contracts name
ASCII_SPACE = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def tag_rows(df: DataFrame, name: str, *cols: str | Column) -> DataFrame:
    """Write the chosen columns with a unique ``ROW`` tag to the shared folder.

    ``monotonically_increasing_id`` may differ from one evaluation to the
    next, so the tag is only usable once it is written down.
    """
    chosen = list(cols) if cols else [F.col(c) for c in df.columns if c != ROW]
    return stage_table(df.select(*chosen, F.monotonically_increasing_id().alias(ROW)), name, compression="zstd")


def content_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Names a row by its id and text (SHA-256): a tag that needs no copy of the
    table, the same for rows that repeat."""
    def part(c: Column) -> Column:
        return F.coalesce(F.concat(F.lit("="), c), F.lit("-"))
    return F.sha2(F.concat(part(F.col(id_col).cast("string")), F.lit("\n"), part(F.col(text_col))), 256)


def keep_rows(docs: DataFrame, decided: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose content key is kept, one of those that repeat.

    ``decided``: a row per row of ``docs``, with its key as ``ROW`` and ``kept``.
    """
    decided = stage_table(decided.select(ROW, "kept"), f"{name}-decided")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    hits = docs.withColumn(ROW, content_key()).join(decided.filter("kept").select(ROW), ROW, "left_semi")
    repeated = stage_table(decided.groupBy(ROW).count().filter("count > 1").select(ROW), f"{name}-repeated")
    if repeated.isEmpty():
        return hits.select(columns)
    single = hits.join(repeated, ROW, "left_anti")
    return single.union(hits.join(repeated, ROW, "left_semi").dropDuplicates([ROW])).select(columns)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def is_held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the decimal doc_id, modulo 3, is 1 (a null id is not held out)."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(3)) == 1, F.lit(False))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file, the same on the driver and the executors."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python tasks get by bytes, not by rows alone:
    ten thousand documents have no bounded size."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(spark.conf.get(name)) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def give_back() -> None:
    """Return freed memory to the system: an executor's other workers need it
    while this one waits for its next task."""
    import ctypes
    import sys

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def tidy(task: Callable) -> Callable:
    """A task over batches that gives its memory back when it ends."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()
    return run
