"""Joins of the pipeline.

A dimension side is hinted for broadcast only with a proven row bound
(:func:`broadcast_bounded`); without one the planner decides by measured size.
NULL keys match NULL keys, as in the source's joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_bounded
from ..sources.codebook import labels_of


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left", right_rows: int | None = None) -> DataFrame:
    """Equi-join where NULL keys match NULL keys (dplyr default, N3).

    ``right_rows``: proven row bound of the right side, for a broadcast hint.
    """
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(r[f"__r_{k}"]) for k in keys])
    return left.join(broadcast_bounded(r, right_rows), cond, how).drop(*[f"__r_{k}" for k in keys])


def _keep_left_order(joined: DataFrame, left: DataFrame, right: DataFrame,
                     keys: Sequence[str]) -> DataFrame:
    # dplyr keeps x's columns in place and appends y's non-key columns
    return joined.select(*left.columns, *[c for c in right.columns if c not in keys])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner",
                 right_rows: int | None = None) -> DataFrame:
    """Join on every shared column name (``inner_join(x)`` without ``by``)."""
    shared = [c for c in left.columns if c in set(right.columns)]
    if not shared:
        raise ValueError("natural join needs at least one shared column")
    return _keep_left_order(null_safe_join(left, right, shared, how, right_rows), left, right, shared)


def title_join(df: DataFrame, titles: DataFrame, key: str, title_rows: int | None = None) -> DataFrame:
    """Inner join to a title dictionary; unknown codes are dropped."""
    out = null_safe_join(df, titles, [key], "inner", title_rows)
    return _keep_left_order(out, df, titles, [key])


def context_join(df: DataFrame, context: DataFrame, key: str, context_key: str,
                 context_rows: int | None = None) -> DataFrame:
    """Left join zone context, renaming its key to ours."""
    ctx = context.withColumnRenamed(context_key, key)
    out = null_safe_join(df, ctx, [key], "left", context_rows)
    return _keep_left_order(out, df, ctx, [key])


def hierarchy_join(df: DataFrame, levels: Sequence[tuple[DataFrame, str]],
                   rows_per_level: int | None = None) -> DataFrame:
    """Chain of left joins attaching the title of each parent level."""
    for dim, key in levels:
        df = null_safe_join(df, dim, [key], "left", rows_per_level)
    return df


def coverage(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Key coverage between two tables, one row per distinct key.

    Columns: ``key, in_left, in_right`` from a full outer join of the two
    distinct key sets (distinct first, so the join sees each key once).
    """
    lk = left.select(F.col(left_key).alias("key")).distinct().withColumn("in_left", F.lit(True))
    rk = right.select(F.col(right_key).alias("key")).distinct().withColumn("in_right", F.lit(True))
    return (lk.join(rk, lk["key"].eqNullSafe(rk["key"]), "full")
            .select(F.coalesce(lk["key"], rk["key"]).alias("key"),
                    F.coalesce("in_left", F.lit(False)).alias("in_left"),
                    F.coalesce("in_right", F.lit(False)).alias("in_right")))


def anti_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              keep: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``left`` without a match in ``right``, distinct on ``keep``."""
    known = right.select(F.col(right_key).alias("__known")).distinct()
    out = left.join(known, left[left_key].eqNullSafe(known["__known"]), "left_anti")
    return out.select(*(keep or [left_key])).distinct()


def merge_indicator(master: DataFrame, using: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stata ``merge`` with ``_merge`` = 1 master only, 2 using only, 3 both.

    A missing key matches a missing key, as in Stata (and in dplyr, N3).
    """
    m = master.withColumn("__in_m", F.lit(True))
    u = using.withColumns({"__in_u": F.lit(True)}).withColumnsRenamed({k: f"__u_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__u_{k}")) for k in keys])
    out = m.join(u, same, "full")
    told = {k: F.when(F.col("__in_m"), F.col(k)).otherwise(F.col(f"__u_{k}")) for k in keys}
    told["_merge"] = F.when(F.col("__in_m") & F.col("__in_u"), 3).when(F.col("__in_m"), 1).otherwise(2)
    rest = [c for c in master.columns if c not in keys], [c for c in using.columns if c not in keys]
    return out.withColumns(told).select(*keys, *rest[0], *rest[1], "_merge")


def decode_labels(df: DataFrame, code: str, labels: DataFrame, variable: str,
                  out: str, label_rows: int | None = None) -> DataFrame:
    """Code -> label from the codebook, falling back to the code as text.

    A column that carries its dictionary (``codebook.with_value_labels``) is
    decoded by a literal map, without a join. Else ``labels`` has columns ``name,
    value, label``; only ``variable``'s labels are broadcast (a codebook
    dictionary is bounded by the variable's codes).
    """
    held = labels_of(df, code)
    if held is not None:
        told = F.create_map(*[F.lit(x) for kv in held.items() for x in kv])[F.col(code)] if held else F.lit(None).cast("string")
        return df.withColumn(out, F.coalesce(told, F.col(code).cast("string")))
    lab = (labels.where(F.col("name") == variable)
           .select(F.col("value").alias("__v"), F.col("label").alias("__l")))
    joined = df.join(broadcast_bounded(lab, label_rows), df[code] == F.col("__v"), "left")
    return joined.withColumn(out, F.coalesce(F.col("__l"), F.col(code).cast("string"))) \
                 .drop("__v", "__l")
