"""Conservation and coverage checks as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conservation(step: str, before: DataFrame, after: DataFrame, measure: str) -> DataFrame:
    """One row ``(step, measure, before, after, diff)``.

    One global aggregate over the union of both sides (partial sums per
    task, one row to the final reducer), so the check never gathers rows
    and needs no join.
    """
    sides = (before.select(F.lit("before").alias("_side"), F.col(measure).cast("double").alias("_v"))
             .unionByName(after.select(F.lit("after").alias("_side"),
                                       F.col(measure).cast("double").alias("_v"))))
    totals = sides.agg(F.sum(F.when(F.col("_side") == "before", F.col("_v"))).alias("before"),
                       F.sum(F.when(F.col("_side") == "after", F.col("_v"))).alias("after"))
    return totals.select(F.lit(step).alias("step"), F.lit(measure).alias("measure"),
                         "before", "after", (F.col("after") - F.col("before")).alias("diff"))


def conservation_report(df: DataFrame, steps: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """A13 for several steps in one global aggregate: ``(step, measure, factor)``.

    ``factor`` says how often a row's measure is counted after the step. The
    one result row is turned into a row per step.
    """
    value = {m: F.col(m).cast("double") for _, m, _ in steps}
    totals = df.agg(*[F.sum(v).alias(f"before_{m}") for m, v in value.items()],
                    *[F.sum(value[m] * f).alias(f"after_{s}") for s, m, f in steps])
    rows = F.array(*[F.struct(F.lit(s).alias("step"), F.lit(m).alias("measure"), F.col(f"before_{m}").alias("before"),
                              F.col(f"after_{s}").alias("after")) for s, m, _ in steps])
    return totals.select(F.inline(rows)).withColumn("diff", F.col("after") - F.col("before"))


def unlisted_levels(df: DataFrame, col: str, listed: Sequence[str]) -> DataFrame:
    """Rows whose pivot level is NULL or outside the explicit level list.

    The cube pivots on fixed level lists; this reports what a data-driven
    pivot would have turned into extra columns (e.g. ``..._na``).
    """
    c = F.col(col)
    return df.agg(F.count(F.when(c.isNull() | ~c.isin(*listed), 1)).alias(f"unlisted_{col}"))
