"""Roll-ups of additive measures, total rows and shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import select_prefix
from ..functions.scalars import pct_ratio, sum_na_rm
from .measures import EMP, EPOP, POP


def rollup_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """A10: ``summarize_at(measures, sum(., na.rm=TRUE))`` by ``keys``.

    Every measure is additive, so a roll-up of the cube is a re-aggregation;
    partial aggregation happens before the shuffle, so a hot key costs one
    row per map task, never a skewed reducer input.
    """
    return df.groupBy(*keys).agg(*[sum_na_rm(m).alias(m) for m in measures])


def rollup_prefixed(df: DataFrame, keys: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
    """A10 with P4: sum every column whose name starts with one of ``prefixes``."""
    return rollup_sum(df, keys, select_prefix(df, *prefixes))


SET = "_set"


def _set_number(keys: Sequence[str], columns: Sequence[str]) -> int:
    """``grouping_id`` of the set ``keys``: a bit per column that is summed over, the first one highest."""
    return sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)


def rollup_lattice(df: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[str]) -> DataFrame:
    """A10 for several key sets in one pass: ``GROUPING SETS`` over one scan.

    Each row is fed to every set before the partial aggregate, so what crosses
    the exchange is partial sums. ``SET`` tells the set apart from a NULL key.
    """
    columns = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([list(s) for s in sets], *columns).agg(
        *[sum_na_rm(m).alias(m) for m in measures], F.grouping_id().alias(SET))


def lattice_level(lattice: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of one key set of a lattice over ``columns``, under its keys and measures."""
    rows = lattice.where(F.col(SET) == _set_number(keys, columns))
    return rows.select(*keys, *[c for c in lattice.columns if c not in columns and c != SET])


def with_epop(df: DataFrame) -> DataFrame:
    """X11 recomputed at each level (EPOP is not additive)."""
    return df.withColumn(EPOP, pct_ratio(EMP, POP))


def share_of_total(df: DataFrame, value: str, name: str,
                   partition: Sequence[str] = ()) -> DataFrame:
    """``value / sum(value)`` over the partition (grand total if empty).

    Meant for aggregated frames: with no partition keys the window runs in
    one task, so the input must be an aggregate of bounded size.
    """
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return df.withColumn(name, F.try_divide(F.col(value), F.sum(value).over(w)))


def with_total_row(df: DataFrame, key: str, aggs: dict[str, Column],
                   total_label: str = "total", flag: str = "is_total") -> DataFrame:
    """Group by ``key`` plus a grand-total row, in one pass.

    Implemented with ``rollup(key)``, which plans an ``Expand`` before the
    partial aggregate, so the total costs no second scan. The total row is
    marked by ``flag`` and labelled ``total_label`` (a NULL key stays NULL).
    """
    grouped = df.rollup(key).agg(*[e.alias(n) for n, e in aggs.items()],
                                 F.grouping_id().alias("_gid"))
    return (grouped
            .withColumn(flag, F.col("_gid") == 1)
            .withColumn(key, F.when(F.col(flag), F.lit(total_label)).otherwise(F.col(key)))
            .drop("_gid"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per group, the last in ``order`` (Stata ``by g: keep if _n==_N``).

    A ``max`` over a struct led by the order columns, so it aggregates
    map-side; a hot group never lands whole in one task. Ties on ``order``
    are broken by the remaining columns, which makes the choice deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in (*order, *rest)]).alias("_last")
    out = df.groupBy(*keys).agg(F.max(packed).alias("_last"))
    return out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in (*order, *rest)])
