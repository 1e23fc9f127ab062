"""Weighted measures and the fused master cube.

The source builds the master cube as three aggregates (overall, by birth
status, by origin), pivots two of them wide and left-joins the three on the
unit x occupation x sector key. Here the three are conditional aggregates
(fused in one ``groupBy``, or narrow sums then a pivot; see ``master_cube``):
map-side partial aggregation, no join, and NULL keys behave as in the join
form (NULL groups with NULL, N3).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions.scalars import pct_ratio

# ---------------------------------------------------------------------------
# Measure names, level labels and their column suffixes.
# ---------------------------------------------------------------------------
POP = "civ_noninst_pop"
EMP = "civ_noninst_pop_employed"
LF = "civ_noninst_labforce"
N = "count"
EPOP = "EPOP"
# Birth-status levels and the suffix each gets in a column name.
STATUS_LEVELS = ((D.STATUS_LOCAL, "local"), (D.STATUS_IMMIGRANT, "immigrant"))
# Origin levels kept in the cube (the source keeps the "merica" and "Mexico" columns).
ORIGIN_LEVELS = (("Central America", "central_america"), ("South America", "south_america"))
ORIGIN_LEVELS_LAST = (("Mexico", "mexico"),)
# Column families selected by prefix in the roll-ups, in selector order.
FULL_PREFIXES = (POP, EMP, LF, N)
EMPLOYMENT_PREFIXES = (EMP, N)
CUBE_KEYS = ("stpuma", "soc_minor", "naics_2d")


@dataclass(frozen=True)
class Measure:
    """A weighted measure: ``sum(weight * flag)``; ``flag=None`` sums the weight,
    ``weight=None`` counts rows."""

    name: str
    flag: str | None = None
    weight: str | None = "PERWT"

    def value(self) -> Column:
        if self.weight is None:
            return F.lit(1)
        w = F.col(self.weight)
        return w if self.flag is None else F.col(self.flag) * w


CUBE_MEASURES = (
    Measure(POP),
    Measure(EMP, "EMPSTAT_2"),
    Measure(LF, "LABFORCE_2"),
    Measure(N, weight=None),
)


def weighted_sum(value: Column, cond: Column | None = None, strict: bool = True) -> Column:
    """Sum of ``value`` over the rows where ``cond`` holds.

    No matching row gives NULL (a missing pivot cell, N21). With ``strict``
    a NULL value among the matching rows makes the cell NULL, as R's
    ``sum`` without ``na.rm`` does (N2).
    """
    if strict:
        # A NULL value becomes NaN, which ``sum`` propagates like R's NA; the
        # NaN total is turned back into NULL. No extra aggregation buffer.
        value = F.coalesce(value.cast("double"), F.lit(float("nan")))
    v = value if cond is None else F.when(cond, value)
    total = F.sum(v)
    return F.nanvl(total, F.lit(None).cast("double")) if strict else total


def row_count(cond: Column | None = None) -> Column:
    """``n()`` over all rows, or over matching rows with NULL for none."""
    if cond is None:
        return F.count(F.lit(1))
    return F.sum(F.when(cond, F.lit(1)).cast("bigint"))


def measure_expr(m: Measure, cond: Column | None = None, strict: bool = True) -> Column:
    if m.weight is None:
        return row_count(cond)
    return weighted_sum(m.value(), cond, strict)


def level_aggregates(measures: Sequence[Measure], level_col: str,
                     levels: Sequence[tuple[str, str]], strict: bool = True) -> list[Column]:
    """A3/A4/A5: one conditional aggregate per (measure, level), named
    ``{measure}_{suffix}`` (N14), in pivot order: measure-major, level-minor."""
    out = []
    for m in measures:
        for value, suffix in levels:
            cond = F.col(level_col) == F.lit(value)
            out.append(measure_expr(m, cond, strict).alias(f"{m.name}_{suffix}"))
    return out


def pivot_wider(df: DataFrame, keys: Sequence[str], names_from: str,
                values: dict[str, Column], levels: Sequence[str | None],
                count_names: Sequence[str] = ()) -> DataFrame:
    """A5: ``pivot_wider(names_from, values_from, names_sep="_")`` + ``clean_names``.

    One column ``{value}_{snake(level)}`` per (value, level), value-major in
    the order given; a (key, level) pair without rows is NULL, never 0.
    Levels are an explicit list (no extra job to discover them, and a NULL
    or unlisted level cannot silently add a column). ``count_names`` are
    values to be counted (``n()``) rather than summed.
    """
    from ..functions.columns import snake_case
    aggs = []
    for name, value in values.items():
        for level in levels:
            cond = F.col(names_from).isNull() if level is None else F.col(names_from) == F.lit(level)
            expr = row_count(cond) if name in count_names else F.sum(F.when(cond, value))
            aggs.append(expr.alias(f"{name}_{'na' if level is None else snake_case(level)}"))
    return df.groupBy(*keys).agg(*aggs)


def levels_as_seen(df: DataFrame, names_from: str, order_by: Sequence[str], most: int = 200) -> list:
    """A5: the levels of a column in the order in which they first occur.

    Rows have no order of their own in Spark, so the first position of a level
    is its smallest ``order_by`` (NULLs last, then the level itself); one
    aggregate keeps it, whatever the number of rows. A NULL is a level. More
    than ``most`` levels raise: a pivot would make a column of each.
    """
    place = F.struct(*[x for c in order_by for x in (F.col(c).isNull().alias(f"{c}_null"), F.col(c).alias(c))],
                     F.col(names_from).isNull().alias("__null"), F.col(names_from).alias("__level"))
    found = (df.groupBy(names_from).agg(F.min(place).alias("__first"))
             .orderBy("__first").select(names_from).limit(most + 1).collect())
    if len(found) > most:
        raise ValueError(f"{names_from}: more than {most} levels to pivot")
    return [r[0] for r in found]


def pivot_as_seen(df: DataFrame, keys: Sequence[str], names_from: str, values: dict[str, Column],
                  order_by: Sequence[str], most: int = 200, count_names: Sequence[str] = ()) -> DataFrame:
    """A5 with the levels found in the data, columns in first-seen order, ``{value}_na`` for NULL.

    Finding the levels is a job of its own; a pivot of known levels needs none.
    """
    return pivot_wider(df, keys, names_from, values, levels_as_seen(df, names_from, order_by, most), count_names)


def prepare_persons(clean: DataFrame) -> DataFrame:
    """T0 derivations used by the cube: flags, status, origin."""
    imm = D.immigrant_flag("CITIZEN")
    return clean.withColumns({
        "EMPSTAT_2": D.employed_flag("EMPSTAT"),
        "LABFORCE_2": D.labforce_flag("LABFORCE"),
        "immigrant_broad": imm,
    }).withColumns({
        "foreign_born": D.birth_status("BPL", F.col("immigrant_broad")),
        "foreing_born_det_1": D.birth_origin("BPL", F.col("immigrant_broad")),
    })


def master_cube(persons: DataFrame, keys: Sequence[str] = CUBE_KEYS,
                strict: bool = True, two_phase: bool = False) -> DataFrame:
    """T1 (A1 + A2 + A3 + A4 + X11): the finest cube.

    ``persons`` must carry ``stpuma, soc_minor, naics_2d, STATEFIP`` (int),
    ``PERWT, EMPSTAT_2, LABFORCE_2, foreign_born, foreing_born_det_1``.
    Output: keys, ``state_code`` (first state of the group, A2), then the
    measures in the source's column order and ``EPOP``.

    ``two_phase`` first sums four narrow measures by key x birth
    status x kept origin, then pivots that aggregate wide. When a task sees
    about as many distinct keys as rows (a fine cube over a large input),
    partial aggregation cannot shrink much, and what crosses the exchange
    is then 4 measures per row instead of 22. The pivot step reads the
    aggregate, whose size is bounded by keys x 8 levels. ``two_phase=False``
    (default) is the single conditional aggregate (one exchange), best when each task
    holds many rows per key.
    """
    if two_phase:
        return _master_cube_two_phase(persons, keys, strict)
    base = [measure_expr(m, None, strict).alias(m.name) for m in CUBE_MEASURES]
    by_status = level_aggregates(CUBE_MEASURES, "foreign_born", STATUS_LEVELS, strict)
    origin_measures = CUBE_MEASURES[1:]   # no population column by origin
    by_origin = level_aggregates(origin_measures, "foreing_born_det_1", ORIGIN_LEVELS, strict)
    by_origin_last = level_aggregates(origin_measures, "foreing_born_det_1", ORIGIN_LEVELS_LAST, strict)
    cube = persons.groupBy(*keys).agg(
        F.min("STATEFIP").alias("state_code"),
        *base, *by_status, *by_origin, *by_origin_last,
    )
    return cube.withColumn(EPOP, pct_ratio(EMP, POP))


def weighted_collapse(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                      weight: str = "PERWT") -> DataFrame:
    """Stata ``collapse (sum) x [pw=w], by(keys)``: ``sum(x * w)`` per group."""
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.col(v) * F.col(weight)), F.lit(0.0)).alias(v) for v in values
    ])


def _master_cube_two_phase(persons: DataFrame, keys: Sequence[str], strict: bool) -> DataFrame:
    return pivot_cube(narrow_cube(persons, keys, strict), keys, strict)


def kept_origin() -> Column:
    """Origin level if it is one of the pivoted levels, else NULL."""
    kept = [lvl for lvl, _ in (*ORIGIN_LEVELS, *ORIGIN_LEVELS_LAST)]
    origin = F.col("foreing_born_det_1")
    return F.when(origin.isin(*kept), origin)


def narrow_aggregates(strict: bool) -> list[Column]:
    """Phase-1 aggregates: first state and the four measures as ``_0.._3``.

    With ``strict`` an NA input is summed as NaN, which survives the second
    phase and is turned into NULL only at the end (R's ``sum`` without
    ``na.rm``).
    """
    def value(m: Measure) -> Column:
        v = m.value()
        return F.coalesce(v.cast("double"), F.lit(float("nan"))) if strict else v
    return [F.min("STATEFIP").alias("state_code"),
            *[(F.count(F.lit(1)) if m.weight is None else F.sum(value(m))).alias(f"_{i}")
              for i, m in enumerate(CUBE_MEASURES)]]


def narrow_cube(persons: DataFrame, keys: Sequence[str], strict: bool = True) -> DataFrame:
    """Phase 1: narrow sums by key x birth status x kept origin (others NULL)."""
    return persons.groupBy(*keys, "foreign_born", kept_origin().alias("_origin")).agg(
        *narrow_aggregates(strict))


def pivot_cube(narrow: DataFrame, keys: Sequence[str], strict: bool = True) -> DataFrame:
    """Phase 2: pivot the narrow aggregate wide into the master cube layout."""
    def part(i: int, cond: Column | None) -> Column:
        src = F.col(f"_{i}")
        return F.sum(src if cond is None else F.when(cond, src))

    names = {m.name: i for i, m in enumerate(CUBE_MEASURES)}
    cols = [part(i, None).alias(m.name) for i, m in enumerate(CUBE_MEASURES)]
    for m in CUBE_MEASURES:
        for lvl, suf in STATUS_LEVELS:
            cols.append(part(names[m.name], F.col("foreign_born") == lvl).alias(f"{m.name}_{suf}"))
    for levels in (ORIGIN_LEVELS, ORIGIN_LEVELS_LAST):
        for m in CUBE_MEASURES[1:]:
            for lvl, suf in levels:
                cols.append(part(names[m.name], F.col("_origin") == lvl).alias(f"{m.name}_{suf}"))
    cube = narrow.groupBy(*keys).agg(F.min("state_code").alias("state_code"), *cols)
    if strict:
        cube = cube.withColumns({
            c: F.nanvl(F.col(c), F.lit(None).cast("double"))
            for c, t in cube.dtypes if t == "double"})
    return cube.withColumn(EPOP, pct_ratio(EMP, POP))
