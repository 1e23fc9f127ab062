"""Areal apportionment through fractional crosswalks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import sum_na_rm
from ..session import BROADCAST_ROW_LIMIT, broadcast_bounded


def build_crosswalk(pieces: DataFrame, unit_keys: Sequence[str], zone: str,
                    pop: str = "pop") -> DataFrame:
    """Crosswalk from intersection populations.

    ``pieces`` holds one row per (unit, zone) piece with its population
    ``pop``. Adds ``pumapop`` (unit total), ``czpop`` (zone total),
    ``county_prop_inpuma = pop / pumapop`` and ``county_prop_incz = pop / czpop``.
    The frame is small (units x zones); the two windows run on it, not on rows.
    """
    unit_w = Window.partitionBy(*unit_keys)
    zone_w = Window.partitionBy(zone)
    return (pieces
            .withColumn("pumapop", F.sum(pop).over(unit_w))
            .withColumn("czpop", F.sum(pop).over(zone_w))
            .withColumn("county_prop_incz", F.try_divide(F.col(pop), F.col("czpop")))
            .withColumn("county_prop_inpuma", F.try_divide(F.col(pop), F.col("pumapop"))))


def crosswalk_pieces(df: DataFrame, unit_keys: Sequence[str], zone: str,
                     weight: str | None = None) -> DataFrame:
    """Intersection populations ``pop`` per (unit, zone) from row-level data."""
    pop = F.count(F.lit(1)).cast("double") if weight is None else F.sum(weight).cast("double")
    return df.groupBy(*unit_keys, zone).agg(pop.alias("pop"))


# units that may be hot, and from how many rows on one is
MOST_HOT, HOT_ROWS = 200, 100_000


def fan_out(unit_totals: DataFrame, crosswalk: DataFrame, unit: str, crosswalk_rows: int | None = None,
            salts: int = 0, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every unit row meets the pieces of its unit (NULL units meet none).

    A crosswalk within the broadcast bound is broadcast. For a larger one, with
    ``salts``, the rows of a hot unit are spread over that many join keys and
    its pieces are repeated under each, so no task gets more than about a
    ``salts``-th of a unit; other units keep one key. Hot are the units of more
    than ``hot_rows`` rows among the ``MOST_HOT`` largest: one count by unit, of
    which the driver sees those few rows. Any unit beyond them holds less than
    one part in ``MOST_HOT`` of all rows. The result is the plain join's.
    """
    bounded = crosswalk_rows is not None and crosswalk_rows <= BROADCAST_ROW_LIMIT
    if bounded or salts < 2:
        return unit_totals.join(broadcast_bounded(crosswalk, crosswalk_rows), on=unit, how="inner")
    largest = unit_totals.where(F.col(unit).isNotNull()).groupBy(unit).count().orderBy(F.desc("count")).limit(MOST_HOT)
    hot = [r[0] for r in largest.where(F.col("count") > hot_rows).collect()]
    if not hot:
        return unit_totals.join(crosswalk, on=unit, how="inner")
    is_hot = F.col(unit).isin(hot)
    spread = F.pmod(F.xxhash64(*[c for c in unit_totals.columns if c != unit]), F.lit(salts)).cast("int")
    rows = unit_totals.withColumn("__salt", F.when(is_hot, spread).otherwise(0))
    pieces = crosswalk.withColumn("__salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return rows.join(pieces, on=[unit, "__salt"], how="inner").drop("__salt")


def apportion(unit_totals: DataFrame, crosswalk: DataFrame, unit: str, zone: str,
              measures: Sequence[str] | None = None, extra_keys: Sequence[str] = (),
              share: str = "county_prop_inpuma", crosswalk_rows: int | None = None,
              drop_na: bool = True, prefixes: Sequence[str] = (), salts: int = 0) -> DataFrame:
    """A11 (J3 + fan-out): spread unit totals over zones by share, sum by zone.

    ``left_join`` + ``drop_na`` of the source is an inner join on the unit
    followed by dropping rows with a NULL anywhere (``drop_na``); the crosswalk
    is broadcast when its proven row bound allows. Aggregation by unit happens
    *before* this fan-out, so the join multiplies aggregated rows only.

    With ``prefixes`` the measures are chosen by prefix on the *joined* frame,
    as the source does; a ``count`` prefix then also takes the crosswalk's
    ``county_prop_incz`` / ``county_prop_inpuma`` columns, which come out as
    ``sum(col * share)`` per zone (quirk Q14).
    """
    joined = fan_out(unit_totals, crosswalk, unit, crosswalk_rows, salts)
    if drop_na:
        joined = joined.na.drop(how="any")
    if prefixes:
        from ..functions.columns import select_prefix
        keys = {unit, zone, *extra_keys}
        measures = [c for c in select_prefix(joined, *prefixes) if c not in keys]
    return joined.groupBy(zone, *extra_keys).agg(*[
        sum_na_rm(F.col(m) * F.col(share)).alias(m) for m in measures
    ])


# digits of the fraction that a group of equal unit totals adds to a zone
SHARE_DIGITS, WORK_DIGITS = 15, 18


def _whole(name: str, decimals: int = 0) -> Column:
    """A column times ``10 ** decimals`` as an exact integer (``decimal(22,0)``);
    a value with more decimals fails the job instead of being rounded."""
    value = F.col(name)
    exact = value.cast(f"decimal(20,{decimals})")
    finer = value.isNotNull() & (exact.isNull() | (exact.cast("double") != value.cast("double")))
    problem = F.raise_error(F.concat(F.lit(f"{name} has more than {decimals} decimals: "), value.cast("string")))
    return F.when(finer, problem.cast("decimal(22,0)")).otherwise((exact * 10 ** decimals).cast("decimal(22,0)"))


def exact_fraction_sum(df: DataFrame, keys: Sequence[str], numerators: dict[str, Column],
                       denominators: dict[str, Column]) -> DataFrame:
    """``sum(numerator / denominator)`` by ``keys``, the same for any order and partitioning.

    Integer numerators are first summed per denominator, exactly, and each such
    sum is divided once: a whole part, and a fraction rounded to
    ``SHARE_DIGITS`` digits. Wholes and fractions are decimals, whose sums know
    no order; the two meet as a double at the end. A zone's error is at most
    half a unit of the last digit per distinct denominator. Not negative.
    """
    names = list(numerators)
    distinct: dict[str, str] = {}
    columns: dict[str, Column] = {}
    for bottom in denominators.values():                        # equal expressions are one group column
        if str(bottom) not in distinct:
            distinct[str(bottom)] = f"__d{len(distinct)}"
            columns[distinct[str(bottom)]] = bottom.cast("decimal(38,0)")
    of = {name: distinct[str(bottom)] for name, bottom in denominators.items()}
    groups = df.select(*keys, *[c.alias(n) for n, c in columns.items()], *[numerators[n].cast("decimal(38,0)").alias(n) for n in names])
    sums = groups.groupBy(*keys, *columns).agg(*[F.sum(n).alias(n) for n in names])
    wholes, parts = {}, {}
    for n in names:
        bottom = F.col(of[n])
        rest = F.col(n) % bottom
        wholes[f"__q_{n}"] = ((F.col(n) - rest) / bottom).cast("decimal(38,0)")
        share = (rest.cast("decimal(20,0)") / bottom.cast("decimal(20,0)")).cast(f"decimal(38,{WORK_DIGITS})")
        parts[f"__f_{n}"] = share.cast(f"decimal(38,{SHARE_DIGITS})")
    divided = sums.select(*keys, *[c.alias(n) for n, c in (wholes | parts).items()])
    total = divided.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*wholes, *parts)])

    def joined(n: str) -> Column:
        # 30 digits: a difference of wider decimals would lose places
        whole, part = F.col(f"__q_{n}"), F.col(f"__f_{n}").cast(f"decimal(30,{SHARE_DIGITS})")
        return ((whole + F.floor(part)).cast("double") + (part - F.floor(part)).cast("double")).alias(n)
    return total.select(*keys, *[joined(n) for n in names])


def apportion_exact(unit_totals: DataFrame, crosswalk: DataFrame, unit: str, zone: str, prefixes: Sequence[str],
                    extra_keys: Sequence[str] = (), crosswalk_rows: int | None = None, decimals: int = 2,
                    salts: int = 0) -> DataFrame:
    """A11 by integers: like :func:`apportion` with ``prefixes``, order-independent.

    A share is ``pop / pumapop``, so ``sum(m * share)`` is a sum of ``m * pop``
    over ``pumapop``; the crosswalk's own two columns (quirk Q14) are
    ``pop * pop`` over ``czpop * pumapop`` and over ``pumapop`` squared. Measures
    carry at most ``decimals`` decimals, as survey weights do, populations none.
    """
    from ..functions.columns import select_prefix
    joined = fan_out(unit_totals, crosswalk, unit, crosswalk_rows, salts).na.drop(how="any")
    keys = [zone, *extra_keys]
    shares = {"county_prop_incz", "county_prop_inpuma"}
    measures = [c for c in select_prefix(joined, *prefixes) if c not in {unit, *keys}]
    scaled = joined.withColumns({f"__{c}": _whole(c) for c in ("pop", "pumapop", "czpop")}
                                | {f"__m_{m}": _whole(m, decimals) for m in measures if m not in shares})
    pop, unit_pop, zone_pop = (F.col(f"__{c}").cast("decimal(16,0)") for c in ("pop", "pumapop", "czpop"))
    tops = {m: pop * pop if m in shares else F.col(f"__m_{m}").cast("decimal(22,0)") * pop.cast("decimal(15,0)") for m in measures}
    bottoms = {m: unit_pop * 10 ** decimals for m in measures} | {
        m: unit_pop * (zone_pop if m == "county_prop_incz" else unit_pop) for m in measures if m in shares}
    return exact_fraction_sum(scaled, keys, tops, bottoms)


def zone_group_total(df: DataFrame, zone: str, value: str, name: str,
                     zone_rows: int | None = None) -> DataFrame:
    """Group total on every row (Stata ``bysort zone: egen name = sum(value)``).

    Aggregated map-side per zone and joined back (broadcast when the zone
    count is bounded), so a zone holding a third of the rows is never sorted
    into one task as a window partition would be. Missing values count as 0
    (``egen sum``); a NULL zone forms its own group.
    """
    totals = df.groupBy(zone).agg(sum_na_rm(value).alias(name))
    return df.join(broadcast_bounded(totals, zone_rows),
                   df[zone].eqNullSafe(totals[zone]), "left").drop(totals[zone])


def main_state(pieces: DataFrame, zone: str, state: str, pop: str) -> DataFrame:
    """Per zone, the state with the largest population part.

    Ties go to the smallest state code. One aggregate (``min_by`` on
    ``(-pop, state)``), no window.
    """
    by_state = pieces.groupBy(zone, state).agg(F.sum(pop).alias("_pop"))
    return by_state.groupBy(zone).agg(
        F.min_by(F.col(state), F.struct(-F.col("_pop"), F.col(state))).alias(state))


def zone_states(pieces: DataFrame, zone: str, state_label: str,
                count_name: str = "states_count", list_name: str = "states_abbv") -> DataFrame:
    """Number of states and their ``"; "``-joined sorted list per zone.

    Distinct (zone, state) pairs are formed first, so the list per zone is
    bounded by the number of states, never by the number of rows.
    """
    pairs = pieces.select(zone, state_label).distinct()
    return pairs.groupBy(zone).agg(
        F.count(state_label).cast("int").alias(count_name),
        F.array_join(F.sort_array(F.collect_list(state_label)), "; ").alias(list_name),
    )


def apportion_stata(unit_values: DataFrame, crosswalk: DataFrame, unit_keys: Sequence[str],
                    zone: str, value: str, share: str = "county_prop_inpuma") -> DataFrame:
    """T15 (J11 + W2 + W3 + W4): the Stata recipe of the crosswalk readme.

    ``merge 1:m`` keeps unmatched units (they form a NULL-zone group whose
    sum is 0, as ``egen sum`` treats missing as 0); one row per zone is kept;
    the national total is put on every row.
    """
    from .joins import merge_indicator
    merged = merge_indicator(unit_values, crosswalk, unit_keys)
    per_zone = merged.groupBy(zone).agg(
        sum_na_rm(F.coalesce(F.col(share) * F.col(value), F.lit(0.0))).alias(f"cz_{value}"))
    return per_zone.withColumn(f"natl_{value}", F.sum(f"cz_{value}").over(Window.partitionBy()))
