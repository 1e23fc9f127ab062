"""Registered queries: one Spark builder and one oracle SQL per operator group.

Keys follow the operator IDs of the blueprint. Every query reads the driver
tables in full, without row caps; those named ``_partial`` or ``unmatched``, and
``j11_merge_indicator``, then drop keys so that two sides differ. Shares of the
crosswalk, conservation totals and the Stata recipe are rounded to 6 decimals
here, at the comparison, never inside the library; the apportioned tables are not.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import derive as D
from ..functions.scalars import pad_left
from ..operators import joins as J
from ..operators import measures as M
from ..operators.apportion import fan_out, main_state, zone_group_total, zone_states
from ..operators.measures import levels_as_seen, pivot_wider
from ..operators.rollup import keep_last
from ..session import checkpoint_root, cut_lineage, person_pass
from ..sources.files import period_tag, write_table
from ..sources.layout import layout_of, write_codebook, write_fixed_width
from ..sources.published import publish_frames, read_published, read_published_panel
from ..streaming.panel import start_published_panel_stream
from . import analog, oracle
from .products import PERSON_COLUMNS, Survey, read_persons, soc_minor_titles, stack_panels, tag_period

ROUND = oracle.ROUND
Query = Callable[[SparkSession, str], DataFrame]


def round_fractional(df: DataFrame, digits: int = ROUND) -> DataFrame:
    """Round every floating column (apportioned sums, shares, EPOP).

    ``+ 0.0`` turns a rounded ``-0.0`` (the sign of a float residue around
    zero, which depends on summation order) into ``0.0``.
    """
    return df.withColumns({
        f.name: F.round(F.col(f.name), digits) + F.lit(0.0)
        for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))
    })


def _survey(spark: SparkSession, sf_dir: str, period: bool = False) -> Survey:
    return Survey.from_driver_tables(spark, sf_dir, ("year",) if period else ())


def _product(method: str, period: bool = False, rounded: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = getattr(_survey(spark, sf_dir, period), method)()
        return round_fractional(df) if rounded else df
    run.__name__ = method
    return run


def _single_pass(method: str) -> Query:
    """A product read from the full build's single person pass (grouping sets)."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_survey(spark, sf_dir).single_pass(), method)()
    run.__name__ = f"{method}_single_pass"
    return run


def _with_nulls(method: str, single_pass: bool = False, rounded: bool = False) -> Query:
    """A product on persons with NULL birthplace, citizenship, labour force and weight."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        survey = _survey(spark, sf_dir)
        survey.microdata = analog.microdata_with_nulls(spark, sf_dir)
        df = getattr(survey.single_pass() if single_pass else survey, method)()
        return round_fractional(df) if rounded else df
    run.__name__ = f"{method}_with_nulls"
    return run


def _two_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Survey.from_driver_tables(spark, sf_dir, two_phase_cube=True).master()


def _lattice(method: str) -> Query:
    """A product read from the one pass that makes all roll-ups of the cube."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(_survey(spark, sf_dir).roll_up_once(), method)()
    run.__name__ = f"{method}_lattice"
    return run


def _u1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state table of every survey year on its own, stacked by name; one person pass for all."""
    cube = _survey(spark, sf_dir, period=True).materialize()
    years = [r.year for r in cube.master().select("year").distinct().orderBy("year").collect()]    # a row a year
    return stack_panels([tag_period(one.state(), y) for y, one in cube.years_of_cube(years).items()])


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def _s9_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + S3 + S4: the state table published as CSV over an older build, and read back."""
    out, state = _scratch(spark, "published"), _survey(spark, sf_dir).state()
    publish_frames(spark, out, {"state_acs_data": state.where("state_fips < '10'")}, "sample")
    publish_frames(spark, out, {"state_acs_data": state}, "sample", order_by={"state_acs_data": ["state_fips"]})
    return read_published(spark, out, "state_acs_data").drop("period")


def _s1_s2_round_trip(spark: SparkSession, sf_dir: str, method: str = "state") -> DataFrame:
    """S1 + S2: all persons as fixed-width lines with an XML codebook, read back; a table of theirs."""
    place, survey = _scratch(spark, "extract"), _survey(spark, sf_dir)
    with person_pass(spark):
        persons = cut_lineage(survey.microdata, "persons")
    layout = layout_of(persons, PERSON_COLUMNS, {"PERWT": 2})
    write_fixed_width(persons, f"{place}/persons.dat", layout)
    write_codebook(spark, f"{place}/codebook.xml", layout, survey.labels)
    survey.microdata, survey.labels = read_persons(spark, f"{place}/codebook.xml", f"{place}/persons.dat")
    return getattr(survey, method)()


def _u2_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state panel from year files in three deliveries; the second is wrong in every
    other year, the third corrects it, and an early one comes late."""
    place, table = _scratch(spark, "deliveries"), "state_acs_data"
    panel = cut_lineage(_survey(spark, sf_dir, period=True).state(), "state-panel")
    years = [r.year for r in panel.select("year").distinct().orderBy("year").collect()]            # a row a year
    wrong = panel.withColumn("count", F.col("count") + 1)

    def deliver(number: int, rows: DataFrame, which: list[int]) -> None:
        for year in which:
            write_table(rows.where(F.col("year") == year).drop("year"), f"{place}/in/{number}/{table}_{year}.csv")
        start_published_panel_stream(spark, f"{place}/in", table, panel.drop("year").schema, f"{place}/out").awaitTermination()

    deliver(2, wrong, years[::2])
    deliver(3, panel, years[::2])
    deliver(1, wrong, years[::2])
    deliver(4, panel, years[1::2])
    return read_published_panel(spark, f"{place}/out", table, years)


def _a5_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 with levels found in the data: birth status, NULL among them, in the order of states."""
    survey = _survey(spark, sf_dir)
    survey.microdata = analog.microdata_with_nulls(spark, sf_dir)
    order = ["STATEFIP", "PUMA"]
    levels = levels_as_seen(survey.clean, "foreign_born", order)
    wide = pivot_wider(survey.clean, ["STATEFIP"], "foreign_born",
                       {"pop": F.col("PERWT"), "n": F.lit(1)}, levels, count_names=["n"])
    return wide.withColumn("level_order", F.lit(",".join("NA" if x is None else x for x in levels)))


def _j11_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole tables, with a missing unit on both sides: missing keys meet."""
    gone = F.expr("nullif(puma, 3)").alias("puma")
    units = analog.customer_geo(spark, sf_dir).select("statefip", gone).distinct()
    xw = analog.crosswalk(spark, sf_dir).select("statefip", gone, "cz90")
    merged = J.merge_indicator(units, xw, ["statefip", "puma"])
    return merged.groupBy("_merge", "puma").agg(F.count(F.lit(1)).alias("n_rows"))


def _x7_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T10 of the persons read from files, whose columns carry their value labels."""
    return _s1_s2_round_trip(spark, sf_dir, "labor_force_by_citizenship")


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T0 + T1 on lines and orders that are staged bucketed by the order key."""
    return Survey.from_driver_tables(spark, sf_dir, buckets=int(spark.conf.get("spark.sql.shuffle.partitions"))).master()


def _j3_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 with the crosswalk taken for too large to broadcast, its largest units salted."""
    survey = Survey.from_driver_tables(spark, sf_dir, fan_out_salts=4)
    by_unit = survey._rolled(["stpuma", "naics_2d"], M.EMPLOYMENT_PREFIXES)
    joined = fan_out(by_unit, survey.crosswalk, "stpuma", None, salts=4, hot_rows=20)
    return joined.na.drop("any").groupBy("cz90", "naics_2d").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(M.N).alias("persons"), F.sum("pop").cast("bigint").alias("pop"))


# queries that write, stream or list levels while they are built
STARTS_JOBS = ("u1_stack", "s9_published_state", "s1_s2_round_trip", "u2_corrected_panel", "a5_first_seen",
               "x7_labels_from_metadata", "t1_master_cube_bucketed", "j3_salted_fan_out")


def _x14(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = analog.table(spark, sf_dir, "part")
    return (part.select(D.soc_minor(analog._occsoc(part)).alias("soc_minor"))
            .groupBy("soc_minor").agg(F.count(F.lit(1)).alias("n_parts")))


def _x15(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = analog.table(spark, sf_dir, "part")
    return (part.select(D.sector_2d(analog._indnaics(part)).alias("naics_2d"))
            .groupBy("naics_2d").agg(F.count(F.lit(1)).alias("n_parts")))


def _x12(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = analog.customer_geo(spark, sf_dir)
    return g.select("statefip", "puma",
                    D.geo_unit_key(pad_left("statefip", 2), F.col("puma")).alias("stpuma")).distinct()


def _status_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _survey(spark, sf_dir)
    return (s.clean.withColumn("bpl_ii", D.birthplace_broad("BPL"))
            .groupBy("foreign_born", F.col("foreing_born_det_1").alias("origin"), "bpl_ii")
            .agg(F.sum("PERWT").alias("civ_noninst_pop"), F.count(F.lit(1)).alias("count")))


def _period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return period_tag(analog.microdata(spark, sf_dir), "YEAR")


def _t13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Survey.occupation_hierarchy(analog.soc_structure(spark, sf_dir))


def _t14(spark: SparkSession, sf_dir: str) -> DataFrame:
    structure = analog.soc_structure(spark, sf_dir)
    return soc_minor_titles(structure.where(F.col("minor_group").isNotNull()))


def _t16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analog.zone_context(spark, sf_dir)


def _a18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_state(analog.zone_pieces(spark, sf_dir), "cz90", "statefip", "pop")


def _a19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_states(analog.zone_pieces(spark, sf_dir), "cz90", "state_abbv")


def _w2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = analog.crosswalk(spark, sf_dir).select("statefip", "puma", "cz90", "pop")
    return zone_group_total(pieces, "cz90", "pop", "cz_pop_total", analog.ZONE_ROWS)


def _w3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = analog.crosswalk(spark, sf_dir).select("cz90", "pop", "statefip", "puma")
    return keep_last(pieces, ["cz90"], ["pop"])


def _a5(spark: SparkSession, sf_dir: str) -> DataFrame:
    persons = _survey(spark, sf_dir).clean.withColumn("bpl_ii", D.birthplace_broad("BPL"))
    levels = [D.BIRTHPLACE_US, "Central America", "Mexico", "South America", D.BIRTHPLACE_OTHERS]
    return pivot_wider(persons, ["STATEFIP"], "bpl_ii",
                       {"emp": F.col("EMPSTAT_2") * F.col("PERWT"), "n": F.lit(1)},
                       levels, count_names=["n"])


def _a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_fractional(analog.crosswalk(spark, sf_dir))


def _j7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return J.coverage(analog.crosswalk(spark, sf_dir), analog.county_zones(spark, sf_dir), "cz90", "ers90")


def _j7_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables whose zones overlap in part, with a NULL zone on either side."""
    units = analog.crosswalk(spark, sf_dir).where("cz90 % 100 < 5").withColumn(
        "cz90", F.expr("nullif(cz90, 101)"))
    counties = analog.county_zones(spark, sf_dir).where("ers90 > 200").withColumn(
        "ers90", F.expr("nullif(ers90, 201)"))
    return J.coverage(units, counties, "cz90", "ers90")


def _j9_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survey(spark, sf_dir).county_unmatched()


def _j9_counties_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County zones without the counties of two zones, so counties of the data go unmatched."""
    s = _survey(spark, sf_dir)
    s.county_zones = analog.county_zones(spark, sf_dir).where("ers90 NOT IN (103, 302)")
    return s.county_unmatched()


def _t15_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recipe with units that the crosswalk lacks and units without persons."""
    s = _survey(spark, sf_dir)
    s.crosswalk = analog.crosswalk(spark, sf_dir).where("puma <> 7").withColumn(
        "puma", F.expr("CASE WHEN puma = 8 THEN 108 ELSE puma END"))
    return round_fractional(s.crosswalk_apportion())


def _j11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge indicator of units in the data against a crosswalk that differs."""
    units = analog.customer_geo(spark, sf_dir).select("statefip", "puma").distinct()
    xw = analog.crosswalk(spark, sf_dir).where("puma <> 7").select(
        "statefip", F.expr("CASE WHEN puma = 8 THEN 108 ELSE puma END").alias("puma"), "cz90")
    merged = J.merge_indicator(units, xw, ["statefip", "puma"])
    return merged.groupBy("_merge").agg(F.count(F.lit(1)).alias("n_rows"))


UNMATCHED_XWALK = ("(SELECT * REPLACE (CASE WHEN puma = 8 THEN 108 ELSE puma END AS puma) "
                   "FROM xwalk WHERE puma <> 7)")


def queries() -> dict[str, Query]:
    return {
        # products
        "t1_master_cube": _product("master"),
        "t2_zone": _product("zone"),
        "t3_state": _product("state"),
        "t4_zone_occupation": _product("zone_occupation"),
        "t5_state_occupation": _product("state_occupation"),
        "t6_occupation": _product("occupation"),
        "t7_zone_sector": _product("zone_sector"),
        "t8_state_sector": _product("state_sector"),
        "t9_sector": _product("sector"),
        "t10_labor_force_citizenship": _product("labor_force_by_citizenship"),
        "t11_labor_force_birthplace": _product("labor_force_by_birthplace"),
        "t1_master_cube_fused": _product("master"),
        "t1_master_cube_two_phase": _two_phase,
        "t2_zone_lattice": _lattice("zone"),
        "t3_state_lattice": _lattice("state"),
        "t5_state_occupation_lattice": _lattice("state_occupation"),
        "t6_occupation_lattice": _lattice("occupation"),
        "t7_zone_sector_lattice": _lattice("zone_sector"),
        "t9_sector_lattice": _lattice("sector"),
        "s9_published_state": _s9_published,
        "s1_s2_round_trip": _s1_s2_round_trip,
        "u2_corrected_panel": _u2_corrected,
        "a5_first_seen": _a5_first_seen,
        "x7_labels_from_metadata": _x7_metadata,
        "t1_master_cube_bucketed": _bucketed,
        "j3_salted_fan_out": _j3_salted,
        "j11_merge_null_keys": _j11_nulls,
        "j1_j2_join_form": _product("join_form"),
        "u1_stack": _u1,
        # persons with NULLs
        "t1_nulls": _with_nulls("master"),
        "t1_nulls_join_form": _with_nulls("join_form"),
        "t1_nulls_single_pass": _with_nulls("master", single_pass=True),
        "t2_nulls": _with_nulls("zone"),
        "t3_nulls": _with_nulls("state"),
        "t10_nulls": _with_nulls("labor_force_by_citizenship"),
        "t11_nulls": _with_nulls("labor_force_by_birthplace"),
        "t11_nulls_single_pass": _with_nulls("labor_force_by_birthplace", single_pass=True),
        "v1_nulls": _with_nulls("county_table"),
        "a5_nulls_unlisted_levels": _with_nulls("unlisted_levels"),
        "t1_master_cube_single_pass": _single_pass("master"),
        "t11_labor_force_birthplace_single_pass": _single_pass("labor_force_by_birthplace"),
        "t12_zone_panel": _product("zone", period=True),
        "t12_state_panel": _product("state", period=True),
        "t12_zone_occupation_panel": _product("zone_occupation", period=True),
        "t12_state_occupation_panel": _product("state_occupation", period=True),
        "t12_occupation_panel": _product("occupation", period=True),
        "t12_zone_sector_panel": _product("zone_sector", period=True),
        "t12_state_sector_panel": _product("state_sector", period=True),
        "t12_sector_panel": _product("sector", period=True),
        "t13_occupation_hierarchy": _t13,
        "t14_occupation_titles": _t14,
        "t15_crosswalk_apportion": _product("crosswalk_apportion", rounded=True),
        "t16_zone_context": _t16,
        "v1_county_table": _product("county_table"),
        "v1_county_zone": _product("county_zone"),
        # operator groups
        "a1_weighted_counts": _product("weighted_counts"),
        "a3_status_pivot": _product("status_pivot"),
        "a4_origin_pivot": _product("origin_pivot"),
        "a13_conservation": _product("conservation", rounded=True),
        "a17_crosswalk": _a17,
        "a18_main_state": _a18,
        "a19_zone_states": _a19,
        "a5_pivot_wider": _a5,
        "a5_unlisted_levels": _product("unlisted_levels"),
        "w2_zone_group_total": _w2,
        "w3_keep_last": _w3,
        "j7_zone_coverage": _j7,
        "j7_zone_coverage_partial": _j7_partial,
        "j9_counties_unmatched": _j9_counties,
        "j9_counties_unmatched_partial": _j9_counties_partial,
        "j11_merge_indicator": _j11,
        "t15_unmatched_units": _t15_unmatched,
        "j9_zones_without_data": _product("zones_without_data"),
        "x12_geo_units": _x12,
        "x14_minor_codes": _x14,
        "x15_sector_codes": _x15,
        "x17_x20_status_origin": _status_origin,
        "s10_s11_period": _period,
    }


def oracle_sql() -> dict[str, str]:
    o = oracle
    return {
        "t1_master_cube": o.t1_master(),
        "t2_zone": o.t2_zone(),
        "t3_state": o.t3_state(),
        "t4_zone_occupation": o.t4_zone_occupation(),
        "t5_state_occupation": o.t5_state_occupation(),
        "t6_occupation": o.t6_occupation(),
        "t7_zone_sector": o.t7_zone_sector(),
        "t8_state_sector": o.t8_state_sector(),
        "t9_sector": o.t9_sector(),
        "t10_labor_force_citizenship": o.t10_labor_force_citizenship(),
        "t11_labor_force_birthplace": o.t11_labor_force_birthplace(),
        "t1_master_cube_fused": o.t1_master(),
        "t1_master_cube_two_phase": o.t1_master(),
        "t2_zone_lattice": o.t2_zone(),
        "t3_state_lattice": o.t3_state(),
        "t5_state_occupation_lattice": o.t5_state_occupation(),
        "t6_occupation_lattice": o.t6_occupation(),
        "t7_zone_sector_lattice": o.t7_zone_sector(),
        "t9_sector_lattice": o.t9_sector(),
        "s9_published_state": o.t3_state(),
        "s1_s2_round_trip": o.t3_state(),
        "u2_corrected_panel": o.t3_state(period=True),
        "a5_first_seen": o.with_nulls(o.a5_first_seen()),
        "x7_labels_from_metadata": o.t10_labor_force_citizenship(),
        "t1_master_cube_bucketed": o.t1_master(),
        "j3_salted_fan_out": o.j3_fan_out(),
        "j11_merge_null_keys": o.j11_merge_null_keys(),
        "j1_j2_join_form": o.t1_master(),
        "u1_stack": o.t3_state(period=True),
        "t1_nulls": o.with_nulls(o.t1_master()),
        "t1_nulls_join_form": o.with_nulls(o.t1_master()),
        "t1_nulls_single_pass": o.with_nulls(o.t1_master()),
        "t2_nulls": o.with_nulls(o.t2_zone()),
        "t3_nulls": o.with_nulls(o.t3_state()),
        "t10_nulls": o.with_nulls(o.t10_labor_force_citizenship()),
        "t11_nulls": o.with_nulls(o.t11_labor_force_birthplace()),
        "t11_nulls_single_pass": o.with_nulls(o.t11_labor_force_birthplace()),
        "v1_nulls": o.with_nulls(o.v1_county_table()),
        "a5_nulls_unlisted_levels": o.with_nulls(o.a5_unlisted_levels()),
        "t1_master_cube_single_pass": o.t1_master(),
        "t11_labor_force_birthplace_single_pass": o.t11_labor_force_birthplace(),
        "t12_zone_panel": o.t2_zone(period=True),
        "t12_state_panel": o.t3_state(period=True),
        "t12_zone_occupation_panel": o.t4_zone_occupation(period=True),
        "t12_state_occupation_panel": o.t5_state_occupation(period=True),
        "t12_occupation_panel": o.t6_occupation(period=True),
        "t12_zone_sector_panel": o.t7_zone_sector(period=True),
        "t12_state_sector_panel": o.t8_state_sector(period=True),
        "t12_sector_panel": o.t9_sector(period=True),
        "t13_occupation_hierarchy": o.t13_occupation_hierarchy(),
        "t14_occupation_titles": o.t14_occupation_titles(),
        "t15_crosswalk_apportion": o.t15_crosswalk_apportion(),
        "t16_zone_context": o.t16_zone_context(),
        "v1_county_table": o.v1_county_table(),
        "v1_county_zone": o.v1_county_zone(),
        "a1_weighted_counts": o.a1_weighted_counts(),
        "a3_status_pivot": o.a3_status_pivot(),
        "a4_origin_pivot": o.a4_origin_pivot(),
        "a13_conservation": o.a13_conservation(),
        "a17_crosswalk": o.a17_crosswalk(),
        "a18_main_state": o.a18_main_state(),
        "a19_zone_states": o.a19_zone_states(),
        "a5_pivot_wider": o.a5_pivot_wider(),
        "a5_unlisted_levels": o.a5_unlisted_levels(),
        "w2_zone_group_total": o.w2_zone_group_total(),
        "w3_keep_last": o.w3_keep_last(),
        "j7_zone_coverage": o.j7_zone_coverage(),
        "j7_zone_coverage_partial": o.j7_zone_coverage_partial(),
        "j11_merge_indicator": o.j11_merge_indicator(),
        "t15_unmatched_units": o.t15_crosswalk_apportion(UNMATCHED_XWALK),
        "j9_counties_unmatched": o.j9_counties_unmatched(),
        "j9_counties_unmatched_partial": o.j9_counties_unmatched_partial(),
        "j9_zones_without_data": o.j9_zones_without_data(),
        "x12_geo_units": o.x12_geo_units(),
        "x14_minor_codes": o.x14_minor_codes(),
        "x15_sector_codes": o.x15_sector_codes(),
        "x17_x20_status_origin": o.x_status_origin(),
        "s10_s11_period": o.s10_period(),
    }
