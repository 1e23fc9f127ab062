"""The products of the pipeline (T0-T16, V1) as DataFrame builders.

:class:`Survey` holds one sample (microdata + dimensions) and builds every
table lazily. All roll-ups start from the master cube (T1), the only
aggregate that reads person rows; :meth:`Survey.materialize` writes T1 to the
shared checkpoint folder once so the eight roll-ups never re-run the person
joins (and survive executor loss).

``period_keys`` turns every table into a panel: with ``("year",)`` the cube
is keyed by year too, and each roll-up carries the year (T12) without a loop
over files.
"""

from __future__ import annotations

import copy
from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import derive as D
from ..functions.columns import move_first, select_prefix
from ..functions.scalars import flag_times, pad_left, r_ifelse
from ..operators import apportion as AP
from ..operators import joins as J
from ..operators import measures as M
from ..operators import rollup as R
from ..operators.quality import conservation_report
from ..session import broadcast_bounded, cut_lineage, person_pass, unstage
from . import analog, titles

ZONE = "cz90"
UNIT = "stpuma"
STATE_KEYS = ("state_fips", "state")


# ---------------------------------------------------------------------------
# Clean microdata
# ---------------------------------------------------------------------------
def clean_microdata(micro: DataFrame, period: str | None = None) -> DataFrame:
    """Derived codes, universe filter (L4), flags and statuses.

    The filter is one conjunctive ``where`` on source columns, so Catalyst
    pushes each conjunct to the scan / join side that owns the column.
    """
    df = D.universe(micro)
    cols = {
        UNIT: D.geo_unit_key(pad_left("STATEFIP", 2), F.col("PUMA")),
        "soc_minor": D.soc_minor("OCCSOC"),
        "naics_2d": D.sector_2d("INDNAICS"),
    }
    if period:
        cols["year"] = F.col(period).cast("int")
    return M.prepare_persons(df.withColumns(cols))


# the person columns of an extract, and those that are not whole numbers
PERSON_COLUMNS = ("YEAR", "MULTYEAR", "STATEFIP", "COUNTYFIP", "PUMA", "GQ", "EMPSTAT", "EMPSTATD", "LABFORCE",
                  "AGE", "CITIZEN", "BPL", "PERWT", "OCCSOC", "INDNAICS")
WEIGHT, CODES = "PERWT", ("OCCSOC", "INDNAICS")


def read_persons(spark: SparkSession, codebook: str, extract: str) -> tuple[DataFrame, DataFrame]:
    """S1 + S2: typed persons of a fixed-width extract, and the codebook's value labels.

    Columns with a small dictionary carry it as metadata too (X7 without a join).
    """
    from ..sources import codebook as CB
    variables, labels = CB.read_codebook(spark, codebook)
    micro = CB.read_fixed_width(spark, extract, variables, keep=list(PERSON_COLUMNS), text_columns=CODES)
    whole = [c for c in PERSON_COLUMNS if c in micro.columns and c not in (WEIGHT, *CODES)]
    typed = micro.withColumns({c: F.col(c).cast("int") for c in whole} | {WEIGHT: F.col(WEIGHT).cast("double")})
    return CB.with_value_labels(typed, labels), labels


def state_names(labels: DataFrame) -> DataFrame:
    """STATEFIP labels as ``(state_code, state)`` for the post-aggregate decode."""
    return labels.where(F.col("name") == "STATEFIP").select(
        F.col("value").alias("state_code"), F.col("label").alias("state"))


def soc_minor_titles(structure_minor: DataFrame) -> DataFrame:
    """``distinct(minor_group, title)``, ``drop_na``, short code."""
    return (structure_minor.select("minor_group", "title").distinct().na.drop("any")
            .withColumn("soc_minor", D.short_minor_code("minor_group")))


class _Dim:
    """A dimension given as a DataFrame or as a zero-argument builder.

    Builders run on first use, so a product that needs no crosswalk (say the
    state table) never constructs one: less driver-side analysis per query.
    """

    def __set_name__(self, owner, name):
        self.slot = "_dim_" + name

    def __get__(self, obj, objtype=None):
        if obj is None:
            return self
        value = obj.__dict__.get(self.slot)
        if value is not None and not isinstance(value, DataFrame):
            value = value()
            obj.__dict__[self.slot] = value
        return value

    def __set__(self, obj, value):
        obj.__dict__[self.slot] = value


class Survey:
    """One survey sample and its dimensions; products are lazy DataFrames.

    Every dimension argument may be a DataFrame or a zero-argument callable
    returning one (built on first use).
    """

    microdata = _Dim()
    labels = _Dim()
    crosswalk = _Dim()
    zone_context = _Dim()
    soc_titles = _Dim()
    sector_titles = _Dim()
    county_zones = _Dim()

    def __init__(self, spark: SparkSession, microdata, labels, crosswalk, zone_context,
                 soc_titles, sector_titles, county_zones=None,
                 period_keys: Sequence[str] = (), dimension_rows: int | None = None,
                 strict_na: bool = True, two_phase_cube: bool = False, exact_shares: bool = False,
                 fan_out_salts: int = 0):
        self.spark = spark
        self.microdata = microdata
        self.labels = labels
        self.crosswalk = crosswalk
        self.zone_context = zone_context
        self.soc_titles = soc_titles
        self.sector_titles = sector_titles
        self.county_zones = county_zones
        self.period_keys = tuple(period_keys)
        # proven row bound of every dimension, or None: no broadcast hint then
        self.dim_rows = dimension_rows
        self.strict_na = strict_na
        # narrow sums, then pivot (see master_cube): for cubes about as fine as the
        # persons that a task sees; measured slower where tasks hold many rows a key
        self.two_phase_cube = two_phase_cube
        # apportion by the crosswalk's populations in integers, not by its rounded shares
        self.exact_shares = exact_shares
        # parts that a unit with very many rows is spread over in the zone join, where
        # the crosswalk is too large to broadcast (0: left to the planner)
        self.fan_out_salts = fan_out_salts
        self._staged: list[DataFrame] = []
        self._cube: DataFrame | None = None
        self._labor_base: DataFrame | None = None
        self._years: DataFrame | None = None
        self._narrow: DataFrame | None = None
        self._lattice: DataFrame | None = None

    # -- construction from the driver tables --------------------------------
    @classmethod
    def from_driver_tables(cls, spark: SparkSession, sf_dir: str,
                           period_keys: Sequence[str] = (), exact_shares: bool = True,
                           buckets: int = 0, **options) -> "Survey":
        """With ``buckets`` the two largest tables are first staged by the order key, so
        that no pass over the persons moves them again; :meth:`release` deletes them."""
        staged = analog.stage_person_tables(spark, sf_dir, buckets) if buckets else None
        survey = cls(
            spark,
            microdata=lambda: analog.microdata(spark, sf_dir, staged=staged),
            labels=lambda: analog.value_labels(spark, sf_dir),
            crosswalk=lambda: analog.crosswalk(spark, sf_dir),
            zone_context=lambda: analog.zone_context(spark, sf_dir),
            soc_titles=lambda: analog.soc_titles(spark, sf_dir),
            sector_titles=lambda: titles.sector_titles(spark),
            county_zones=lambda: analog.county_zones(spark, sf_dir),
            period_keys=period_keys,
            dimension_rows=analog.CROSSWALK_ROWS,
            exact_shares=exact_shares,
            **options,
        )
        survey._staged += staged or ()
        return survey

    @classmethod
    def from_files(cls, spark: SparkSession, codebook: str, extract: str, crosswalk: str,
                   zone_context: str, soc_structure: str, sector_titles: str,
                   counties: str | None = None, period_keys: Sequence[str] = (),
                   stage_microdata: bool = False,
                   stage_partitions: int | None = None) -> "Survey":
        """A survey from the source's own inputs: XML codebook + fixed-width
        extract (S1, S2) and the dimension files as CSV (S3, S5-S8).

        With ``stage_microdata`` the decoded extract is written once as Parquet
        in the shared checkpoint folder, so the products read a columnar table
        with pushed filters instead of re-parsing text. A gzipped extract
        cannot be split, so one task reads it; ``stage_partitions`` spreads
        the decoded rows over that many partitions before the write, making
        the staged table (which every product reads) splittable.
        """
        from ..sources import files as FS
        from ..session import stage_table
        micro, labels = read_persons(spark, codebook, extract)
        if stage_microdata:
            if stage_partitions:
                micro = micro.repartition(stage_partitions)
            micro = stage_table(micro, "microdata", partition_by=["YEAR"])
        survey = cls(
            spark,
            microdata=micro,
            labels=labels,
            crosswalk=lambda: FS.read_crosswalk(spark, crosswalk),
            zone_context=lambda: FS.read_zone_context(spark, zone_context),
            soc_titles=lambda: soc_minor_titles(FS.read_soc_structure(spark, soc_structure)),
            sector_titles=lambda: FS.read_sector_titles(spark, sector_titles),
            county_zones=(lambda: FS.read_counties(spark, counties)) if counties else None,
            period_keys=period_keys,
        )
        if stage_microdata:
            survey._staged.append(micro)
        return survey

    def where_year(self, year: int) -> "Survey":
        """The same survey on one survey year's persons."""
        self.microdata = self.microdata.where(F.col("YEAR") == year)
        return self

    # -- T0 / T1 ------------------------------------------------------------
    @cached_property
    def clean(self) -> DataFrame:
        period = "YEAR" if "year" in self.period_keys else None
        return clean_microdata(self.microdata, period)

    def master(self) -> DataFrame:
        """The master cube with state name and padded state code."""
        if self._cube is not None:
            return self._cube
        return self._build_master(self.clean, self.labels)

    def _build_master(self, clean: DataFrame, labels: DataFrame) -> DataFrame:
        keys = (*self.period_keys, *M.CUBE_KEYS)
        cube = M.master_cube(clean, keys, strict=self.strict_na, two_phase=self.two_phase_cube)
        return self._label_cube(cube, labels)

    def _label_cube(self, cube: DataFrame, labels: DataFrame) -> DataFrame:
        """State name (X7, after the aggregate) and padded state code; T1 layout."""
        keys = (*self.period_keys, *M.CUBE_KEYS)
        names = broadcast_bounded(state_names(labels), self.dim_rows)
        cube = cube.join(names, "state_code", "left").withColumns({
            "state": F.coalesce(F.col("state"), F.col("state_code").cast("string")),
            "state_fips": pad_left(F.col("state_code"), 2),
        })
        measures = [c for c in cube.columns
                    if c not in (*keys, "state_code", "state", "state_fips")]
        return cube.select(*keys, "state", "state_fips", *measures)

    # -- A1 / A3 / A4: the source's three intermediate aggregates ------------
    def weighted_counts(self) -> DataFrame:
        """A1 + A2: weighted counts by unit x occupation x sector, first state."""
        keys = (*self.period_keys, *M.CUBE_KEYS)
        agg = self.clean.groupBy(*keys).agg(
            F.min("STATEFIP").alias("state_code"),
            *[M.measure_expr(m, None, self.strict_na).alias(m.name) for m in M.CUBE_MEASURES])
        return self._label_cube(agg, self.labels)

    def status_pivot(self) -> DataFrame:
        """A3: the four measures by birth status, pivoted wide (missing cell NULL)."""
        keys = (*self.period_keys, *M.CUBE_KEYS)
        return self.clean.groupBy(*keys).agg(*M.level_aggregates(
            M.CUBE_MEASURES, "foreign_born", M.STATUS_LEVELS, self.strict_na))

    def origin_pivot(self) -> DataFrame:
        """A4: employment, labour force and count by detailed origin, pivoted;
        only the Central / South America and Mexico columns are kept."""
        keys = (*self.period_keys, *M.CUBE_KEYS)
        return self.clean.groupBy(*keys).agg(*M.level_aggregates(
            M.CUBE_MEASURES[1:], "foreing_born_det_1",
            (*M.ORIGIN_LEVELS, *M.ORIGIN_LEVELS_LAST), self.strict_na))

    def join_form(self) -> DataFrame:
        """T1 as the source forms it: counts, status pivot and origin pivot
        joined on the cube keys, NULL keys matching each other (J1, J2)."""
        keys = [*self.period_keys, *M.CUBE_KEYS]
        joined = J.null_safe_join(self.weighted_counts(), self.status_pivot(), keys)
        return R.with_epop(J.null_safe_join(joined, self.origin_pivot(), keys))

    def materialize(self, single_pass: bool = False) -> "Survey":
        """Cut lineage after T1 (a written table in the shared folder) for reuse.

        Losing it would mean re-running the person joins, so what is written
        is durable Parquet. By default that is the cube itself. With
        ``single_pass`` it is one ``GROUPING SETS`` aggregate over *all*
        persons that serves both the cube (universe persons) and the
        labour-force tables (everyone), so the person joins run once for the
        whole build instead of twice; the cube is then pivoted from it.
        :meth:`release` deletes what was written.
        """
        if self._cube is None:
            if single_pass:
                self.single_pass(write=True)
            else:
                self._cube = self._write(self.master(), "master_cube")
        return self

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        with person_pass(self.spark):
            out = cut_lineage(df, name)
        self._staged.append(out)
        return out

    def release(self) -> None:
        """Delete the tables written for this survey; its frames are unusable then."""
        while self._staged:
            unstage(self._staged.pop())

    def single_pass(self, write: bool = False) -> "Survey":
        """One aggregate over all persons with three grouping sets:

        A: universe flag x (period) x cube keys x birth status x kept origin
           -> the narrow cube (rows with the flag set);
        B: citizenship code x broad birthplace -> the labour-force base;
        C: the survey years -> the period tag and sample description.

        An ``Expand`` feeds each person row to every set before the partial
        aggregate, so only partial aggregates cross the exchange. Without
        ``write`` the products stay lazy and each runs the pass for itself.
        """
        persons = self.microdata
        period = "YEAR" if "year" in self.period_keys else None
        uni = F.coalesce(D.civilian() & D.non_institutional() & D.working_age(), F.lit(False))
        cols = {
            UNIT: D.geo_unit_key(pad_left("STATEFIP", 2), F.col("PUMA")),
            "soc_minor": D.soc_minor("OCCSOC"),
            "naics_2d": D.sector_2d("INDNAICS"),
            "_ua": uni,
            "bpl_ii": D.birthplace_broad("BPL"),
        }
        if period:
            cols["year"] = F.col(period).cast("int")
        year_cols = [c for c in ("YEAR", "MULTYEAR") if c in persons.columns]
        cols.update({f"_{c}": F.col(c) for c in year_cols})
        df = M.prepare_persons(persons.withColumns(cols)).withColumn("_origin", M.kept_origin())
        lf = flag_times(F.col("LABFORCE") == 2, "PERWT")
        if self.strict_na:
            lf = F.coalesce(lf.cast("double"), F.lit(float("nan")))
        set_a = ["_ua", *self.period_keys, *M.CUBE_KEYS, "foreign_born", "_origin"]
        set_b = ["CITIZEN", "bpl_ii"]
        set_c = [f"_{c}" for c in year_cols]          # the sample's years (S10, S11)
        sets = [set_a, set_b] + ([set_c] if set_c else [])
        group_cols = list(dict.fromkeys(c for g in sets for c in g))
        sets_agg = df.groupingSets(sets, *group_cols).agg(
            *M.narrow_aggregates(self.strict_na), F.sum(lf).alias("lf"),
            F.grouping("_ua").alias("_not_a"), F.grouping("CITIZEN").alias("_not_b"))
        if write:
            sets_agg = self._write(sets_agg, "person_pass")
        keys = [*self.period_keys, *M.CUBE_KEYS]
        narrow = sets_agg.where((F.col("_not_a") == 0) & F.col("_ua"))
        self._narrow = narrow
        cube = M.pivot_cube(narrow, keys, self.strict_na)
        self._cube = self._label_cube(cube, self.labels)
        self._labor_base = sets_agg.where(F.col("_not_b") == 0).select(*set_b, "lf")
        if set_c:
            self._years = sets_agg.where((F.col("_not_a") == 1) & (F.col("_not_b") == 1)).select(
                *[F.col(f"_{c}").alias(c) for c in year_cols])
        return self

    def roll_up_once(self, write: bool = False) -> "Survey":
        """Every roll-up of T2-T9 in one pass over the cube (``GROUPING SETS``).

        The products then read their own key set of that one aggregate, which
        ``write`` puts down once; :meth:`release` deletes it.
        """
        if self._lattice is None:
            cube = self.master()
            lattice = R.rollup_lattice(cube, self._sets, select_prefix(cube, *M.FULL_PREFIXES))
            if write:
                lattice = cut_lineage(lattice, "rollups")
                self._staged.append(lattice)
            self._lattice = lattice
        return self

    @property
    def _sets(self) -> list[list[str]]:
        """The key sets of the roll-ups: zone tables start from units."""
        bases = ((UNIT,), (UNIT, "soc_minor"), (UNIT, "naics_2d"), STATE_KEYS, (*STATE_KEYS, "soc_minor"),
                 (*STATE_KEYS, "naics_2d"), ("soc_minor",), ("naics_2d",))
        return [self._k(*b) for b in bases]

    def _rolled(self, keys: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
        """A10 by ``keys``: from the lattice if there is one, else from the cube."""
        if self._lattice is None:
            return R.rollup_prefixed(self.master(), keys, prefixes)
        columns = list(dict.fromkeys(c for s in self._sets for c in s))
        level = R.lattice_level(self._lattice, keys, columns)
        return level.select(*keys, *select_prefix(level, *prefixes))

    def years_of_cube(self, years: Sequence[int]) -> dict[int, "Survey"]:
        """Single-year surveys that share this one's cube, which must be keyed by year:
        their roll-ups read it and no persons."""
        if "year" not in self.period_keys:
            raise ValueError("the cube is not keyed by year")
        out = {}
        for year in years:
            one = copy.copy(self)
            one.period_keys = tuple(k for k in self.period_keys if k != "year")
            one._cube, one._lattice, one._staged = self.master().where(F.col("year") == year).drop("year"), None, []
            out[year] = one
        return out

    def sample_years(self) -> DataFrame:
        """Distinct survey years (``YEAR``, ``MULTYEAR``) of the sample, for S10/S11.

        Taken from the single-pass aggregate when there is one, so the
        period tag costs no extra pass over the persons.
        """
        if self._years is not None:
            return self._years
        cols = [c for c in ("YEAR", "MULTYEAR") if c in self.microdata.columns]
        return self.microdata.select(*cols).distinct()

    # -- helpers --------------------------------------------------------------
    def _k(self, *keys: str) -> list[str]:
        return [*self.period_keys, *keys]

    def _apportioned(self, extra: Sequence[str], prefixes: Sequence[str]) -> DataFrame:
        by_unit = self._rolled(self._k(UNIT, *extra), prefixes)
        if self.exact_shares:
            return AP.apportion_exact(by_unit, self.crosswalk, UNIT, ZONE, prefixes, self._k(*extra), self.dim_rows,
                                      salts=self.fan_out_salts)
        return AP.apportion(by_unit, self.crosswalk, UNIT, ZONE, prefixes=prefixes,
                            extra_keys=self._k(*extra), crosswalk_rows=self.dim_rows,
                            salts=self.fan_out_salts)

    def _with_zone_context(self, df: DataFrame) -> DataFrame:
        return J.context_join(df, self.zone_context, ZONE, "ers90", self.dim_rows)

    def _occupation_titles(self, df: DataFrame) -> DataFrame:
        out = J.title_join(df, self.soc_titles, "soc_minor", self.dim_rows)
        return out.where(D.not_military("soc_minor"))

    def _sector_titles(self, df: DataFrame) -> DataFrame:
        return J.natural_join(df, self.sector_titles, "inner", self.dim_rows)

    # -- T2-T9 ----------------------------------------------------------------
    def zone(self) -> DataFrame:
        """Zone table, all measures, apportioned; EPOP; zone context."""
        df = R.with_epop(self._apportioned((), M.FULL_PREFIXES))
        return self._with_zone_context(df)

    def state(self) -> DataFrame:
        """State table, all measures, EPOP."""
        return R.with_epop(self._rolled(self._k(*STATE_KEYS), M.FULL_PREFIXES))

    def zone_occupation(self) -> DataFrame:
        """T4: zone x occupation, employment measures, context + titles, no military."""
        df = self._apportioned(("soc_minor",), M.EMPLOYMENT_PREFIXES)
        return self._occupation_titles(self._with_zone_context(df))

    def state_occupation(self) -> DataFrame:
        """T5: state x occupation, employment measures + titles, no military."""
        df = self._rolled(self._k(*STATE_KEYS, "soc_minor"),
                               M.EMPLOYMENT_PREFIXES)
        return self._occupation_titles(df)

    def occupation(self) -> DataFrame:
        """Occupation, employment measures + titles, no military."""
        df = self._rolled(self._k("soc_minor"), M.EMPLOYMENT_PREFIXES)
        return self._occupation_titles(df)

    def zone_sector(self) -> DataFrame:
        """Zone x sector, employment measures, context + sector titles."""
        df = self._apportioned(("naics_2d",), M.EMPLOYMENT_PREFIXES)
        return self._sector_titles(self._with_zone_context(df))

    def state_sector(self) -> DataFrame:
        """State x sector, employment measures + sector titles."""
        df = self._rolled(self._k(*STATE_KEYS, "naics_2d"),
                               M.EMPLOYMENT_PREFIXES)
        return self._sector_titles(df)

    def sector(self) -> DataFrame:
        """Sector, employment measures + sector titles."""
        df = self._rolled(self._k("naics_2d"), M.EMPLOYMENT_PREFIXES)
        return self._sector_titles(df)

    def tables(self) -> dict[str, DataFrame]:
        """All output tables under the source's file stems."""
        return {
            "puma_sector_soc_acs_data": self.master(),
            "cz_acs_data": self.zone(),
            "state_acs_data": self.state(),
            "cz_soc_minor_acs_data": self.zone_occupation(),
            "state_soc_minor_acs_data": self.state_occupation(),
            "soc_minor_acs_data": self.occupation(),
            "cz_sector_acs_data": self.zone_sector(),
            "state_sector_acs_data": self.state_sector(),
            "sector_acs_data": self.sector(),
            "labor_force_citizenship": self.labor_force_by_citizenship(),
            "labor_force_citizenship_birthplace": self.labor_force_by_birthplace(),
        }

    # -- pivot level coverage (explicit level lists) ---------------------------
    def unlisted_levels(self) -> DataFrame:
        """Universe persons whose birth status is outside the pivoted levels.

        The cube pivots on the fixed levels ``Local`` / ``immigrant``; a NULL
        status (unknown birthplace of a flagged person) would have become an
        extra ``..._na`` column in the source. Reported as one row instead
        (``unlisted_status_rows``), read from the single-pass aggregate when
        there is one.
        """
        levels = [lvl for lvl, _ in M.STATUS_LEVELS]
        fb = F.col("foreign_born")
        off = fb.isNull() | ~fb.isin(*levels)
        if self._narrow is not None:
            rows, src = F.sum(F.when(off, F.col("_3"))), self._narrow
        else:
            rows, src = F.count(F.when(off, 1)), self.clean
        return src.agg(F.coalesce(rows.cast("bigint"), F.lit(0).cast("bigint"))
                       .alias("unlisted_status_rows"))

    # -- A13 ------------------------------------------------------------------
    def conservation(self) -> DataFrame:
        """Totals before and after every roll-up, one ``quality`` frame.

        One global aggregate of the cube. A roll-up keeps a cell once for every
        match that its joins find: per unit the sum of its shares (zone steps),
        per occupation or sector code the number of its titles; so each table's
        total is the cube's, weighted by those factors, and no table is built.
        """
        once = F.lit(1.0)
        # the zone tables drop a piece with a NULL anywhere before they sum
        pieces = self.crosswalk.na.drop("any").groupBy(UNIT).agg(
            F.sum("county_prop_inpuma").alias("_shares"))
        occupations = self.soc_titles.where(D.not_military("soc_minor")).groupBy("soc_minor").agg(
            F.count(F.lit(1)).alias("_occupations"))
        sectors = self.sector_titles.groupBy("naics_2d").agg(F.count(F.lit(1)).alias("_sectors"))
        cube = self.master()
        for dim, key in ((pieces, UNIT), (occupations, "soc_minor"), (sectors, "naics_2d")):
            dim = broadcast_bounded(dim.withColumnRenamed(key, "_key"), self.dim_rows)
            cube = cube.join(dim, cube[key].eqNullSafe(dim["_key"]), "left").drop("_key")
        zone, occ, sec = (F.coalesce(F.col(c), F.lit(0)) for c in ("_shares", "_occupations", "_sectors"))
        return conservation_report(cube, [
            ("zone", M.POP, zone), ("state", M.POP, once),
            ("zone_occupation", M.EMP, zone * occ), ("state_occupation", M.EMP, occ),
            ("occupation", M.EMP, occ), ("zone_sector", M.EMP, zone * sec),
            ("state_sector", M.EMP, sec), ("sector", M.EMP, sec)])

    # -- T10 / T11 (unfiltered microdata, Q5) ----------------------------------
    # pivot columns in the order the sorted groups present them (by label)
    BIRTHPLACE_LEVELS = (("Central America", "central_america"), ("Mexico", "mexico"),
                         (D.BIRTHPLACE_OTHERS, "others"), ("South America", "south_america"),
                         (D.BIRTHPLACE_US, "us_and_us_possessions"))

    def labor_force_base(self) -> DataFrame:
        """Labour force by citizenship code x broad birthplace: the one pass over
        persons that T10 and T11 share (at most codes x 5 rows).

        The strict sum keeps NaN for an NA input so that the roll-ups above
        still propagate it; they turn NaN into NULL at the end.
        """
        value = F.coalesce(flag_times(F.col("LABFORCE") == 2, "PERWT").cast("double"),
                           F.lit(float("nan"))) if self.strict_na else \
            flag_times(F.col("LABFORCE") == 2, "PERWT")
        if self._labor_base is not None:        # from the single-pass build
            base = self._labor_base
        else:
            base = (self.microdata.withColumn("bpl_ii", D.birthplace_broad("BPL"))
                    .groupBy("CITIZEN", "bpl_ii").agg(F.sum(value).alias("lf")))
        dec = J.decode_labels(base, "CITIZEN", self.labels, "CITIZEN", "_cit", self.dim_rows)
        return dec.withColumn("citizenship", D.citizenship_label("_cit")).drop("_cit")

    @staticmethod
    def _na(c):
        return F.nanvl(c, F.lit(None).cast("double"))

    def labor_force_by_citizenship(self) -> DataFrame:
        """T10 (A6 + W1 + A8): labour force by citizenship, share, total row.

        The total row's share is total / total, i.e. the sum of the shares
        without its rounding noise.
        """
        df = R.with_total_row(self.labor_force_base(), "citizenship",
                              {"labor_force": self._na(F.sum("lf"))})
        # window over the aggregated frame (one row per citizenship label + total)
        total = F.max(F.when(F.col("is_total"), F.col("labor_force"))).over(Window.partitionBy())
        return df.withColumn("labor_force_share", F.try_divide(F.col("labor_force"), total))

    def labor_force_by_birthplace(self) -> DataFrame:
        """T11 (A7 + A5 + A9): citizenship x broad birthplace, pivoted, with a
        total row over the four named birthplaces (``Others`` left NULL).

        The total row is ``sum(cell, na.rm=TRUE)`` over the *group rows*, as
        the source's summary row: a group whose cell is NA is skipped, an
        all-NA column totals 0. It is an aggregate of the few group rows.
        """
        levels = self.BIRTHPLACE_LEVELS
        # cell = sum restricted to the level; NULL when the pair has no row (A5)
        cells = [self._na(F.sum(F.when(F.col("bpl_ii") == lvl, F.col("lf")))).alias(name)
                 for lvl, name in levels]
        groups = self.labor_force_base().groupBy("citizenship").agg(*cells)
        named = [name for lvl, name in levels if lvl != D.BIRTHPLACE_OTHERS]
        total = groups.agg(
            F.lit("total").alias("citizenship"),
            *[(F.coalesce(F.sum(name), F.lit(0.0)) if name in named
               else F.lit(None).cast("double")).alias(name) for _, name in levels])
        return (groups.withColumn("is_total", F.lit(False))
                .unionByName(total.withColumn("is_total", F.lit(True))))

    # -- T13 / T14 / T15 / T16 ---------------------------------------------------
    @staticmethod
    def occupation_hierarchy(structure: DataFrame, dim_rows: int | None = None) -> DataFrame:
        """Detailed code with its broad, minor and major titles."""
        def level(code: str, out: str) -> DataFrame:
            return (structure.select(F.col(code).alias(out), F.col("title").alias(f"{out}_title"))
                    .distinct().where(F.col(out).isNotNull()))
        major = level("major_group", "major_group")
        minor = level("minor_group", "minor_group")
        broad = level("broad_group", "broad_group")
        detailed = level("detailed_occupation", "detailed_soc")
        df = detailed.withColumns(D.soc_parent_codes("detailed_soc"))
        df = J.hierarchy_join(df, [(major, "major_group"), (minor, "minor_group"),
                                   (broad, "broad_group")], dim_rows)
        return df.select("detailed_soc", "detailed_soc_title", "broad_group", "broad_group_title",
                         "minor_group", "minor_group_title", "major_group", "major_group_title")

    def crosswalk_apportion(self) -> DataFrame:
        """Stata recipe: weighted unit counts -> merge -> zone sums -> national."""
        persons = self.clean.withColumns({"statefip": F.col("STATEFIP").cast("int"),
                                          "puma": F.col("PUMA").cast("int"),
                                          "n_persons": F.lit(1.0)})
        units = M.weighted_collapse(persons, ["statefip", "puma"], ["n_persons"])
        xw = self.crosswalk.select("statefip", "puma", ZONE, "county_prop_inpuma")
        return AP.apportion_stata(units, xw, ["statefip", "puma"], ZONE, "n_persons")

    # Measure names of the county table, in its column order.
    V1_MEASURES = ("civ_noninst_pop", "civ_noninst_pop_employed",
                   "civ_noninst_pop_employed_foreign", "civ_noninst_pop_employed_ca",
                   "civ_noninst_pop_employed_mx", "civ_noninst_pop_employed_sa",
                   "civ_noninst_labforce", "civ_noninst_labforce_foreign",
                   "civ_noninst_labforce_ca", "civ_noninst_labforce_mx",
                   "civ_noninst_labforce_sa", "count_foreign", "count_mx", "count_ca",
                   "count_sa")

    # -- V1 ------------------------------------------------------------------------
    def county_persons(self) -> DataFrame:
        """V1 input: universe persons with the padded county code."""
        df = D.universe(self.microdata)
        return df.withColumn("COUNTYFIP", D.county_fips(F.col("STATEFIP"), F.col("COUNTYFIP")))

    def county_table(self) -> DataFrame:
        """15 conditional measures by county (commented-out variant)."""
        df = self.county_persons().withColumns({
            "EMPSTAT_2": D.employed_flag("EMPSTAT"),
            "LABFORCE_2": D.labforce_flag("LABFORCE"),
            "fb": (F.col("BPL") > D.US_BPL_MAX).cast("int"),
            "ca": r_ifelse(F.col("BPL") == 210, 1, 0),
            "mx": r_ifelse(F.col("BPL") == 200, 1, 0),
            "sa": r_ifelse(F.col("BPL") == 300, 1, 0),
        })
        w, e, lf = F.col("PERWT"), F.col("EMPSTAT_2"), F.col("LABFORCE_2")
        def s(x):
            return M.weighted_sum(x, None, self.strict_na)
        values = [w, e * w, *[e * w * F.col(c) for c in ("fb", "ca", "mx", "sa")],
                  lf * w, *[lf * w * F.col(c) for c in ("fb", "ca", "mx", "sa")],
                  *[F.col(c) for c in ("fb", "mx", "ca", "sa")]]
        aggs = {n: s(v).cast("bigint") if n.startswith("count") else s(v)
                for n, v in zip(self.V1_MEASURES, values, strict=True)}
        g = df.groupBy("COUNTYFIP", F.col("STATEFIP").alias("state_code")).agg(
            *[v.alias(k) for k, v in aggs.items()])
        # keys as in the source (COUNTYFIP, STATE, STATEFIP): the label and the
        # padded code are functions of the state code, attached after the aggregate
        names = broadcast_bounded(state_names(self.labels), self.dim_rows)
        g = g.join(names, "state_code", "left").select(
            "COUNTYFIP",
            F.coalesce(F.col("state"), F.col("state_code").cast("string")).alias("STATE"),
            pad_left(F.col("state_code"), 2).alias("STATEFIP"),
            *aggs.keys())
        return R.with_epop(g)

    def county_zone(self) -> DataFrame:
        """V1 (J10 + A15): county table -> zone by plain sums, EPOP.

        Grouped by the zone column actually joined (``ers90``; Q10).
        """
        counties = broadcast_bounded(self.county_zones, self.dim_rows)
        joined = self.county_table().join(
            counties, F.col("COUNTYFIP") == F.col("county_fips"), "left").na.drop("any")
        out = joined.groupBy("ers90").agg(*[F.sum(m).alias(m) for m in self.V1_MEASURES])
        return R.with_epop(out)

    def county_unmatched(self) -> DataFrame:
        """Counties with data but no zone, distinct."""
        return J.anti_keys(self.county_table(), self.county_zones, "COUNTYFIP", "county_fips")

    def zones_without_data(self) -> DataFrame:
        """Zones of the county table without any county in the data."""
        return J.anti_keys(self.county_zones, self.county_table(), "county_fips", "COUNTYFIP",
                           keep=["out90"])


def zone_context_from_pieces(pieces: DataFrame) -> DataFrame:
    """T16 (A18 + A19): main state, number of states and state list per zone.

    ``pieces``: ``cz90, statefip, state_abbv, pop`` (population per piece).
    Pieces are first summed per (zone, state); one aggregate per zone then
    yields the main state (``min_by`` on ``(-pop, state)``: largest part,
    ties to the smaller code), the state count and the sorted ``"; "`` list.
    The list is bounded by the number of states, whatever the data size.
    """
    per_state = pieces.groupBy(ZONE, "statefip").agg(
        F.sum("pop").alias("pop"), F.min("state_abbv").alias("state_abbv"))
    main = F.min_by(F.struct("statefip", "state_abbv"), F.struct(-F.col("pop"), F.col("statefip")))
    zones = per_state.groupBy(ZONE).agg(
        main.alias("main"),
        F.count(F.lit(1)).cast("int").alias("states_count"),
        F.array_join(F.sort_array(F.collect_list("state_abbv")), "; ").alias("states_abbv"))
    return zones.select(
        F.col(ZONE).alias("ers90"), pad_left(F.col("main.statefip"), 2).alias("state_fips"),
        F.col("main.state_abbv").alias("state_abbv"), "states_count", "states_abbv")


def stack_panels(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack period frames by column name (same column set required, N20)."""
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), frames)


def tag_period(df: DataFrame, year: int) -> DataFrame:
    """P9 + P5: add ``year`` and put it first (panel rows)."""
    return move_first(df.withColumn("year", F.lit(int(year))), "year")


__all__ = ["Survey", "clean_microdata", "soc_minor_titles", "state_names",
           "zone_context_from_pieces", "stack_panels", "tag_period"]
