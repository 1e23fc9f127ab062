"""Binding of the driver tables to the survey microdata schema.

The products are written against the census microdata layout (``YEAR,
STATEFIP, PUMA, GQ, EMPSTAT, EMPSTATD, LABFORCE, AGE, CITIZEN, BPL, PERWT,
OCCSOC, INDNAICS``). The driver supplies TPC-H-like tables instead, so this
module derives that layout from them; a person is one ``lineitem`` row:

==============  =====================================================
column          derived from
==============  =====================================================
PERWT           ``l_quantity`` (whole numbers, exact sums)
STATEFIP        customer nation; ``STATE`` label = ``n_name``
PUMA            ``c_custkey % 40`` (unit within state)
COUNTYFIP       ``c_custkey % 50`` (county within state)
GQ              3 (institutional) when ``o_orderstatus = 'P'``, else 1
EMPSTATD        14 (armed forces) when ``o_orderpriority = '5-LOW'``, else 10
EMPSTAT         1 / 2 / 3 for ``l_returnflag`` N / A / R
LABFORCE        2 (in labour force) unless ``l_returnflag = 'R'``
AGE             ``p_size``
CITIZEN, BPL    supplier nation relative to the customer nation
OCCSOC          major group from ``p_brand`` + 4 digits from ``p_partkey``
INDNAICS        a NAICS 2-digit code chosen by ``p_partkey`` + 2 digits
YEAR, MULTYEAR  ``year(o_orderdate)``
==============  =====================================================

Zones (``cz90``) group counties: ``100 * (state % 5 + 1) + county % 7``; a
unit (PUMA) spreads over several counties and hence several zones, which
gives a genuinely fractional crosswalk. All dimension tables here have row
bounds fixed by these rules (25 states x 40 units x 7 zone suffixes, ...),
so they are broadcast-safe at any data size.

Scale: the person view is a star join. ``orders`` is joined to ``customer``
first, so the lineitem-sized stream is shuffled for three joins (order,
part, supplier) rather than four; only the columns the rules need are read
(Parquet column pruning) and the universe filters reach the ``orders`` and
``part`` scans before any shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import derive as D
from ..session import broadcast_bounded, stage_bucketed
from . import titles

# ---------------------------------------------------------------------------
# Fixed binding parameters (the oracle SQL in plans/oracle.py uses the same).
# ---------------------------------------------------------------------------
UNITS_PER_STATE = 40
COUNTIES_PER_STATE = 50
ZONE_BANDS = 5
ZONE_SUFFIXES = 7
MAX_STATES = 25                      # nation has 25 rows
OCCSOC_NULL_MOD = 101                # every 101st part has no occupation code
INDNAICS_NULL_MOD = 103              # every 103rd part has no industry code
OCC_SUFFIX_MULT = 7919
# NAICS 2-digit codes as they appear in the census industry code, including
# the two "not specified" classes that have no sector title.
NAICS_CODES = ("11", "21", "22", "23", "31", "32", "33", "42", "44", "45", "48", "49",
               "51", "52", "53", "54", "55", "56", "61", "62", "71", "72", "81", "92",
               "99", "3S", "4S")

# Row bounds implied by the rules above (used for broadcast decisions).
UNIT_ROWS = MAX_STATES * UNITS_PER_STATE
COUNTY_ROWS = MAX_STATES * COUNTIES_PER_STATE
ZONE_ROWS = ZONE_BANDS * ZONE_SUFFIXES
CROSSWALK_ROWS = UNIT_ROWS * ZONE_SUFFIXES


# Fixed layouts of the driver tables: with a schema given, making a reader
# starts no job (Spark would read a footer to find it).
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                 "l_linestatus string, l_shipdate timestamp_ntz"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table ``name``."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def zone_of(state: Column, county: Column) -> Column:
    """Zone code of a county: ``100 * (state % 5 + 1) + county % 7``."""
    return (F.lit(100) * (state % ZONE_BANDS + 1) + county % ZONE_SUFFIXES).cast("int")


def _occsoc(p: DataFrame) -> Column:
    brand_no = F.substring(p["p_brand"], 7, 10).cast("int")
    major = (F.lit(11) + F.lit(2) * ((brand_no - 1) % 25)).cast("string")
    suffix = F.lpad(((p["p_partkey"] * OCC_SUFFIX_MULT) % 10000).cast("string"), 4, "0")
    return F.when(p["p_partkey"] % OCCSOC_NULL_MOD != 0, F.concat(major, suffix))


def _indnaics(p: DataFrame) -> Column:
    codes = F.array(*[F.lit(c) for c in NAICS_CODES])
    pick = F.element_at(codes, (p["p_partkey"] % len(NAICS_CODES) + 1).cast("int"))
    suffix = F.lpad((p["p_partkey"] % 100).cast("string"), 2, "0")
    return F.when(p["p_partkey"] % INDNAICS_NULL_MOD != 0, F.concat(pick, suffix))


def _citizen(same_nation: Column, suppkey: Column, custkey: Column) -> Column:
    return F.when(same_nation, F.lit(0)).otherwise(((suppkey + custkey) % 6).cast("int"))


def _bpl(same_nation: Column, s_nation: Column, s_region: Column) -> Column:
    return (F.when(same_nation, s_nation + 1)
            .when(s_region == 1, F.when(s_nation % 3 == 0, 200)
                  .when(s_nation % 3 == 1, 210).otherwise(300))
            .when(s_region == 3, 400 + s_nation)
            .when(s_region == 2, 500 + s_nation)
            .when(s_region == 0, F.when(s_nation % 3 == 0, 600)
                  .when(s_nation % 3 == 1, 700).otherwise(710))
            .otherwise(100 + s_nation)).cast("int")


def microdata_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persons with NULLs in four columns and ages up to 100, for the rules
    that the NULL-free driver tables would not exercise."""
    def gone(col: str, mod: int) -> Column:
        return F.when(F.col("PARTKEY") % mod != 1, F.col(col))
    return microdata(spark, sf_dir, keep_part=True).withColumns({
        "BPL": gone("BPL", 13), "CITIZEN": gone("CITIZEN", 11), "LABFORCE": gone("LABFORCE", 17),
        "PERWT": gone("PERWT", 1009), "AGE": 2 * F.col("AGE")}).drop("PARTKEY")


def person_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a person takes from ``lineitem``."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")


def person_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a person takes from its order and the order's customer."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return orders.join(cust, orders["o_custkey"] == cust["c_custkey"]).select(
        "o_orderkey", "c_custkey", "c_nationkey",
        F.year("o_orderdate").alias("YEAR"),
        F.when(F.col("o_orderstatus") == "P", 3).otherwise(1).alias("GQ"),
        F.when(F.col("o_orderpriority") == "5-LOW", 14).otherwise(10).alias("EMPSTATD"),
    )


def stage_person_tables(spark: SparkSession, sf_dir: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """The two largest sides of the person join, written once, bucketed and sorted by
    the order key: every later join of them needs no exchange. ``unstage`` both at the end."""
    return (stage_bucketed(person_lines(spark, sf_dir), "person-lines", ["l_orderkey"], buckets),
            stage_bucketed(person_orders(spark, sf_dir), "person-orders", ["o_orderkey"], buckets))


def microdata(spark: SparkSession, sf_dir: str, keep_part: bool = False,
              staged: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Person-level microdata in the census layout (all persons, no filter).

    A person is a line whose order, part and supplier all exist; every table
    starts from this one set. ``keep_part`` adds the line's part key;
    ``staged`` takes lines and orders from :func:`stage_person_tables`.
    """
    li, order_attrs = staged or (person_lines(spark, sf_dir), person_orders(spark, sf_dir))
    part = table(spark, sf_dir, "part")
    part = part.select(
        "p_partkey",
        part["p_size"].alias("AGE"),
        _occsoc(part).alias("OCCSOC"),
        _indnaics(part).alias("INDNAICS"),
    )
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    s_nation = broadcast_bounded(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("s_nationkey"), F.col("n_regionkey").alias("s_regionkey")),
        MAX_STATES)
    people = (li.join(order_attrs, li["l_orderkey"] == order_attrs["o_orderkey"])
              .join(part, li["l_partkey"] == part["p_partkey"])
              .join(supp, li["l_suppkey"] == supp["s_suppkey"])
              .join(s_nation, "s_nationkey"))
    same = F.col("s_nationkey") == F.col("c_nationkey")
    return people.select(
        "YEAR",
        F.col("YEAR").alias("MULTYEAR"),
        F.col("c_nationkey").alias("STATEFIP"),
        (F.col("c_custkey") % COUNTIES_PER_STATE).cast("int").alias("COUNTYFIP"),
        (F.col("c_custkey") % UNITS_PER_STATE).cast("int").alias("PUMA"),
        "GQ",
        "EMPSTATD",
        F.when(F.col("l_returnflag") == "N", 1)
         .when(F.col("l_returnflag") == "A", 2).otherwise(3).alias("EMPSTAT"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(2).alias("LABFORCE"),
        "AGE",
        _citizen(same, F.col("l_suppkey"), F.col("c_custkey")).alias("CITIZEN"),
        _bpl(same, F.col("s_nationkey"), F.col("s_regionkey")).alias("BPL"),
        F.col("l_quantity").alias("PERWT"),
        "OCCSOC",
        "INDNAICS",
        *([F.col("l_partkey").alias("PARTKEY")] if keep_part else []),
    )


def survey_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Years of the orders, ascending (one row per year comes to the driver)."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y")).distinct()
    return sorted(r.y for r in years.where("y IS NOT NULL").collect())


def value_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codebook value labels: ``STATEFIP`` from ``nation``, ``CITIZEN`` fixed."""
    states = table(spark, sf_dir, "nation").select(
        F.lit("STATEFIP").alias("name"), F.col("n_nationkey").cast("int").alias("value"),
        F.col("n_name").alias("label"))
    return states.unionByName(titles.citizen_labels(spark))


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: state, unit, county and zone codes."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    county = (F.col("c_custkey") % COUNTIES_PER_STATE).cast("int")
    return c.select(
        F.col("c_nationkey").cast("int").alias("statefip"),
        (F.col("c_custkey") % UNITS_PER_STATE).cast("int").alias("puma"),
        county.alias("county"),
        zone_of(F.col("c_nationkey"), county).alias("cz90"),
    )


def crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit -> zone crosswalk built from customer counts.

    Columns as the published crosswalk: ``statefip, puma, cz90, pop, pumapop,
    czpop, county_prop_incz, county_prop_inpuma`` plus the unit key ``stpuma``.
    """
    from ..operators.apportion import build_crosswalk, crosswalk_pieces
    pieces = crosswalk_pieces(customer_geo(spark, sf_dir), ["statefip", "puma"], "cz90")
    xw = build_crosswalk(pieces, ["statefip", "puma"], "cz90")
    return xw.withColumn("stpuma", D.geo_unit_key(F.col("statefip"), F.col("puma")))


def county_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County -> zone table (1990 definition): ``county_fips, ers90, out90, pop90``."""
    g = customer_geo(spark, sf_dir)
    return (g.groupBy("statefip", "county", "cz90").agg(F.count(F.lit(1)).alias("pop90"))
            .select(D.county_fips(F.col("statefip"), F.col("county")).alias("county_fips"),
                    F.col("cz90").alias("ers90"),
                    F.concat(F.lit("zone "), F.col("cz90").cast("string")).alias("out90"), "pop90"))


def zone_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population of every (zone, state) piece with the state's name."""
    g = customer_geo(spark, sf_dir)
    pieces = g.groupBy("cz90", "statefip").agg(F.count(F.lit(1)).cast("double").alias("pop"))
    names = broadcast_bounded(
        table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("statefip"),
                                              F.col("n_name").alias("state_abbv")),
        MAX_STATES)
    return pieces.join(names, "statefip", "left")


def soc_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 analog: occupation structure rows, one code filled per row.

    Detailed rows come from the occupation codes of ``part`` (title
    ``p_name``); broad, minor and major rows are derived from them (title
    ``group <code>``), and minor rows carry the SOC titles when known.
    """
    part = table(spark, sf_dir, "part")
    occ = _occsoc(part)
    detailed = part.where(occ.isNotNull()).select(
        F.concat(F.substring(occ, 1, 2), F.lit("-"), F.substring(occ, 3, 4)).alias("code"),
        F.col("p_name").alias("title"))
    parents = D.soc_parent_codes(F.col("code"))
    null = F.lit(None).cast("string")
    minor_titles = broadcast_bounded(titles.soc_structure_minor(spark), len(titles.SOC_MINOR_GROUPS))
    minor = (detailed.select(parents["minor_group"].alias("minor_group")).distinct()
             .join(minor_titles, "minor_group", "left")
             .select(null.alias("major_group"), "minor_group", null.alias("broad_group"),
                     null.alias("detailed_occupation"),
                     F.coalesce("title", F.concat(F.lit("group "), "minor_group")).alias("title")))
    major = detailed.select(parents["major_group"].alias("c")).distinct().select(
        F.col("c").alias("major_group"), null.alias("minor_group"), null.alias("broad_group"),
        null.alias("detailed_occupation"), F.concat(F.lit("group "), "c").alias("title"))
    broad = detailed.select(parents["broad_group"].alias("c")).distinct().select(
        null.alias("major_group"), null.alias("minor_group"), F.col("c").alias("broad_group"),
        null.alias("detailed_occupation"), F.concat(F.lit("group "), "c").alias("title"))
    det = detailed.select(
        null.alias("major_group"), null.alias("minor_group"), null.alias("broad_group"),
        F.col("code").alias("detailed_occupation"), "title")
    return major.unionByName(minor).unionByName(broad).unionByName(det)


def zone_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T16 on the driver tables: main state and state list per zone."""
    from .products import zone_context_from_pieces
    return zone_context_from_pieces(zone_pieces(spark, sf_dir))


def soc_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T14 on the fixed SOC minor-group list (titles for the occupation tables)."""
    from .products import soc_minor_titles
    return soc_minor_titles(titles.soc_structure_minor(spark))
