"""Typed file readers and sinks.

CSV is always read with an explicit schema and ``NA`` as the null marker, so
codes such as ``01`` stay text (N11) and literal ``NA`` cells become NULL.
Sinks write ``NA`` for NULL (N12) and partition by period instead of putting
the period in a file name per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------
# Fixed schemas of the dimension files (column names as published).
# ---------------------------------------------------------------------------
CROSSWALK_SCHEMA = ("statefip int, puma int, cz90 int, pop double, pumapop double, czpop double, "
                    "county_prop_incz double, county_prop_inpuma double")
ZONE_CONTEXT_SCHEMA = ("ers90 int, state_fips string, state_abbv string, states_count int, "
                       "states_abbv string, cbsa10 string, cbsa_name string")
COUNTY_1990_SCHEMA = ("county_fips string, ers90 int, out90 string, rep90 string, pop90 double, "
                      "cbsa10 string, cbsa_name string")
COUNTY_2010_SCHEMA = "county_fips string, out10 string, rep10 string, pop10 double"
SOC_STRUCTURE_SCHEMA = ("major_group string, minor_group string, broad_group string, "
                        "detailed_occupation string, title string")
SECTOR_TITLES_SCHEMA = "naics_2d string, sector string, short_sector string"
MINOR_SOC_SCHEMA = "occ_code string, occ_title string, minor_socxx string"


def read_csv(spark: SparkSession, path: str, schema: str | StructType,
             null_value: str = "NA") -> DataFrame:
    """S3: CSV with header, columns matched by name, ``NA`` as NULL.

    The header (of the first file under ``path``) says in which order the
    columns stand; a missing or extra column raises here. A cell that does not
    fit its type, or another file under ``path`` with another header, fails the
    job that reads it.
    """
    wanted = _struct(schema)
    header = spark.read.option("header", True).csv(path).columns
    if sorted(header) != sorted(wanted.names):
        raise ValueError(f"{path}: columns {sorted(header)}, expected {sorted(wanted.names)}")
    in_file = StructType([wanted[c] for c in header])
    return (spark.read.option("header", True).option("nullValue", null_value)
            .option("mode", "FAILFAST").option("enforceSchema", False)
            .schema(in_file).csv(path).select(*wanted.names))


def _struct(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Unit -> zone crosswalk with the unit key ``stpuma``."""
    from ..functions.derive import geo_unit_key
    df = read_csv(spark, path, CROSSWALK_SCHEMA)
    return df.withColumn("stpuma", geo_unit_key(F.col("statefip"), F.col("puma")))


def read_zone_context(spark: SparkSession, path: str) -> DataFrame:
    """S3 for the zone context file (``NA`` cells NULL, codes as text)."""
    return read_csv(spark, path, ZONE_CONTEXT_SCHEMA)


def read_counties(spark: SparkSession, path: str, definition: int = 1990) -> DataFrame:
    """County -> zone attributes, county code padded to 5."""
    from ..functions.scalars import pad_left
    schema = COUNTY_1990_SCHEMA if definition == 1990 else COUNTY_2010_SCHEMA
    df = read_csv(spark, path, schema)
    return df.withColumn("county_fips", pad_left("county_fips", 5))


def read_soc_structure(spark: SparkSession, path: str) -> DataFrame:
    """Occupation structure, one code filled per row."""
    return read_csv(spark, path, SOC_STRUCTURE_SCHEMA)


def read_sector_titles(spark: SparkSession, path: str) -> DataFrame:
    """Sector titles."""
    return read_csv(spark, path, SECTOR_TITLES_SCHEMA)


def read_panel(spark: SparkSession, directory: str, table: str,
               schema: str | StructType, expected_years=None) -> DataFrame:
    """S4 + U2: every ``{table}_{yyyy}.csv`` of ``directory``, stacked by column name.

    The glob is anchored at the table name and requires exactly four digits
    before ``.csv``, so ``cz_{table}_2019.csv`` and ``{table}_2015_2019.csv``
    are not picked up (N22). Each file is read by its own header, so files may
    order their columns differently; a missing or extra column raises (N20).
    The year comes from the file name; ``year`` is put first (P5). With
    ``expected_years`` a missing year raises, as the source's loop fails on a
    missing file (Q12). The driver lists one path per year, no rows.
    """
    pattern = f"{directory.rstrip('/')}/{table}_[0-9][0-9][0-9][0-9].csv"
    listed = spark.read.format("binaryFile").load(pattern).select("path")
    paths = {int(r.path[-8:-4]): r.path for r in listed.collect()}
    return _stack_years({y: (lambda p=p: read_csv(spark, p, schema)) for y, p in paths.items()},
                        table, directory, expected_years)


def _stack_years(readers: dict, table: str, place: str, expected_years) -> DataFrame:
    missing = sorted({int(y) for y in expected_years or ()} - set(readers))
    if missing or not readers:
        raise FileNotFoundError(f"{table}: no file for year(s) {missing or 'any'} in {place}")
    frames = []
    for year in sorted(readers):
        df = readers[year]()
        frames.append(df.select(F.lit(year).alias("year"), *[c for c in df.columns if c != "year"]))
    return reduce(lambda a, b: a.unionByName(b), frames)


def read_built_panel(spark: SparkSession, out_dir: str, table: str, years,
                     schema: str | StructType, fmt: str = "csv") -> DataFrame:
    """U2 on the build's own output: ``{table}/period={yyyy}`` of every year, stacked by name."""
    place = f"{out_dir.rstrip('/')}/{table}"

    def reader(year: int):
        path = f"{place}/period={year}"
        if fmt == "csv":
            return lambda: read_csv(spark, path, schema)
        return lambda: spark.read.schema(_struct(schema)).format(fmt).load(path)
    listed = {r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .load(place).select("path").collect()} if years else set()
    have = [int(y) for y in years if any(f"/period={int(y)}/" in p for p in listed)]
    return _stack_years({y: reader(y) for y in have}, table, out_dir, years)


def write_table(df: DataFrame, path: str, fmt: str = "csv",
                partition_by: list[str] | None = None, mode: str = "overwrite",
                order_by: list[str] | None = None) -> None:
    """CSV (``NA`` for NULL, header) or Parquet, optionally partitioned by period.

    ``order_by`` (O1) sorts rows by key at the sink only, as grouped output
    is in R; Spark range-partitions for it, so it stays parallel.
    """
    if order_by:
        # partition columns lead, so the partitioned writer's required order
        # is already met and it does not re-sort (which would scramble keys)
        lead = [c for c in (partition_by or []) if c not in order_by]
        df = df.orderBy(*lead, *order_by)
    w = df.write.mode(mode)
    if partition_by:
        # an overwrite replaces the periods it writes and no other
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        w.option("header", True).option("nullValue", "NA").csv(path)
    else:
        w.format(fmt).save(path)


def period_tag(df: DataFrame, year_col: str = "MULTYEAR", multi_year: bool = True) -> DataFrame:
    """S10 + S11: period tag and sample description, one row.

    ``first_last_year`` is ``{min}_{max}`` for a multi-year sample and the
    single year otherwise; the description lists the distinct years, sorted.
    """
    y = F.col(year_col).cast("string")
    years = F.array_join(F.array_sort(F.collect_set(y)), ", ")
    tag = (F.concat_ws("_", F.min(F.col(year_col)).cast("string"), F.max(F.col(year_col)).cast("string"))
           if multi_year else F.min(F.col(year_col)).cast("string"))
    return df.agg(tag.alias("first_last_year"),
                  F.concat(F.lit("Based in ACS samples from "), years).alias("sample_description"))
