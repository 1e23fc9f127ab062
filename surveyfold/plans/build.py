"""One sample in, every table out (the reference's main entry, S9 + S10 + A13).

``build_tables`` runs one pass over the person joins (written once in the
shared checkpoint folder), then writes the eleven output tables and the
quality frame, each partitioned by the sample's period tag. With
``period_keys=("year",)`` the same call writes panels partitioned by year.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import period_tag, read_built_panel, write_table
from ..sources.published import publish_frames, read_published_panel
from .products import Survey

# Keys of each output table, for the key order at the sink (O1).
TABLE_KEYS = {
    "puma_sector_soc_acs_data": ["stpuma", "soc_minor", "naics_2d"],
    "cz_acs_data": ["cz90"],
    "state_acs_data": ["state_fips", "state"],
    "cz_soc_minor_acs_data": ["cz90", "soc_minor"],
    "state_soc_minor_acs_data": ["state_fips", "state", "soc_minor"],
    "soc_minor_acs_data": ["soc_minor"],
    "cz_sector_acs_data": ["cz90", "naics_2d"],
    "state_sector_acs_data": ["state_fips", "state", "naics_2d"],
    "sector_acs_data": ["naics_2d"],
    "labor_force_citizenship": ["is_total", "citizenship"],
    "labor_force_citizenship_birthplace": ["is_total", "citizenship"],
    "quality_conservation": ["step"],
}


# The eight tables that are stacked over single-year samples.
PANEL_TABLES = ("cz_acs_data", "state_acs_data", "cz_soc_minor_acs_data", "state_soc_minor_acs_data",
                "soc_minor_acs_data", "cz_sector_acs_data", "state_sector_acs_data", "sector_acs_data")
SCHEMA_TABLE = "_schemas"


def build_tables(survey: Survey, out_dir: str, fmt: str = "csv",
                 year_col: str = "MULTYEAR", multi_year: bool = True) -> None:
    """Write every product under ``out_dir/{table}``.

    The period tag (``2015_2019``-style, S10) is the partition folder of every
    non-panel table, so several samples sit side by side like the source's
    ``{table}_{period}``; building a sample again replaces its period only. The
    sample's description (S11) is a table of its own. What was staged for the
    build is deleted at its end, also when it fails.
    """
    try:
        # one pass over the person joins serves the cube and the labour-force tables
        survey.materialize(single_pass=True).roll_up_once(write=True)
        _write_tables(survey, out_dir, fmt, year_col, multi_year)
    finally:
        survey.release()


def publish_tables(survey: Survey, out_dir: str, fmt: str = "csv",
                   year_col: str = "MULTYEAR", multi_year: bool = True) -> int:
    """The same tables as one published build: readers see all of them or none.

    The part is the sample's period tag (``panel`` where tables are keyed by
    year). Returns the version. A failure leaves the version before as it was.
    """
    try:
        survey.materialize(single_pass=True).roll_up_once(write=True)
        tables, period = _tables(survey), "panel"
        if not survey.period_keys:
            sample = _sample(survey, year_col, multi_year)
            tables["sample_description"] = survey.spark.createDataFrame(
                [(sample["sample_description"],)], "sample_description string")
            period = sample["first_last_year"]
        keys = {name: [*(k for k in survey.period_keys if k in df.columns), *TABLE_KEYS.get(name, [])]
                for name, df in tables.items()}
        return publish_frames(survey.spark, out_dir, tables, period, fmt, keys)
    finally:
        survey.release()


def publish_panels(spark: SparkSession, out_dir: str, years, fmt: str = "csv", tables=PANEL_TABLES) -> int:
    """Stack published single-year samples and publish the panels as one build (part ``panel``)."""
    frames = {f"{name}_panel": read_published_panel(spark, out_dir, name, years) for name in tables}
    return publish_frames(spark, out_dir, frames, "panel", fmt, {f"{n}_panel": ["year", *TABLE_KEYS[n]] for n in tables})


def _tables(survey: Survey) -> dict:
    return {**survey.tables(), "quality_conservation": survey.conservation(),
            "quality_unlisted_levels": survey.unlisted_levels()}


def _sample(survey: Survey, year_col: str, multi_year: bool):
    """Period tag and description: one tiny aggregate over the distinct years."""
    years = survey.sample_years()
    return period_tag(years, year_col if year_col in years.columns else "YEAR", multi_year).first()


def _write_tables(survey: Survey, out_dir: str, fmt: str, year_col: str, multi_year: bool) -> None:
    tables = _tables(survey)
    schemas = survey.spark.createDataFrame(
        [(name, df.schema.json()) for name, df in tables.items()], "table string, schema string")
    schemas.coalesce(1).write.mode("overwrite").parquet(os.path.join(out_dir, SCHEMA_TABLE))
    if survey.period_keys:
        parts = list(survey.period_keys)
        for name, df in tables.items():
            keys = parts + TABLE_KEYS.get(name, []) if all(k in df.columns for k in parts) \
                else TABLE_KEYS.get(name, [])
            write_table(df, os.path.join(out_dir, name), fmt,
                        partition_by=parts if all(k in df.columns for k in parts) else None,
                        order_by=keys)
        return
    # the tag is one short string (like the source's file-name suffix): a literal on every table
    sample = _sample(survey, year_col, multi_year)
    tables["sample_description"] = survey.spark.createDataFrame(
        [(sample["sample_description"],)], "sample_description string")
    for name, df in tables.items():
        write_table(df.withColumn("period", F.lit(sample["first_last_year"])), os.path.join(out_dir, name), fmt,
                    partition_by=["period"], order_by=TABLE_KEYS.get(name))


def build_panels(spark: SparkSession, out_dir: str, panel_dir: str, years, fmt: str = "csv",
                 tables=PANEL_TABLES) -> None:
    """Stack the single-year samples of ``out_dir`` into one panel per table.

    Every year of ``years`` must have been built. A panel is partitioned by
    year and sorted by the table's keys.
    """
    schemas = {r.table: r.schema for r in spark.read.parquet(os.path.join(out_dir, SCHEMA_TABLE)).collect()}
    for name in tables:
        schema = StructType.fromJson(json.loads(schemas[name]))
        panel = read_built_panel(spark, out_dir, name, years, schema, fmt)
        write_table(panel, os.path.join(panel_dir, name), fmt, partition_by=["year"],
                    order_by=["year", *TABLE_KEYS[name]])
