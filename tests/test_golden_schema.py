"""Output layout equals the reference's committed result files (headers as fixed values)."""
import pytest

from conftest import SF_SMALL
from surveyfold.plans.products import Survey

# Header lines of the reference's state, sector and occupation outputs.
STATE_HEADER = (
    "state_fips,state,civ_noninst_pop,civ_noninst_pop_employed,civ_noninst_pop_local,"
    "civ_noninst_pop_immigrant,civ_noninst_pop_employed_local,civ_noninst_pop_employed_immigrant,"
    "civ_noninst_pop_employed_central_america,civ_noninst_pop_employed_south_america,"
    "civ_noninst_pop_employed_mexico,civ_noninst_labforce,civ_noninst_labforce_local,"
    "civ_noninst_labforce_immigrant,civ_noninst_labforce_central_america,"
    "civ_noninst_labforce_south_america,civ_noninst_labforce_mexico,count,count_local,"
    "count_immigrant,count_central_america,count_south_america,count_mexico,EPOP")
SECTOR_HEADER = (
    "naics_2d,civ_noninst_pop_employed,civ_noninst_pop_employed_local,"
    "civ_noninst_pop_employed_immigrant,civ_noninst_pop_employed_central_america,"
    "civ_noninst_pop_employed_south_america,civ_noninst_pop_employed_mexico,count,count_local,"
    "count_immigrant,count_central_america,count_south_america,count_mexico,sector,short_sector")
OCCUPATION_HEADER = (
    "soc_minor,civ_noninst_pop_employed,civ_noninst_pop_employed_local,"
    "civ_noninst_pop_employed_immigrant,civ_noninst_pop_employed_central_america,"
    "civ_noninst_pop_employed_south_america,civ_noninst_pop_employed_mexico,count,count_local,"
    "count_immigrant,count_central_america,count_south_america,count_mexico,minor_group,title")


@pytest.fixture(scope="module")
def survey(spark):
    return Survey.from_driver_tables(spark, SF_SMALL)


def test_state_layout(survey):
    assert ",".join(survey.state().columns) == STATE_HEADER


def test_sector_layout(survey):
    assert ",".join(survey.sector().columns) == SECTOR_HEADER


def test_occupation_layout(survey):
    assert ",".join(survey.occupation().columns) == OCCUPATION_HEADER


def test_codes_are_text(survey):
    types = dict(survey.state().dtypes)
    assert types["state_fips"] == "string"
    assert dict(survey.sector().dtypes)["naics_2d"] == "string"
    assert dict(survey.occupation().dtypes)["soc_minor"] == "string"
