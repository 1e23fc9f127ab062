"""Products on the driver tables: golden invariants 1-7 of the blueprint."""
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from surveyfold.operators import measures as M
from surveyfold.plans.products import Survey


@pytest.fixture(scope="module")
def survey(spark):
    return Survey.from_driver_tables(spark, SF_SMALL).materialize()


def total(df, c):
    return df.agg(F.sum(c)).first()[0] or 0


def test_local_plus_immigrant(survey):
    st = survey.state()
    for r in st.collect():
        for m in (M.POP, M.EMP, M.LF, M.N):
            assert r[m] == r[f"{m}_local"] + r[f"{m}_immigrant"]
        assert r[f"{M.EMP}_central_america"] + r[f"{M.EMP}_south_america"] + \
            r[f"{M.EMP}_mexico"] <= r[f"{M.EMP}_immigrant"]
        assert r["EPOP"] == r[M.EMP] / r[M.POP] * 100


def test_state_and_occupation_conserve(survey):
    cube = survey.master()
    assert total(survey.state(), M.POP) == total(cube, M.POP)
    assert total(survey.occupation(), M.EMP) <= total(cube, M.EMP)


def test_zone_conserves_when_shares_sum_to_one(survey):
    cube = survey.master()
    assert abs(total(survey.zone(), M.POP) - total(cube, M.POP)) < 1e-6


def test_keys_unique(survey):
    for df, keys in ((survey.state(), ["state_fips"]), (survey.sector(), ["naics_2d"]),
                     (survey.occupation(), ["soc_minor"]), (survey.zone(), ["cz90"])):
        assert df.count() == df.select(*keys).distinct().count()


def test_conservation_frame(survey):
    q = {r.step: r for r in survey.conservation().collect()}
    assert abs(q["state"].diff) < 1e-6 and abs(q["zone"].diff) < 1e-6
    assert q["sector"].diff <= 0      # 3S / 4S have no title (F:502)


def test_no_military_and_titles(survey):
    occ = survey.occupation()
    assert occ.where(F.substring("soc_minor", 1, 2) == "55").count() == 0
    assert occ.where(F.col("title").isNull()).count() == 0


def test_labor_force_tables(survey):
    t10 = {r.citizenship: r for r in survey.labor_force_by_citizenship().collect()}
    assert t10["total"].labor_force_share == 1.0
    assert "Not foreign born" in t10
    t11 = {r.citizenship: r for r in survey.labor_force_by_birthplace().collect()}
    assert t11["total"].others is None


def test_panel_years(spark):
    s = Survey.from_driver_tables(spark, SF_SMALL, period_keys=("year",))
    st = s.state()
    assert st.columns[0] == "year"
    years = sorted(r.year for r in st.select("year").distinct().collect())
    assert years[0] >= 1995 and len(years) >= 5
    one = Survey.from_driver_tables(spark, SF_SMALL).state()
    assert total(st, M.POP) == total(one, M.POP)


def test_pipeline_writes_tables(spark, tmp_path):
    from surveyfold.plans.build import build_tables
    s = Survey.from_driver_tables(spark, SF_SMALL)
    build_tables(s, str(tmp_path / "out"), fmt="parquet", year_col="YEAR")
    st = spark.read.parquet(str(tmp_path / "out" / "state_acs_data"))
    assert st.select("period").distinct().count() == 1
    assert st.first()["period"].count("_") == 1
    assert spark.read.parquet(str(tmp_path / "out" / "quality_conservation")).count() == 8


def test_zone_tables_carry_share_sums(survey):
    """Q14: starts_with("count") after the crosswalk join also sums the shares."""
    for df in (survey.zone(), survey.zone_occupation(), survey.zone_sector()):
        cols = df.columns
        assert cols.index("county_prop_incz") == cols.index("count_mexico") + 1
        assert cols.index("county_prop_inpuma") == cols.index("county_prop_incz") + 1
    zone = survey.zone()
    # per zone: sum of squared shares is positive and at most the number of units
    for r in zone.select("county_prop_inpuma").collect():
        assert r[0] > 0


def test_cli_build(spark, tmp_path):
    from surveyfold.__main__ import main
    out = tmp_path / "cli"
    main(["--master", "local[2]", "build", "--sf-dir", SF_SMALL, "--out", str(out),
          "--format", "parquet", "--panel"])
    st = spark.read.parquet(str(out / "state_acs_data"))
    assert "year" in st.columns and st.select("year").distinct().count() >= 5
    assert (out / "labor_force_citizenship").exists()


@pytest.mark.parametrize("period", [(), ("year",)])
def test_single_pass_build_equals_products(spark, period):
    from surveyfold.operators.measures import POP
    ref = Survey.from_driver_tables(spark, SF_SMALL, period_keys=period)
    one = Survey.from_driver_tables(spark, SF_SMALL, period_keys=period).materialize(single_pass=True)

    def rows(df):
        return sorted((tuple((c, r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    assert rows(one.master()) == rows(ref.master())
    assert rows(one.labor_force_by_citizenship()) == rows(ref.labor_force_by_citizenship())
    assert rows(one.labor_force_by_birthplace()) == rows(ref.labor_force_by_birthplace())
    assert total(one.state(), POP) == total(ref.state(), POP)
