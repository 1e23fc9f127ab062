"""Samples side by side, files read by name, one person set, no hidden state."""
import shutil

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from surveyfold.operators import joins as J
from surveyfold.plans import analog, registry
from surveyfold.plans.build import PANEL_TABLES, build_panels, build_tables
from surveyfold.plans.products import Survey, stack_panels, tag_period
from surveyfold.sources import files as FS
from surveyfold.streaming.panel import start_panel_stream

XWALK_HEADER = "statefip,puma,cz90,pop,pumapop,czpop,county_prop_incz,county_prop_inpuma"


def rows(df):
    return sorted(map(repr, (tuple((c, r[c]) for c in sorted(df.columns)) for r in df.collect())))


def one_year(spark, year):
    return Survey.from_driver_tables(spark, SF_SMALL).where_year(year)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_two_samples_in_one_folder_and_their_panels(spark, tmp_path, fmt):
    out, years = str(tmp_path / "out"), [1996, 1997]
    for y in years:
        build_tables(one_year(spark, y), out, fmt, year_col="YEAR", multi_year=False)
    for table in (*PANEL_TABLES, "puma_sector_soc_acs_data", "sample_description", "quality_conservation"):
        assert sorted(p.name for p in (tmp_path / "out" / table).iterdir() if p.is_dir()) == ["period=1996", "period=1997"]
    # a sample built again replaces its own period only
    before = {p.name for p in (tmp_path / "out" / "state_acs_data" / "period=1996").iterdir()}
    build_tables(one_year(spark, 1997), out, fmt, year_col="YEAR", multi_year=False)
    assert {p.name for p in (tmp_path / "out" / "state_acs_data" / "period=1996").iterdir()} == before
    assert "1996" in "".join(r[0] for r in spark.read.option("header", True).format(fmt).load(out + "/sample_description")
                             .select("sample_description").collect())
    build_panels(spark, out, str(tmp_path / "panels"), years, fmt)
    cube = Survey.from_driver_tables(spark, SF_SMALL, ("year",))
    want = cube.state().where(F.col("year").isin(years))
    got = (FS.read_built_panel(spark, out, "state_acs_data", years, cube.state().drop("year").schema, fmt))
    assert got.columns[0] == "year"
    drop = [c for c in got.columns if got.schema[c].dataType.typeName() == "double"]
    keys = [c for c in got.columns if c not in drop]
    assert rows(got.select(*keys)) == rows(want.select(*keys))
    both = got.join(want.select("year", "state_fips", *[F.col(c).alias(f"w_{c}") for c in drop]), ["year", "state_fips"])
    assert both.where(" OR ".join(f"abs({c} - w_{c}) > 1e-6" for c in drop)).count() == 0
    for table in PANEL_TABLES:
        years_found = {p.name for p in (tmp_path / "panels" / table).iterdir() if p.is_dir()}
        assert years_found == {"year=1996", "year=1997"}
    with pytest.raises(FileNotFoundError):
        build_panels(spark, out, str(tmp_path / "panels"), [1996, 1998], fmt)


def test_staged_tables_are_deleted(spark, tmp_path):
    survey = one_year(spark, 1996)
    build_tables(survey, str(tmp_path), "parquet", year_col="YEAR", multi_year=False)
    assert survey._staged == []
    kept = one_year(spark, 1996).materialize()
    path = kept._staged[0].staged_path
    assert kept.state().count() > 0
    kept.release()
    import os
    assert not os.path.exists(path)


def test_csv_columns_go_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(XWALK_HEADER.replace("county_prop_incz,county_prop_inpuma", "county_prop_inpuma,county_prop_incz")
                                    + "\n1,100,100,1,2,3,0.5,0.3\n")
    r = FS.read_crosswalk(spark, str(tmp_path / "a.csv")).first()
    assert (r.county_prop_incz, r.county_prop_inpuma) == (0.3, 0.5)
    for header in ("statefip,puma", XWALK_HEADER + ",more", XWALK_HEADER.replace("pop,", "people,", 1)):
        (tmp_path / "b.csv").write_text(header + "\n" + ",".join("1" * len(header.split(","))) + "\n")
        with pytest.raises(ValueError):
            FS.read_crosswalk(spark, str(tmp_path / "b.csv"))


def test_yearly_files_go_by_name(spark, tmp_path):
    (tmp_path / "t_2018.csv").write_text("a,b\n1,2\n")
    (tmp_path / "t_2019.csv").write_text("b,a\n4,3\n")
    got = FS.read_panel(spark, str(tmp_path), "t", "a int, b int")
    assert sorted(tuple(r) for r in got.collect()) == [(2018, 1, 2), (2019, 3, 4)]
    (tmp_path / "t_2020.csv").write_text("a\n1\n")
    with pytest.raises(ValueError):
        FS.read_panel(spark, str(tmp_path), "t", "a int, b int")
    (tmp_path / "t_2020.csv").write_text("a,b\n1,x\n")
    with pytest.raises(Exception):
        FS.read_panel(spark, str(tmp_path), "t", "a int, b int").collect()


def test_one_person_set_with_orphan_keys(spark, tmp_path):
    for t in analog.TABLE_SCHEMAS:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        (df.where("p_partkey > 20") if t == "part" else df).write.parquet(str(tmp_path / f"{t}.parquet"))
    plain = Survey.from_driver_tables(spark, str(tmp_path)).labor_force_by_birthplace()
    single = Survey.from_driver_tables(spark, str(tmp_path)).single_pass().labor_force_by_birthplace()
    assert rows(plain) == rows(single)
    whole = Survey.from_driver_tables(spark, SF_SMALL).labor_force_by_birthplace()
    assert rows(plain) != rows(whole)


def test_changed_input_gives_changed_output(spark, tmp_path):
    path = str(tmp_path / "customer.parquet")
    customers = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    customers.write.parquet(path)
    first = analog.crosswalk(spark, str(tmp_path)).agg(F.sum("pop")).first()[0]
    shutil.rmtree(path)
    customers.limit(50).write.parquet(path)
    second = analog.crosswalk(spark, str(tmp_path)).agg(F.sum("pop")).first()[0]
    assert (first, second) == (customers.count(), 50)


def test_making_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, query in registry.queries().items():
        if name in registry.STARTS_JOBS:
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        query(spark, SF_SMALL)
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_forced_broadcast_of_file_dimensions(spark, tmp_path):
    lines = "\n".join(f"{i % 56},{i},{100 + i % 700},1,1,1,1,1" for i in range(40_000))
    (tmp_path / "xw.csv").write_text(XWALK_HEADER + "\n" + lines + "\n")
    s = Survey.from_driver_tables(spark, SF_SMALL)
    s.dim_rows = None                    # as from_files leaves it
    s.crosswalk = FS.read_crosswalk(spark, str(tmp_path / "xw.csv"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        spark.conf.set("spark.sql.maxMetadataStringLength", "1000")      # a path is cut otherwise
        plan = s.zone()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    head = plan[:plan.index("xw.csv")]
    assert "SortMergeJoin" in head and "hint" not in plan.lower()
    for line in plan.splitlines():
        assert not ("BroadcastExchange" in line and "cz90" in line)


def test_null_keys_match(spark):
    a = spark.createDataFrame([(1,), (None,), (2,)], "k int")
    b = spark.createDataFrame([(None, "n"), (1, "x")], "k int, v string")
    assert rows(J.coverage(a, b, "k", "k")) == rows(spark.createDataFrame(
        [(None, True, True), (1, True, True), (2, True, False)], "key int, in_left boolean, in_right boolean"))
    assert [r.k for r in J.anti_keys(a, b, "k", "k").collect()] == [2]
    for joined in (J.natural_join(a, b, "inner"), J.title_join(a, b, "k")):
        assert sorted(r.v for r in joined.collect()) == ["n", "x"]
    assert sorted((r.v or "") for r in J.hierarchy_join(a, [(b, "k")]).collect()) == ["", "n", "x"]
    assert sorted((r.v or "") for r in J.context_join(a, b.withColumnRenamed("k", "c"), "k", "c").collect()) == ["", "n", "x"]


def test_a_new_output_of_the_stream_starts_from_the_first_file(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "s_2018.csv").write_text("k,v\na,1\n")
    for out in ("one", "two", "one"):
        start_panel_stream(spark, str(tmp_path / "src"), "s", "k string, v int", str(tmp_path / out)).awaitTermination(120)
    assert [spark.read.parquet(str(tmp_path / o)).count() for o in ("one", "two")] == [1, 1]
    (tmp_path / "src" / "s_2019.csv").write_text("k,v\na,x\n")
    with pytest.raises(Exception):
        start_panel_stream(spark, str(tmp_path / "src"), "s", "k string, v int", str(tmp_path / "one")).awaitTermination(120)


def test_yearly_tables_stack_to_the_panel(spark):
    years = analog.survey_years(spark, SF_SMALL)[:2]
    stacked = stack_panels([tag_period(one_year(spark, y).state(), y) for y in years])
    want = Survey.from_driver_tables(spark, SF_SMALL, ("year",)).state().where(F.col("year").isin(years))
    assert rows(stacked) == rows(want)
