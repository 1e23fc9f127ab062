"""Published builds (S9, S3, S4, U2): a reader sees a build whole or not at all."""

import json
import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from surveyfold.operators import apportion as AP
from surveyfold.operators import joins as J
from surveyfold.operators import measures as M
from surveyfold.operators import rollup as R
from surveyfold.plans import analog
from surveyfold.plans import build as B
from surveyfold.plans.products import Survey, read_persons
from surveyfold.sources import codebook as CB
from surveyfold.sources import layout as LY
from surveyfold.sources import published as P
from surveyfold.streaming.panel import start_published_panel_stream

from conftest import SF_SMALL


def rows(df):
    return sorted(map(repr, df.collect()))


def frame(spark, *values):
    return spark.createDataFrame([(v, f"0{v}" if v else None) for v in values], "v int, code string")


# --- manifests -----------------------------------------------------------------

@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_parts_are_replaced_and_kept(spark, tmp_path, fmt):
    out = str(tmp_path)
    assert P.publish_frames(spark, out, {"a": frame(spark, 1, 2), "b": frame(spark, 9)}, "2018", fmt) == 1
    assert P.publish_frames(spark, out, {"a": frame(spark, 3)}, "2019", fmt) == 2
    assert P.publish_frames(spark, out, {"a": frame(spark, 4, 0)}, "2018", fmt) == 3
    assert rows(P.read_published(spark, out, "a")) == rows(spark.createDataFrame(
        [("2018", 4, "04"), ("2018", 0, None), ("2019", 3, "03")], "period string, v int, code string"))
    assert [r.v for r in P.read_published(spark, out, "b").collect()] == [9]
    assert sorted(r.v for r in P.read_published(spark, out, "a", version=1).collect()) == [1, 2]     # an old version stays
    panel = P.read_published_panel(spark, out, "a", [2018, 2019])
    assert panel.columns == ["year", "v", "code"] and panel.schema["year"].dataType.simpleString() == "int"
    with pytest.raises(FileNotFoundError):
        P.read_published_panel(spark, out, "a", [2018, 2020])
    with pytest.raises(FileNotFoundError):
        P.read_published(spark, out, "c")


def test_a_build_killed_half_way_shows_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    P.publish_frames(spark, out, {"a": frame(spark, 1), "b": frame(spark, 2)}, "x")
    write, written = P.write_table, []

    def dies(df, path, *args, **kwargs):
        if written:
            raise RuntimeError("killed")
        written.append(path)
        write(df, path, *args, **kwargs)
    monkeypatch.setattr(P, "write_table", dies)
    with pytest.raises(RuntimeError, match="killed"):
        P.publish_frames(spark, out, {"a": frame(spark, 7), "b": frame(spark, 8)}, "x")
    assert os.path.isdir(written[0])                              # its folder is there, and nobody reads it
    assert [P.read_published(spark, out, t).first().v for t in "ab"] == [1, 2] and P.versions(spark, out) == [1]


def test_writers_that_race_merge(spark, tmp_path, monkeypatch):
    out, put, others = str(tmp_path), P.Folder.put_new, []

    def late(self, text, folder, name):
        if not others:                                           # somebody else publishes the same version first
            others.append(1)
            path = f"{P.BUILDS}/other/b"
            frame(spark, 5).write.option("header", True).csv(f"{out}/{path}")
            entry = {"table": "b", "part": "x", "path": path, "format": "csv", "schema": frame(spark, 5).schema.json()}
            assert put(self, json.dumps({"version": 1, "entries": [entry]}), folder, name)
        return put(self, text, folder, name)
    monkeypatch.setattr(P.Folder, "put_new", late)
    assert P.publish_frames(spark, out, {"a": frame(spark, 1)}, "x") == 2
    assert [P.read_published(spark, out, t).first().v for t in "ab"] == [1, 5]
    assert sorted(os.listdir(f"{out}/{P.MANIFESTS}")) == sorted(
        n for v in (1, 2) for n in (f"{v:010d}.json", *[f for f in os.listdir(f"{out}/{P.MANIFESTS}") if f.endswith(".crc") and f"{v:010d}" in f]))


def test_vacuum_keeps_what_recent_versions_name(spark, tmp_path):
    out = str(tmp_path)
    for v in (1, 2, 3):
        P.publish_frames(spark, out, {"a": frame(spark, v)}, "x", build=f"b{v}")
    os.makedirs(f"{out}/{P.BUILDS}/dead")
    assert P.vacuum(spark, out, keep=2) == []                     # all too young
    assert sorted(P.vacuum(spark, out, keep=1, hours=-1)) == ["b1", "b2", "dead"]
    assert P.versions(spark, out) == [3] and P.read_published(spark, out, "a").first().v == 3


def test_published_tables_equal_the_products(spark, tmp_path):
    out = str(tmp_path)
    survey = Survey.from_driver_tables(spark, SF_SMALL)
    assert B.publish_tables(survey, out, "parquet", "YEAR") == 1
    plain = Survey.from_driver_tables(spark, SF_SMALL)
    for name, df in plain.tables().items():
        got = P.read_published(spark, out, name).drop("period")
        if "share" in "".join(df.columns):
            assert got.count() == df.count()
        else:
            assert rows(got.select(*df.columns)) == rows(df), name
    assert P.read_published(spark, out, "sample_description").count() == 1


# --- corrected years -------------------------------------------------------------

def deliver(tmp_path, number, year, *lines):
    folder = tmp_path / "in" / str(number)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"s_{year}.csv").write_text("k,v\n" + "".join(f"{x}\n" for x in lines))


def test_a_second_delivery_replaces_its_year_once(spark, tmp_path):
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run(checkpoint=ckpt):
        start_published_panel_stream(spark, str(tmp_path / "in"), "s", "k string, v int", out, checkpoint).awaitTermination()
        return sorted(tuple(r) for r in P.read_published_panel(spark, out, "s").collect())
    deliver(tmp_path, 1, 2018, "a,1", "b,NA")
    deliver(tmp_path, 1, 2019, "a,2")
    assert run() == [(2018, "a", 1), (2018, "b", None), (2019, "a", 2)]
    deliver(tmp_path, 3, 2018, "a,10")
    deliver(tmp_path, 3, 12018, "a,99")                           # not a year
    assert run() == [(2018, "a", 10), (2019, "a", 2)]
    deliver(tmp_path, 2, 2018, "a,5")                             # an older delivery, late
    version = max(P.versions(spark, out))
    assert run() == [(2018, "a", 10), (2019, "a", 2)] and max(P.versions(spark, out)) == version
    # progress lost after publishing: every file is read again, and nothing changes
    assert run(str(tmp_path / "ckpt2")) == [(2018, "a", 10), (2019, "a", 2)] and max(P.versions(spark, out)) == version
    deliver(tmp_path, 4, 2018, "a,x")
    with pytest.raises(Exception):
        run()
    assert [tuple(r) for r in P.read_published_panel(spark, out, "s", [2018]).collect()] == [(2018, "a", 10)]


# --- fixed-width extracts -----------------------------------------------------------

def test_layout_round_trip_with_nulls_and_labels(spark, tmp_path):
    df = spark.createDataFrame([(1, "0101", 12.5, -3), (20, None, None, None), (None, "9", 0.25, 1000)],
                               "STATEFIP int, OCC string, PERWT double, X long")
    layout = LY.layout_of(df, dcml={"PERWT": 2})
    assert [(f.name, f.start, f.width, f.dcml) for f in layout] == [("STATEFIP", 1, 2, 0), ("OCC", 3, 4, 0), ("PERWT", 7, 4, 2), ("X", 11, 4, 0)]
    LY.write_fixed_width(df, str(tmp_path / "x.dat"), layout)
    labels = spark.createDataFrame([("STATEFIP", 1, "Here"), ("STATEFIP", 20, "There")], "name string, value int, label string")
    LY.write_codebook(spark, str(tmp_path / "x.xml"), layout, labels, {"OCC": "Occupation"})
    variables, told = CB.read_codebook(spark, str(tmp_path / "x.xml"))
    assert rows(told) == rows(labels)
    assert {r.name: r.label for r in variables.collect()}["OCC"] == "Occupation"
    back = CB.read_fixed_width(spark, str(tmp_path / "x.dat"), variables, text_columns=("OCC",))
    assert sorted(map(repr, [(r.STATEFIP, r.OCC, None if r.PERWT is None else float(r.PERWT), r.X) for r in back.collect()])) == \
        sorted(map(repr, [tuple(r) for r in df.collect()]))


@pytest.mark.parametrize("value,kind,dcml", [("a ", "string", 0), ("", "string", 0), ("a\nb", "string", 0), (1.005, "double", 2), (1e40, "double", 2)])
def test_values_that_no_field_can_hold_fail(spark, tmp_path, value, kind, dcml):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    with pytest.raises(Exception):
        LY.write_fixed_width(df, str(tmp_path / "x"), [LY.Field("v", 1, 50, dcml)])


def test_a_value_wider_than_its_field_fails(spark, tmp_path):
    df = spark.createDataFrame([(123,)], "v int")
    with pytest.raises(Exception, match="wider than 2"):
        LY.write_fixed_width(df, str(tmp_path / "x"), [LY.Field("v", 3, 2)])
    with pytest.raises(ValueError, match="overlaps"):
        LY.write_fixed_width(df, str(tmp_path / "y"), [LY.Field("v", 1, 4), LY.Field("v", 4, 4)])
    LY.write_fixed_width(df, str(tmp_path / "z"), [LY.Field("v", 3, 4)])
    assert [r.value for r in spark.read.text(str(tmp_path / "z")).collect()] == ["   123"]


def test_persons_come_back_from_their_extract(spark, tmp_path):
    persons = analog.microdata_with_nulls(spark, SF_SMALL).where("PERWT IS NOT NULL")
    layout = LY.layout_of(persons, dcml={"PERWT": 2})
    LY.write_fixed_width(persons, str(tmp_path / "p.dat"), layout)
    LY.write_codebook(spark, str(tmp_path / "p.xml"), layout, analog.value_labels(spark, SF_SMALL))
    back, labels = read_persons(spark, str(tmp_path / "p.xml"), str(tmp_path / "p.dat"))
    assert rows(back.select(*persons.columns)) == rows(persons)
    assert rows(labels) == rows(analog.value_labels(spark, SF_SMALL))


# --- exact apportionment ---------------------------------------------------------------

def test_apportionment_knows_no_order_and_is_close_to_the_fraction(spark):
    rng = random.Random(1)
    pieces = [(u, z, rng.randrange(1, 5000)) for u in range(60) for z in range(7) if rng.random() < 0.6]
    unit_pop = {u: sum(p for a, _, p in pieces if a == u) for u, _, _ in pieces}
    zone_pop = {z: sum(p for _, b, p in pieces if b == z) for _, z, _ in pieces}
    xw = spark.createDataFrame([(str(u), z, float(p), float(unit_pop[u]), float(zone_pop[z]), p / zone_pop[z], p / unit_pop[u]) for u, z, p in pieces],
                               "stpuma string, cz90 int, pop double, pumapop double, czpop double, county_prop_incz double, county_prop_inpuma double")
    units = [(u, rng.randrange(10 ** 9) / 100, rng.randrange(1000)) for u in unit_pop]
    df = spark.createDataFrame([(str(u), m, c) for u, m, c in units], "stpuma string, civ double, count long")
    want = {z: (sum(Fraction(round(m * 100), 100) * p / unit_pop[u] for u, m, _ in units for a, b, p in pieces if a == u and b == z),
                sum(Fraction(p * p, zone_pop[z] * unit_pop[u]) for u, b, p in pieces if b == z)) for z in zone_pop}
    seen = set()
    for parts in (2, 64):
        got = AP.apportion_exact(df.repartition(parts), xw.repartition(parts), "stpuma", "cz90", ("civ", "count")).collect()
        seen.add(tuple(sorted(map(repr, got))))
        for r in got:
            assert r.civ == pytest.approx(float(want[r.cz90][0]), rel=1e-15, abs=1e-12)
            assert r.county_prop_incz == pytest.approx(float(want[r.cz90][1]), abs=1e-13)
    assert len(seen) == 1 and len(want) == 7


def test_finer_measures_raise_and_missing_units_drop(spark):
    xw = spark.createDataFrame([("1", 5, 2.0, 2.0, 2.0, 1.0, 1.0), ("2", 5, 0.0, 0.0, 2.0, 0.0, None)],
                               "stpuma string, cz90 int, pop double, pumapop double, czpop double, county_prop_incz double, county_prop_inpuma double")
    fine = spark.createDataFrame([("1", 1.25), ("2", 9.0), ("3", 4.0), (None, 1.0)], "stpuma string, civ double")
    assert [tuple(r) for r in AP.apportion_exact(fine, xw, "stpuma", "cz90", ("civ",)).collect()] == [(5, 1.25)]
    with pytest.raises(Exception, match="more than 2 decimals"):
        AP.apportion_exact(spark.createDataFrame([("1", 1.255)], "stpuma string, civ double"), xw, "stpuma", "cz90", ("civ",)).collect()


# --- one pass for all roll-ups --------------------------------------------------------

def test_lattice_levels_equal_the_roll_ups_with_null_keys(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), (None, "x", 4), (None, None, None), ("b", "y", 8)], "p string, q string, m int")
    sets = [["p"], ["q"], ["p", "q"]]
    lattice = R.rollup_lattice(df, sets, ["m"])
    for s in sets:
        assert rows(R.lattice_level(lattice, s, ["p", "q"])) == rows(R.rollup_sum(df, s, ["m"]))


def test_all_roll_ups_read_the_written_pass_and_the_cube_once(spark):
    survey = Survey.from_driver_tables(spark, SF_SMALL).materialize()
    lazy = survey.roll_up_once()
    plan = lazy._lattice._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan      # the cube, once, for eight tables
    survey._lattice = None
    survey.roll_up_once(write=True)
    for method in ("state", "state_occupation", "occupation", "state_sector", "sector"):
        plan = getattr(survey, method)()._jdf.queryExecution().executedPlan().toString()
        assert "rollups-" in plan and "master_cube-" not in plan and "Join" not in plan.replace("BroadcastHashJoin", "")
    survey.release()


# --- levels found in the data -----------------------------------------------------------

def test_levels_in_first_seen_order(spark):
    df = spark.createDataFrame([(3, "a"), (2, None), (2, "c"), (None, "z"), (1, "b"), (4, "b")], "k int, v string").repartition(4)
    assert M.levels_as_seen(df, "v", ["k"]) == ["b", "c", None, "a", "z"]
    with pytest.raises(ValueError, match="more than 4"):
        M.levels_as_seen(df, "v", ["k"], most=4)
    assert M.levels_as_seen(df.limit(0), "v", ["k"]) == []
    wide = M.pivot_as_seen(df, ["k"], "v", {"n": F.lit(1)}, ["k"], count_names=["n"])
    assert wide.columns == ["k", "n_b", "n_c", "n_na", "n_a", "n_z"]
    assert [r for r in wide.collect() if r.k == 2] == [(2, None, 1, 1, None, None)]


def test_merge_matches_missing_keys(spark):
    a = spark.createDataFrame([(1, "p"), (None, "q")], "k int, m string")
    b = spark.createDataFrame([(None, "u"), (2, "w")], "k int, n string")
    got = J.merge_indicator(a, b, ["k"])
    assert got.columns == ["k", "m", "n", "_merge"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, [(1, "p", None, 1), (None, "q", "u", 3), (2, None, "w", 2)]))
