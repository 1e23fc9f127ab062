"""Sources, sinks and panel stacking on files the test writes."""
import pytest
from pyspark.sql import functions as F

from surveyfold.plans.products import stack_panels, tag_period
from surveyfold.sources import codebook as CB
from surveyfold.sources import files as FS

DDI = """<?xml version="1.0" encoding="UTF-8"?>
<codeBook><dataDscr>
<var ID="YEAR" name="YEAR" dcml="0"><location StartPos="1" EndPos="4" width="4"/><labl>Census year</labl></var>
<var ID="STATEFIP" name="STATEFIP" dcml="0"><location StartPos="5" EndPos="6" width="2"/><labl>State</labl>
  <catgry><catValu>01</catValu><labl>Alabama</labl></catgry>
  <catgry><catValu>02</catValu><labl>Alaska</labl></catgry></var>
<var ID="PERWT" name="PERWT" dcml="2"><location StartPos="7" EndPos="16" width="10"/><labl>Person weight</labl></var>
<var ID="OCCSOC" name="OCCSOC" dcml="0"><location StartPos="17" EndPos="22" width="6"/><labl>Occupation</labl></var>
</dataDscr></codeBook>
"""
DAT = ["201901000001250015125X", "2019020000010000      ", "201801          111021"]


def test_codebook_and_fixed_width(spark, tmp_path):
    (tmp_path / "x.xml").write_text(DDI)
    (tmp_path / "x.dat").write_text("\n".join(DAT) + "\n")
    variables, labels = CB.read_codebook(spark, str(tmp_path / "x.xml"))
    v = {r.name: (r.start, r.width, r.dcml) for r in variables.collect()}
    assert v == {"YEAR": (1, 4, 0), "STATEFIP": (5, 2, 0), "PERWT": (7, 10, 2), "OCCSOC": (17, 6, 0)}
    lab = {(r.name, r.value): r.label for r in labels.collect()}
    assert lab == {("STATEFIP", 1): "Alabama", ("STATEFIP", 2): "Alaska"}
    df = CB.read_fixed_width(spark, str(tmp_path / "x.dat"), variables, text_columns=("OCCSOC",))
    rows = [(r.YEAR, r.STATEFIP, None if r.PERWT is None else float(r.PERWT), r.OCCSOC) for r in df.collect()]
    assert rows == [(2019, 1, 125.0, "15125X"), (2019, 2, 100.0, None), (2018, 1, None, "111021")]


def test_csv_keeps_codes_and_na(spark, tmp_path):
    p = tmp_path / "ctx.csv"
    p.write_text("ers90,state_fips,state_abbv,states_count,states_abbv,cbsa10,cbsa_name\n"
                 "100,01,AL,1,AL,NA,NA\n200,47,TN,2,TN; VA,28700,\"K, TN\"\n")
    rows = FS.read_zone_context(spark, str(p)).orderBy("ers90").collect()
    assert rows[0].state_fips == "01" and rows[0].cbsa10 is None
    assert rows[1].cbsa_name == "K, TN"


def test_panel_glob_and_year(spark, tmp_path):
    for name in ("x_2018.csv", "x_2019.csv", "x_2015_2019.csv", "cz_x_2019.csv"):
        (tmp_path / name).write_text("k,v\na,1\n")
    df = FS.read_panel(spark, str(tmp_path), "x", "k string, v int")
    assert df.columns == ["year", "k", "v"]
    assert sorted(r.year for r in df.collect()) == [2018, 2019]
    FS.read_panel(spark, str(tmp_path), "x", "k string, v int", expected_years=[2018, 2019])
    with pytest.raises(FileNotFoundError):
        FS.read_panel(spark, str(tmp_path), "x", "k string, v int", expected_years=range(2017, 2020))


def test_stack_by_name(spark):
    a = spark.createDataFrame([(1, "a")], "v int, k string")
    b = spark.createDataFrame([("b", 2)], "k string, v int")
    out = stack_panels([tag_period(a, 2018), tag_period(b, 2019)])
    assert out.columns[0] == "year"
    assert sorted((r.year, r.k, r.v) for r in out.collect()) == [(2018, "a", 1), (2019, "b", 2)]
    c = spark.createDataFrame([("c",)], "k string")
    with pytest.raises(Exception):
        stack_panels([a, c]).collect()


def test_csv_sink_writes_na(spark, tmp_path):
    df = spark.createDataFrame([("01", None, 2019)], "s string, v double, year int")
    FS.write_table(df, str(tmp_path / "out"), partition_by=["year"])
    text = "".join(p.read_text() for p in (tmp_path / "out" / "year=2019").glob("*.csv"))
    assert "01,NA" in text


def test_period_tag(spark):
    df = spark.createDataFrame([(2017,), (2015,), (2019,), (2015,)], "MULTYEAR int")
    r = FS.period_tag(df).first()
    assert r.first_last_year == "2015_2019"
    assert r.sample_description == "Based in ACS samples from 2015, 2017, 2019"
    r1 = FS.period_tag(df.where(F.col("MULTYEAR") == 2017), multi_year=False).first()
    assert r1.first_last_year == "2017"


def test_codebook_without_decimals_and_labels(spark, tmp_path):
    (tmp_path / "c.xml").write_text('<codeBook><dataDscr><var name="AGE"><location StartPos="2" width="3"/></var>'
                                    '<var name="SEX"><location StartPos="1" width="1"/></var></dataDscr></codeBook>')
    variables, labels = CB.read_codebook(spark, str(tmp_path / "c.xml"))
    assert sorted((r.name, r.start, r.width, r.dcml, r.label) for r in variables.collect()) == [
        ("AGE", 2, 3, 0, None), ("SEX", 1, 1, 0, None)]
    assert labels.count() == 0


def test_codebook_namespace_and_single_category(spark, tmp_path):
    xml = ('<?xml version="1.0"?><codeBook xmlns="ddi:codebook:2_5" version="2.5"><dataDscr>'
           '<var ID="SEX" name="SEX" dcml="0" files="F1"><location StartPos="1" EndPos="1" width="1"/>'
           '<labl>Sex</labl><varFormat type="numeric"/><catgry><catValu>1</catValu><labl>Male</labl>'
           '</catgry></var><var ID="AGE" name="AGE" dcml="0"><location StartPos="2" EndPos="4" '
           'width="3"/><labl>Age</labl></var></dataDscr></codeBook>')
    (tmp_path / "c.xml").write_text(xml)
    variables, labels = CB.read_codebook(spark, str(tmp_path / "c.xml"))
    assert {r.name: (r.start, r.width) for r in variables.collect()} == {"SEX": (1, 1), "AGE": (2, 3)}
    assert [(r.name, r.value, r.label) for r in labels.collect()] == [("SEX", 1, "Male")]
