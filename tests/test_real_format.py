"""End to end on the source's own input formats: codebook + fixed-width extract
+ CSV dimensions, with expected values worked out by hand."""
import pytest

from surveyfold.plans.products import Survey

LAYOUT = [("YEAR", 1, 4, 0), ("MULTYEAR", 5, 4, 0), ("STATEFIP", 9, 2, 0), ("COUNTYFIP", 11, 3, 0),
          ("PUMA", 14, 5, 0), ("GQ", 19, 1, 0), ("EMPSTAT", 20, 1, 0), ("EMPSTATD", 21, 2, 0),
          ("LABFORCE", 23, 1, 0), ("AGE", 24, 3, 0), ("CITIZEN", 27, 1, 0), ("BPL", 28, 3, 0),
          ("PERWT", 31, 10, 2), ("OCCSOC", 41, 6, 0), ("INDNAICS", 47, 4, 0)]
LABELS = {"STATEFIP": [("01", "Alabama"), ("02", "Alaska")],
          "CITIZEN": [("0", "N/A"), ("2", "Naturalized citizen"), ("3", "Not a citizen")]}
# YEAR MULTYEAR ST CTY PUMA GQ ES ESD LF AGE CIT BPL PERWT OCCSOC INDNAICS
PEOPLE = [
    ("2019", "2015", "01", "001", "00100", "1", "1", "10", "2", "030", "0", "001", "0000010000", "111021", "311M"),
    ("2019", "2016", "01", "001", "00100", "1", "1", "10", "2", "040", "2", "210", "0000005000", "151252", "4411"),
    ("2019", "2017", "01", "003", "00200", "1", "2", "20", "2", "025", "3", "200", "0000002000", "152031", "23  "),
    ("2019", "2019", "02", "001", "00100", "1", "3", "30", "1", "050", "0", "002", "0000003000", "311120", "3S  "),
    ("2019", "2015", "02", "001", "00100", "3", "1", "10", "2", "030", "0", "002", "0000009900", "111021", "311M"),
    ("2019", "2015", "02", "001", "00100", "1", "1", "14", "2", "030", "0", "002", "0000009900", "111021", "311M"),
    ("2019", "2015", "02", "001", "00100", "1", "1", "10", "2", "070", "0", "002", "0000009900", "111021", "311M"),
]


def _codebook():
    out = ['<?xml version="1.0" encoding="UTF-8"?>', "<codeBook><dataDscr>"]
    for name, start, width, dcml in LAYOUT:
        cats = "".join(f"<catgry><catValu>{v}</catValu><labl>{lab}</labl></catgry>"
                       for v, lab in LABELS.get(name, []))
        out.append(f'<var ID="{name}" name="{name}" dcml="{dcml}"><location StartPos="{start}" '
                   f'EndPos="{start + width - 1}" width="{width}"/><labl>{name}</labl>{cats}</var>')
    out.append("</dataDscr></codeBook>")
    return "\n".join(out)


@pytest.fixture(scope="module")
def survey(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("extract")
    (d / "x.xml").write_text(_codebook())
    (d / "x.dat").write_text("\n".join("".join(p) for p in PEOPLE) + "\n")
    (d / "xw.csv").write_text(
        "statefip,puma,cz90,pop,pumapop,czpop,county_prop_incz,county_prop_inpuma\n"
        "1,100,100,5,10,5,1,0.5\n1,100,200,5,10,7,0.7142857,0.5\n1,200,200,2,2,7,0.2857143,1\n"
        "2,100,300,4,4,4,1,1\n")
    (d / "ctx.csv").write_text(
        "ers90,state_fips,state_abbv,states_count,states_abbv,cbsa10,cbsa_name\n"
        "100,01,AL,1,AL,NA,NA\n200,01,AL,1,AL,10000,\"X, AL\"\n300,02,AK,1,AK,NA,NA\n")
    (d / "soc.csv").write_text(
        "major_group,minor_group,broad_group,detailed_occupation,title\n"
        "11-0000,NA,NA,NA,Management Occupations\nNA,11-1000,NA,NA,Top Executives\n"
        "NA,15-1200,NA,NA,Computer Occupations\nNA,15-2000,NA,NA,Mathematical Science Occupations\n"
        "NA,31-1100,NA,NA,Home Health Aides\n")
    (d / "sec.csv").write_text("naics_2d,sector,short_sector\n23,Construction,Construction\n"
                               "31,Manufacturing,Manufacturing\n44,Retail Trade,Retail\n")
    return Survey.from_files(spark, str(d / "x.xml"), str(d / "x.dat"), str(d / "xw.csv"),
                             str(d / "ctx.csv"), str(d / "soc.csv"), str(d / "sec.csv"))


def test_state_table(survey):
    st = {r.state: r.asDict() for r in survey.state().collect()}
    al, ak = st["Alabama"], st["Alaska"]
    assert al["state_fips"] == "01"
    assert (al["civ_noninst_pop"], al["civ_noninst_pop_employed"], al["civ_noninst_labforce"]) == (170, 150, 170)
    assert (al["civ_noninst_pop_local"], al["civ_noninst_pop_immigrant"]) == (100, 70)
    assert (al["civ_noninst_pop_employed_central_america"], al["civ_noninst_labforce_mexico"]) == (50, 20)
    assert (al["count"], al["count_immigrant"], al["count_mexico"], al["count_south_america"]) == (3, 2, 1, 0)
    assert al["EPOP"] == 150 / 170 * 100
    assert (ak["civ_noninst_pop"], ak["civ_noninst_pop_employed"], ak["count"], ak["EPOP"]) == (30, 0, 1, 0.0)


def test_zone_table(survey):
    z = {r.cz90: r for r in survey.zone().collect()}
    assert {k: round(v.civ_noninst_pop, 9) for k, v in z.items()} == {100: 75.0, 200: 95.0, 300: 30.0}
    assert z[200].cbsa_name == "X, AL" and z[100].cbsa10 is None


def test_occupation_and_sector(survey):
    occ = {r.soc_minor: (r.civ_noninst_pop_employed, r["count"], r.title) for r in survey.occupation().collect()}
    assert occ == {"111": (100, 1, "Top Executives"), "1512": (50, 1, "Computer Occupations"),
                   "152": (0, 1, "Mathematical Science Occupations"), "3111": (0, 1, "Home Health Aides")}
    sec = {r.naics_2d: r.civ_noninst_pop_employed for r in survey.sector().collect()}
    assert sec == {"31": 100, "44": 50, "23": 0}           # 3S has no title


def test_labor_force_tables_use_all_persons(survey):
    t10 = {r.citizenship: r.labor_force for r in survey.labor_force_by_citizenship().collect()}
    # unfiltered (Q5): the three dropped persons count too
    assert t10 == {"Not foreign born": 100 + 99 * 3, "Naturalized citizen": 50, "Not a citizen": 20,
                   "total": 100 + 99 * 3 + 70}


def test_gzipped_extract_staged(spark, tmp_path):
    import gzip
    d = tmp_path
    (d / "x.xml").write_text(_codebook())
    with gzip.open(d / "x.dat.gz", "wt") as f:
        f.write("\n".join("".join(p) for p in PEOPLE) + "\n")
    for name, body in (("xw.csv", "statefip,puma,cz90,pop,pumapop,czpop,county_prop_incz,county_prop_inpuma\n"),
                       ("ctx.csv", "ers90,state_fips,state_abbv,states_count,states_abbv,cbsa10,cbsa_name\n"),
                       ("soc.csv", "major_group,minor_group,broad_group,detailed_occupation,title\n"),
                       ("sec.csv", "naics_2d,sector,short_sector\n")):
        (d / name).write_text(body)
    s = Survey.from_files(spark, str(d / "x.xml"), str(d / "x.dat.gz"), str(d / "xw.csv"),
                          str(d / "ctx.csv"), str(d / "soc.csv"), str(d / "sec.csv"),
                          stage_microdata=True, stage_partitions=3)
    st = {r.state: r.civ_noninst_pop for r in s.state().collect()}
    assert st == {"Alabama": 170, "Alaska": 30}


def test_cli_files_and_panel(spark, tmp_path):
    from surveyfold.__main__ import main
    d = tmp_path
    (d / "x.xml").write_text(_codebook())
    (d / "x.dat").write_text("\n".join("".join(p) for p in PEOPLE) + "\n")
    (d / "xw.csv").write_text("statefip,puma,cz90,pop,pumapop,czpop,county_prop_incz,county_prop_inpuma\n"
                              "1,100,100,1,1,1,1,1\n1,200,100,1,1,1,1,1\n2,100,300,1,1,1,1,1\n")
    (d / "ctx.csv").write_text("ers90,state_fips,state_abbv,states_count,states_abbv,cbsa10,cbsa_name\n"
                               "100,01,AL,1,AL,NA,NA\n300,02,AK,1,AK,NA,NA\n")
    (d / "soc.csv").write_text("major_group,minor_group,broad_group,detailed_occupation,title\n"
                               "NA,11-1000,NA,NA,Top Executives\n")
    (d / "sec.csv").write_text("naics_2d,sector,short_sector\n31,Manufacturing,Manufacturing\n")
    out = d / "out"
    main(["--master", "local[2]", "files", "--codebook", str(d / "x.xml"), "--extract", str(d / "x.dat"),
          "--crosswalk", str(d / "xw.csv"), "--zone-context", str(d / "ctx.csv"),
          "--soc-structure", str(d / "soc.csv"), "--sector-titles", str(d / "sec.csv"),
          "--out", str(out), "--format", "csv"])
    parts = sorted(p.name for p in (out / "state_acs_data").iterdir() if p.name.startswith("period="))
    assert parts == ["period=2015_2019"]                 # MULTYEAR first_last (S10)
    zone = spark.read.option("header", True).csv(str(out / "cz_acs_data" / parts[0]))
    assert sorted(r.cz90 for r in zone.collect()) == ["100", "300"]
    # panel: stack per-year state files by name
    for year in (2018, 2019):
        (d / f"state_acs_data_{year}.csv").write_text("state_fips,count\n01,3\n" if year == 2018 else "count,state_fips\n3,01\n")
    main(["--master", "local[2]", "panel", "--dir", str(d), "--table", "state_acs_data",
          "--schema", "state_fips string, count int", "--out", str(d / "panel")])
    panel = spark.read.option("header", True).csv(str(d / "panel"))
    assert sorted((r.year, r.state_fips) for r in panel.collect()) == [("2018", "01"), ("2019", "01")]
