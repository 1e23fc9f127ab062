"""Column handling (P2-P9), dimension readers (S5-S8), joins (J4-J11, X7),
pivot (A5), distinct (A12), group totals (W2, W3) and the unlisted-level check."""
from pyspark.sql import functions as F

from surveyfold.functions import columns as C
from surveyfold.operators import apportion as AP
from surveyfold.operators import joins as J
from surveyfold.operators import measures as M
from surveyfold.operators import rollup as R
from surveyfold.operators.quality import unlisted_levels
from surveyfold.sources import files as FS


def test_clean_names_and_selection(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "`Major Group` int, `minorGroup` int, ` ` int, `2x` int, `a` int")
    out = C.clean_names(df)
    assert out.columns == ["major_group", "minor_group", "x3", "x2x", "a"]
    df2 = spark.createDataFrame([(1,) * 6], "count int, civ_pop int, count_mx int, civ_pop_emp int, CIV_x int, y int")
    assert C.select_prefix(df2, "civ_pop", "count") == ["civ_pop", "civ_pop_emp", "count", "count_mx"]
    assert C.select_prefix(df2, "civ") == ["civ_pop", "civ_pop_emp", "CIV_x"]      # case ignored (N15)
    assert C.select_contains(df2, "MX", "emp") == ["count_mx", "civ_pop_emp"]
    assert C.keep_first(df2, 2).columns == ["count", "civ_pop"]
    assert C.move_first(df2, "y").columns[0] == "y"
    assert "total" in C.rename(df2, {"count": "total"}).columns


def test_mutate_chain_and_tag(spark):
    df = spark.createDataFrame([(1, "a")], "x int, s string")
    out = C.mutate(df, {"y": F.col("x") + 1}, {"z": F.col("y") * 10})
    out = C.mutate_at(out, ["x", "y"], lambda c: c * 2)
    out = C.tag(out, inpuma=True)
    r = out.first()
    assert (r.x, r.y, r.z, r.inpuma) == (2, 4, 20, True)


def test_dimension_readers(spark, tmp_path):
    (tmp_path / "xw.csv").write_text(
        "statefip,puma,cz90,pop,pumapop,czpop,county_prop_incz,county_prop_inpuma\n1,100,100,3,10,3,1,0.3\n")
    xw = FS.read_crosswalk(spark, str(tmp_path / "xw.csv")).first()
    assert xw.stpuma == "100100" and xw.county_prop_inpuma == 0.3
    (tmp_path / "c90.csv").write_text(
        "county_fips,ers90,out90,rep90,pop90,cbsa10,cbsa_name\n1001,100,1,1,5,NA,NA\n")
    c = FS.read_counties(spark, str(tmp_path / "c90.csv")).first()
    assert c.county_fips == "01001" and c.cbsa10 is None
    (tmp_path / "soc.csv").write_text(
        "major_group,minor_group,broad_group,detailed_occupation,title\n11-0000,NA,NA,NA,Management\n")
    assert FS.read_soc_structure(spark, str(tmp_path / "soc.csv")).first().minor_group is None
    (tmp_path / "sec.csv").write_text("naics_2d,sector,short_sector\n11,Agriculture,Agri\n")
    assert FS.read_sector_titles(spark, str(tmp_path / "sec.csv")).first().naics_2d == "11"


def test_natural_title_context_joins(spark):
    facts = spark.createDataFrame([(100, "111", 5.0), (200, "999", 1.0), (300, "111", 2.0)],
                                  "cz90 int, soc_minor string, m double")
    titles = spark.createDataFrame([("111", "Top")], "soc_minor string, title string")
    ctx = spark.createDataFrame([(100, "01")], "ers90 int, state_fips string")
    t = J.title_join(facts, titles, "soc_minor", 10)
    assert t.count() == 2                                   # J5 drops unknown codes
    c = J.context_join(t, ctx, "cz90", "ers90", 10)
    got = {r.cz90: r.state_fips for r in c.collect()}
    assert got == {100: "01", 300: None}                    # J4 keeps unmatched zones
    n = J.natural_join(facts, titles, "inner", 10)
    assert n.count() == 2 and set(n.columns) == {"cz90", "soc_minor", "m", "title"}


def test_null_safe_join_matches_nulls(spark):
    a = spark.createDataFrame([("k", None, 1), ("k", "x", 2)], "a string, b string, v int")
    b = spark.createDataFrame([("k", None, 10), ("k", "x", 20)], "a string, b string, w int")
    got = sorted((r.v, r.w) for r in J.null_safe_join(a, b, ["a", "b"]).collect())
    assert got == [(1, 10), (2, 20)]


def test_hierarchy_join(spark):
    det = spark.createDataFrame([("11-1011", "Chief", "11-0000")], "d string, t string, major_group string")
    major = spark.createDataFrame([("11-0000", "Management")], "major_group string, major_title string")
    out = J.hierarchy_join(det, [(major, "major_group")], 10).first()
    assert out.major_title == "Management"


def test_coverage_anti_merge(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k2 int")
    cov = {r.key: (r.in_left, r.in_right) for r in J.coverage(a, b, "k", "k2").collect()}
    assert cov == {1: (True, False), 2: (True, True), 3: (False, True)}
    assert [r.k for r in J.anti_keys(a, b, "k", "k2").collect()] == [1]
    m = J.merge_indicator(a.distinct(), b.withColumnRenamed("k2", "k"), ["k"])
    assert {r.k: r._merge for r in m.collect()} == {1: 1, 2: 3, 3: 2}


def test_decode_labels(spark):
    df = spark.createDataFrame([(0,), (2,), (9,), (None,)], "CITIZEN int")
    labels = spark.createDataFrame([("CITIZEN", 0, "N/A"), ("CITIZEN", 2, "Naturalized citizen"),
                                    ("OTHER", 9, "nine")], "name string, value int, label string")
    got = [r.lab for r in J.decode_labels(df, "CITIZEN", labels, "CITIZEN", "lab").orderBy(
        F.col("CITIZEN").asc_nulls_last()).collect()]
    assert got == ["N/A", "Naturalized citizen", "9", None]   # unlabelled -> value


def test_pivot_wider_names_and_missing(spark):
    df = spark.createDataFrame([("a", "Central America", 2.0), ("a", "Mexico", 3.0), ("b", "Mexico", 1.0)],
                               "k string, lvl string, w double")
    out = M.pivot_wider(df, ["k"], "lvl", {"emp": F.col("w"), "count": F.lit(1)},
                        ["Central America", "Mexico"], count_names=["count"])
    assert out.columns == ["k", "emp_central_america", "emp_mexico", "count_central_america", "count_mexico"]
    b = out.where("k = 'b'").first()
    assert b.emp_central_america is None and b.count_central_america is None and b.count_mexico == 1


def test_group_total_and_keep_last(spark):
    df = spark.createDataFrame([(1, 10.0, 1), (1, 5.0, 2), (2, 1.0, 1), (None, 4.0, 1)],
                               "cz int, v double, n int")
    tot = {(r.cz, r.n): r.t for r in AP.zone_group_total(df, "cz", "v", "t").collect()}
    assert tot == {(1, 1): 15.0, (1, 2): 15.0, (2, 1): 1.0, (None, 1): 4.0}
    last = {r.cz: (r.n, r.v) for r in R.keep_last(df, ["cz"], ["n"]).collect()}
    assert last == {1: (2, 5.0), 2: (1, 1.0), None: (1, 4.0)}


def test_distinct_and_unlisted(spark):
    df = spark.createDataFrame([("Local",), ("immigrant",), (None,), ("x",), ("Local",)], "s string")
    assert df.distinct().count() == 4                      # A12 keeps one NULL
    assert unlisted_levels(df, "s", ["Local", "immigrant"]).first()[0] == 2


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "k string, v double")
    got = {r.k: r.s for r in R.share_of_total(df, "v", "s").collect()}
    assert got == {"a": 0.25, "b": 0.75}
