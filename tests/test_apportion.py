"""A11, A13, A17-A19, T15 on the literal fixtures."""

from surveyfold.operators import apportion as AP
from surveyfold.operators.quality import conservation


def test_crosswalk_shares(spark):
    pieces = spark.createDataFrame([("u1", "A", 3.0), ("u1", "B", 7.0), ("u2", "B", 5.0)],
                                   "unit string, zone string, pop double")
    xw = {(r.unit, r.zone): (r.county_prop_inpuma, r.county_prop_incz)
          for r in AP.build_crosswalk(pieces, ["unit"], "zone").collect()}
    assert xw[("u1", "A")] == (0.3, 1.0)
    assert xw[("u1", "B")] == (0.7, 7 / 12)
    assert xw[("u2", "B")] == (1.0, 5 / 12)


def test_apportion_and_conservation(spark):
    units = spark.createDataFrame([("u1", 100.0), ("u2", 50.0), ("u3", 9.0)], "stpuma string, m double")
    xw = spark.createDataFrame([("u1", "A", 0.3), ("u1", "B", 0.7), ("u2", "B", 1.0)],
                               "stpuma string, cz90 string, county_prop_inpuma double")
    out = AP.apportion(units, xw, "stpuma", "cz90", ["m"])
    got = {r.cz90: round(r.m, 9) for r in out.collect()}
    assert got == {"A": 30.0, "B": 120.0}
    chk = conservation("zone", units, out, "m").first()
    assert chk.before == 159.0 and round(chk.after, 9) == 150.0 and round(chk.diff, 9) == -9.0


def test_main_state_and_states(spark):
    pieces = spark.createDataFrame(
        [(1, "51", "VA", 60.0), (1, "37", "NC", 40.0), (2, "51", "VA", 50.0), (2, "37", "NC", 50.0)],
        "cz int, st string, abbv string, pop double")
    main = {r.cz: r.st for r in AP.main_state(pieces, "cz", "st", "pop").collect()}
    assert main == {1: "51", 2: "37"}          # tie goes to the smaller state code
    lst = {r.cz: (r.states_count, r.states_abbv)
           for r in AP.zone_states(pieces.union(pieces), "cz", "abbv").collect()}
    assert lst[1] == (2, "NC; VA")


def test_stata_recipe_keeps_unmatched(spark):
    units = spark.createDataFrame([(1, 1, 10.0), (1, 2, 4.0)], "statefip int, puma int, v double")
    xw = spark.createDataFrame([(1, 1, 100, 0.5), (1, 1, 200, 0.5)],
                               "statefip int, puma int, cz90 int, county_prop_inpuma double")
    out = {r.cz90: (r.cz_v, r.natl_v) for r in
           AP.apportion_stata(units, xw, ["statefip", "puma"], "cz90", "v").collect()}
    assert out == {100: (5.0, 10.0), 200: (5.0, 10.0), None: (0.0, 10.0)}
