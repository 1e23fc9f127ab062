"""Property tests (hypothesis) for the cube and apportionment invariants,
on random person rows that include NULL keys, codes and weights."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from surveyfold.operators import apportion as AP
from surveyfold.operators import measures as M
from test_measures import SCHEMA, join_form

person = st.tuples(
    st.sampled_from(["100", "200", None]),                 # stpuma
    st.sampled_from(["111", "1512", None]),                # soc_minor
    st.sampled_from(["31", "44", None]),                   # naics_2d
    st.sampled_from([1, 2]),                               # STATEFIP
    st.one_of(st.integers(1, 50).map(float), st.none()),   # PERWT
    st.sampled_from([1, 2, 3, None]),                      # EMPSTAT
    st.sampled_from([1, 2, None]),                         # LABFORCE
    st.sampled_from([0, 1, 2, 3, 4, 5, None]),             # CITIZEN
    st.sampled_from([1, 120, 150, 200, 210, 300, 450, 515, 600, 700, None]),  # BPL
)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _rows(df, cols):
    def key(r):
        return tuple((v is None, str(v)) for v in r)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=key)


@SETTINGS
@given(st.lists(person, min_size=1, max_size=25))
def test_fused_cube_equals_join_form(spark, rows):
    p = M.prepare_persons(spark.createDataFrame(rows, SCHEMA))
    # compare on rows whose status/origin are defined; strict NA handled by both forms
    p = p.where(F.col("foreign_born").isNotNull() & F.col("PERWT").isNotNull()
                & F.col("EMPSTAT").isNotNull() & F.col("LABFORCE").isNotNull())
    if p.count() == 0:
        return
    ref = join_form(p)
    assert _rows(M.master_cube(p), ref.columns) == _rows(ref, ref.columns)


@SETTINGS
@given(st.lists(person, min_size=1, max_size=25))
def test_status_levels_add_up(spark, rows):
    cube = M.master_cube(M.prepare_persons(spark.createDataFrame(rows, SCHEMA)))
    for r in cube.collect():
        for m in (M.POP, M.EMP, M.LF):
            parts = [r[f"{m}_local"], r[f"{m}_immigrant"]]
            if r[m] is None or any(v is None for v in parts):
                continue          # an NA cell (R semantics) or a level without rows
            assert r[m] >= parts[0] + parts[1] - 1e-9
        n_parts = [r["count_local"] or 0, r["count_immigrant"] or 0]
        assert sum(n_parts) <= r[M.N]


@SETTINGS
@given(st.dictionaries(st.sampled_from(["u1", "u2", "u3", "u4"]), st.integers(1, 1000), min_size=1),
       st.data())
def test_apportion_conserves_when_shares_sum_to_one(spark, units, data):
    xw_rows = []
    for u in units:
        zones = data.draw(st.lists(st.sampled_from(["A", "B", "C"]), min_size=1, max_size=3, unique=True))
        weights = data.draw(st.lists(st.integers(1, 9), min_size=len(zones), max_size=len(zones)))
        tot = sum(weights)
        xw_rows += [(u, z, w / tot) for z, w in zip(zones, weights)]
    unit_df = spark.createDataFrame([(u, float(v)) for u, v in units.items()], "stpuma string, m double")
    xw = spark.createDataFrame(xw_rows, "stpuma string, cz90 string, county_prop_inpuma double")
    out = AP.apportion(unit_df, xw, "stpuma", "cz90", ["m"])
    assert abs(out.agg(F.sum("m")).first()[0] - sum(units.values())) < 1e-6


MICRO_SCHEMA = ("YEAR int, MULTYEAR int, STATEFIP int, COUNTYFIP int, PUMA int, GQ int, EMPSTAT int, "
                "EMPSTATD int, LABFORCE int, AGE int, CITIZEN int, BPL int, PERWT double, "
                "OCCSOC string, INDNAICS string")
micro_row = st.tuples(
    st.just(2019), st.just(2019), st.sampled_from([1, 2, None]), st.just(1),
    st.sampled_from([100, 200, None]), st.sampled_from([1, 3, None]), st.sampled_from([1, 2, 3, None]),
    st.sampled_from([10, 14, None]), st.sampled_from([1, 2, None]), st.sampled_from([15, 30, 64, None]),
    st.sampled_from([0, 2, 3, None]), st.sampled_from([1, 200, 210, 300, 450, None]),
    st.one_of(st.integers(1, 50).map(float), st.none()),
    st.sampled_from(["111021", "151252", None]), st.sampled_from(["311M", "4411", "3S", None]))


@SETTINGS
@given(st.lists(micro_row, min_size=1, max_size=20))
def test_single_pass_equals_products(spark, rows):
    from surveyfold.plans.products import Survey
    labels = spark.createDataFrame([("STATEFIP", 1, "Alabama"), ("CITIZEN", 0, "N/A"),
                                    ("CITIZEN", 2, "Naturalized citizen")],
                                   "name string, value int, label string")
    micro = spark.createDataFrame(rows, MICRO_SCHEMA)

    def survey():
        return Survey(spark, micro, labels, None, None, None, None)

    def as_rows(df):
        return sorted((tuple((c, r[c]) for c in sorted(df.columns)) for r in df.collect()), key=repr)
    ref, one = survey(), survey().materialize(single_pass=True)
    assert as_rows(one.master()) == as_rows(ref.master())
    assert as_rows(one.labor_force_by_citizenship()) == as_rows(ref.labor_force_by_citizenship())
    assert as_rows(one.labor_force_by_birthplace()) == as_rows(ref.labor_force_by_birthplace())
    assert as_rows(one.unlisted_levels()) == as_rows(ref.unlisted_levels())


LF_LABELS = {0: "N/A", 2: "Naturalized citizen", 3: "Not a citizen"}
lf_row = st.tuples(st.sampled_from([0, 2, 3, 5, None]),                 # CITIZEN (5 unlabelled)
                   st.sampled_from([1, 2, None]),                       # LABFORCE
                   st.one_of(st.integers(1, 9).map(float), st.none()),  # PERWT
                   st.sampled_from([1, 150, 200, 210, 300, None]))      # BPL


def _r_labor_tables(rows):
    """Brute-force model of the source's two labour-force tables (R NA rules)."""
    def label(c):
        if c is None:
            return None
        lab = LF_LABELS.get(c, str(c))
        return "Not foreign born" if lab == "N/A" else lab

    def bpl_ii(b):
        if b is not None and b <= 120:
            return "us_and_us_possessions"
        return {210: "central_america", 200: "mexico", 300: "south_america"}.get(b, "others")

    def term(lfc, w):       # PERWT * (LABFORCE == 2), NA if either is NA
        return None if lfc is None or w is None else w * (1.0 if lfc == 2 else 0.0)

    def rsum(xs):           # sum without na.rm
        return None if any(x is None for x in xs) else float(sum(xs))
    groups, cells = {}, {}
    for cit, lfc, w, b in rows:
        groups.setdefault(label(cit), []).append(term(lfc, w))
        cells.setdefault((label(cit), bpl_ii(b)), []).append(term(lfc, w))
    t10 = {k: rsum(v) for k, v in groups.items()}
    total = rsum(list(t10.values()))
    def share(a, b):        # x / 0 is NULL here (R: NaN; blueprint N10)
        return None if a is None or b is None or b == 0 else a / b
    t10_rows = {k: (v, share(v, total)) for k, v in t10.items()}
    t10_rows["total"] = (total, share(total, total))
    names = ["central_america", "mexico", "others", "south_america", "us_and_us_possessions"]
    t11 = {g: {n: (rsum(cells[(g, n)]) if (g, n) in cells else None) for n in names} for g in groups}
    t11["total"] = {n: (float(sum(r[n] for r in t11.values() if r[n] is not None))
                        if n != "others" else None) for n in names}
    return t10_rows, t11


@SETTINGS
@given(st.lists(lf_row, min_size=1, max_size=25))
def test_labor_force_tables_match_r_model(spark, rows):
    from surveyfold.plans.products import Survey
    labels = spark.createDataFrame([("CITIZEN", k, v) for k, v in LF_LABELS.items()],
                                   "name string, value int, label string")
    micro = spark.createDataFrame(rows, "CITIZEN int, LABFORCE int, PERWT double, BPL int")
    s = Survey(spark, micro, labels, None, None, None, None)
    want10, want11 = _r_labor_tables(rows)
    got10 = {r.citizenship if not r.is_total else "total": (r.labor_force, r.labor_force_share)
             for r in s.labor_force_by_citizenship().collect()}
    assert got10 == want10
    got11 = {r.citizenship if not r.is_total else "total":
             {n: r[n] for n in want11["total"]} for r in s.labor_force_by_birthplace().collect()}
    assert got11 == want11


cube_row = st.tuples(
    st.just(2019), st.just(2019), st.sampled_from([1, 2]), st.just(1), st.sampled_from([100, 200]),
    st.sampled_from([1, 3, None]), st.sampled_from([1, 2, 3, None]), st.sampled_from([10, 14, None]),
    st.sampled_from([1, 2, None]), st.sampled_from([15, 30, 64, None]), st.sampled_from([0, 2, 3, None]),
    st.sampled_from([1, 200, 210, 300, 450, None]), st.one_of(st.integers(1, 50).map(float), st.none()),
    st.sampled_from(["111021", "151252", None]), st.sampled_from(["311M", "4411", None]))


def _r_cube_and_state(rows):
    """Brute-force model of the source's master cube and state table (R NA rules)."""
    def in_universe(r):
        gq, esd, age = r[5], r[7], r[9]
        return (esd is not None and esd not in (13, 14, 15) and gq is not None and gq != 3
                and age is not None and 16 <= age <= 64)

    def ifelse(c, a, b):
        return None if c is None else (a if c else b)

    def mul(a, b):
        return None if a is None or b is None else a * b

    def rsum(xs):
        return None if any(x is None for x in xs) else float(sum(xs))

    cube = {}
    for r in filter(in_universe, rows):
        st_, puma, occ, ind = r[2], r[4], r[13], r[14]
        stpuma = str(int(f"{st_:03d}{puma:05d}"))
        soc = None if occ is None else (occ[:4] if occ[:4] in ("1512", "3111", "5151") else occ[:3])
        s2 = None if ind is None else ind[:2]
        naics = None if s2 is None else ("31" if "30" <= s2 <= "33" else "44" if "44" <= s2 <= "45"
                                         else "48" if "48" <= s2 <= "49" else s2)
        emp, lf = ifelse(None if r[6] is None else r[6] == 1, 1, 0), ifelse(None if r[8] is None else r[8] == 2, 1, 0)
        imm = r[10] in (2, 3, 4, 5)
        bpl, w = r[11], r[12]
        big = None if bpl is None else bpl > 120
        status_c = (False if big is False or not imm else (None if big is None else True))
        status = None if status_c is None else ("immigrant" if status_c else "Local")
        origin = ("Central America" if bpl == 210 and imm else "Mexico" if bpl == 200 and imm
                  else "South America" if bpl == 300 and imm else "other")
        g = cube.setdefault((stpuma, soc, naics), {"state": st_, "rows": []})
        g["rows"].append((w, mul(emp, w), mul(lf, w), status, origin))
    measures = {}
    for key, g in cube.items():
        rs = g["rows"]
        m = {"state_code": g["state"], "civ_noninst_pop": rsum([x[0] for x in rs]),
             "civ_noninst_pop_employed": rsum([x[1] for x in rs]),
             "civ_noninst_labforce": rsum([x[2] for x in rs]), "count": len(rs)}
        for lvl, suf in (("Local", "local"), ("immigrant", "immigrant")):
            sub = [x for x in rs if x[3] == lvl]
            for i, name in ((0, "civ_noninst_pop"), (1, "civ_noninst_pop_employed"), (2, "civ_noninst_labforce")):
                m[f"{name}_{suf}"] = rsum([x[i] for x in sub]) if sub else None
            m[f"count_{suf}"] = len(sub) if sub else None
        for lvl, suf in (("Central America", "central_america"), ("South America", "south_america"),
                         ("Mexico", "mexico")):
            sub = [x for x in rs if x[4] == lvl]
            for i, name in ((1, "civ_noninst_pop_employed"), (2, "civ_noninst_labforce")):
                m[f"{name}_{suf}"] = rsum([x[i] for x in sub]) if sub else None
            m[f"count_{suf}"] = len(sub) if sub else None
        measures[key] = m
    state = {}
    for m in measures.values():
        acc = state.setdefault(f"{m['state_code']:02d}", {})
        for k, v in m.items():
            if k != "state_code":
                acc[k] = acc.get(k, 0) + (v or 0)        # sum(., na.rm = TRUE)
    for acc in state.values():
        pop, emp = acc["civ_noninst_pop"], acc["civ_noninst_pop_employed"]
        acc["EPOP"] = None if pop == 0 else emp / pop * 100
    return measures, state


@SETTINGS
@given(st.lists(cube_row, min_size=1, max_size=25))
def test_cube_and_state_match_r_model(spark, rows):
    from surveyfold.plans.products import Survey
    labels = spark.createDataFrame([("STATEFIP", 1, "Alabama"), ("STATEFIP", 2, "Alaska")],
                                   "name string, value int, label string")
    micro = spark.createDataFrame(rows, MICRO_SCHEMA)
    s = Survey(spark, micro, labels, None, None, None, None)
    want_cube, want_state = _r_cube_and_state(rows)
    got_cube = {(r.stpuma, r.soc_minor, r.naics_2d): r.asDict() for r in s.master().collect()}
    assert set(got_cube) == set(want_cube)
    for key, m in want_cube.items():
        g = got_cube[key]
        assert int(g["state_fips"]) == m["state_code"]
        for k, v in m.items():
            if k != "state_code":
                assert g[k] == v, (key, k, g[k], v)
    got_state = {r.state_fips: r.asDict() for r in s.state().collect()}
    assert set(got_state) == set(want_state)
    for st_code, acc in want_state.items():
        for k, v in acc.items():
            got = got_state[st_code][k]
            assert (got is None and v is None) or abs(got - v) < 1e-9, (st_code, k, got, v)


@SETTINGS
@given(st.lists(cube_row, min_size=1, max_size=25),
       st.sampled_from([((1, 100, 10, 0.25), (1, 100, 20, 0.75), (2, 100, 20, 1.0)),
                        ((1, 100, 10, 1.0), (1, 200, 10, 0.5), (1, 200, 30, 0.5))]))
def test_zone_table_matches_r_model(spark, rows, xw_rows):
    """Unit totals (na.rm) -> crosswalk fan-out (units without a row drop)
    -> sum(measure * share) by zone; checked on population and count."""
    from surveyfold.plans.products import Survey
    from surveyfold.functions.derive import geo_unit_key
    from pyspark.sql import functions as F
    labels = spark.createDataFrame([("STATEFIP", 1, "Alabama"), ("STATEFIP", 2, "Alaska")],
                                   "name string, value int, label string")
    xw = spark.createDataFrame([(s_, p, z, sh) for s_, p, z, sh in xw_rows],
                               "statefip int, puma int, cz90 int, county_prop_inpuma double")
    xw = xw.withColumns({"county_prop_incz": F.lit(1.0),
                         "stpuma": geo_unit_key(F.col("statefip"), F.col("puma"))})
    ctx = spark.createDataFrame([], "ers90 int, state_fips string")
    s = Survey(spark, spark.createDataFrame(rows, MICRO_SCHEMA), labels, xw, ctx, None, None)
    cube, _ = _r_cube_and_state(rows)
    units = {}
    for (stpuma, _soc, _naics), m in cube.items():
        u = units.setdefault(stpuma, {"pop": 0.0, "n": 0})
        u["pop"] += m["civ_noninst_pop"] or 0.0           # sum(., na.rm = TRUE)
        u["n"] += m["count"] or 0
    want = {}
    for s_, p, z, share in xw_rows:
        key = str(int(f"{s_:03d}{p:05d}"))
        if key in units:
            w = want.setdefault(z, {"pop": 0.0, "n": 0.0})
            w["pop"] += units[key]["pop"] * share
            w["n"] += units[key]["n"] * share
    got = {r.cz90: r for r in s.zone().collect()}
    assert set(got) == set(want)
    for z, w in want.items():
        assert abs(got[z]["civ_noninst_pop"] - w["pop"]) < 1e-9
        assert abs(got[z]["count"] - w["n"]) < 1e-9


@SETTINGS
@given(st.lists(cube_row, min_size=1, max_size=25))
def test_occupation_table_matches_r_model(spark, rows):
    """Cube -> sum(., na.rm=TRUE) by minor group -> inner join titles ->
    military groups dropped; checked on employment and count."""
    from surveyfold.plans.products import Survey, soc_minor_titles
    labels = spark.createDataFrame([("STATEFIP", 1, "Alabama"), ("STATEFIP", 2, "Alaska")],
                                   "name string, value int, label string")
    titles = soc_minor_titles(spark.createDataFrame(
        [("11-1000", "Top Executives"), ("15-1200", "Computer Occupations")],
        "minor_group string, title string"))
    s = Survey(spark, spark.createDataFrame(rows, MICRO_SCHEMA), labels, None, None, titles, None)
    cube, _ = _r_cube_and_state(rows)
    want = {}
    for (_u, soc, _n), m in cube.items():
        if soc in ("111", "1512"):
            w = want.setdefault(soc, {"emp": 0.0, "n": 0})
            w["emp"] += m["civ_noninst_pop_employed"] or 0.0
            w["n"] += m["count"] or 0
    got = {r.soc_minor: {"emp": r.civ_noninst_pop_employed, "n": r["count"]}
           for r in s.occupation().collect()}
    assert got == want


@SETTINGS
@given(st.lists(cube_row, min_size=1, max_size=25))
def test_sector_table_matches_r_model(spark, rows):
    """Cube -> sum(., na.rm=TRUE) by sector -> natural join to sector titles
    (untitled sectors drop); checked on employment and count."""
    from surveyfold.plans.products import Survey
    labels = spark.createDataFrame([("STATEFIP", 1, "Alabama")], "name string, value int, label string")
    sectors = spark.createDataFrame([("31", "Manufacturing", "Manufacturing")],
                                    "naics_2d string, sector string, short_sector string")
    s = Survey(spark, spark.createDataFrame(rows, MICRO_SCHEMA), labels, None, None, None, sectors)
    cube, _ = _r_cube_and_state(rows)
    want = {}
    for (_u, _soc, naics), m in cube.items():
        if naics == "31":
            w = want.setdefault(naics, {"emp": 0.0, "n": 0})
            w["emp"] += m["civ_noninst_pop_employed"] or 0.0
            w["n"] += m["count"] or 0
    got = {r.naics_2d: {"emp": r.civ_noninst_pop_employed, "n": r["count"]}
           for r in s.sector().collect()}
    assert got == want
