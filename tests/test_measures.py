"""The fused cube equals the source's three-aggregate join form."""

from pyspark.sql import functions as F

from surveyfold.operators import joins as J
from surveyfold.operators import measures as M

ROWS = [
    # stpuma, soc, naics, STATEFIP, PERWT, EMPSTAT, LABFORCE, CITIZEN, BPL
    ("100", "111", "31", 1, 10.0, 1, 2, 0, 1),
    ("100", "111", "31", 1, 5.0, 2, 2, 3, 210),
    ("100", None, "31", 1, 7.0, 1, 2, 4, 200),
    ("100", None, "31", 1, 3.0, 3, 1, 0, 5),
    ("200", "152", None, 2, 8.0, 1, 2, 2, 300),
    ("200", "152", None, 2, 2.0, 1, 2, 2, 450),
]
SCHEMA = ("stpuma string, soc_minor string, naics_2d string, STATEFIP int, PERWT double, "
          "EMPSTAT int, LABFORCE int, CITIZEN int, BPL int")


def persons(spark):
    return M.prepare_persons(spark.createDataFrame(ROWS, SCHEMA))


def join_form(p):
    """The source's form: three aggregates, two pivots, two null-safe left joins."""
    keys = list(M.CUBE_KEYS)
    e = F.col("EMPSTAT_2") * F.col("PERWT")
    l = F.col("LABFORCE_2") * F.col("PERWT")
    base = p.groupBy(*keys).agg(F.sum("PERWT").alias(M.POP), F.sum(e).alias(M.EMP),
                                F.sum(l).alias(M.LF), F.count(F.lit(1)).alias(M.N))
    st = p.groupBy(*keys).pivot("foreign_born", ["Local", "immigrant"]).agg(
        F.sum("PERWT").alias("p"), F.sum(e).alias("e"), F.sum(l).alias("l"), F.count(F.lit(1)).alias("n"))
    ren = {}
    for lv, suf in M.STATUS_LEVELS:
        for short, name in (("p", M.POP), ("e", M.EMP), ("l", M.LF), ("n", M.N)):
            ren[f"{lv}_{short}"] = f"{name}_{suf}"
    st = st.withColumnsRenamed(ren)
    og = p.groupBy(*keys).pivot("foreing_born_det_1", ["Central America", "South America", "Mexico"]).agg(
        F.sum(e).alias("e"), F.sum(l).alias("l"), F.count(F.lit(1)).alias("n"))
    ren = {}
    for lv, suf in M.ORIGIN_LEVELS + M.ORIGIN_LEVELS_LAST:
        for short, name in (("e", M.EMP), ("l", M.LF), ("n", M.N)):
            ren[f"{lv}_{short}"] = f"{name}_{suf}"
    og = og.withColumnsRenamed(ren)
    out = J.null_safe_join(J.null_safe_join(base, st, keys), og, keys)
    # pivot counts of absent cells are 0 in Spark but NA in R
    fix = {c: F.when(F.col(c) != 0, F.col(c)) for c in out.columns if c.startswith("count_")}
    return out.withColumns(fix)


def as_set(df, cols):
    return {tuple(r[c] for c in cols) for r in df.select(*cols).collect()}


def test_fused_equals_join_form(spark):
    p = persons(spark)
    fused = M.master_cube(p)
    ref = join_form(p)
    cols = [c for c in ref.columns]
    assert as_set(fused, cols) == as_set(ref, cols)
    assert fused.count() == 3   # the NULL soc group is kept (N3)


def test_missing_cell_is_null_then_zero(spark):
    from surveyfold.operators.rollup import rollup_sum
    cube = M.master_cube(persons(spark))
    r = cube.where(F.col("stpuma") == "200").first()
    assert r["count_local"] is None and r["civ_noninst_pop_local"] is None
    rolled = rollup_sum(cube, ["stpuma"], ["count_local", "civ_noninst_pop_local"])
    r2 = rolled.where(F.col("stpuma") == "200").first()
    assert r2["count_local"] == 0 and r2["civ_noninst_pop_local"] == 0


def test_totals_invariant(spark):
    cube = M.master_cube(persons(spark)).na.fill(0)
    for r in cube.collect():
        for m in (M.POP, M.EMP, M.LF, M.N):
            assert r[m] == r[f"{m}_local"] + r[f"{m}_immigrant"]
        assert r[f"{M.EMP}_central_america"] + r[f"{M.EMP}_south_america"] + \
            r[f"{M.EMP}_mexico"] <= r[f"{M.EMP}_immigrant"]


def test_strict_sum_null_weight(spark):
    rows = [("1", "a", "b", 1, None, 1, 2, 0, 1), ("1", "a", "b", 1, 4.0, 1, 2, 0, 1)]
    cube = M.master_cube(M.prepare_persons(spark.createDataFrame(rows, SCHEMA)))
    r = cube.first()
    assert r[M.POP] is None and r[M.N] == 2        # R: sum(c(NA, 4)) is NA
    loose = M.master_cube(M.prepare_persons(spark.createDataFrame(rows, SCHEMA)), strict=False)
    assert loose.first()[M.POP] == 4.0


def test_two_phase_equals_fused(spark):
    rows = ROWS + [("100", "111", "31", 1, None, 1, 2, 0, 1), ("300", "111", "44", 3, 4.0, None, 2, 5, 300)]
    p = M.prepare_persons(spark.createDataFrame(rows, SCHEMA))
    fused = M.master_cube(p, two_phase=False)
    two = M.master_cube(p, two_phase=True)
    assert fused.columns == two.columns
    assert as_set(fused, fused.columns) == as_set(two, fused.columns)
