"""ANSI SQL (DuckDB dialect) restatements of the registered queries.

Each product is written independently in SQL over the driver's views
(``lineitem orders customer part supplier nation``), so the driver can check
the Spark plans against DuckDB. Shared pieces are CTEs; every column is
aliased to the Spark name. Fractional (apportioned) measures are rounded to
6 decimals on both sides (N19).
"""

from __future__ import annotations

from . import titles

ROUND = 6

# Fixed values, written out here and not taken from the code under test:
# output names, pivot levels with their column suffixes, selector prefixes,
# and the binding of the driver tables.
POP, EMP, LF, N = "civ_noninst_pop", "civ_noninst_pop_employed", "civ_noninst_labforce", "count"
STATUS_LEVELS = (("Local", "local"), ("immigrant", "immigrant"))
ORIGIN_LEVELS = (("Central America", "central_america"), ("South America", "south_america"))
ORIGIN_LEVELS_LAST = (("Mexico", "mexico"),)
FULL_PREFIXES, EMPLOYMENT_PREFIXES = (POP, EMP, LF, N), (EMP, N)
US, OTHERS = "US and US Possessions", "Others"
UNITS_PER_STATE, COUNTIES_PER_STATE, ZONE_BANDS, ZONE_SUFFIXES = 40, 50, 5, 7
OCCSOC_NULL_MOD, INDNAICS_NULL_MOD, OCC_SUFFIX_MULT = 101, 103, 7919
NAICS_CODES = ("11 21 22 23 31 32 33 42 44 45 48 49 51 52 53 54 55 56 61 62 71 72 81 92 "
               "99 3S 4S").split()


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _pad(expr: str, width: int) -> str:
    return (f"(CASE WHEN length(CAST({expr} AS VARCHAR)) < {width} "
            f"THEN lpad(CAST({expr} AS VARCHAR), {width}, '0') ELSE CAST({expr} AS VARCHAR) END)")


def _paste0(*parts: str) -> str:
    """R ``paste0``: NA becomes the text 'NA' (DuckDB's concat would skip it)."""
    return "concat(" + ", ".join(f"COALESCE({p}, 'NA')" for p in parts) + ")"


def _unit_key(state: str, unit: str) -> str:
    return f"CAST(TRY_CAST({_paste0(_pad(state, 3), _pad(unit, 5))} AS BIGINT) AS VARCHAR)"


NAICS_LIST = "[" + ", ".join(_q(c) for c in NAICS_CODES) + "]"
OCCSOC_SQL = (
    f"CASE WHEN p.p_partkey % {OCCSOC_NULL_MOD} = 0 THEN NULL ELSE concat("
    "CAST(11 + 2 * ((CAST(substring(p.p_brand, 7, 10) AS INTEGER) - 1) % 25) AS VARCHAR), "
    f"lpad(CAST((p.p_partkey * {OCC_SUFFIX_MULT}) % 10000 AS VARCHAR), 4, '0')) END")
INDNAICS_SQL = (
    f"CASE WHEN p.p_partkey % {INDNAICS_NULL_MOD} = 0 THEN NULL ELSE concat("
    f"list_extract({NAICS_LIST}, CAST(p.p_partkey % {len(NAICS_CODES)} AS INTEGER) + 1), "
    "lpad(CAST(p.p_partkey % 100 AS VARCHAR), 2, '0')) END")

# The persons as they come, and with NULLs in four columns and ages beyond 64.
_AS_THEY_COME = "SELECT * EXCLUDE (partkey) FROM persons_raw"
_WITH_NULLS = """SELECT * EXCLUDE (partkey) REPLACE (
    CASE WHEN partkey % 13 = 1 THEN NULL ELSE "BPL" END AS "BPL",
    CASE WHEN partkey % 11 = 1 THEN NULL ELSE "CITIZEN" END AS "CITIZEN",
    CASE WHEN partkey % 17 = 1 THEN NULL ELSE "LABFORCE" END AS "LABFORCE",
    CASE WHEN partkey % 1009 = 1 THEN NULL ELSE "PERWT" END AS "PERWT",
    2 * "AGE" AS "AGE") FROM persons_raw"""


def with_nulls(sql: str) -> str:
    """The same statement on persons with NULLs."""
    return sql.replace(_AS_THEY_COME, _WITH_NULLS)


PERSONS = f"""
persons_raw AS (
  SELECT
    p.p_partkey AS partkey,
    CAST(year(o.o_orderdate) AS INTEGER) AS "YEAR",
    CAST(c.c_nationkey AS INTEGER) AS "STATEFIP",
    CAST(c.c_custkey % {COUNTIES_PER_STATE} AS INTEGER) AS "COUNTYFIP",
    CAST(c.c_custkey % {UNITS_PER_STATE} AS INTEGER) AS "PUMA",
    CASE WHEN o.o_orderstatus = 'P' THEN 3 ELSE 1 END AS "GQ",
    CASE WHEN o.o_orderpriority = '5-LOW' THEN 14 ELSE 10 END AS "EMPSTATD",
    CASE WHEN l.l_returnflag = 'N' THEN 1 WHEN l.l_returnflag = 'A' THEN 2 ELSE 3 END AS "EMPSTAT",
    CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 2 END AS "LABFORCE",
    p.p_size AS "AGE",
    CASE WHEN s.s_nationkey = c.c_nationkey THEN 0
         ELSE CAST((l.l_suppkey + c.c_custkey) % 6 AS INTEGER) END AS "CITIZEN",
    CAST(CASE WHEN s.s_nationkey = c.c_nationkey THEN s.s_nationkey + 1
         WHEN sn.n_regionkey = 1 THEN (CASE WHEN s.s_nationkey % 3 = 0 THEN 200
                                            WHEN s.s_nationkey % 3 = 1 THEN 210 ELSE 300 END)
         WHEN sn.n_regionkey = 3 THEN 400 + s.s_nationkey
         WHEN sn.n_regionkey = 2 THEN 500 + s.s_nationkey
         WHEN sn.n_regionkey = 0 THEN (CASE WHEN s.s_nationkey % 3 = 0 THEN 600
                                            WHEN s.s_nationkey % 3 = 1 THEN 700 ELSE 710 END)
         ELSE 100 + s.s_nationkey END AS INTEGER) AS "BPL",
    l.l_quantity AS "PERWT",
    {OCCSOC_SQL} AS "OCCSOC",
    {INDNAICS_SQL} AS "INDNAICS"
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation sn ON s.s_nationkey = sn.n_nationkey
),
persons AS ({_AS_THEY_COME})"""

_SOC = 'substring("OCCSOC", 1, 4)'
CLEAN = f"""
clean0 AS (
  SELECT *,
    {_unit_key(_pad('"STATEFIP"', 2), '"PUMA"')} AS stpuma,
    CASE WHEN {_SOC} IN ('1512', '3111', '5151') THEN {_SOC}
         ELSE substring("OCCSOC", 1, 3) END AS soc_minor,
    CASE WHEN substring("INDNAICS", 1, 2) BETWEEN '30' AND '33' THEN '31'
         WHEN substring("INDNAICS", 1, 2) BETWEEN '44' AND '45' THEN '44'
         WHEN substring("INDNAICS", 1, 2) BETWEEN '48' AND '49' THEN '48'
         ELSE substring("INDNAICS", 1, 2) END AS naics_2d,
    CASE WHEN "EMPSTAT" = 1 THEN 1 WHEN NOT ("EMPSTAT" = 1) THEN 0 END AS emp2,
    CASE WHEN "LABFORCE" = 2 THEN 1 WHEN NOT ("LABFORCE" = 2) THEN 0 END AS lf2,
    COALESCE("CITIZEN" IN (2, 3, 4, 5), false) AS imm
  FROM persons
  WHERE NOT ("EMPSTATD" IN (13, 14, 15)) AND "GQ" <> 3 AND "AGE" BETWEEN 16 AND 64
),
clean AS (
  SELECT *,
    CASE WHEN "BPL" > 120 AND imm THEN 'immigrant'
         WHEN NOT ("BPL" > 120 AND imm) THEN 'Local' END AS foreign_born,
    CASE WHEN "BPL" = 210 AND imm THEN 'Central America'
         WHEN "BPL" = 200 AND imm THEN 'Mexico'
         WHEN "BPL" = 300 AND imm THEN 'South America'
         WHEN "BPL" BETWEEN 400 AND 499 AND imm THEN 'Europe'
         WHEN "BPL" BETWEEN 500 AND 599 AND imm THEN 'Asia'
         WHEN "BPL" = 600 THEN 'Africa'
         WHEN "BPL" IN (700, 710) AND imm THEN 'Africa'
         WHEN imm THEN 'Other' ELSE 'Local' END AS origin
  FROM clean0
)"""

# master cube measures: name -> SQL aggregate
_W = '"PERWT"'


def _cell(value: str, cond: str | None, count: bool) -> str:
    if count:
        inner = "1" if cond is None else f"CASE WHEN {cond} THEN 1 END"
        return f"CAST({'COUNT(*)' if cond is None else f'SUM({inner})'} AS BIGINT)"
    return _strict_sum(value, cond)


def _strict_sum(value: str, cond: str | None = None) -> str:
    """R's ``sum`` without ``na.rm``: NULL if a matching row's value is NULL."""
    rows, values = ("COUNT(*)", value) if cond is None else (
        f"COUNT(CASE WHEN {cond} THEN 1 END)", f"CASE WHEN {cond} THEN {value} END")
    return f"CASE WHEN {rows} = COUNT({values}) THEN SUM({values}) END"


_VALUES = {POP: _W, EMP: f"emp2 * {_W}", LF: f"lf2 * {_W}", N: None}


def _cube_measures() -> list[tuple[str, str]]:
    out = [(name, _cell(v, None, v is None)) for name, v in _VALUES.items()]
    for name, v in _VALUES.items():
        for level, suf in STATUS_LEVELS:
            out.append((f"{name}_{suf}", _cell(v, f"foreign_born = {_q(level)}", v is None)))
    for levels in (ORIGIN_LEVELS, ORIGIN_LEVELS_LAST):
        for name, v in list(_VALUES.items())[1:]:
            for level, suf in levels:
                out.append((f"{name}_{suf}", _cell(v, f"origin = {_q(level)}", v is None)))
    return out


CUBE_MEASURES = _cube_measures()
CUBE_NAMES = [n for n, _ in CUBE_MEASURES]


def _prefixed(prefixes) -> list[str]:
    out: list[str] = []
    for p in prefixes:
        out.extend(n for n in CUBE_NAMES if n.lower().startswith(p.lower()) and n not in out)
    return out


FULL = _prefixed(FULL_PREFIXES)
EMPLOYMENT = _prefixed(EMPLOYMENT_PREFIXES)


def _is_count(name: str) -> bool:
    return name.startswith("count")


def master_cte(period: bool = False) -> str:
    keys = ("year, " if period else "") + "stpuma, soc_minor, naics_2d"
    yr = 'CAST("YEAR" AS INTEGER) AS year, ' if period else ""
    aggs = ",\n    ".join(f"{sql} AS {name}" for name, sql in CUBE_MEASURES)
    return f"""
cube0 AS (
  SELECT {keys}, MIN("STATEFIP") AS state_code,
    {aggs}
  FROM (SELECT {yr}* FROM clean) GROUP BY {keys}
),
master AS (
  SELECT c.*, COALESCE(n.n_name, CAST(c.state_code AS VARCHAR)) AS state,
         {_pad('c.state_code', 2)} AS state_fips,
         c.{EMP} / NULLIF(c.{POP}, 0) * 100 AS "EPOP"
  FROM cube0 c LEFT JOIN nation n ON c.state_code = n.n_nationkey
)"""


def _sum0(name: str, expr: str | None = None, integral: bool = True) -> str:
    e = expr or name
    if integral and _is_count(name):
        return f"CAST(COALESCE(SUM({e}), 0) AS BIGINT) AS {name}"
    return f"COALESCE(SUM({e}), 0) AS {name}"


def _rollup(keys: list[str], names: list[str], src: str = "master") -> str:
    k = ", ".join(keys)
    aggs = ", ".join(_sum0(n) for n in names)
    return f"SELECT {k}, {aggs} FROM {src} GROUP BY {k}"


GEO = f"""
geo AS (
  SELECT CAST(c_nationkey AS INTEGER) AS statefip,
         CAST(c_custkey % {UNITS_PER_STATE} AS INTEGER) AS puma,
         CAST(c_custkey % {COUNTIES_PER_STATE} AS INTEGER) AS county,
         CAST(100 * (c_nationkey % {ZONE_BANDS} + 1)
              + (c_custkey % {COUNTIES_PER_STATE}) % {ZONE_SUFFIXES} AS INTEGER) AS cz90
  FROM customer
),
xpieces AS (SELECT statefip, puma, cz90, CAST(COUNT(*) AS DOUBLE) AS pop FROM geo GROUP BY statefip, puma, cz90),
xwalk AS (
  SELECT statefip, puma, cz90, pop,
         SUM(pop) OVER (PARTITION BY statefip, puma) AS pumapop,
         SUM(pop) OVER (PARTITION BY cz90) AS czpop,
         pop / SUM(pop) OVER (PARTITION BY cz90) AS county_prop_incz,
         pop / SUM(pop) OVER (PARTITION BY statefip, puma) AS county_prop_inpuma,
         {_unit_key('statefip', 'puma')} AS stpuma
  FROM xpieces
),
zpieces AS (SELECT cz90, statefip, CAST(COUNT(*) AS DOUBLE) AS pop FROM geo GROUP BY cz90, statefip),
zmain AS (
  SELECT cz90, statefip FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY cz90 ORDER BY pop DESC, statefip) AS rn FROM zpieces
  ) WHERE rn = 1
),
zstates AS (
  SELECT z.cz90, CAST(COUNT(*) AS INTEGER) AS states_count,
         string_agg(n.n_name, '; ' ORDER BY n.n_name) AS states_abbv
  FROM (SELECT DISTINCT cz90, statefip FROM zpieces) z JOIN nation n ON n.n_nationkey = z.statefip
  GROUP BY z.cz90
),
zctx AS (
  SELECT m.cz90 AS ers90, {_pad('m.statefip', 2)} AS state_fips, n.n_name AS state_abbv,
         s.states_count, s.states_abbv
  FROM zmain m LEFT JOIN nation n ON n.n_nationkey = m.statefip
  LEFT JOIN zstates s ON s.cz90 = m.cz90
)"""


def _values(rows, cols) -> str:
    body = ",\n    ".join("(" + ", ".join(_q(str(v)) for v in r) + ")" for r in rows)
    return f"(VALUES\n    {body}) AS t({', '.join(cols)})"


SOC_TITLES = f"""
soc_titles AS (
  SELECT DISTINCT minor_group, title,
         replace(replace(minor_group, '-', ''), '0', '') AS soc_minor
  FROM {_values(titles.SOC_MINOR_GROUPS, ['minor_group', 'title'])}
)"""
SECTOR_TITLES = f"""
sector_titles AS (SELECT * FROM {_values(titles.SECTORS, ['naics_2d', 'sector', 'short_sector'])})"""
CITIZEN_LABELS = f"""
citizen_labels AS (
  SELECT CAST(v AS INTEGER) AS value, label
  FROM {_values(titles.CITIZEN_LABELS, ['v', 'label'])}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _r(name: str) -> str:
    # + 0.0 turns a rounded -0.0 into 0.0 (a sign left by float residue)
    return f"(ROUND({name}, {ROUND}) + 0.0)"


def _epop(src_emp: str = EMP, src_pop: str = POP) -> str:
    return f"{src_emp} / NULLIF({src_pop}, 0) * 100"


# ---------------------------------------------------------------------------
# products
# ---------------------------------------------------------------------------
def t1_master(period: bool = False) -> str:
    keys = ("year, " if period else "") + "stpuma, soc_minor, naics_2d"
    cols = ", ".join(CUBE_NAMES)
    return _with(PERSONS, CLEAN, master_cte(period)) + \
        f"\nSELECT {keys}, state, state_fips, {cols}, \"EPOP\" FROM master"


def t3_state(period: bool = False) -> str:
    keys = (["year"] if period else []) + ["state_fips", "state"]
    return _with(PERSONS, CLEAN, master_cte(period), f"\nst AS ({_rollup(keys, FULL)})") + \
        f'\nSELECT *, {_epop()} AS "EPOP" FROM st'


def _employment_rollup(keys: list[str], period: bool, titles_join: str, where: str = "") -> str:
    k = (["year"] if period else []) + keys
    return _with(PERSONS, CLEAN, master_cte(period), SOC_TITLES, SECTOR_TITLES,
                 f"\nr AS ({_rollup(k, EMPLOYMENT)})") + f"\nSELECT * FROM r {titles_join} {where}"


_OCC_JOIN = "JOIN soc_titles USING (soc_minor)"
_OCC_WHERE = "WHERE substring(soc_minor, 1, 2) <> '55'"
_SECTOR_JOIN = "JOIN sector_titles USING (naics_2d)"


def t5_state_occupation(period: bool = False) -> str:
    return _employment_rollup(["state_fips", "state", "soc_minor"], period, _OCC_JOIN, _OCC_WHERE)


def t6_occupation(period: bool = False) -> str:
    return _employment_rollup(["soc_minor"], period, _OCC_JOIN, _OCC_WHERE)


def t8_state_sector(period: bool = False) -> str:
    return _employment_rollup(["state_fips", "state", "naics_2d"], period, _SECTOR_JOIN)


def t9_sector(period: bool = False) -> str:
    return _employment_rollup(["naics_2d"], period, _SECTOR_JOIN)


Q14 = ["county_prop_incz", "county_prop_inpuma"]


def _zone(extra: list[str], names: list[str], period: bool, suffix: str = "") -> str:
    """CTEs ``unit{suffix}`` (roll-up by unit) and ``zone{suffix}`` (apportioned)."""
    pk = ["year"] if period else []
    unit_sql = _rollup(pk + ["stpuma"] + extra, names)
    not_null = " AND ".join(f"u.{c} IS NOT NULL" for c in ["stpuma"] + extra)
    gk = ", ".join([f"u.{c}" for c in pk] + ["x.cz90"] + [f"u.{c}" for c in extra])
    names_k = ", ".join(pk + ["cz90"] + extra)
    pop, unit, zone = (f"CAST(x.{c} AS HUGEINT)" for c in ("pop", "pumapop", "czpop"))
    # numerators over (d0) 100 * pumapop, (d1) czpop * pumapop, (d2) pumapop squared; the source's
    # starts_with("count") also takes the crosswalk's two shares (Q14)
    tops = [(n, f"CAST(u.{n} * 100 AS HUGEINT) * {pop}", "d0") for n in names]
    tops += [("county_prop_incz", f"{pop} * {pop}", "d1"), ("county_prop_inpuma", f"{pop} * {pop}", "d2")]
    sums = ", ".join(f"CAST(SUM({e}) AS HUGEINT) AS {n}" for n, e, _ in tops)
    # each sum over equal denominators is divided once: whole part, and a fraction of 15 digits (by way of 18)
    split = ", ".join(f"{n} // {d} AS q_{n}, ((({n} % {d}) * 1000000000000000000 * 2 + {d}) // (2 * {d}) + 500) // 1000 AS f_{n}"
                      for n, _, d in tops)
    back = ", ".join(f"CAST(SUM(q_{n}) + SUM(f_{n}) // 1000000000000000 AS DOUBLE) "
                     f"+ CAST(SUM(f_{n}) % 1000000000000000 AS DOUBLE) / 1e15 AS {n}" for n, _, _ in tops)
    return (f"\nunit{suffix} AS ({unit_sql}),\nzsum{suffix} AS (SELECT {gk}, 100 * {unit} AS d0, {zone} * {unit} AS d1, "
            f"{unit} * {unit} AS d2, {sums} FROM unit{suffix} u JOIN xwalk x ON u.stpuma = x.stpuma WHERE {not_null} "
            f"GROUP BY {gk}, d0, d1, d2),\nzsplit{suffix} AS (SELECT {names_k}, {split} FROM zsum{suffix}),\n"
            f"zone{suffix} AS (SELECT {names_k}, {back} FROM zsplit{suffix} GROUP BY {names_k})")


def t2_zone(period: bool = False) -> str:
    body = _with(PERSONS, CLEAN, master_cte(period), GEO, _zone([], FULL, period))
    pk = "z.year, " if period else ""
    cols = ", ".join(f"z.{n}" for n in FULL + Q14)
    return body + (f"\nSELECT {pk}z.cz90, {cols}, {_epop('z.' + EMP, 'z.' + POP)} "
                   f"AS \"EPOP\", c.state_fips, c.state_abbv, c.states_count, c.states_abbv "
                   f"FROM zone z LEFT JOIN zctx c ON z.cz90 = c.ers90")


def _zone_titled(extra: str, join: str, where: str, period: bool) -> str:
    body = _with(PERSONS, CLEAN, master_cte(period), GEO, SOC_TITLES, SECTOR_TITLES,
                 _zone([extra], EMPLOYMENT, period))
    pk = "z.year, " if period else ""
    cols = ", ".join(f"z.{n}" for n in EMPLOYMENT + Q14)
    return body + (f"\nSELECT {pk}z.cz90, z.{extra}, {cols}, c.state_fips, c.state_abbv, "
                   f"c.states_count, c.states_abbv, t.* EXCLUDE ({extra}) FROM zone z "
                   f"LEFT JOIN zctx c ON z.cz90 = c.ers90 {join} {where}")


def t4_zone_occupation(period: bool = False) -> str:
    return _zone_titled("soc_minor", "JOIN soc_titles t ON t.soc_minor = z.soc_minor",
                        "WHERE substring(z.soc_minor, 1, 2) <> '55'", period)


def t7_zone_sector(period: bool = False) -> str:
    return _zone_titled("naics_2d", "JOIN sector_titles t ON t.naics_2d = z.naics_2d", "", period)


_CITIZENSHIP = f"""
cit AS (
  SELECT p.*, COALESCE(l.label, CAST(p."CITIZEN" AS VARCHAR)) AS cit_label
  FROM persons p LEFT JOIN citizen_labels l ON p."CITIZEN" = l.value
),
cit2 AS (
  SELECT *, CASE WHEN cit_label = 'N/A' THEN 'Not foreign born'
                 WHEN NOT (cit_label = 'N/A') THEN cit_label END AS citizenship,
         CASE WHEN "LABFORCE" = 2 THEN {_W} WHEN NOT ("LABFORCE" = 2) THEN {_W} * 0.0 END AS lfw,
         CASE WHEN "BPL" <= 120 THEN 'US and US Possessions' WHEN "BPL" = 210 THEN 'Central America'
              WHEN "BPL" = 200 THEN 'Mexico' WHEN "BPL" = 300 THEN 'South America'
              ELSE 'Others' END AS bpl_ii
  FROM cit
)"""


def t10_labor_force_citizenship() -> str:
    return _with(PERSONS, CITIZEN_LABELS, _CITIZENSHIP, """
agg AS (
  SELECT CASE WHEN GROUPING(citizenship) = 1 THEN 'total' ELSE citizenship END AS citizenship,
         """ + _strict_sum("lfw") + """ AS labor_force, GROUPING(citizenship) = 1 AS is_total
  FROM cit2 GROUP BY ROLLUP (citizenship)
)""") + """
SELECT citizenship, labor_force, is_total,
       labor_force / MAX(CASE WHEN is_total THEN labor_force END) OVER () AS labor_force_share
FROM agg"""


_BPL_LEVELS = ((US, "us_and_us_possessions"), ("Central America", "central_america"),
               ("Mexico", "mexico"), ("South America", "south_america"),
               (OTHERS, "others"))


def t11_labor_force_birthplace() -> str:
    cells = ", ".join(f"{_strict_sum('lfw', f'bpl_ii = {_q(lv)}')} AS {n}" for lv, n in _BPL_LEVELS)
    totals = ", ".join(f"COALESCE(SUM({n}), 0.0) AS {n}" for _, n in _BPL_LEVELS[:-1])
    names = ", ".join(n for _, n in _BPL_LEVELS)
    return _with(PERSONS, CITIZEN_LABELS, _CITIZENSHIP, f"""
g AS (SELECT citizenship, {cells} FROM cit2 GROUP BY citizenship)""") + f"""
SELECT citizenship, {names}, false AS is_total FROM g
UNION ALL
SELECT 'total' AS citizenship, {totals}, CAST(NULL AS DOUBLE) AS others, true AS is_total FROM g"""


_STRUCTURE = f"""
occ AS (SELECT p.p_name, {OCCSOC_SQL} AS occsoc FROM part p),
det AS (
  SELECT concat(substring(occsoc, 1, 2), '-', substring(occsoc, 3, 4)) AS code, p_name AS title
  FROM occ WHERE occsoc IS NOT NULL
),
minor_fixed AS (SELECT * FROM {_values(titles.SOC_MINOR_GROUPS, ['minor_group', 'title'])}),
minor_rows AS (
  SELECT m.minor_group, COALESCE(f.title, concat('group ', m.minor_group)) AS title
  FROM (SELECT DISTINCT concat(substring(code, 1, 4), '000') AS minor_group FROM det) m
  LEFT JOIN minor_fixed f ON f.minor_group = m.minor_group
),
major_rows AS (
  SELECT DISTINCT concat(substring(code, 1, 3), '0000') AS major_group,
         concat('group ', concat(substring(code, 1, 3), '0000')) AS title FROM det
),
broad_rows AS (
  SELECT DISTINCT concat(substring(code, 1, 6), '0') AS broad_group,
         concat('group ', concat(substring(code, 1, 6), '0')) AS title FROM det
)"""


def t13_occupation_hierarchy() -> str:
    return _with(_STRUCTURE, """
dsoc AS (SELECT DISTINCT code AS detailed_soc, title AS detailed_soc_title FROM det)""") + """
SELECT d.detailed_soc, d.detailed_soc_title,
       concat(substring(d.detailed_soc, 1, 6), '0') AS broad_group, b.title AS broad_group_title,
       concat(substring(d.detailed_soc, 1, 4), '000') AS minor_group, mi.title AS minor_group_title,
       concat(substring(d.detailed_soc, 1, 3), '0000') AS major_group, ma.title AS major_group_title
FROM dsoc d
LEFT JOIN (SELECT DISTINCT * FROM major_rows) ma ON ma.major_group = concat(substring(d.detailed_soc, 1, 3), '0000')
LEFT JOIN (SELECT DISTINCT * FROM minor_rows) mi ON mi.minor_group = concat(substring(d.detailed_soc, 1, 4), '000')
LEFT JOIN (SELECT DISTINCT * FROM broad_rows) b ON b.broad_group = concat(substring(d.detailed_soc, 1, 6), '0')"""


def t14_occupation_titles() -> str:
    return _with(_STRUCTURE) + """
SELECT DISTINCT minor_group, title, replace(replace(minor_group, '-', ''), '0', '') AS soc_minor
FROM minor_rows WHERE minor_group IS NOT NULL AND title IS NOT NULL"""


def t15_crosswalk_apportion(crosswalk: str = "xwalk") -> str:
    return _with(PERSONS, CLEAN, GEO, f"""
units AS (
  SELECT CAST("STATEFIP" AS INTEGER) AS statefip, CAST("PUMA" AS INTEGER) AS puma,
         COALESCE(SUM(1.0 * "PERWT"), 0.0) AS n_persons
  FROM clean GROUP BY 1, 2
),
merged AS (
  SELECT * FROM units FULL JOIN (SELECT statefip, puma, cz90, county_prop_inpuma FROM {crosswalk} z) x
  USING (statefip, puma)
),
per_zone AS (
  SELECT cz90, COALESCE(SUM(COALESCE(county_prop_inpuma * n_persons, 0.0)), 0.0) AS cz_n_persons
  FROM merged GROUP BY cz90
)""") + f"""
SELECT cz90, {_r('cz_n_persons')} AS cz_n_persons,
       {_r('SUM(cz_n_persons) OVER ()')} AS natl_n_persons FROM per_zone"""


def t16_zone_context() -> str:
    return _with(GEO) + "\nSELECT * FROM zctx"


def a17_crosswalk() -> str:
    return _with(GEO) + f"""
SELECT statefip, puma, cz90, pop, pumapop, czpop, {_r('county_prop_incz')} AS county_prop_incz,
       {_r('county_prop_inpuma')} AS county_prop_inpuma, stpuma FROM xwalk"""


_V1 = [("civ_noninst_pop", _W), ("civ_noninst_pop_employed", f"emp2 * {_W}"),
       ("civ_noninst_pop_employed_foreign", f"emp2 * {_W} * fb"),
       ("civ_noninst_pop_employed_ca", f"emp2 * {_W} * ca"),
       ("civ_noninst_pop_employed_mx", f"emp2 * {_W} * mx"),
       ("civ_noninst_pop_employed_sa", f"emp2 * {_W} * sa"),
       ("civ_noninst_labforce", f"lf2 * {_W}"),
       ("civ_noninst_labforce_foreign", f"lf2 * {_W} * fb"),
       ("civ_noninst_labforce_ca", f"lf2 * {_W} * ca"),
       ("civ_noninst_labforce_mx", f"lf2 * {_W} * mx"),
       ("civ_noninst_labforce_sa", f"lf2 * {_W} * sa"),
       ("count_foreign", "fb"), ("count_mx", "mx"), ("count_ca", "ca"), ("count_sa", "sa")]

_COUNTY = f"""
cp AS (
  SELECT {_paste0(_pad('"STATEFIP"', 2), _pad('"COUNTYFIP"', 3))} AS "COUNTYFIP_S", "STATEFIP",
         CAST("EMPSTAT" = 1 AS INTEGER) AS emp2, CAST("LABFORCE" = 2 AS INTEGER) AS lf2,
         CAST("BPL" > 120 AS INTEGER) AS fb, CAST("BPL" = 210 AS INTEGER) AS ca,
         CAST("BPL" = 200 AS INTEGER) AS mx, CAST("BPL" = 300 AS INTEGER) AS sa, "PERWT"
  FROM persons
  WHERE NOT ("EMPSTATD" IN (13, 14, 15)) AND "GQ" <> 3 AND "AGE" BETWEEN 16 AND 64
),
county_agg AS (
  SELECT "COUNTYFIP_S" AS "COUNTYFIP", "STATEFIP" AS state_code,
         {", ".join((f"CAST({_strict_sum(e)} AS BIGINT) AS {n}" if n.startswith("count") else f"{_strict_sum(e)} AS {n}") for n, e in _V1)}
  FROM cp GROUP BY 1, 2
),
county_tbl AS (
  SELECT a."COUNTYFIP", COALESCE(n.n_name, CAST(a.state_code AS VARCHAR)) AS "STATE",
         {_pad('a.state_code', 2)} AS "STATEFIP", a.* EXCLUDE ("COUNTYFIP", state_code)
  FROM county_agg a LEFT JOIN nation n ON a.state_code = n.n_nationkey
),
czones AS (
  SELECT {_paste0(_pad('statefip', 2), _pad('county', 3))} AS county_fips, cz90 AS ers90,
         COUNT(*) AS pop90
  FROM geo GROUP BY statefip, county, cz90
)"""


def v1_county_table() -> str:
    return _with(PERSONS, GEO, _COUNTY) + \
        f'\nSELECT *, {_epop()} AS "EPOP" FROM county_tbl'


def v1_county_zone() -> str:
    sums = ", ".join((f"CAST(SUM({n}) AS BIGINT) AS {n}" if n.startswith("count") else f"SUM({n}) AS {n}")
                     for n, _ in _V1)
    return _with(PERSONS, GEO, _COUNTY) + f"""
, z AS (
  SELECT ers90, {sums}
  FROM county_tbl t JOIN czones c ON t."COUNTYFIP" = c.county_fips GROUP BY ers90
)
SELECT *, {_epop()} AS "EPOP" FROM z"""


def j9_counties_unmatched() -> str:
    return _with(PERSONS, GEO, _COUNTY) + """
SELECT DISTINCT "COUNTYFIP" FROM county_tbl t
WHERE NOT EXISTS (SELECT 1 FROM czones c WHERE c.county_fips = t."COUNTYFIP")"""


def j9_counties_unmatched_partial() -> str:
    return _with(PERSONS, GEO, _COUNTY) + """
SELECT DISTINCT "COUNTYFIP" FROM county_tbl t
WHERE NOT EXISTS (SELECT 1 FROM czones c WHERE c.county_fips = t."COUNTYFIP"
                  AND c.ers90 NOT IN (103, 302))"""


def j9_zones_without_data() -> str:
    return _with(PERSONS, GEO, _COUNTY) + """
SELECT DISTINCT 'zone ' || CAST(ers90 AS VARCHAR) AS out90 FROM czones c
WHERE NOT EXISTS (SELECT 1 FROM county_tbl t WHERE t."COUNTYFIP" = c.county_fips)"""


def j7_zone_coverage() -> str:
    return _with(GEO, """
czones AS (SELECT DISTINCT cz90 AS ers90 FROM geo)""") + """
SELECT key, bool_or(side = 1) AS in_left, bool_or(side = 2) AS in_right
FROM (SELECT 1 AS side, cz90 AS key FROM xwalk UNION ALL SELECT 2, ers90 FROM czones)
GROUP BY key"""


def j7_zone_coverage_partial() -> str:
    return _with(GEO, """
czones AS (SELECT DISTINCT cz90 AS ers90 FROM geo)""") + """
SELECT key, bool_or(side = 1) AS in_left, bool_or(side = 2) AS in_right
FROM (SELECT 1 AS side, NULLIF(cz90, 101) AS key FROM xwalk WHERE cz90 % 100 < 5
      UNION ALL SELECT 2, NULLIF(ers90, 201) FROM czones WHERE ers90 > 200)
GROUP BY key"""


def j11_merge_indicator() -> str:
    return _with(GEO) + """
SELECT CASE WHEN u.puma IS NOT NULL AND x.puma IS NOT NULL THEN 3
            WHEN u.puma IS NOT NULL THEN 1 ELSE 2 END AS "_merge", COUNT(*) AS n_rows
FROM (SELECT DISTINCT statefip, puma FROM geo) u
FULL JOIN (SELECT statefip, CASE WHEN puma = 8 THEN 108 ELSE puma END AS puma FROM xwalk WHERE puma <> 7) x
  ON u.statefip = x.statefip AND u.puma = x.puma
GROUP BY 1"""


def x14_minor_codes() -> str:
    return f"""
WITH occ AS (SELECT {OCCSOC_SQL} AS occsoc FROM part p)
SELECT CASE WHEN substring(occsoc, 1, 4) IN ('1512', '3111', '5151') THEN substring(occsoc, 1, 4)
            ELSE substring(occsoc, 1, 3) END AS soc_minor, COUNT(*) AS n_parts
FROM occ GROUP BY 1"""


def x15_sector_codes() -> str:
    return f"""
WITH ind AS (SELECT substring({INDNAICS_SQL}, 1, 2) AS s FROM part p)
SELECT CASE WHEN s BETWEEN '30' AND '33' THEN '31' WHEN s BETWEEN '44' AND '45' THEN '44'
            WHEN s BETWEEN '48' AND '49' THEN '48' ELSE s END AS naics_2d, COUNT(*) AS n_parts
FROM ind GROUP BY 1"""


def x12_geo_units() -> str:
    return _with(GEO) + f"""
SELECT DISTINCT statefip, puma, {_unit_key(_pad('statefip', 2), 'puma')} AS stpuma FROM geo"""


def x_status_origin() -> str:
    return _with(PERSONS, CLEAN) + """
SELECT foreign_born, origin, CASE WHEN "BPL" <= 120 THEN 'US and US Possessions'
  WHEN "BPL" = 210 THEN 'Central America' WHEN "BPL" = 200 THEN 'Mexico'
  WHEN "BPL" = 300 THEN 'South America' ELSE 'Others' END AS bpl_ii,
  SUM("PERWT") AS civ_noninst_pop, COUNT(*) AS count
FROM clean GROUP BY 1, 2, 3"""


def s10_period() -> str:
    return _with(PERSONS) + """
SELECT concat(CAST(MIN("YEAR") AS VARCHAR), '_', CAST(MAX("YEAR") AS VARCHAR)) AS first_last_year,
       concat('Based in ACS samples from ', string_agg(DISTINCT CAST("YEAR" AS VARCHAR), ', ' ORDER BY CAST("YEAR" AS VARCHAR))) AS sample_description
FROM persons"""


def a13_conservation() -> str:
    """Before/after totals of every roll-up (rounded: zone sums are fractional)."""
    body = _with(PERSONS, CLEAN, master_cte(False), GEO, SOC_TITLES, SECTOR_TITLES,
                 _zone([], [POP], False, "_a"),
                 _zone(["soc_minor"], [EMP], False, "_b"),
                 _zone(["naics_2d"], [EMP], False, "_c"))
    pop, emp = POP, EMP
    parts = [
        ("zone", pop, "zone_a"),
        ("state", pop, "master"),
        ("zone_occupation", emp, "zone_b z JOIN soc_titles t USING (soc_minor) WHERE substring(z.soc_minor,1,2) <> '55'"),
        ("state_occupation", emp, "master z JOIN soc_titles t USING (soc_minor) WHERE substring(z.soc_minor,1,2) <> '55'"),
        ("occupation", emp, "master z JOIN soc_titles t USING (soc_minor) WHERE substring(z.soc_minor,1,2) <> '55'"),
        ("zone_sector", emp, "zone_c z JOIN sector_titles t USING (naics_2d)"),
        ("state_sector", emp, "master z JOIN sector_titles t USING (naics_2d)"),
        ("sector", emp, "master z JOIN sector_titles t USING (naics_2d)"),
    ]
    sel = "\nUNION ALL\n".join(
        f"SELECT '{step}' AS step, '{m}' AS measure, "
        f"{_r(f'(SELECT SUM({m}) FROM master)')} AS before, "
        f"{_r(f'(SELECT SUM({m}) FROM {src})')} AS after, "
        f"{_r(f'(SELECT SUM({m}) FROM {src}) - (SELECT SUM({m}) FROM master)')} AS diff"
        for step, m, src in parts)
    return body + "\n" + sel


def a1_weighted_counts() -> str:
    aggs = ", ".join(f"{sql} AS {name}" for name, sql in CUBE_MEASURES[:4])
    return _with(PERSONS, CLEAN, f"""
a1 AS (
  SELECT stpuma, soc_minor, naics_2d, MIN("STATEFIP") AS state_code, {aggs}
  FROM clean GROUP BY stpuma, soc_minor, naics_2d
)""") + f"""
SELECT a.stpuma, a.soc_minor, a.naics_2d, COALESCE(n.n_name, CAST(a.state_code AS VARCHAR)) AS state,
       {_pad('a.state_code', 2)} AS state_fips, {", ".join("a." + n for n, _ in CUBE_MEASURES[:4])}
FROM a1 a LEFT JOIN nation n ON a.state_code = n.n_nationkey"""


def _pivot_sql(names: list[str]) -> str:
    chosen = [(n, sql) for n, sql in CUBE_MEASURES if n in names]
    aggs = ", ".join(f"{sql} AS {name}" for name, sql in chosen)
    return _with(PERSONS, CLEAN) + \
        f"\nSELECT stpuma, soc_minor, naics_2d, {aggs} FROM clean GROUP BY stpuma, soc_minor, naics_2d"


def a3_status_pivot() -> str:
    return _pivot_sql([n for n, _ in CUBE_MEASURES if n.endswith(("_local", "_immigrant"))])


def a4_origin_pivot() -> str:
    return _pivot_sql([n for n, _ in CUBE_MEASURES
                       if n.endswith(("_central_america", "_south_america", "_mexico"))])


def a18_main_state() -> str:
    return _with(GEO) + "\nSELECT cz90, statefip FROM zmain"


def a19_zone_states() -> str:
    return _with(GEO) + "\nSELECT cz90, states_count, states_abbv FROM zstates"


def w2_zone_group_total() -> str:
    return _with(GEO) + """
SELECT statefip, puma, cz90, pop, SUM(pop) OVER (PARTITION BY cz90) AS cz_pop_total FROM xpieces"""


def w3_keep_last() -> str:
    return _with(GEO) + """
SELECT cz90, pop, statefip, puma FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY cz90 ORDER BY pop DESC, statefip DESC, puma DESC) AS rn
  FROM xpieces) WHERE rn = 1"""


def a5_pivot_wider() -> str:
    levels = [(US, "us_and_us_possessions"), ("Central America", "central_america"),
              ("Mexico", "mexico"), ("South America", "south_america"), (OTHERS, "others")]
    bpl = ("CASE WHEN \"BPL\" <= 120 THEN 'US and US Possessions' WHEN \"BPL\" = 210 THEN "
           "'Central America' WHEN \"BPL\" = 200 THEN 'Mexico' WHEN \"BPL\" = 300 THEN "
           "'South America' ELSE 'Others' END")
    emp = ", ".join(f"SUM(CASE WHEN bpl_ii = {_q(lv)} THEN emp2 * {_W} END) AS emp_{n}" for lv, n in levels)
    cnt = ", ".join(f"CAST(SUM(CASE WHEN bpl_ii = {_q(lv)} THEN 1 END) AS BIGINT) AS n_{n}"
                    for lv, n in levels)
    return _with(PERSONS, CLEAN) + f"""
SELECT "STATEFIP", {emp}, {cnt}
FROM (SELECT *, {bpl} AS bpl_ii FROM clean) GROUP BY 1"""


def a5_unlisted_levels() -> str:
    return _with(PERSONS, CLEAN) + """
SELECT CAST(COUNT(CASE WHEN foreign_born IS NULL OR foreign_born NOT IN ('Local', 'immigrant')
                       THEN 1 END) AS BIGINT) AS unlisted_status_rows
FROM clean"""


def a5_first_seen() -> str:
    levels = [("foreign_born = 'Local'", "local"), ("foreign_born = 'immigrant'", "immigrant"), ("foreign_born IS NULL", "na")]
    pop = ", ".join(f"SUM(CASE WHEN {c} THEN {_W} END) AS pop_{n}" for c, n in levels)
    cnt = ", ".join(f"CAST(SUM(CASE WHEN {c} THEN 1 END) AS BIGINT) AS n_{n}" for c, n in levels)
    return _with(PERSONS, CLEAN) + f"""
, seen AS (SELECT COALESCE(foreign_born, 'NA') AS level, MIN(100000 * "STATEFIP" + "PUMA") AS first,
                  MIN(foreign_born) AS own FROM clean GROUP BY foreign_born)
SELECT "STATEFIP", {pop}, {cnt},
       (SELECT string_agg(level, ',' ORDER BY first, own NULLS LAST) FROM seen) AS level_order
FROM clean GROUP BY 1"""


def j11_merge_null_keys() -> str:
    return _with(GEO) + """
SELECT CASE WHEN u.here AND x.there THEN 3 WHEN u.here THEN 1 ELSE 2 END AS "_merge",
       CASE WHEN u.here THEN u.puma ELSE x.puma END AS puma, COUNT(*) AS n_rows
FROM (SELECT DISTINCT statefip, NULLIF(puma, 3) AS puma, true AS here FROM geo) u
FULL JOIN (SELECT statefip, NULLIF(puma, 3) AS puma, true AS there FROM xwalk) x
  ON u.statefip = x.statefip AND u.puma IS NOT DISTINCT FROM x.puma
GROUP BY 1, 2"""


def j3_fan_out() -> str:
    return _with(PERSONS, CLEAN, master_cte(), GEO) + f"""
, unit AS ({_rollup(["stpuma", "naics_2d"], [N])})
SELECT x.cz90, u.naics_2d, COUNT(*) AS n_rows, CAST(SUM(u.count) AS BIGINT) AS persons, CAST(SUM(x.pop) AS BIGINT) AS pop
FROM unit u JOIN xwalk x ON u.stpuma = x.stpuma WHERE u.naics_2d IS NOT NULL GROUP BY 1, 2"""
