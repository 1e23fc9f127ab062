"""Derived survey codes and universe filters.

Codes are strings from scan to sink; every comparison against a code is a
text comparison, as in the R source (N8, N9).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import (
    _col,
    canonical_key,
    pad_left,
    r_ifelse,
    r_isin,
    r_paste0,
    r_substr,
    remove_all,
    remove_first,
    text_between,
)

# ---------------------------------------------------------------------------
# Fixed values (must equal the source rules for identical results)
# ---------------------------------------------------------------------------
# EMPSTATD codes of the armed forces, dropped from the civilian universe.
ARMED_FORCES_CODES = (13, 14, 15)
# GQ code of institutional group quarters, dropped.
INSTITUTIONAL_GQ = 3
# Working-age range, inclusive.
WORKING_AGE = (16, 64)
# CITIZEN codes counted as foreign born to non-US parents.
IMMIGRANT_CITIZEN_CODES = (2, 3, 4, 5)
# BPL at or below this is the US or a US possession.
US_BPL_MAX = 120
# Occupation prefixes (SOC 2018) whose minor group is 4 digits long.
FOUR_DIGIT_MINOR_PREFIXES = ("1512", "3111", "5151")
# Two-digit sector ranges merged into one sector: (low, high, merged code).
SECTOR_RANGES = (("30", "33", "31"), ("44", "45", "44"), ("48", "49", "48"))
# Military occupations start with this major group and are dropped from titles.
MILITARY_MAJOR = "55"
# Detailed birth origin, first matching rule wins:
#   (label, BPL codes as a (low, high) range or a set, needs_immigrant_flag)
ORIGIN_RULES = (
    ("Central America", {210}, True),
    ("Mexico", {200}, True),
    ("South America", {300}, True),
    ("Europe", (400, 499), True),
    ("Asia", (500, 599), True),
    ("Africa", {600}, False),       # Q1: no immigrant test in the source
    ("Africa", {700, 710}, True),   # Q2: 700 and 710 are also Africa
)
ORIGIN_OTHER = "Other"
ORIGIN_LOCAL = "Local"
# Broad birthplace labels of the labour-force table (BPL_II).
BIRTHPLACE_US = "US and US Possessions"
BIRTHPLACE_RULES = (("Central America", 210), ("Mexico", 200), ("South America", 300))
BIRTHPLACE_OTHERS = "Others"
# Birth status labels.
STATUS_IMMIGRANT = "immigrant"
STATUS_LOCAL = "Local"
# Citizenship label replaced in the labour-force tables.
CITIZEN_NA_LABEL = "N/A"
CITIZEN_NA_REPLACEMENT = "Not foreign born"


# ---------------------------------------------------------------------------
# Geography
# ---------------------------------------------------------------------------
def geo_unit_key(state, unit) -> Column:
    """State padded to 3 + unit padded to 5, then canonicalised.

    ``("01", 100)`` -> ``"00100100"`` -> ``"100100"``.
    """
    return canonical_key(r_paste0(pad_left(state, 3), pad_left(unit, 5)))


def county_fips(state, county) -> Column:
    """State padded to 2 + county padded to 3 (``paste0``: NA gives ``"NA"``)."""
    return r_paste0(pad_left(state, 2), pad_left(county, 3))


# ---------------------------------------------------------------------------
# Occupation and industry
# ---------------------------------------------------------------------------
def soc_minor(occsoc) -> Column:
    """First 3 characters, except the 4-digit minor groups."""
    s = _col(occsoc).cast("string")
    four = r_substr(s, 1, 4)
    return F.when(four.isin(*FOUR_DIGIT_MINOR_PREFIXES), four).otherwise(r_substr(s, 1, 3))


def sector_2d(indnaics) -> Column:
    """First 2 characters; 30-33 -> 31, 44-45 -> 44, 48-49 -> 48 (text ranges)."""
    s = r_substr(indnaics, 1, 2)
    out = None
    for lo, hi, code in SECTOR_RANGES:
        cond = text_between(s, lo, hi)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out.otherwise(s)


def soc_parent_codes(detailed) -> dict[str, Column]:
    """Parent codes of a detailed SOC code ``11-1011``."""
    d = _col(detailed)
    return {
        "major_group": r_paste0(r_substr(d, 1, 3), F.lit("0000")),
        "minor_group": r_paste0(r_substr(d, 1, 4), F.lit("000")),
        "broad_group": r_paste0(r_substr(d, 1, 6), F.lit("0")),
    }


def short_minor_code(minor_group) -> Column:
    """``15-1200`` -> ``1512``: drop the first ``-``, then every ``0``."""
    return remove_all(remove_first(minor_group, "-"), "0")


# ---------------------------------------------------------------------------
# Flags and statuses
# ---------------------------------------------------------------------------
def employed_flag(empstat="EMPSTAT") -> Column:
    """1 when employed (``EMPSTAT == 1``), else 0; NULL stays NULL."""
    return r_ifelse(_col(empstat) == 1, 1, 0)


def labforce_flag(labforce="LABFORCE") -> Column:
    """1 when in the labour force (``LABFORCE == 2``), else 0."""
    return r_ifelse(_col(labforce) == 2, 1, 0)


def immigrant_flag(citizen="CITIZEN") -> Column:
    """Citizenship in the immigrant codes; NULL is FALSE."""
    return r_isin(citizen, IMMIGRANT_CITIZEN_CODES)


def birth_status(bpl="BPL", immigrant: Column | None = None) -> Column:
    """``immigrant`` when born outside the US and flagged, else ``Local``.

    A NULL birthplace with the flag set gives NULL (R three-valued ``&``).
    """
    imm = immigrant if immigrant is not None else immigrant_flag()
    return r_ifelse((_col(bpl) > US_BPL_MAX) & imm, STATUS_IMMIGRANT, STATUS_LOCAL)


def birth_origin(bpl="BPL", immigrant: Column | None = None) -> Column:
    """Detailed origin, first matching rule of :data:`ORIGIN_RULES` wins."""
    b = _col(bpl)
    imm = immigrant if immigrant is not None else immigrant_flag()
    out = None
    for label, codes, needs_imm in ORIGIN_RULES:
        if isinstance(codes, tuple):
            cond = b.between(*codes)
        elif len(codes) == 1:
            cond = b == next(iter(codes))
        else:
            cond = b.isin(*sorted(codes))
        if needs_imm:
            cond = cond & imm
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.when(imm, F.lit(ORIGIN_OTHER)).otherwise(F.lit(ORIGIN_LOCAL))


def birthplace_broad(bpl="BPL") -> Column:
    """Broad birthplace label; NULL falls to ``Others``."""
    b = _col(bpl)
    out = F.when(b <= US_BPL_MAX, F.lit(BIRTHPLACE_US))
    for label, code in BIRTHPLACE_RULES:
        out = out.when(b == code, F.lit(label))
    return out.otherwise(F.lit(BIRTHPLACE_OTHERS))


def citizenship_label(decoded) -> Column:
    """Decoded citizenship with ``N/A`` shown as ``Not foreign born``."""
    d = _col(decoded)
    return r_ifelse(d == CITIZEN_NA_LABEL, CITIZEN_NA_REPLACEMENT, d)


# ---------------------------------------------------------------------------
# Universe filters
# ---------------------------------------------------------------------------
def civilian(empstatd="EMPSTATD") -> Column:
    """L1: not in the armed forces (NULL dropped)."""
    return ~_col(empstatd).isin(*ARMED_FORCES_CODES)


def non_institutional(gq="GQ") -> Column:
    """L2: not in institutional group quarters."""
    return _col(gq) != INSTITUTIONAL_GQ


def working_age(age="AGE") -> Column:
    """L3: age in the working-age range, inclusive."""
    return _col(age).between(*WORKING_AGE)


def universe(df: DataFrame) -> DataFrame:
    """L4: civilian, non-institutional, working-age persons (one pushed ``where``)."""
    return df.where(civilian() & non_institutional() & working_age())


def not_military(soc="soc_minor") -> Column:
    """Occupation outside the military major group (NULL dropped)."""
    return r_substr(soc, 1, 2) != MILITARY_MAJOR
