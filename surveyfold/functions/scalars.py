"""Scalar expressions with R's missing-value rules.

Every helper returns a ``Column`` built from native Spark functions, so it
stays inside whole-stage codegen. The R rules are encoded here once:

* ``ifelse(NA, a, b)`` is NA              -> :func:`r_ifelse` (N5)
* ``NA %in% c(..)`` is FALSE              -> :func:`r_isin` (N4)
* ``str_pad`` never truncates             -> :func:`pad_left` (N7)
* text vs number comparisons are textual  -> :func:`text_between` (N8, N9)
* ``as.character(as.numeric(x))``         -> :func:`canonical_key` (N13)
* ``x / 0``                                -> NULL via ``try_divide`` (N10)
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def pad_left(c: ColumnOrName, width: int, pad: str = "0") -> Column:
    """Left pad to ``width`` without ever truncating (R ``str_pad``)."""
    s = _col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, pad)).otherwise(s)


def canonical_key(c: ColumnOrName) -> Column:
    """Text -> number -> text, dropping leading zeros (``"00100100"`` -> ``"100100"``).

    A non-numeric text gives NULL (R gives NA with a warning).
    """
    return _col(c).try_cast("bigint").cast("string")


def r_ifelse(cond: Column, yes, no) -> Column:
    """``ifelse(cond, yes, no)``; a NULL condition gives NULL."""
    return F.when(cond, _lit(yes)).when(~cond, _lit(no))


def r_isin(c: ColumnOrName, values: Iterable) -> Column:
    """``x %in% values``; NULL is FALSE, never NULL."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def flag_times(cond: Column, value: ColumnOrName) -> Column:
    """``value * (cond)`` with the logical as 0/1.

    A NULL condition gives NULL, and so does a NULL value even when the
    condition is false (R: ``NA * FALSE`` is ``NA``).
    """
    v = _col(value)
    return F.when(cond, v).when(~cond, v * F.lit(0))


def text_between(c: ColumnOrName, lo: str, hi: str) -> Column:
    """``lo <= x <= hi`` compared as text, as R does for a string column."""
    return _col(c).between(F.lit(str(lo)), F.lit(str(hi)))


def pct_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """X11: ``num / den * 100``; a zero denominator gives NULL (R gives NaN/Inf, N10)."""
    return F.try_divide(_col(num), _col(den)) * F.lit(100.0)


def remove_first(c: ColumnOrName, literal: str) -> Column:
    """``str_remove``: drop the first occurrence of a literal text."""
    esc = re.escape(literal)
    first = re.escape(literal[0])
    if len(literal) == 1:
        pattern = f"^([^{first}]*){esc}"
    else:
        pattern = f"^(.*?){esc}"
    return F.regexp_replace(_col(c), pattern, "$1")


def remove_all(c: ColumnOrName, literal: str) -> Column:
    """``str_remove_all``: drop every occurrence of a literal text."""
    return F.replace(_col(c), F.lit(literal), F.lit(""))


def r_paste0(*cols: ColumnOrName) -> Column:
    """R ``paste0``: text concatenation where NA becomes the text ``"NA"``."""
    return F.concat(*[F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols])


def r_substr(c: ColumnOrName, start: int, stop: int) -> Column:
    """R ``substr(x, start, stop)`` (1-based, inclusive)."""
    return F.substring(_col(c).cast("string"), start, stop - start + 1)


def sum_na_rm(c: ColumnOrName) -> Column:
    """A10: ``sum(x, na.rm=TRUE)``: NULLs skipped, all-NULL gives 0."""
    return F.coalesce(F.sum(_col(c)), F.lit(0))
