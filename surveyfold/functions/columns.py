"""Column handling (P1-P9): names, prefix selection, reorder, derived columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snake_case(name: str, position: int = 1) -> str:
    """``janitor::clean_names`` for one name.

    Lower snake case, non-alphanumerics to ``_``, camelCase split, a leading
    digit prefixed with ``x``; a blank name becomes ``x{position}``.
    """
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.strip())
    s = re.sub(r"%", "percent", s)
    s = re.sub(r"[^0-9A-Za-z]+", "_", s).strip("_").lower()
    if not s:
        return f"x{position}"
    if s[0].isdigit():
        s = f"x{s}"
    return s


def clean_names(df: DataFrame) -> DataFrame:
    """Normalise every column name; duplicates get ``_2``, ``_3``..."""
    seen: dict[str, int] = {}
    out = []
    for i, c in enumerate(df.columns, start=1):
        n = snake_case(c, i)
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 1
        out.append(n)
    return df.toDF(*out)


def _union_select(columns: list[str], patterns: list[re.Pattern]) -> list[str]:
    # tidyselect: matches of the first selector in frame order, then new
    # matches of the second selector, and so on.
    out: list[str] = []
    for pat in patterns:
        out.extend(c for c in columns if pat.search(c) and c not in out)
    return out


def select_prefix(df: DataFrame, *prefixes: str, ignore_case: bool = True) -> list[str]:
    """``vars(starts_with(a), starts_with(b), ..)``, ignoring case by default."""
    flags = re.IGNORECASE if ignore_case else 0
    return _union_select(df.columns, [re.compile("^" + re.escape(p), flags) for p in prefixes])


def select_contains(df: DataFrame, *parts: str, ignore_case: bool = True) -> list[str]:
    """``select(contains(a), contains(b), ..)``, ignoring case by default."""
    flags = re.IGNORECASE if ignore_case else 0
    return _union_select(df.columns, [re.compile(re.escape(p), flags) for p in parts])


def keep_first(df: DataFrame, n: int) -> DataFrame:
    """Positional keep ``select(1:n)``."""
    return df.select(df.columns[:n])


def move_first(df: DataFrame, *first: str) -> DataFrame:
    """P5: ``select(a, b, everything())``."""
    rest = [c for c in df.columns if c not in first]
    return df.select(*first, *rest)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``old -> new`` in one projection."""
    return df.withColumnsRenamed(dict(mapping))


def mutate(df: DataFrame, *steps: Mapping[str, Column]) -> DataFrame:
    """Each step sees the columns of the earlier ones (chained ``withColumns``)."""
    for step in steps:
        df = df.withColumns(dict(step))
    return df


def mutate_at(df: DataFrame, cols: Iterable[str], fn) -> DataFrame:
    """Same function over a column set."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def tag(df: DataFrame, **values) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})
