"""Derivation rules against plain-Python models of the R rules (hypothesis).

Each example batches many random codes into one DataFrame, so a handful of
Spark jobs checks thousands of values."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from surveyfold.functions import derive as D
from surveyfold.functions import scalars as S

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
digits = st.text(alphabet="0123456789", min_size=0, max_size=8)
codes = st.text(alphabet="0123456789SMX", min_size=0, max_size=6)


def r_str_pad(x, w):
    return None if x is None else (x if len(x) >= w else "0" * (w - len(x)) + x)


def r_soc_minor(x):
    if x is None:
        return None
    return x[:4] if x[:4] in ("1512", "3111", "5151") else x[:3]


def r_sector(x):
    if x is None:
        return None
    s = x[:2]
    for lo, hi, code in (("30", "33", "31"), ("44", "45", "44"), ("48", "49", "48")):
        if lo <= s <= hi:
            return code
    return s


def r_canonical(x):
    if x is None or x == "" or not x.isdigit():
        return None
    return str(int(x))


def r_short_minor(x):
    return None if x is None else x.replace("-", "", 1).replace("0", "")


def run(spark, expr, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr.alias("o")).collect()]


@SETTINGS
@given(st.lists(st.one_of(digits, st.none()), min_size=1, max_size=60))
def test_pad_and_canonical(spark, values):
    assert run(spark, S.pad_left("x", 5), values) == [r_str_pad(v, 5) for v in values]
    safe = [v for v in values if v is None or len(v) <= 18]
    assert run(spark, S.canonical_key("x"), safe) == [r_canonical(v) for v in safe]


@SETTINGS
@given(st.lists(st.one_of(codes, st.sampled_from(["151252", "311120", "515111", "3S", "4S"]), st.none()),
                min_size=1, max_size=60))
def test_occupation_and_sector(spark, values):
    assert run(spark, D.soc_minor("x"), values) == [r_soc_minor(v) for v in values]
    assert run(spark, D.sector_2d("x"), values) == [r_sector(v) for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.from_regex(r"[0-9]{2}-[0-9]{4}", fullmatch=True), st.none()),
                min_size=1, max_size=60))
def test_short_minor_code(spark, values):
    assert run(spark, D.short_minor_code("x"), values) == [r_short_minor(v) for v in values]
