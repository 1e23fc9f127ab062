"""X12-X23 and L1-L7 against the literal rule fixtures."""
from pyspark.sql import functions as F

from surveyfold.functions import derive as D


def col_of(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("o")).collect()]


def test_geo_unit_key(spark):
    got = col_of(spark, D.geo_unit_key(F.col("s"), F.col("u")), "s string, u int",
                 [("01", 100), ("36", 3801)])
    assert got == ["100100", "3603801"]


def test_county_fips(spark):
    got = col_of(spark, D.county_fips(F.col("s"), F.col("c")), "s int, c int",
                 [(1, 7), (None, 7), (1, None)])
    assert got == ["01007", "NA007", "01NA"]      # paste0 writes NA as "NA"


def test_geo_unit_key_na(spark):
    got = col_of(spark, D.geo_unit_key(F.col("s"), F.col("u")), "s string, u int", [(None, 100), ("01", None)])
    assert got == [None, None]                    # "NA00100" is not a number


def test_soc_minor(spark):
    rows = [("111021",), ("151252",), ("152031",), ("311120",), ("312011",), ("515111",), ("0",), (None,)]
    assert col_of(spark, D.soc_minor("x"), "x string", rows) == \
        ["111", "1512", "152", "3111", "312", "5151", "0", None]


def test_sector_2d(spark):
    rows = [("311M",), ("33MS",), ("4411",), ("45XX",), ("4853",), ("491",), ("3S",), ("4S",), ("23",), (None,)]
    assert col_of(spark, D.sector_2d("x"), "x string", rows) == \
        ["31", "31", "44", "44", "48", "48", "3S", "4S", "23", None]


def test_immigrant_flag(spark):
    rows = [(0,), (1,), (2,), (3,), (4,), (5,), (None,)]
    assert col_of(spark, D.immigrant_flag("x"), "x int", rows) == \
        [False, False, True, True, True, True, False]


def test_birth_status(spark):
    rows = [(200, True), (200, False), (110, True), (None, False), (None, True)]
    assert col_of(spark, D.birth_status("b", F.col("i")), "b int, i boolean", rows) == \
        ["immigrant", "Local", "Local", "Local", None]


def test_birth_origin(spark):
    rows = [(210, True), (200, True), (300, True), (450, True), (515, True), (600, False),
            (700, True), (150, True), (100, True), (200, False), (None, True)]
    assert col_of(spark, D.birth_origin("b", F.col("i")), "b int, i boolean", rows) == \
        ["Central America", "Mexico", "South America", "Europe", "Asia", "Africa", "Africa",
         "Other", "Other", "Local", "Other"]


def test_birthplace_broad(spark):
    rows = [(1,), (120,), (200,), (210,), (300,), (150,), (500,), (None,)]
    assert col_of(spark, D.birthplace_broad("b"), "b int", rows) == \
        ["US and US Possessions", "US and US Possessions", "Mexico", "Central America",
         "South America", "Others", "Others", "Others"]


def test_citizenship_label(spark):
    rows = [("N/A",), ("Naturalized citizen",), (None,)]
    assert col_of(spark, D.citizenship_label("x"), "x string", rows) == \
        ["Not foreign born", "Naturalized citizen", None]


def test_soc_parents_and_short_code(spark):
    df = spark.createDataFrame([("11-1011",)], "d string")
    r = df.select(*[v.alias(k) for k, v in D.soc_parent_codes("d").items()]).first()
    assert (r.major_group, r.minor_group, r.broad_group) == ("11-0000", "11-1000", "11-1010")
    got = col_of(spark, D.short_minor_code("x"), "x string", [("11-1000",), ("15-1200",), ("31-1100",)])
    assert got == ["111", "1512", "3111"]


def test_universe_and_military(spark):
    df = spark.createDataFrame(
        [(10, 1, 30), (14, 1, 30), (10, 3, 30), (10, 1, 15), (10, 1, 64), (None, 1, 30)],
        "EMPSTATD int, GQ int, AGE int")
    assert D.universe(df).count() == 2
    got = col_of(spark, D.not_military("s"), "s string", [("551",), ("155",), (None,)])
    assert got == [False, True, None]
