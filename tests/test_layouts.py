"""How rows are laid out: bucketed person tables (T0), salted fan-out (J3), labels as metadata."""

from pyspark.sql import functions as F

from surveyfold.operators import apportion as AP
from surveyfold.operators import joins as J
from surveyfold.plans import analog
from surveyfold.plans.products import Survey
from surveyfold.session import stage_table
from surveyfold.sources import codebook as CB

from conftest import SF_SMALL


def rows(df):
    return sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcast(spark):
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        yield name, spark.conf.get(name, None)
        spark.conf.set(name, "-1")


def restore(spark, before):
    for name, value in before:
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_no_exchange_under_the_order_join_of_staged_tables(spark):
    survey = Survey.from_driver_tables(spark, SF_SMALL, buckets=8)
    before = list(without_broadcast(spark))
    try:
        lines, orders = survey._staged
        joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        whole = plan_of(survey.microdata)
        lowest = whole[whole.index("person_lines") - 2500:whole.index("person_lines")] if "person_lines" in whole else whole
        assert "Bucketed: true" in whole and "l_orderkey" in lowest
        assert "hashpartitioning(l_orderkey" not in whole and "hashpartitioning(o_orderkey" not in whole
    finally:
        restore(spark, before)
    assert rows(survey.microdata) == rows(analog.microdata(spark, SF_SMALL))
    tables = [df.staged_table for df in survey._staged]
    survey.release()
    assert not any(spark.catalog.tableExists(t) for t in tables)


def test_a_hot_unit_is_spread_over_tasks(spark):
    n = 3000
    units = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 400)).alias("stpuma"),
                                  F.col("id").cast("int").alias("m"))
    units = units.union(spark.createDataFrame([(None, 1), ("nowhere", 2)], "stpuma string, m int"))
    pieces = spark.range(400).select(F.concat(F.lit("u"), F.col("id")).alias("stpuma"), (F.col("id") % 5).alias("cz90")).union(
        spark.createDataFrame([("hot", z) for z in range(7)], "stpuma string, cz90 long"))
    before = list(without_broadcast(spark))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = units.join(pieces, "stpuma")
        salted = AP.fan_out(units, pieces, "stpuma", None, salts=16, hot_rows=500)
        assert rows(salted) == rows(plain) and salted.columns == plain.columns

        def most_in_a_task(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert most_in_a_task(plain) >= 7 * n // 3                # one task has the whole unit
        assert most_in_a_task(salted) <= 0.5 * most_in_a_task(plain)
        assert rows(AP.fan_out(units, pieces, "stpuma", None, salts=16)) == rows(plain)      # nothing is hot
        assert "__salt" not in plan_of(AP.fan_out(units, pieces, "stpuma", 400, salts=16))   # small: broadcast
    finally:
        restore(spark, before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_labels_ride_on_the_column(spark):
    labels = spark.createDataFrame([("C", 0, "N/A"), ("C", 2, "Naturalized"), ("C", 2, "Naturalized"), ("T", 1, "x"), ("BIG", 1, "a"), ("BIG", 2, "b"), ("BIG", 3, "c"), ("BIG", None, "d")],
                                   "name string, value int, label string")
    df = spark.createDataFrame([(0, "1", 3), (2, "1", 1), (7, "1", 9), (None, None, None)], "C int, T string, BIG int")
    held = CB.with_value_labels(df, labels.distinct(), most=2)
    assert CB.labels_of(held, "C") == {0: "N/A", 2: "Naturalized"}
    assert CB.labels_of(held, "T") is None and CB.labels_of(held, "BIG") is None
    staged = stage_table(held, "labelled")
    grouped = staged.groupBy("C", "BIG").agg(F.count(F.lit(1)).alias("n"))
    decoded = J.decode_labels(grouped, "C", labels.where("false"), "C", "label")
    assert "Join" not in plan_of(decoded)
    assert sorted(map(str, [(r.C, r.label) for r in decoded.collect()])) == sorted(map(str, [(0, "N/A"), (2, "Naturalized"), (7, "7"), (None, None)]))
    joined = J.decode_labels(grouped, "BIG", labels, "BIG", "label", 10)                      # too many: by join
    assert "Join" in plan_of(joined) and {(r.BIG, r.label) for r in joined.collect()} == {(3, "c"), (1, "a"), (9, "9"), (None, None)}
    empty = CB.with_value_labels(df, labels.where("false"))
    assert CB.labels_of(empty, "C") is None
