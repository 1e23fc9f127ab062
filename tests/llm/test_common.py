import zlib
from collections import Counter

from pyspark.sql import functions as F

from surveyfold.llm import common as c

from .helpers import empty_docs


def test_held_out_rule(spark):
    got = {r.doc_id: r.h for r in spark.range(300).withColumnRenamed("id", "doc_id")
           .withColumn("h", c.is_held_out()).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) % 3 == 1 for d in got}
    assert spark.sql("SELECT CAST(NULL AS BIGINT) AS doc_id").select(c.is_held_out()).first()[0] is False


def test_content_key_tells_rows_apart(spark, docs):
    keys = docs.withColumn("k", c.content_key()).collect()
    by = {}
    for r in keys:
        by.setdefault(r.k, set()).add((r.doc_id, r.text))
    assert all(len(v) == 1 for v in by.values()) and len(by) == len({(r.doc_id, r.text) for r in keys})


def test_kept_rows_come_once(spark, docs):
    decided = docs.select(c.content_key().alias(c.ROW), F.expr("coalesce(doc_id, 0) < 10").alias("kept"))
    got = c.keep_rows(docs, decided, "test")
    assert got.schema == docs.schema
    want = {(r.doc_id, r.text) for r in docs.collect() if (r.doc_id or 0) < 10}
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(want)
    assert c.keep_rows(empty_docs(spark), decided.limit(0), "test").count() == 0


def test_tags_are_unique_and_written(spark, docs):
    tagged = c.tag_rows(docs, "test-tags")
    tags = [r[c.ROW] for r in tagged.collect()]
    assert len(set(tags)) == len(tags) == docs.count()
    assert sorted(r[c.ROW] for r in tagged.repartition(3).collect()) == sorted(tags)


def test_batches_are_bounded_by_bytes(spark):
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")
    c.bound_batches(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(c.BATCH_BYTES)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    c.bound_batches(spark)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "1m"

    def sizes(batches):
        import pandas as pd
        for f in batches:
            yield pd.DataFrame({"n": [len(f)]})
    long = spark.range(200).select(F.repeat(F.lit("x"), 100_000).alias("t")).coalesce(1)
    assert max(r.n for r in long.mapInPandas(sizes, "n int").collect()) < 60


def test_tidy_passes_batches_on():
    assert list(c.tidy(lambda b: (x + 1 for x in b))(iter([1, 2]))) == [2, 3]
