"""Small tables with the awkward cases, and the rules of the contracts in plain Python."""

import re

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names the operators use inside
    T.StructField("digest", T.StringType()), T.StructField("fp", T.LongType()),
    T.StructField("key", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("kept", T.BooleanType()), T.StructField("toxic", T.LongType()),
])

WORDS = "the cat sat on a mat while Birds sang loud songs over green hills and rivers ran".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] for i in range(n))


def awkward_docs(spark):
    """Nulls in every column, empty and blank texts, a very long text, exact and
    near copies, equal rows, ids that repeat, and clashing column names."""
    long_text = " ".join(f"{w}{i % 97}" for i, w in enumerate(WORDS * 1500))
    same = prose(3, 40)
    rows = [
        (1, same, "en", "a"), (2, same, "en", "b"), (3, same.replace(" ", "\n"), "en", "b"),
        (4, prose(5, 60), "en", None), (5, prose(5, 60) + " more", "en", "a"), (5, prose(5, 60) + " more", "en", "a"),
        (6, None, "en", "a"), (7, "", None, "c"), (8, " \t\n\x0b\f\r ", "de", "c"), (9, "1234 5678 !!", "de", "a"),
        (10, long_text, "de", "b"), (11, "été œuvre naïve ſ K İ 日本語 𝔘𝔫𝔦 " + prose(8, 30), "fr", "é"),
        (12, "x", "fr", ""), (None, same, None, None), (None, None, None, None), (13, prose(9, 25), "fr", "a"),
    ]
    rows += [(20 + i, prose(40 + i % 9, 12 + i % 5), ("en", "de", "fr")[i % 3], ("a", "b")[i % 2]) for i in range(60)]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] else None, "d", -1, "k", 3, None, 7) for r in rows], DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
