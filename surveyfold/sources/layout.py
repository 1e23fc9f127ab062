"""Fixed-width extracts and their codebook, written from a typed frame (S1, S2 the other way).

``layout_of`` gives every column a start and a width from one aggregate over the
frame; ``write_fixed_width`` makes one line per row by native expressions, and
``write_codebook`` the XML that ``codebook.read_codebook`` reads: a ``var``
element per column with its location, implied decimals and value labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Field(NamedTuple):
    name: str
    start: int               # from 1
    width: int
    dcml: int = 0


def field_text(name: str, dcml: int = 0) -> Column:
    """A value as it stands in its field, not padded: NULL is blank, a number has
    its decimals implied. A number with more decimals than that, and text that
    blanks or line ends would not bring back, fail the job."""
    value = F.col(name)
    if dcml:
        exact = value.cast(f"decimal(30,{dcml})")
        told = (exact * 10 ** dcml).cast("decimal(38,0)").cast("string")
        # finer decimals of any type show in the wider cast
        bad = value.isNotNull() & (exact.isNull() | (value.cast("decimal(38,12)") != exact))
    else:
        told = value.cast("string")
        bad = (told != F.trim(told)) | told.rlike("[\r\n]") | (told == "")
    problem = F.concat(F.lit(f"{name}: no field can hold '"), told, F.lit("'"))
    return F.when(F.coalesce(bad, F.lit(False)), F.raise_error(problem).cast("string")).otherwise(F.coalesce(told, F.lit("")))


def layout_of(df: DataFrame, columns: Sequence[str] | None = None, dcml: dict[str, int] | None = None) -> list[Field]:
    """Columns side by side, each as wide as its longest value (one aggregate over the frame)."""
    columns, dcml = list(columns or df.columns), dcml or {}
    widths = df.agg(*[F.coalesce(F.max(F.length(field_text(c, dcml.get(c, 0)))), F.lit(0)).alias(c) for c in columns]).first()
    out, start = [], 1
    for c in columns:
        width = max(1, widths[c])
        out.append(Field(c, start, width, dcml.get(c, 0)))
        start += width
    return out


def write_fixed_width(df: DataFrame, path: str, layout: Sequence[Field]) -> None:
    """One line per row; fields of the layout need not follow each other. A value
    that is wider than its field fails the job. Lines come in no order."""
    parts, at = [], 1
    for f in sorted(layout, key=lambda f: f.start):
        if f.start < at:
            raise ValueError(f"{f.name}: its field overlaps the one before")
        text = field_text(f.name, f.dcml)
        wide = F.raise_error(F.concat(F.lit(f"{f.name}: wider than {f.width}: '"), text, F.lit("'"))).cast("string")
        parts += [F.lit(" " * (f.start - at)), F.when(F.length(text) > f.width, wide).otherwise(F.lpad(text, f.width, " "))]
        at = f.start + f.width
    df.select(F.concat(*parts).alias("value")).write.mode("errorifexists").text(path)


def write_codebook(spark: SparkSession, path: str, layout: Sequence[Field], value_labels: DataFrame | None = None,
                   labels: dict[str, str] | None = None) -> None:
    """S1's input: one ``var`` element per field, with the labels of its values.

    ``value_labels``: ``name, value, label``, joined to its field; a dictionary's
    size is that of a code list. A field without labels has no ``catgry``.
    """
    rows = [(f.name, f.start, f.start + f.width - 1, f.width, f.dcml, (labels or {}).get(f.name, f.name)) for f in layout]
    fields = spark.createDataFrame(rows, "name string, start int, stop int, width int, dcml int, label string")
    if value_labels is None:
        value_labels = spark.createDataFrame([], "name string, value int, label string")
    lists = value_labels.groupBy("name").agg(F.sort_array(F.collect_list(F.struct(
        F.col("value").alias("catValu"), F.col("label").alias("labl")))).alias("catgry"))
    (fields.join(lists, "name", "left").coalesce(1).sortWithinPartitions("start")
     .select(F.col("name").alias("_ID"), F.col("name").alias("_name"), F.col("dcml").alias("_dcml"),
             F.struct(F.col("start").alias("_StartPos"), F.col("stop").alias("_EndPos"), F.col("width").alias("_width")).alias("location"),
             F.col("label").alias("labl"), "catgry")
     .write.format("xml").option("rootTag", "codeBook").option("rowTag", "var").mode("errorifexists").save(path))
