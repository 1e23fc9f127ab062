"""Codebook-driven microdata scan.

S1 reads the XML codebook that ships beside a fixed-width extract (one
``<var>`` element per variable, with its location, implied decimals and
value labels) into two small tables, ``variables`` and ``value_labels``.
S2 scans the fixed-width text with one ``select`` of ``substring``
expressions built from ``variables``; the scan is split by Spark like any
text file, so it parallelises over the whole extract. Stage the result to
Parquet once: later reads then get column pruning and pushed filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegralType

VARIABLES_SCHEMA = "name string, start int, width int, dcml int, label string"


def read_codebook(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(variables, value_labels)`` from an XML codebook.

    ``variables``: ``name, start, width, dcml, label``.
    ``value_labels``: ``name, value, label`` (one row per category).
    """
    raw = (spark.read.format("xml").option("rowTag", "var")
           .option("attributePrefix", "_").option("valueTag", "_VALUE").load(path))
    loc = F.col("location")
    # the variable name attribute; some codebooks carry only ID
    name = F.coalesce(*[F.col(c).cast("string") for c in ("_name", "_ID") if c in raw.columns])
    variables = raw.select(
        name.alias("name"),
        loc["_StartPos"].cast("int").alias("start"),
        loc["_width"].cast("int").alias("width"),
        # columns of the XML reader are those that the file has somewhere
        F.coalesce(_given(raw, "_dcml").cast("int"), F.lit(0)).alias("dcml"),
        _given(raw, "labl").cast("string").alias("label"),
    )
    if "catgry" in raw.columns:
        cat = F.col("catgry")
        # one category in the whole file is inferred as a struct, not a list
        if not isinstance(raw.schema["catgry"].dataType, ArrayType):
            cat = F.array(cat)
        cats = raw.select(name.alias("name"), F.explode_outer(cat).alias("c"))
        labels = cats.where(F.col("c").isNotNull()).select(
            "name",
            F.col("c.catValu").cast("string").try_cast("int").alias("value"),
            F.col("c.labl").cast("string").alias("label"))
    else:
        labels = spark.createDataFrame([], "name string, value int, label string")
    return variables, labels


def _given(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def _field(line: Column, start: int, width: int, dcml: int, as_text: bool) -> Column:
    raw = F.trim(F.substring(line, start, width))
    if as_text:
        return F.when(raw != "", raw)
    num = raw.try_cast("bigint")
    if dcml:
        return (num.cast("decimal(38,0)") / F.lit(10 ** dcml)).cast(f"decimal(18,{dcml})")
    return num


def read_fixed_width(spark: SparkSession, path: str, variables: DataFrame,
                     keep: list[str] | None = None, text_columns: tuple[str, ...] = ()) -> DataFrame:
    """Fixed-width scan driven by the layout; implied decimals applied.

    The layout (one row per variable, a few hundred at most) is read on the
    driver to build the projection; the data itself never leaves the
    executors. Blank fields become NULL (``try_cast``); ``text_columns``
    stay strings (codes such as ``OCCSOC``).
    """
    layout = variables.orderBy("start").collect()
    wanted = set(keep) if keep else None
    line = F.col("value")
    cols = []
    for v in layout:
        if wanted is not None and v["name"] not in wanted:
            continue
        cols.append(_field(line, v["start"], v["width"], v["dcml"] or 0,
                           v["name"] in text_columns).alias(v["name"]))
    return spark.read.text(path).select(*cols)


# where a column keeps its value labels, and how many it may have there
LABELS_KEY, MOST_LABELS = "value_labels", 500


def with_value_labels(df: DataFrame, labels: DataFrame, most: int = MOST_LABELS) -> DataFrame:
    """Labelled integers: each whole-number column carries its dictionary as metadata.

    A variable with more than ``most`` labels carries none (and is decoded by a
    join). The metadata goes through projections, grouping keys and Parquet, so
    a small dictionary decodes anywhere without a join. At most ``most`` rows
    per column reach the driver.
    """
    whole = [f.name for f in df.schema.fields if isinstance(f.dataType, IntegralType)]
    own = labels.where(F.col("name").isin(whole) & F.col("value").isNotNull() & F.col("label").isNotNull())
    small = [r["name"] for r in own.groupBy("name").count().where(F.col("count") <= most).collect()]
    held: dict[str, dict[str, str]] = {}
    for r in own.where(F.col("name").isin(small)).select("name", "value", "label").collect() if small else ():
        held.setdefault(r["name"], {})[str(r["value"])] = r["label"]
    for name, dictionary in held.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, LABELS_KEY: dictionary})
    return df


def labels_of(df: DataFrame, column: str) -> dict[int, str] | None:
    """The dictionary that a column carries, None if it carries none."""
    held = df.schema[column].metadata.get(LABELS_KEY)
    return None if held is None else {int(k): v for k, v in held.items()}
