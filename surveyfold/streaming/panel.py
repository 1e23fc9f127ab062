"""Incremental panel build with Structured Streaming (U2 / T12 as files arrive).

The source's runner stacks one output file per (table, year) into a panel
by looping over years. When period files arrive over time, the same stack
is a file-source stream: every new ``{table}_{yyyy}.csv`` is read once,
tagged with its year from the path, and appended to a Parquet panel
partitioned by year. Progress lives in a checkpoint in the shared folder,
so a restarted job resumes without re-reading or duplicating files. Files
must have the schema's columns in its order; another header or a cell that
does not fit its type fails the query.

A source that sends a year again, corrected, puts it in the folder of a later
delivery, ``{delivery}/{table}_{yyyy}.csv``. :func:`start_published_panel_stream`
then publishes a panel whose parts are (table, year): the rows of the latest
delivery replace those of any earlier one, as a whole and once.
"""

from __future__ import annotations

import hashlib
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import checkpoint_root
from ..sources.files import write_table
from ..sources.published import BUILDS, manifest, publish


def start_panel_stream(spark: SparkSession, directory: str, table: str,
                       schema: str | StructType, out_path: str,
                       checkpoint: str | None = None,
                       available_now: bool = True) -> StreamingQuery:
    """Stream ``{directory}/{table}_{yyyy}.csv`` files into a year-partitioned panel."""
    stream = (spark.readStream.option("header", True).option("nullValue", "NA")
              .option("mode", "FAILFAST").option("enforceSchema", False).schema(schema).csv(f"{directory.rstrip('/')}/{table}_[0-9][0-9][0-9][0-9].csv"))
    year = F.regexp_extract(F.col("_metadata.file_path"),
                            rf"/{re.escape(table)}_(\d{{4}})\.csv$", 1).cast("int")
    tagged = stream.withColumn("year", year)
    tagged = tagged.select("year", *[c for c in tagged.columns if c != "year"])
    # progress belongs to one (source, output) pair: a new output starts from the first file
    pair = hashlib.sha256(f"{directory}\n{table}\n{out_path}".encode()).hexdigest()[:16]
    ckpt = checkpoint or os.path.join(checkpoint_root(spark), f"panel-{table}-{pair}")
    writer = (tagged.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", ckpt).partitionBy("year"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out_path)


def start_published_panel_stream(spark: SparkSession, directory: str, table: str, schema: str | StructType,
                                 out_dir: str, checkpoint: str | None = None, fmt: str = "parquet",
                                 available_now: bool = True) -> StreamingQuery:
    """Stream ``{directory}/{delivery}/{table}_{yyyy}.csv`` into published parts, one per year.

    ``delivery`` is a number; the highest one of a year holds. Each micro-batch
    writes the years it brings to a folder of its own and publishes them with
    their deliveries in one manifest, so readers (``read_published_panel``) see
    a corrected year whole or not at all. A batch that runs again after a crash
    writes the same folder again, or finds its deliveries published and does
    nothing; an earlier delivery that arrives late is passed over. A delivery
    without rows replaces nothing. Per batch the driver sees a row per year.
    """
    stream = (spark.readStream.option("header", True).option("nullValue", "NA")
              .option("mode", "FAILFAST").option("enforceSchema", False).schema(schema)
              .csv(f"{directory.rstrip('/')}/[0-9]*/{table}_[0-9][0-9][0-9][0-9].csv"))
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    columns = [c for c in kind.names if c != "year"]
    # a period file may be one file or a folder of part files
    where = rf"/(\d+)/{re.escape(table)}_(\d{{4}})\.csv(/[^/]*)?$"
    path = F.col("_metadata.file_path")
    tagged = stream.select(F.regexp_extract(path, where, 1).cast("long").alias("__delivery"),
                           F.regexp_extract(path, where, 2).cast("int").alias("__year"), *columns)
    pair = hashlib.sha256(f"{directory}\n{table}\n{out_dir}".encode()).hexdigest()[:16]

    def apply(batch: DataFrame, number: int) -> None:
        held = {e["part"]: e.get("delivery", 0) for e in manifest(spark, out_dir)["entries"] if e["table"] == table}
        sent = batch.groupBy("__year").agg(F.max("__delivery").alias("delivery")).collect()
        todo = {r["__year"]: r["delivery"] for r in sent if r["delivery"] > held.get(str(r["__year"]), -1)}
        if not todo:
            return
        chosen = spark.createDataFrame(list(todo.items()), "__year int, __delivery long")
        rows = batch.join(F.broadcast(chosen), ["__year", "__delivery"])       # a row per year
        build = f"{BUILDS}/stream-{pair}-{number}"
        write_table(rows.select(F.col("__year").alias("part"), *columns), f"{out_dir.rstrip('/')}/{build}", fmt,
                    partition_by=["part"])
        inside = StructType([kind[c] for c in columns]).json()
        publish(spark, out_dir, [{"table": table, "part": str(year), "path": f"{build}/part={year}", "format": fmt,
                                  "schema": inside, "delivery": delivery} for year, delivery in sorted(todo.items())])

    writer = (tagged.writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint or os.path.join(checkpoint_root(spark), f"published-{table}-{pair}")))
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
