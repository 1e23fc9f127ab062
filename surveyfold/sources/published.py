"""Published builds: a commit manifest over immutable build folders.

A build writes its tables under ``{out}/_builds/{build}/`` and touches nothing
that is already there. What readers see is the newest manifest,
``{out}/_manifests/{version}.json``: for every (table, part) the folder, format
and schema of its rows. A manifest starts from the one before and replaces the
entries of the new build, and it appears by one rename that fails if the
version exists; a writer that loses the race merges into the newer manifest and
tries again. So a build is seen whole or not at all, a build that dies half-way
leaves only a folder that no manifest names, and a reader that holds a version
keeps reading it while others publish. The rename must be atomic in the folder's
file system (HDFS and local disks; an object store needs a committer that gives
the same).

Manifests are small: an entry per table and part. Rows never pass the driver.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import read_csv, write_table

BUILDS, MANIFESTS = "_builds", "_manifests"


class Folder:
    """The few file-system calls that a manifest needs, through Hadoop, so that
    any scheme works that Spark itself reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.gateway = spark.sparkContext._gateway
        self.conf = spark._jsparkSession.sessionState().newHadoopConf()
        root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = root.getFileSystem(self.conf)
        self.root = self.fs.makeQualified(root)

    def at(self, *names: str):
        path = self.root
        for name in names:
            path = self.jvm.org.apache.hadoop.fs.Path(path, name)
        return path

    def listed(self, *names: str) -> list[tuple[str, int]]:
        """(name, time of change in ms) of what lies in a folder; none if there is no such folder."""
        path = self.at(*names)
        if not self.fs.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime()) for s in self.fs.listStatus(path)]

    def text(self, *names: str) -> str:
        stream = self.fs.open(self.at(*names))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, text: str, folder: str, name: str) -> bool:
        """Make a file appear whole; False if there is one of that name."""
        temp, final = self.at(folder, f".{uuid.uuid4().hex}"), self.at(folder, name)
        stream = self.fs.create(temp)
        stream.write(bytearray(text.encode()))
        stream.close()
        plain = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf)
        try:
            context.rename(temp, final, plain)
            return True
        except Py4JJavaError as refused:
            if "FileAlreadyExistsException" not in refused.java_exception.getClass().getName():
                raise
            self.fs.delete(temp, False)
            return False

    def delete(self, *names: str) -> None:
        self.fs.delete(self.at(*names), True)


def versions(spark: SparkSession, out_dir: str) -> list[int]:
    """Versions that were published, ascending."""
    names = (n for n, _ in Folder(spark, out_dir).listed(MANIFESTS))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, out_dir: str, version: int | None = None) -> dict:
    """The manifest of a version, the newest by default; version 0 holds nothing."""
    if version is None:
        version = max(versions(spark, out_dir), default=0)
    if version == 0:
        return {"version": 0, "entries": []}
    return json.loads(Folder(spark, out_dir).text(MANIFESTS, f"{version:010d}.json"))


def publish(spark: SparkSession, out_dir: str, entries: list[dict], attempts: int = 50) -> int:
    """Make written folders visible at once; returns the version that shows them.

    An entry has ``table, part, path`` (below ``out_dir``), ``format, schema`` and
    may have a ``delivery``: it then gives way to a later delivery that is
    already published, whoever comes first. Nothing new to show: the newest
    version as it is.
    """
    folder = Folder(spark, out_dir)
    for _ in range(attempts):
        old = manifest(spark, out_dir)
        seen = {(e["table"], e["part"]): e for e in old["entries"]}
        fresh = [e for e in entries if e.get("delivery", 0) >= seen.get((e["table"], e["part"]), {}).get("delivery", 0)
                 and seen.get((e["table"], e["part"])) != e]
        if not fresh:
            return old["version"]
        seen |= {(e["table"], e["part"]): e for e in fresh}
        new = {"version": old["version"] + 1, "entries": [seen[k] for k in sorted(seen)]}
        if folder.put_new(json.dumps(new, indent=1), MANIFESTS, f"{new['version']:010d}.json"):
            return new["version"]
    raise RuntimeError(f"{out_dir}: other writers published first, {attempts} times")


def publish_frames(spark: SparkSession, out_dir: str, frames: dict[str, DataFrame], part: str, fmt: str = "csv",
                   order_by: dict[str, list[str]] | None = None, build: str | None = None) -> int:
    """Write frames as one build and publish them as the given part (a period) of their tables."""
    build = build or uuid.uuid4().hex
    entries = []
    for name, df in frames.items():
        path = f"{BUILDS}/{build}/{name}"
        write_table(df, f"{out_dir.rstrip('/')}/{path}", fmt, order_by=(order_by or {}).get(name))
        entries.append({"table": name, "part": str(part), "path": path, "format": fmt, "schema": df.schema.json()})
    return publish(spark, out_dir, entries)


def read_published(spark: SparkSession, out_dir: str, table: str, parts: Iterable[str] | None = None,
                   version: int | None = None, part_col: str = "period") -> DataFrame:
    """A table of the newest (or a given) version, its parts stacked by name.

    ``part_col`` tells the part of each row and comes first. A part of ``parts``
    that is not published raises, as does a table without any.
    """
    held = {e["part"]: e for e in manifest(spark, out_dir, version)["entries"] if e["table"] == table}
    wanted = sorted(held) if parts is None else [str(p) for p in parts]
    missing = [p for p in wanted if p not in held]
    if missing or not wanted:
        raise FileNotFoundError(f"{table}: not published for {missing or 'any part'} in {out_dir}")

    def one(e: dict) -> DataFrame:
        path, schema = f"{out_dir.rstrip('/')}/{e['path']}", StructType.fromJson(json.loads(e["schema"]))
        df = read_csv(spark, path, schema) if e["format"] == "csv" else spark.read.schema(schema).format(e["format"]).load(path)
        return df.select(F.lit(e["part"]).alias(part_col), *[c for c in df.columns if c != part_col])
    return reduce(lambda a, b: a.unionByName(b), [one(held[p]) for p in wanted])


def read_published_panel(spark: SparkSession, out_dir: str, table: str, years=None, version: int | None = None) -> DataFrame:
    """The published single-year parts of a table as a panel, ``year`` (a number) first."""
    if years is None:
        years = [e["part"] for e in manifest(spark, out_dir, version)["entries"]
                 if e["table"] == table and len(e["part"]) == 4 and e["part"].isdigit()]
    df = read_published(spark, out_dir, table, [str(int(y)) for y in years], version, "year")
    return df.withColumn("year", F.col("year").cast("int"))


def vacuum(spark: SparkSession, out_dir: str, keep: int = 5, hours: float = 24) -> list[str]:
    """Delete manifests but the newest ``keep``, and builds that none of those names
    and that nobody changed for ``hours`` (a build that is being written is younger)."""
    folder = Folder(spark, out_dir)
    published = versions(spark, out_dir)
    kept = published[-keep:]
    named = {e["path"].split("/")[1] for v in kept for e in manifest(spark, out_dir, v)["entries"]}
    for v in published[:-keep]:
        folder.delete(MANIFESTS, f"{v:010d}.json")
    limit = (time.time() - 3600 * hours) * 1000
    gone = [n for n, changed in folder.listed(BUILDS) if n not in named and changed <= limit]
    for name in gone:
        folder.delete(BUILDS, name)
    return gone
