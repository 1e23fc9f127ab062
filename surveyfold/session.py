"""Session construction, lineage cuts and size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side must have a row bound that is proven by how its keys are
# built (e.g. 25 nations x 40 units x 7 zones), never one observed on a sample.
# Above this many rows we leave the join to the planner / AQE instead.
BROADCAST_ROW_LIMIT = 2_000_000


def is_local(spark: SparkSession) -> bool:
    """True for a single-JVM ``local[...]`` master (tests, bench, laptops)."""
    return (spark.conf.get("spark.master", "") or "").startswith("local")


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "surveyfold") -> SparkSession:
    """Local session for tests and the bench (the cluster supplies its own)."""
    parts = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # In one local JVM a broadcast hash table is built by a single task;
        # a fact-sized side (a few MB on disk at small scale factors) must not
        # be chosen for it. Bounded dimensions are hinted and unaffected.
        .config("spark.sql.autoBroadcastJoinThreshold", "1m")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "1m")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.ansi.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Settings for the cluster target (~100 TB input, ~1000 executors). The
# cluster's own submit configuration applies them; nothing here overrides a
# value the session already has.
CLUSTER_CONF = {
    # AQE re-plans with measured sizes: coalesces small shuffle partitions,
    # turns sort-merge joins with a small measured side into broadcast joins,
    # and splits skewed partitions of a hot key across tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # for everything but the person joins: roll-ups of an aggregate that the
    # code lists bound, where a high number would be scheduling only
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.files.maxPartitionBytes": "512m",
    # only bounded dimensions are hinted; measured sides up to 64 MB may be
    # broadcast by AQE as well
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
}


# ~100 TB of person joins shuffles a few tens of TB per join, i.e. ~100k
# partitions of ~256 MB to begin with; AQE coalesces from there.
PERSON_PASS_PARTITIONS = 100_000


@contextmanager
def person_pass(spark: SparkSession):
    """Many shuffle partitions while the person joins run (cluster settings only)."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if before == CLUSTER_CONF[name]:
        spark.conf.set(name, str(PERSON_PASS_PARTITIONS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def apply_cluster_conf(spark: SparkSession) -> None:
    """Fill in :data:`CLUSTER_CONF` for every key the submitted configuration
    does not name (built-in defaults are replaced, explicit settings kept)."""
    try:
        submitted = spark.sparkContext.getConf()
        named = submitted.contains
    except Exception:   # no SparkContext on a Connect session: runtime conf only
        def named(key):
            return spark.conf.get(key, None) not in (None, "")
    for key, value in CLUSTER_CONF.items():
        if not named(key):
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Uses ``spark.checkpoint.dir`` when the cluster names one. Only when it is
    unset (local tests) is a private scratch folder created and registered.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: a machine-local "
                               "folder does not survive the loss of an executor")
        conf_dir = tempfile.mkdtemp(prefix="surveyfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    return conf_dir


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as Parquet into the shared checkpoint folder.

    Survives executor loss (the data lives in the shared folder, not on the
    executors' local disks) and stops recomputation of the upstream joins
    when several products reuse the frame. A written table is used rather
    than ``Dataset.checkpoint``: a reliable RDD checkpoint evaluates the plan
    once for its action and again to write the checkpoint files, while a
    Parquet write evaluates it once, and the read-back gets column pruning.
    """
    return stage_table(df, name)


def stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    out = spark.read.parquet(path)
    out.staged_path = path
    return out


def stage_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Write ``df`` bucketed and sorted by ``keys`` and read it back.

    Two tables with the same keys and buckets join on them without an exchange.
    Buckets are known to the catalog only, so the files (in the shared folder)
    are an external table until :func:`unstage`. Rows are dealt to their buckets
    before the write, so each bucket is one file. A bucket has to fit the join's
    sort: take bytes / 256 MB for the number.
    """
    spark = df.sparkSession
    unique = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = os.path.join(checkpoint_root(spark), unique)
    (df.repartition(buckets, *keys).write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
     .format("parquet").saveAsTable(unique))
    out = spark.table(unique)
    out.staged_path, out.staged_table = path, unique
    return out


def unstage(df: DataFrame) -> None:
    """Delete the folder behind a frame of :func:`stage_table` (or
    :func:`stage_bucketed`, and its table); it is unusable then."""
    path = df.staged_path
    if hasattr(df, "staged_table"):
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.staged_table}")
    jvm = df.sparkSession._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def broadcast_bounded(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast hint for a side whose row count is bounded by construction.

    ``max_rows`` is the proven upper bound (from key construction or a fixed
    code list). Without one (None: a table read from a file), or if it exceeds
    :data:`BROADCAST_ROW_LIMIT`, the frame is returned unhinted and the planner
    (AQE, with measured sizes) decides.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROW_LIMIT:
        return F.broadcast(df)
    return df
