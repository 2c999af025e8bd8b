"""Session settings the engine relies on."""

from __future__ import annotations

import os
import logging
import tempfile
import time
import uuid

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("threadkeeper.session")

# Runtime SQL settings applied to whatever session the caller hands us.  All
# are session-scoped, so they can be set on a shared cluster session.
RUNTIME_CONF = {
    # Every timestamp is a UTC instant; Pacific dates are derived explicitly.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn joins into broadcasts only when the *measured*
    # side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "threadkeeper") -> SparkSession:
    """Session for tests and the local benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("THREADKEEPER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    The cluster names it in ``spark.checkpoint.dir``; only a local-mode session
    without that setting (tests) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running multi-phase jobs")
        configured = tempfile.mkdtemp(prefix="threadkeeper-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# Nothing reads the shuffle files of a write again: they go when it ends, not
# when the driver happens to collect its garbage.
CUT_CONF = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# A bucketed table is read bucket by bucket even if no join gains by it, so a
# task of the write holds whole buckets.
BUCKET_CONF = CUT_CONF | {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false"}


def cut_lineage(df: DataFrame, *partition_by: str) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from the written files.

    Survives the loss of executors (the data lives on the shared file
    system, not in executor memory or local disks), keeps later plans small,
    and gives the next joins real file-size statistics for AQE's broadcast /
    skew decisions.  ``partition_by`` columns become partitions that later
    filters prune.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tk-{uuid.uuid4().hex}"
    t0 = time.time()
    # written texts are most of a run's bytes: zstd keeps them smaller than the default
    writer = df.write.option("compression", "zstd")
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    with _settings(spark, CUT_CONF):
        writer.parquet(path)
    if log.isEnabledFor(logging.DEBUG):
        import traceback

        caller = traceback.extract_stack(limit=3)[0]
        log.debug("materialised %s:%s in %.2fs", caller.name, caller.lineno, time.time() - t0)
    # the schema is known: no footer is read for it, an empty table works too
    return spark.read.schema(df.schema).parquet(path)


def cut_buckets(df: DataFrame, key: str, *partition_by: str) -> DataFrame:
    """``cut_lineage`` to one of Spark's bucketed tables: later joins,
    aggregates and windows on ``key`` read it without a shuffle.

    There are as many buckets as shuffle partitions.  ``df`` is laid out by
    ``key`` already (it ends in an exchange, a join or a bucketed read by it);
    any other result is written right too, but in many small files.
    """
    spark = df.sparkSession
    name = f"tk_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("compression", "zstd").option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    writer = writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key)
    writer = writer.partitionBy(*partition_by) if partition_by else writer
    with _settings(spark, BUCKET_CONF):
        writer.saveAsTable(name)
    return spark.table(name).select(*df.columns)


def wall_clock(df: DataFrame) -> DataFrame:
    """Present UTC instants as timezone-free wall-clock values.

    Results compared with another engine (or collected into Python) then do
    not depend on the local time zone of the collecting process.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
