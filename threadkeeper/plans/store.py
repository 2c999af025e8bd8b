"""Versioned state store on plain Parquet (no MERGE needed).

Layout under ``root`` (a shared folder on the cluster's file system):

    <root>/<table>/v=<n>/part-*.parquet     one directory per table version
    <root>/_versions/part-*.parquet         commit log: (version, batch_id, run_ts)

A version becomes visible only when its commit row is appended, after every
table of that version is written, so readers always see one consistent
version.  A batch id that is already committed is not applied again, which
makes replays of a micro-batch a no-op.  All I/O goes through Spark, so the
store works on HDFS / object stores as well as local disks.

With ``buckets`` the tables are Spark's own bucketed tables (catalog tables at
the same paths), hashed and sorted by the post's id: with as many buckets as
``spark.sql.shuffle.partitions`` a run joins tracked and posts without
shuffling them.  The commit log keeps the number of buckets of a version.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadkeeper.plans.lifecycle import State

KEYS = {"tracked": "post_id", "posts": "id", "comments": "post_id", "queue": "post_id"}
COMMIT = "version int, batch_id string, run_ts string, buckets int"
TABLES = ("tracked", "posts", "comments", "queue")


class StateStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets

    def _log(self) -> DataFrame | None:
        log = f"{self.root}/_versions"
        target = self.spark._jvm.org.apache.hadoop.fs.Path(log)
        if not target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target):
            return None
        return self.spark.read.schema(COMMIT).parquet(log)

    def current_version(self) -> int | None:
        log = self._log()
        if log is None:
            return None
        row = log.agg(F.max("version").alias("v")).first()
        return None if row is None or row["v"] is None else int(row["v"])

    def batches(self) -> DataFrame:
        """(version, batch_id, run_ts) of every commit."""
        log = self._log()
        return self.spark.createDataFrame([], COMMIT) if log is None else log

    def has_batch(self, batch_id: str) -> bool:
        log = self._log()
        return log is not None and log.where(F.col("batch_id") == batch_id).limit(1).count() > 0

    def read(self, version: int | None = None) -> State:
        v = self.current_version() if version is None else version
        if v is None:
            raise LookupError(f"no committed version under {self.root}")
        log = self._log()
        row = log.where(F.col("version") == v).select("buckets").first()
        n = None if row is None else row["buckets"]
        return State(**{name: self._bucketed(name, v, n) if n else self.spark.read.parquet(self._path(name, v)) for name in TABLES})

    def _path(self, name: str, v: int) -> str:
        return f"{self.root}/{name}/v={v}"

    def _bucketed(self, name: str, v: int, buckets: int) -> DataFrame:
        """A bucketed table of this version; a session that didn't write it learns of it first."""
        table, path = self._name(name, v), self._path(name, v)
        if not self.spark.catalog.tableExists(table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema.fields)
            key = KEYS[name]
            self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(table)

    def _name(self, name: str, v: int) -> str:
        return f"threadkeeper_{hashlib.md5(self.root.encode()).hexdigest()}_{name}_{v}"

    def rejects(self, version: int | None = None) -> DataFrame:
        """SRC-7: the landed rows that the run of a version could not take, with the reason."""
        v = self.current_version() if version is None else version
        return self.spark.read.parquet(f"{self.root}/rejects/v={v}")

    def write(self, state: State, batch_id: str, run_ts: str, rejects: DataFrame | None = None) -> int:
        """Write every table of ``state`` (and the run's rejects) as the next version, then commit."""
        if self.has_batch(batch_id):
            return self.current_version()  # replay: already applied
        cur = self.current_version()
        v = 0 if cur is None else cur + 1
        for name in TABLES:
            df: DataFrame = getattr(state, name)
            if not self.buckets:
                df.write.mode("overwrite").parquet(self._path(name, v))
                continue
            # dealt like the buckets, so a task writes one file
            dealt = df.repartition(self.buckets, KEYS[name]).write.mode("overwrite").option("path", self._path(name, v))
            dealt.bucketBy(self.buckets, KEYS[name]).sortBy(KEYS[name]).saveAsTable(self._name(name, v))
        if rejects is not None:
            rejects.write.mode("overwrite").parquet(f"{self.root}/rejects/v={v}")
        commit = self.spark.createDataFrame([(v, batch_id, run_ts, self.buckets)], COMMIT)
        commit.coalesce(1).write.mode("append").parquet(f"{self.root}/_versions")
        return v
