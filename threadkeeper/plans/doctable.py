"""SNK-5/SNK-4 across runs: the document index and the DELETEs still owed, as
Parquet tables partitioned by the posts' day of creation.

A run touches few days: posts are refreshed for some days and then frozen.
``merge`` reads only the partitions of the days that the outbox names
(partition pruning), applies the operations to them and writes them back by
dynamic partition overwrite; all other partitions keep their files.  The merged
partitions are written to the checkpoint folder first, so a job that dies while
it writes can be run again on the same inputs: operations put, replace or
remove whole documents, applying them twice changes nothing.

The days come to the driver (one value per touched day), documents never do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadkeeper.operators import outbox as O
from threadkeeper.plans.lifecycle import RunResult
from threadkeeper.session import cut_lineage

DOCUMENTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("doc_id", "post_id", "html", "metadata_json")] + [T.StructField("size_bytes", T.LongType()), T.StructField("day", T.DateType())]
)
PENDING = T.StructType([T.StructField(c, T.StringType()) for c in ("post_id", "doc_key", "error")] + [T.StructField("failed_at", T.TimestampType()), T.StructField("day", T.DateType())])


class DocumentTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.paths = {"documents": f"{root.rstrip('/')}/documents", "pending": f"{root.rstrip('/')}/pending_deletes"}
        for name, schema in (("documents", DOCUMENTS), ("pending", PENDING)):
            if not self._exists(self.paths[name]):
                spark.createDataFrame([], schema).write.mode("append").parquet(self.paths[name])

    def documents(self) -> DataFrame:
        """The index: doc_id, post_id, html, metadata_json, size_bytes, day."""
        return self.spark.read.schema(DOCUMENTS).parquet(self.paths["documents"])

    def pending(self) -> DataFrame:
        """DELETEs that no run has delivered yet: post_id, doc_key, error, failed_at, day."""
        return self.spark.read.schema(PENDING).parquet(self.paths["pending"])

    def apply(self, result: RunResult) -> None:
        """Take in a run that was given ``pending()``: its outbox goes to the
        index, and what it could not delete is owed to the next run."""
        # written first: the outbox may itself be planned over this table
        box, owed = cut_lineage(result.outbox), cut_lineage(result.pending_deletes)
        self.merge(box)
        days = owed.select("day").union(self.pending().select("day")).distinct()
        self._replace("pending", owed, [r["day"] for r in days.collect()])

    def merge(self, box: DataFrame) -> list:
        """Apply an outbox (with day) to the partitions it touches; returns their days."""
        days = [r["day"] for r in box.select("day").distinct().collect()]
        self._replace("documents", O.apply_to_index(self._of_days(days), box), days)
        return days

    def _of_days(self, days: list) -> DataFrame:
        return self.documents().where(self._on(days))

    @staticmethod
    def _on(days: list):
        known = [d for d in days if d is not None]
        on = F.col("day").isin(known) if known else F.lit(False)
        return on | F.col("day").isNull() if None in days else on

    def _replace(self, name: str, rows: DataFrame, days: list) -> None:
        """Make ``rows`` the whole content of the partitions ``days``."""
        new = cut_lineage(rows)
        # partitions of even size: a day that holds much is written by several tasks
        dealt = new.hint("rebalance", "day")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("day").parquet(self.paths[name])
        left = {r["day"] for r in new.select("day").distinct().collect()}
        for day in days:  # a partition without rows is not overwritten
            if day not in left:
                self._drop(f"{self.paths[name]}/day={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")

    def _file_system(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, path: str) -> bool:
        target, fs = self._file_system(path)
        return fs.exists(target)

    def _drop(self, path: str) -> None:
        target, fs = self._file_system(path)
        fs.delete(target, True)
