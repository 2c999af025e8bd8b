"""STR-2: incremental sync of landed snapshots.

A snapshot is all rows of one ``observed_at``; its manifest says how many there
are.  Files of a snapshot may land in any number of pieces, before or after
their manifest.  Two small streams keep what is known: which file holds how
many rows of which snapshot, and the manifests.  A snapshot is applied once it
is whole, in order of observation, so a later one waits for an earlier one
that is still landing; ``waiting`` lists those with what they lack.

Applying a snapshot runs the whole lifecycle fold with the run time taken from
the data, takes the outbox into the document table and commits a new state
version tagged with that time: a replay, or a new checkpoint, applies no
snapshot twice and skips none.  The rows themselves are read from the landed
files again, they are not copied.

``trigger(availableNow=True)``: process what has landed, then stop (the
scheduled-job form of a stream).  The intake's own streams are in ``feeds``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadkeeper.params import SyncParams
from threadkeeper.plans import lifecycle as L
from threadkeeper.plans.doctable import DocumentTable
from threadkeeper.plans.store import StateStore
from threadkeeper.schemas import RAW_POST_SCHEMA

MANIFEST = "observed_at timestamp, n_rows bigint"
LANDED = "observed_at timestamp, file string, n_rows bigint"


def write_manifest(snapshots: DataFrame, path: str) -> None:
    """One manifest row per snapshot in ``snapshots``: its whole number of rows."""
    rows = snapshots.where("observed_at is not null").groupBy("observed_at").agg(F.count(F.lit(1)).alias("n_rows"))
    rows.coalesce(1).write.mode("append").parquet(path)


class SnapshotSync:
    def __init__(
        self, spark: SparkSession, landing: str, manifests: str, raw_comments: DataFrame, sinks: DataFrame,
        store: StateStore, documents: DocumentTable, checkpoint: str, params: SyncParams,
    ):
        self.spark, self.landing, self.manifests, self.checkpoint = spark, landing, manifests, checkpoint.rstrip("/")
        self.raw_comments, self.sinks, self.store, self.documents, self.params = raw_comments, sinks, store, documents, params
        self.known = {"landed": LANDED, "manifest": MANIFEST}

    def _path(self, name: str) -> str:
        return f"{self.checkpoint}/known-{name}"

    def _note(self, name: str, rows: DataFrame, batch_id: int) -> None:
        """Keep a micro-batch's rows; a replayed batch overwrites its own."""
        rows.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(self._path(name))

    def _known(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.known[name]).parquet(self._path(name))

    def run(self) -> None:
        """Take in what has landed, then apply every snapshot that is whole."""
        files = self.spark.readStream.schema(RAW_POST_SCHEMA).parquet(self.landing).select("observed_at", F.col("_metadata.file_path").alias("file"))
        manifests = self.spark.readStream.schema(MANIFEST).parquet(self.manifests)

        def landed(batch: DataFrame, batch_id: int) -> None:
            rows = batch.where("observed_at is not null").groupBy("observed_at", "file").agg(F.count(F.lit(1)).alias("n_rows"))
            self._note("landed", rows, batch_id)

        def announced(batch: DataFrame, batch_id: int) -> None:
            self._note("manifest", batch, batch_id)

        for name, src, take in (("landed", files, landed), ("manifest", manifests, announced)):
            empty = self.spark.createDataFrame([], self.known[name] + ", batch bigint")
            empty.write.mode("ignore").partitionBy("batch").parquet(self._path(name))
            q = src.writeStream.foreachBatch(take).option("checkpointLocation", f"{self.checkpoint}/{name}").trigger(availableNow=True).start()
            q.awaitTermination()
        self.apply_whole()

    def waiting(self) -> DataFrame:
        """Announced snapshots that no state version has yet: rows expected and landed."""
        want = self._known("manifest").groupBy("observed_at").agg(F.max("n_rows").alias("n_rows"))
        have = self._known("landed").groupBy("observed_at").agg(F.sum("n_rows").alias("landed"))
        done = self.store.batches().select(F.col("batch_id"))
        keyed = want.withColumn("batch_id", F.concat(F.lit("snapshot-"), F.unix_micros("observed_at").cast("string")))
        open_ = keyed.join(done, "batch_id", "left_anti")
        return open_.join(have, "observed_at", "left").select("observed_at", "n_rows", F.coalesce("landed", F.lit(0)).cast("bigint").alias("landed"))

    def apply_whole(self) -> None:
        # one row per announced snapshot that isn't applied yet
        for row in self.waiting().select(F.unix_micros("observed_at").alias("m"), "n_rows", "landed").orderBy("m").collect():
            if row["landed"] < row["n_rows"]:
                return
            self._apply(row["m"])

    def _apply(self, micros: int) -> None:
        run_ts = dt.datetime.fromtimestamp(micros / 1_000_000, tz=dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        p = self.params.at(run_ts)
        here = F.unix_micros("observed_at") == micros
        names = [r["file"] for r in self._known("landed").where(here).select("file").distinct().collect()]
        state = self.store.read()
        snapshot = self.spark.read.schema(RAW_POST_SCHEMA).parquet(*names).where(here) if names else self.spark.createDataFrame([], RAW_POST_SCHEMA)
        obs = L.observe(snapshot, self.raw_comments, p, L.refresh_ids(state, p))
        result = L.run(state, obs, self.sinks, p, index=self.documents.documents(), pending=self.documents.pending())
        # documents first: applied again after a failure they end the same
        self.documents.apply(result)
        self.store.write(result.state, f"snapshot-{micros}", run_ts, obs.rejects)
