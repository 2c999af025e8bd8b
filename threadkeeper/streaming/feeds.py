"""STR-1: the intake of overlapping feed polls as stateful streams.

Two streams over one landing keep, with the batch's own rules (SRC-1..3):

* ``post``: the latest new-feed observation of every post in the window.  The
  state of a post is the order of the observation it last put out, so an older
  observation that lands late changes nothing and a newer one goes out again.
  The watermark follows the newest creation time just beyond a window's distance, and an
  event-time timer frees a post's state once it has passed the post's own: from
  then on the post is out of the window and its rows are late.
* ``hot``: the first ``hot_limit`` entries of every source's newest hot
  snapshot.  The state is the snapshot's time and the (position, id, tie) of
  those entries, however many snapshots pass.  Entries that a newer snapshot or
  a late file of the same one pushes out are put out again as removed.

Both write a change log: key (post or source), entry (a place in the hot feed),
version (counted per key), removed and the raw row.  ``current_intake`` is what
the intake shows after any number of micro-batches: the last version of every
entry that is not removed, with
the cutoff, one row per id by the batch's order, normalised.  It equals
``intake_posts`` over all landed rows, in whatever order their files came.

Rows are reduced inside each Arrow batch before the shuffle, so a post or a
source that holds a third of all rows sends little of it; rows travel as one
JSON payload that Python never opens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threadkeeper.functions import columns as C
from threadkeeper.params import SyncParams
from threadkeeper.schemas import RAW_POST_COLS, RAW_POST_SCHEMA
from threadkeeper.sources import intake as I

MICRO_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
CHANGES = "key string, entry string, version bigint, removed boolean, payload string"
NO_TIME = -(1 << 63)  # an observation without a time is older than any other


def _messages(landing: DataFrame, params: SyncParams) -> DataFrame:
    """Valid rows of the configured sources with their order columns and payload."""
    good, _ = I.split_rejects(landing)
    return I.in_sources(good, params).select(
        "id", "subreddit", "feed", "created_utc",
        F.coalesce(F.unix_micros("observed_at"), F.lit(NO_TIME)).alias("observed"),
        F.coalesce("feed_pos", F.lit(NO_TIME)).alias("feed_pos"),
        I.row_tie(RAW_POST_COLS).alias("tie"),
        F.to_json(F.struct(*RAW_POST_COLS), MICRO_FORMAT).alias("payload"),
    )


# ---------------------------------------------------------------------------
# new feed: the latest observation of every post
# ---------------------------------------------------------------------------
POST = "id string, created_ts timestamp, observed bigint, feed_pos bigint, tie bigint, payload string"
ORDER = ["observed", "feed_pos", "tie"]


def _latest_in_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        yield f.sort_values(ORDER, kind="stable").drop_duplicates("id", keep="last")


def _last_row(f: pd.DataFrame) -> int:
    """Place of the row that comes last in ORDER (of equal ones the last).

    A call per post and micro-batch: arrays, as sorting a frame of a few rows costs more than all else."""
    first, *more = [f[c].to_numpy() for c in ORDER]
    at = np.flatnonzero(first == first.max())
    for values in more:
        if len(at) == 1:
            break
        of = values[at]
        at = at[of == of.max()]
    return int(at[-1])


def _keep_latest(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    best = None
    for f in frames:
        at = _last_row(f)
        order = tuple(int(f[c].array[at]) for c in ORDER)
        if best is None or order > best[0]:
            best = order, f, at
    if best is None:
        return
    order, f, at = best
    leaves = int(f["created_ts"].array[at].timestamp() * 1000) + 1  # the watermark is a window behind the newest post
    if leaves <= state.getCurrentWatermarkMs():
        return  # the post has left the window
    version = 0
    if state.exists:
        *last, version = state.get
        if order <= tuple(last):
            return
    state.update((*order, version + 1))
    state.setTimeoutTimestamp(leaves)
    yield pd.DataFrame({"key": [key[0]], "version": [version + 1], "payload": [f["payload"].array[at]]})


def post_changes(landing: DataFrame, params: SyncParams) -> DataFrame:
    rows = _messages(landing, params).where((F.col("feed") == "new") & (F.col("created_utc") >= F.lit(I.cutoff_seconds(params))))
    rows = rows.select("id", C.epoch_to_ts("created_utc").alias("created_ts"), *ORDER, "payload")
    # a row at the watermark is late, one at the cutoff is in the window: a second between them
    reduced = rows.mapInPandas(_latest_in_batch, POST).withWatermark("created_ts", f"{params.window_hours * 3600 + 1} seconds")
    latest = reduced.groupBy("id").applyInPandasWithState(
        _keep_latest, "key string, version bigint, payload string", "observed bigint, feed_pos bigint, tie bigint, version bigint",
        "append", GroupStateTimeout.EventTimeTimeout,
    )
    return latest.select("key", F.lit("").alias("entry"), "version", F.lit(False).alias("removed"), "payload")


# ---------------------------------------------------------------------------
# hot feed: the first entries of every source's newest snapshot
# ---------------------------------------------------------------------------
HOT = "subreddit string, id string, observed bigint, feed_pos bigint, tie bigint, payload string"
PLACE = ["feed_pos", "id", "tie"]


def _newest_top(f: pd.DataFrame, limit: int) -> pd.DataFrame:
    newest = f[f["observed"] == f.groupby("subreddit")["observed"].transform("max")]
    return newest.sort_values(PLACE, kind="stable").groupby("subreddit").head(limit)


def _top_in_batch(limit: int):
    def reduce(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield _newest_top(f, limit)

    return reduce


def _keep_top(limit: int):
    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, version = NO_TIME - 1, 0
        entries: list[tuple] = []  # (feed_pos, id, tie, payload of a row of this batch)
        if state.exists:
            at, version, positions, ids, ties = state.get
            entries = [(*e, None) for e in zip(positions, ids, ties)]
        before = [e[:3] for e in entries]
        for f in frames:
            top = _newest_top(f, limit)
            seen = int(top["observed"].iloc[0])
            if seen < at:
                continue  # an older snapshot that landed late
            if seen > at:
                at, entries = seen, []
            entries += [(int(p), i, int(t), x) for p, i, t, x in zip(top["feed_pos"], top["id"], top["tie"], top["payload"])]
            entries = sorted(entries, key=lambda e: e[:3])[:limit]
        now = [e[:3] for e in entries]
        stay = set(before) & set(now)
        added = [e for e in entries if e[3] is not None and e[:3] not in stay]
        gone = [e for e in before if e not in stay]
        state.update((at, version + 1, [e[0] for e in now], [e[1] for e in now], [e[2] for e in now]))
        names = [f"{pos}:{tie}:{i}" for pos, i, tie in [*gone, *(e[:3] for e in added)]]
        yield pd.DataFrame({
            "key": key[0], "entry": pd.Series(names, dtype=object), "version": version + 1,
            "removed": [True] * len(gone) + [False] * len(added), "payload": pd.Series([None] * len(gone) + [e[3] for e in added], dtype=object),
        })

    return update


def hot_changes(landing: DataFrame, params: SyncParams) -> DataFrame:
    rows = _messages(landing, params).where(F.col("feed") == "hot")
    reduced = rows.select("subreddit", "id", *ORDER, "payload").mapInPandas(_top_in_batch(params.hot_limit), HOT)
    return reduced.groupBy("subreddit").applyInPandasWithState(
        _keep_top(params.hot_limit), CHANGES, "observed bigint, version bigint, positions array<bigint>, ids array<string>, ties array<bigint>",
        "append", GroupStateTimeout.NoTimeout,
    )


# ---------------------------------------------------------------------------
# running the streams, and what they show
# ---------------------------------------------------------------------------
def run_feeds(spark: SparkSession, landing: str, out: str, checkpoint: str, params: SyncParams, files_per_trigger: int | None = None) -> None:
    """Process what has landed since the last call, then stop (``availableNow``)."""
    for name, changes in (("post", post_changes), ("hot", hot_changes)):
        src = spark.readStream.schema(RAW_POST_SCHEMA)
        if files_per_trigger:
            src = src.option("maxFilesPerTrigger", files_per_trigger)
        log = changes(src.parquet(landing), params).writeStream.format("parquet").outputMode("append")
        q = log.option("path", f"{out}/{name}").option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
        q.awaitTermination()


def last_changes(spark: SparkSession, out: str, name: str) -> DataFrame:
    """The raw rows that a change log shows now."""
    w = Window.partitionBy("key", "entry").orderBy(F.col("version").desc())
    log = spark.read.schema(CHANGES).parquet(f"{out}/{name}")
    last = log.withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) & ~F.col("removed"))
    return last.select(F.from_json("payload", RAW_POST_SCHEMA, MICRO_FORMAT).alias("r")).select("r.*")


def current_intake(spark: SparkSession, out: str, params: SyncParams) -> DataFrame:
    """SET-1 of everything the streams have seen: normalised posts."""
    in_window = F.col("created_utc") >= F.lit(I.cutoff_seconds(params))
    both = last_changes(spark, out, "post").unionByName(last_changes(spark, out, "hot")).where(in_window)
    return I.normalize_posts(I.latest_observation(both))

