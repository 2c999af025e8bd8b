"""Intake: landed feed snapshots -> normalised posts and capped comments.

SRC-1..7, PRJ-1/2, FLT-1/2/4, WIN-1/3, SET-1/2.  One scan per table; the
source list is a filter, not a loop over sources.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadkeeper.functions import columns as C
from threadkeeper.params import EXCLUDED_AUTHORS, SyncParams
from threadkeeper.schemas import COMMENT_COLS, POST_COLS, RAW_COMMENT_SCHEMA, RAW_POST_COLS, RAW_POST_SCHEMA

CORRUPT = "_corrupt_record"


# ---------------------------------------------------------------------------
# Reading landed files (SRC-7: bad records are isolated, not fatal)
# ---------------------------------------------------------------------------
def read_landing(spark: SparkSession, path: str, kind: str = "posts", fmt: str = "parquet", since: str | None = None) -> DataFrame:
    """Read a landed snapshot with a fixed schema (no inference).

    JSON is read PERMISSIVE with a corrupt-record column, so a malformed line
    becomes a reject row instead of failing the job.  ``since`` (a date) keeps
    the partitions of a landing by ``observed_date`` from that day on; the
    others are not listed or read.
    """
    schema = RAW_POST_SCHEMA if kind == "posts" else RAW_COMMENT_SCHEMA
    if fmt == "json":
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
        raw = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    else:
        raw = spark.read.schema(schema).format(fmt).load(path)
    return raw if since is None else raw.where(F.col("observed_date") >= F.lit(since).cast("date")).drop("observed_date")


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """A landing of posts partitioned by ``observed_date``, with that column."""
    return spark.read.schema(T.StructType([*RAW_POST_SCHEMA.fields, T.StructField("observed_date", T.DateType())])).parquet(path)


def seen_days(seen: DataFrame | None, landing: DataFrame, since: str | None = None) -> DataFrame:
    """(post_id, day) of the last landed day of every post (valid rows), after
    the days from ``since`` on (all without it) have landed; ``seen`` is what earlier runs kept."""
    new = landing if since is None else landing.where(F.col("observed_date") >= F.lit(since).cast("date"))
    new = new.where(post_is_valid(new)).select(F.col("id").alias("post_id"), F.col("observed_date").alias("day"))
    both = new if seen is None else new.unionByName(seen.select("post_id", "day"))
    return both.groupBy("post_id").agg(F.max("day").alias("day"))


def refresh_scan(landing: DataFrame, wanted: DataFrame, seen: DataFrame) -> DataFrame:
    """SRC-5: the landed rows of ``wanted`` (post_id) on the day each was last
    seen.  The days are few values, so the join with them prunes the landing's
    partitions at run time, however many days it holds."""
    at = wanted.select("post_id").distinct().join(seen.where(F.col("day").isNotNull()), "post_id")
    days = at.select(F.col("day").alias("observed_date")).distinct()
    rows = landing.join(days, "observed_date", "left_semi")
    last = at.select(F.col("post_id").alias("id"), F.col("day").alias("observed_date"))
    return rows.join(last, ["id", "observed_date"], "left_semi")


def first_window_day(params: SyncParams) -> str:
    """The first landed day that can hold posts of the window: a post created
    at or after the cutoff is not observed before it."""
    return dt.datetime.fromtimestamp(cutoff_seconds(params), tz=dt.timezone.utc).strftime("%Y-%m-%d")


REQUIRED = ["id", "subreddit", "title", "url", "permalink", "score", "upvote_ratio", "num_comments", "created_utc"]


def post_is_valid(df: DataFrame) -> Column:
    ok = F.lit(True)
    for c in REQUIRED:
        ok = ok & F.col(c).isNotNull()
    if CORRUPT in df.columns:
        ok = ok & F.col(CORRUPT).isNull()
    return ok


def split_rejects(raw_posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-7: (good rows, rejected rows); the run continues with the good."""
    flagged = raw_posts.withColumn("_ok", post_is_valid(raw_posts))
    good = flagged.where(F.col("_ok")).drop("_ok")
    bad = flagged.where(~F.col("_ok")).drop("_ok")
    if CORRUPT in good.columns:
        good = good.drop(CORRUPT)
    return good, bad


def quarantine(rejects: DataFrame) -> DataFrame:
    """Rejected rows with the reason: "malformed", or the required fields that are missing."""
    reason = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED])
    if CORRUPT in rejects.columns:
        return rejects.withColumn("reason", F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(F.concat(F.lit("missing "), reason)))
    return rejects.withColumn(CORRUPT, F.lit(None).cast("string")).withColumn("reason", F.concat(F.lit("missing "), reason))


# ---------------------------------------------------------------------------
# Normalisation (PRJ-1, PRJ-2)
# ---------------------------------------------------------------------------
def normalize_posts(raw: DataFrame, *extra: str) -> DataFrame:
    """PRJ-1 with FN-1..6: one projection, no shuffle; ``extra`` columns pass."""
    exprs = {
        "author": C.author_or_deleted("author"),
        "selftext": C.text_or_empty("selftext"),
        "created_utc": C.epoch_to_ts("created_utc"),
        "edited": C.edited_flag("edited"),
        "total_awards_received": F.coalesce(F.col("total_awards_received"), F.lit(0)),
        "thumbnail": C.thumbnail_or_null("thumbnail"),
        "media_url": C.media_url("url"),
    }
    for flag in ["is_video", "is_original_content", "over_18", "spoiler", "stickied", "locked", "archived"]:
        exprs[flag] = F.coalesce(F.col(flag), F.lit(False))
    exprs["is_self"] = F.coalesce(F.col("is_self"), F.lit(True))
    cols = [exprs.get(c, F.col(c)).alias(c) for c in POST_COLS]
    return raw.select(*cols, *extra)


def is_bot(author_after_default: Column) -> Column:
    """FLT-2: case-insensitive match against the excluded names.

    Only a name as long as one of them is folded (folding to ASCII keeps the
    number of code points)."""
    names = sorted({a.lower() for a in EXCLUDED_AUTHORS})
    return F.char_length(author_after_default).isin(*sorted(set(map(len, names)))) & F.lower(author_after_default).isin(*names)


def comment_is_valid() -> Column:
    ok = F.lit(True)
    for c in ["id", "body", "score", "created_utc", "parent_id", "is_submitter", "depth"]:
        ok = ok & F.col(c).isNotNull()
    return ok


def normalize_comments(raw: DataFrame, params: SyncParams) -> DataFrame:
    """SRC-6 + FLT-2 + PRJ-2 + WIN-1.

    Placeholders, bots and malformed rows are dropped first; the first
    ``max_comments`` remaining comments in listing order are kept.  The
    row_number limit is planned as a WindowGroupLimit, which also runs
    *before* the shuffle, so a post with millions of comments ships at most
    ``max_comments`` rows per map partition.
    """
    if not params.include_comments or params.max_comments <= 0:
        return _comment_projection(raw.where(F.lit(False)).withColumn("edited", C.edited_flag("edited")))
    author = C.author_or_deleted("author")
    kept = raw.where(~F.coalesce(F.col("is_placeholder"), F.lit(False)) & ~is_bot(author) & comment_is_valid())
    w = Window.partitionBy("post_id").orderBy("listing_pos", "id")
    flat = kept.withColumns({"author": author, "edited": C.edited_flag("edited")})  # the flag is narrower than the time
    capped = flat.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= params.max_comments).drop("_rn")
    return _comment_projection(capped)


def _comment_projection(df: DataFrame) -> DataFrame:
    exprs = {"created_utc": C.epoch_to_ts("created_utc")}
    return df.select(*[exprs.get(c, F.col(c)).alias(c) for c in COMMENT_COLS])


# ---------------------------------------------------------------------------
# Feeds (SRC-1..3, SET-1, WIN-3)
# ---------------------------------------------------------------------------
def cutoff_seconds(params: SyncParams) -> float:
    return params.run_micros / 1_000_000 - params.window_hours * 3600


def in_sources(df: DataFrame, params: SyncParams) -> DataFrame:
    """SRC-3: one scan, configured sources as an IN filter (pushed to the scan)."""
    if params.subreddits:
        return df.where(F.col("subreddit").isin(*params.subreddits))
    return df


def window_scan(raw: DataFrame, params: SyncParams) -> DataFrame:
    """SRC-1 + FLT-1: chronological feed rows created at or after the cutoff."""
    return in_sources(raw, params).where((F.col("feed") == "new") & (F.col("created_utc") >= F.lit(cutoff_seconds(params))))


def hot_top(raw: DataFrame, params: SyncParams) -> DataFrame:
    """SRC-2 / TOP-2: first ``hot_limit`` entries of each source's latest
    engagement feed (its newest snapshot), then the same inclusive cutoff
    (applied after the top-N).

    Newest snapshot first, then feed position: the limit is a group limit ahead
    of the shuffle, so a map partition sends ``hot_limit`` rows of a source at
    most; entries of older snapshots that fill up a short feed go afterwards."""
    hot = in_sources(raw, params).where(F.col("feed") == "hot")
    source = Window.partitionBy("subreddit")
    w = source.orderBy(F.col("observed_at").desc_nulls_last(), "feed_pos", "id")
    top = hot.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= params.hot_limit)
    newest = top.withColumn("_newest", F.max("observed_at").over(source)).where(F.col("observed_at").eqNullSafe(F.col("_newest")))
    return newest.drop("_rk", "_newest").where(F.col("created_utc") >= F.lit(cutoff_seconds(params)))


def row_tie(columns: list[str]) -> Column:
    """Decides between observations that agree in time, feed and position."""
    return F.xxhash64(*[F.col(c) for c in RAW_POST_COLS if c in columns])


def obs_order(columns: list[str]) -> list[Column]:
    return [F.col("observed_at"), (F.col("feed") == "hot"), F.col("feed_pos"), row_tie(columns)]


def latest_observation(obs: DataFrame) -> DataFrame:
    """WIN-3: one row per post id: latest observation, 'hot' over 'new' at the
    same instant, then the later feed position, then a hash of the row.

    A limit of one per id is planned as a WindowGroupLimit that also runs
    before the shuffle: a post observed millions of times sends one row per
    map partition.
    """
    w = Window.partitionBy("id").orderBy(*[c.desc_nulls_last() for c in obs_order(obs.columns)])
    return obs.withColumn("_nth", F.row_number().over(w)).where(F.col("_nth") == 1).drop("_nth")


def intake_posts(good: DataFrame, params: SyncParams) -> DataFrame:
    """SET-1: new-feed window ∪ hot top-N, de-duplicated by id, normalised."""
    return normalize_posts(latest_observation(window_scan(good, params).unionByName(hot_top(good, params))))


def failed_sources(manifest: DataFrame, params: SyncParams) -> DataFrame:
    """SRC-4: configured sources whose poll raised an error, or that were not
    polled, by the run's manifest (subreddit, ok, error).  A source that was
    polled and had nothing new did not fail."""
    configured = manifest.sparkSession.createDataFrame([(s,) for s in params.subreddits], "subreddit string")
    per_source = manifest.groupBy("subreddit").agg(F.min("ok").alias("ok"), F.max("error").alias("error"))
    j = configured.join(per_source, "subreddit", "left").where(~F.coalesce("ok", F.lit(False)))
    return j.select("subreddit", F.when(F.col("ok").isNull(), F.lit("not polled")).otherwise(F.col("error")).alias("error"))


def refresh_outcome(wanted: DataFrame, snapshot: DataFrame) -> DataFrame:
    """SRC-5: wanted(post_id) x latest raw observation -> FOUND / DELETED /
    FETCH_FAILED.  Absent from the snapshot is a failed fetch, never a delete."""
    latest = latest_observation(snapshot).withColumnRenamed("id", "post_id").withColumn("_seen", F.lit(True))
    j = wanted.select("post_id").join(latest, "post_id", "left")
    outcome = (
        F.when(F.col("_seen").isNull(), F.lit("FETCH_FAILED"))
        .when(C.is_deleted_raw("author", "selftext"), F.lit("DELETED"))
        .otherwise(F.lit("FOUND"))
    )
    return j.withColumn("outcome", outcome).drop("_seen")
