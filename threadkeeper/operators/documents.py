"""Document building: HTML rendering and the metadata record.

DOC-1..4, MD-1, AGG-1, WIN-2.  The markup is our own template carrying the
same fields in the same order as the original documents: title, source,
author, posting time (Pacific and UTC), thread URL, optional external link,
engagement line, body (or a no-text note) and the discussion with each
comment's rank, author, points, tags, time, permalink and body.

Scale: everything per comment (escaping, time labels, tags) is formatted
*before* the per-post aggregation, inside whole-stage codegen; the aggregate
only sorts the (already capped) per-post list and inserts the rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadkeeper.functions import columns as C


def comment_pieces(comments: DataFrame) -> DataFrame:
    """Per comment: sort key and the block text before / after its rank."""
    head = F.concat(
        F.lit('<article class="reply" id="c-'),
        C.html_attr("id"),
        F.lit('" data-depth="'),
        F.col("depth").cast("string"),
        F.lit('">\n<header>#'),
    )
    tail = F.concat(
        F.lit(" u/"),
        C.html_escape("author"),
        F.lit(" | "),
        F.col("score").cast("string"),
        F.lit(" points"),
        C.comment_tags("is_submitter", "edited", "depth"),
        F.lit('</header>\n<p class="when">'),
        C.dual_time_label("created_utc"),
        F.lit(' | <a href="'),
        C.html_attr(C.comment_permalink("parent_id", "id")),
        F.lit('">permalink</a></p>\n<blockquote>'),
        C.html_escape("body"),
        F.lit("</blockquote>\n</article>\n"),
    )
    # AGG-1 / WIN-2: score descending, listing order on ties (stable sort).
    return comments.select(
        "post_id",
        F.struct((-F.col("score")).alias("neg_score"), F.col("listing_pos"), F.col("id"), head.alias("head"), tail.alias("tail")).alias("c"),
    )


def discussion(comments: DataFrame) -> DataFrame:
    """DOC-1/DOC-2: (post_id, n_comments, discussion html) per post with comments."""
    pieces = comment_pieces(comments)
    agg = pieces.groupBy("post_id").agg(F.array_sort(F.collect_list("c")).alias("cs"))
    blocks = F.transform("cs", lambda s, i: F.concat(s["head"], (i + 1).cast("string"), s["tail"]))
    n = F.size("cs")
    html = F.concat(
        F.lit('<section class="discussion">\n<h2>Discussion: '),
        n.cast("string"),
        F.lit(" comments</h2>\n"),
        F.array_join(blocks, ""),
        F.lit("</section>\n"),
    )
    return agg.select("post_id", n.cast("bigint").alias("n_comments"), html.alias("discussion"))


def has_external_link(url="url", is_self="is_self", permalink="permalink") -> Column:
    """DOC-3: not a self post, url non-empty and not the thread URL itself."""
    u = C.col(url)
    return ~C.col(is_self) & u.isNotNull() & (u != "") & (u != C.full_url(permalink))


def post_html(discussion_col: Column | str = "discussion") -> Column:
    """DOC-4 over a post row (with ``discussion`` possibly null)."""
    title = C.html_escape("title")
    link = F.when(
        has_external_link(),
        F.concat(F.lit('<dt>Links to</dt><dd><a href="'), C.html_attr("url"), F.lit('">'), C.html_escape("url"), F.lit("</a></dd>\n")),
    ).otherwise(F.lit(""))
    body = F.when(
        F.coalesce(F.col("selftext"), F.lit("")) != "",
        F.concat(F.lit('<div class="text">'), C.html_escape("selftext"), F.lit("</div>\n")),
    ).otherwise(F.lit('<p class="empty">No text: this post links elsewhere.</p>\n'))
    furl = C.full_url("permalink")
    return F.concat(
        F.lit('<!doctype html>\n<html lang="en">\n<head><meta charset="utf-8"><title>'),
        title,
        F.lit('</title></head>\n<body>\n<main class="thread" id="post-'),
        C.html_attr("id"),
        F.lit('" data-source="'),
        C.html_attr("subreddit"),
        F.lit('">\n<h1>'),
        title,
        F.lit('</h1>\n<dl class="facts">\n<dt>Source</dt><dd>r/'),
        C.html_escape("subreddit"),
        F.lit("</dd>\n<dt>Posted by</dt><dd>u/"),
        C.html_escape("author"),
        F.lit("</dd>\n<dt>Posted</dt><dd>"),
        C.dual_time_label("created_utc"),
        F.lit('</dd>\n<dt>Thread</dt><dd><a href="'),
        C.html_attr(furl),
        F.lit('">'),
        C.html_escape(furl),
        F.lit("</a></dd>\n"),
        link,
        F.lit("<dt>Engagement</dt><dd>"),
        F.coalesce(F.col("score"), F.lit(0)).cast("string"),
        F.lit(" points, "),
        F.coalesce(F.col("num_comments"), F.lit(0)).cast("string"),
        F.lit(' comments</dd>\n</dl>\n<section class="post">\n'),
        body,
        F.lit("</section>\n"),
        F.coalesce(C.col(discussion_col), F.lit("")),
        F.lit("</main>\n</body>\n</html>\n"),
    )


def render(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """posts (normalised, ``id``) + comments -> posts with ``html`` (one shuffle)."""
    disc = discussion(comments).withColumnRenamed("post_id", "id")
    return posts.join(disc, "id", "left").withColumn("html", post_html("discussion")).drop("discussion")


# ---------------------------------------------------------------------------
# MD-1 metadata record
# ---------------------------------------------------------------------------
METADATA_FIELDS = [
    "url", "subreddit", "author", "title", "score", "num_comments", "upvote_ratio_bp",
    "created_utc", "created_pacific", "date_pacific", "post_id", "is_self",
    "total_awards_received", "external_url", "flair", "media_url",
]


def metadata_columns() -> list[Column]:
    """Metadata fields as columns; optional ones are null when absent."""
    return [
        C.full_url("permalink").alias("url"),
        F.col("subreddit"),
        F.col("author"),
        F.col("title"),
        F.coalesce(F.col("score"), F.lit(0)).cast("int").alias("score"),
        F.coalesce(F.col("num_comments"), F.lit(0)).cast("int").alias("num_comments"),
        C.ratio_bp("upvote_ratio").alias("upvote_ratio_bp"),
        C.iso_utc("created_utc").alias("created_utc"),
        C.iso_pacific("created_utc").alias("created_pacific"),
        F.date_format(C.pacific("created_utc"), "yyyy-MM-dd").alias("date_pacific"),
        F.col("id").alias("post_id"),
        F.coalesce(F.col("is_self"), F.lit(False)).alias("is_self"),
        F.coalesce(F.col("total_awards_received"), F.lit(0)).cast("int").alias("total_awards_received"),
        F.when(has_external_link(), F.col("url")).alias("external_url"),
        F.col("link_flair_text").alias("flair"),
        F.col("media_url"),
    ]


def metadata_json() -> Column:
    """The record as JSON; absent (null) fields are omitted."""
    return F.to_json(F.struct(*metadata_columns()))
