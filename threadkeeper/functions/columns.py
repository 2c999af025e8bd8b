"""Scalar column expressions (all JVM-side, no Python UDFs).

FN-1..FN-19 of the survey; each function takes and returns ``Column``s.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadkeeper.params import (
    DELETED_AUTHOR,
    DOC_ID_PREFIX,
    MEDIA_SUFFIXES,
    PACIFIC,
    REMOVED_TEXTS,
    SITE,
)

MICROS_PER_DAY = 86_400_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def run_ts_lit(run_micros: int) -> Column:
    """The run instant as a timestamp literal, independent of any time zone."""
    return F.timestamp_micros(F.lit(run_micros).cast("bigint"))


# FN-1 / FN-2 -----------------------------------------------------------------
def author_or_deleted(author) -> Column:
    return F.coalesce(col(author), F.lit(DELETED_AUTHOR))


def text_or_empty(text) -> Column:
    return F.coalesce(col(text), F.lit(""))


# FN-3: `edited` is false or an epoch number; truthiness of that value.
def edited_flag(edited) -> Column:
    return F.coalesce(col(edited), F.lit(0.0)) != 0


# FN-4: epoch seconds (double) -> UTC instant, rounded to the microsecond.
def epoch_to_ts(seconds) -> Column:
    return F.timestamp_micros(F.round(col(seconds) * 1_000_000).cast("bigint"))


# FN-5
def thumbnail_or_null(thumb) -> Column:
    return F.when(col(thumb) != "self", col(thumb))


# FN-6: url is also the media url when it ends with a media suffix.
def media_url(url) -> Column:
    u = col(url)
    cond = None
    for s in MEDIA_SUFFIXES:
        c = u.endswith(s)
        cond = c if cond is None else (cond | c)
    return F.when(u.isNotNull() & (u != "") & cond, u)


# FN-7
def full_url(permalink) -> Column:
    return F.concat(F.lit(SITE), col(permalink))


# FN-8: permalink of a comment embeds the last '_' part of its parent id.
def comment_permalink(parent_id, comment_id) -> Column:
    return F.concat(
        F.lit(SITE + "/comments/"),
        F.element_at(F.split(col(parent_id), "_"), -1),
        F.lit("/_/"),
        col(comment_id),
    )


# FN-9
def age_days(created, run_micros: int) -> Column:
    return (F.lit(run_micros) - F.unix_micros(col(created))).cast("double") / F.lit(float(MICROS_PER_DAY))


# FN-10
def pacific(ts) -> Column:
    return F.from_utc_timestamp(col(ts), PACIFIC)


def pacific_date(ts) -> Column:
    return F.to_date(pacific(ts))


def _pacific_offset_hours(ts) -> Column:
    return ((F.unix_micros(pacific(ts)) - F.unix_micros(col(ts))) / F.lit(3_600_000_000)).cast("int")


# FN-11: "Jan 25, 2026 at 02:30 AM PST (2026-01-25 10:30 UTC)"
def dual_time_label(ts) -> Column:
    zone = F.when(_pacific_offset_hours(ts) == -8, F.lit("PST")).otherwise(F.lit("PDT"))
    return F.concat(
        F.date_format(pacific(ts), "MMM dd, yyyy 'at' hh:mm a "),
        zone,
        F.lit(" ("),
        F.date_format(col(ts), "yyyy-MM-dd HH:mm"),
        F.lit(" UTC)"),
    )


# FN-12: ISO-8601 with a 6-digit fraction only when the microseconds are not 0.
def _iso_fraction(ts) -> Column:
    micros = F.pmod(F.unix_micros(col(ts)), F.lit(1_000_000))
    return F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit(""))


def iso_utc(ts) -> Column:
    return F.concat(F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss"), _iso_fraction(ts), F.lit("+00:00"))


def iso_pacific(ts) -> Column:
    off = F.when(_pacific_offset_hours(ts) == -8, F.lit("-08:00")).otherwise(F.lit("-07:00"))
    return F.concat(F.date_format(pacific(ts), "yyyy-MM-dd'T'HH:mm:ss"), _iso_fraction(ts), off)


# FN-13: basis points, half-to-even; null stays null.
def ratio_bp(ratio) -> Column:
    return F.bround(col(ratio) * 10000, 0).cast("int")


# FN-15: '&' first, then '<' and '>'.
def html_escape(text) -> Column:
    t = col(text)
    return F.replace(F.replace(F.replace(t, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def html_attr(text) -> Column:
    """Escape for an attribute value (also quotes; see decision Q15)."""
    return F.replace(html_escape(text), F.lit('"'), F.lit("&quot;"))


# FN-16 / FN-17
def doc_id(post_id) -> Column:
    return F.concat(F.lit(DOC_ID_PREFIX), col(post_id))


def doc_file_name(post_id) -> Column:
    return F.concat(doc_id(post_id), F.lit(".html"))


def size_bytes(text) -> Column:
    return F.octet_length(col(text)).cast("bigint")


# FN-18
def preview(title, n: int = 50) -> Column:
    return F.substring(col(title), 1, n)


# FN-19: " [OP, edited, reply depth N]" or "".
def comment_tags(is_submitter, edited, depth) -> Column:
    tags = F.array_compact(
        F.array(
            F.when(col(is_submitter), F.lit("OP")),
            F.when(col(edited), F.lit("edited")),
            F.when(col(depth) > 0, F.concat(F.lit("reply depth "), col(depth).cast("string"))),
        )
    )
    return F.when(F.size(tags) > 0, F.concat(F.lit(" ["), F.array_join(tags, ", "), F.lit("]"))).otherwise(F.lit(""))


# FLT-4 on the raw row (before FN-1): author missing or text removed.
def is_deleted_raw(author, selftext) -> Column:
    return col(author).isNull() | F.coalesce(col(selftext), F.lit("")).isin(*REMOVED_TEXTS)
