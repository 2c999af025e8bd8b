"""HASH-1: canonical content fingerprint as a native Spark expression.

The fingerprint is ``sha256(json)[:16]`` of the JSON text

    {"comments": [{"body_hash": <md5(body[:500])[:8]>, "id": <id>}, ...],
     "selftext": <selftext[:2000]>, "title": <title>}

with keys sorted, ``", "`` / ``": "`` separators, comments sorted by id and
every character outside printable ASCII written as a ``\\uXXXX`` escape
(UTF-16 surrogate pairs above the BMP), the way Python's ``json.dumps``
writes it by default.  Score, comment count, author and flair are not part
of it, so metadata churn never looks like a content change.

Scale notes: the per-comment digest is computed before any shuffle, so only
an 8-character digest and the comment id travel to the per-post aggregate,
and the comment list is already capped at ``max_comments`` per post.  The
escape only runs on strings that contain a character needing it, only over
the capped text, and per run of safe characters rather than per character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadkeeper.functions.columns import col
from threadkeeper.params import HASH_BODY_CHARS, HASH_SELFTEXT_CHARS

# Characters that may be copied into a JSON string as they are: printable
# ASCII except the quote and the backslash.  Named one by one they are a table
# to the regex engine, and the anchored run is one loop over it; a search for
# a character outside their ranges takes several calls a character.
_SAFE_CHARS = "".join("\\" + c if c in "[]^-&" else c for c in map(chr, range(0x20, 0x7F)) if c not in '"\\')
_SAFE_ONLY = rf"\A[{_SAFE_CHARS}]*\z"
_SHORT_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def _escape_char(c: Column) -> Column:
    expr = None
    for raw, esc in _SHORT_ESCAPES.items():
        expr = F.when(c == raw, F.lit(esc)) if expr is None else expr.when(c == raw, F.lit(esc))
    cp = F.ascii(c)  # the code point of the (single) character
    printable = (cp >= 0x20) & (cp <= 0x7E)
    # \\uXXXX of the UTF-16 code unit(s); above U+FFFF a surrogate pair.
    bmp = F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(cp), 4, "0")))
    off = cp - 0x10000
    pair = F.concat(
        F.lit("\\u"), F.lower(F.hex(F.shiftright(off, 10) + 0xD800)), F.lit("\\u"), F.lower(F.hex(off.bitwiseAND(F.lit(0x3FF)) + 0xDC00))
    )
    return expr.when(printable, c).when(cp < 0x10000, bmp).otherwise(pair)


_SAFE = r"[ !#-\[\]-~]"
# A string as tokens: runs of characters that need no escape, or one other
# character (code point).  Runs are copied, single characters escaped, so the
# per-element work is per run, not per character.
_TOKENS = "(?s)" + _SAFE + "+|."


def json_string(text) -> Column:
    """JSON string literal (with the quotes) of a non-null string column."""
    t = col(text)
    toks = F.regexp_extract_all(t, F.lit(_TOKENS), 0)
    # a token longer than one character is always a run of safe characters
    escaped = F.array_join(F.transform(toks, lambda tok: F.when(F.length(tok) > 1, tok).otherwise(_escape_char(tok))), "")
    body = F.when(~t.rlike(_SAFE_ONLY), F.coalesce(escaped, F.lit(""))).otherwise(t)
    return F.concat(F.lit('"'), body, F.lit('"'))


def comment_digest(body) -> Column:
    """md5 of the first 500 code points of the body, first 8 hex characters."""
    return F.substring(F.md5(F.substring(F.coalesce(col(body), F.lit("")), 1, HASH_BODY_CHARS)), 1, 8)


def comment_fragment(comment_id, body) -> Column:
    return F.concat(
        F.lit('{"body_hash": "'), comment_digest(body), F.lit('", "id": '), json_string(comment_id), F.lit("}")
    )


def comment_fragments(comments: DataFrame) -> DataFrame:
    """(post_id, fragments) with the comment part of the JSON, ids ascending.

    ``comments`` holds (post_id, id, body); the fragment is built map-side.
    """
    frag = comments.select("post_id", F.struct(F.col("id"), comment_fragment("id", "body").alias("frag")).alias("c"))
    return frag.groupBy("post_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda s: s["frag"]), ", ").alias("fragments"),
        F.count(F.lit(1)).alias("n_comments"),
    )


def content_json(title, selftext, fragments) -> Column:
    st = F.substring(F.coalesce(col(selftext), F.lit("")), 1, HASH_SELFTEXT_CHARS)
    return F.concat(
        F.lit('{"comments": ['),
        F.coalesce(col(fragments), F.lit("")),
        F.lit('], "selftext": '),
        json_string(st),
        F.lit(', "title": '),
        json_string(F.coalesce(col(title), F.lit(""))),
        F.lit("}"),
    )


def content_hash(title, selftext, fragments) -> Column:
    return F.substring(F.sha2(content_json(title, selftext, fragments), 256), 1, 16)


def fingerprint_posts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """posts(post_id, title, selftext, ...) + comments(post_id, id, body)
    -> posts with ``n_comments`` and ``content_hash`` (one shuffle on post_id)."""
    frags = comment_fragments(comments)
    joined = posts.join(frags, "post_id", "left")
    return joined.withColumn("content_hash", content_hash("title", "selftext", "fragments")).withColumn(
        "n_comments", F.coalesce(F.col("n_comments"), F.lit(0))
    ).drop("fragments")
