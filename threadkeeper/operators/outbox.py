"""Document-index operations as an outbox table, delivery results, index apply.

SNK-1..6.  The remote index is never called from a transformation: a run
plans operations into an outbox (written once), a delivery step reports
``sink_results(doc_key, op, ok, returned_doc_id, error)``, optionally with the
``attempt`` it belongs to (the pass of the run that sent it, 1 by default), and
the fold applies those results to state.  A missing result means the op
succeeded and the index kept the deterministic document id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadkeeper.functions import columns as C
from threadkeeper.operators import documents as D

OP_INGEST, OP_REINGEST, OP_SET_METADATA, OP_DELETE = "INGEST", "REINGEST", "SET_METADATA", "DELETE"
OP_RANK = {OP_DELETE: 0, OP_INGEST: 1, OP_REINGEST: 2, OP_SET_METADATA: 3}


def outbox(ops: DataFrame, posts: DataFrame, comments: DataFrame) -> DataFrame:
    """ops(post_id, op, doc_key) + post rows + comments -> outbox rows.

    HTML is rendered only for INGEST / REINGEST rows (the filter runs before
    the rendering join); SET_METADATA carries metadata only; DELETE nothing.
    """
    content_ops = ops.where(F.col("op").isin(OP_INGEST, OP_REINGEST))
    other_ops = ops.where(~F.col("op").isin(OP_INGEST, OP_REINGEST))
    p = posts.withColumnRenamed("id", "post_id")
    needs_html = content_ops.join(p, "post_id", "inner").withColumnRenamed("post_id", "id")
    meta = other_ops.join(p, "post_id", "left").withColumnRenamed("post_id", "id")
    return filled(needs_html, meta, comments)


def filled(needs_html: DataFrame, meta: DataFrame, comments: DataFrame, *more: str) -> DataFrame:
    """Outbox rows of operations (op, doc_key and ``more``) that hold the columns
    of their post: ``needs_html`` with their document, ``meta`` without."""
    wanted = needs_html.select("id").withColumnRenamed("id", "post_id")
    rendered = D.render(needs_html, comments.join(wanted, "post_id", "left_semi"))
    with_html = rendered.select(
        F.col("id").alias("post_id"),
        "op",
        "doc_key",
        F.col("html"),
        D.metadata_json().alias("metadata_json"),
        C.size_bytes("html").alias("size_bytes"),
        *more,
    )
    meta_rows = meta.select(
        F.col("id").alias("post_id"),
        "op",
        "doc_key",
        F.lit(None).cast("string").alias("html"),
        F.when(F.col("op") == OP_SET_METADATA, D.metadata_json()).alias("metadata_json"),
        F.lit(None).cast("bigint").alias("size_bytes"),
        *more,
    )
    return with_html.unionByName(meta_rows)


def one_result(sink_results: DataFrame) -> DataFrame:
    """One result per (doc_key, op, attempt): a redelivered report may say the
    same twice, and any success means the document is in place."""
    best = F.max_by(F.struct("returned_doc_id", "error"), F.struct("ok", F.coalesce("returned_doc_id", F.lit("")), F.coalesce("error", F.lit(""))))
    r = sink_results.groupBy("doc_key", "op", F.coalesce("attempt", F.lit(1)).alias("attempt")).agg(F.max("ok").alias("ok"), best.alias("b"))
    return r.select("doc_key", "op", "attempt", "ok", "b.returned_doc_id", "b.error")


def fallback_id(op: Column, doc_key: Column, post_id: Column) -> Column:
    """The document's id when the index returns none: a re-ingest deletes the
    old document and makes one under the deterministic id."""
    return F.when(op == OP_REINGEST, C.doc_id(post_id)).otherwise(doc_key)


def delivery(ops: DataFrame, sink_results: DataFrame, attempt: int = 1) -> DataFrame:
    """SNK-6: attach the delivery outcome of this attempt; no result = success."""
    if "attempt" not in sink_results.columns:
        sink_results = sink_results.withColumn("attempt", F.lit(None).cast("int"))
    r = one_result(sink_results).where(F.col("attempt") == attempt)
    r = r.select("doc_key", "op", F.col("ok").alias("_ok"), "returned_doc_id", "error")
    j = ops.join(r, ["doc_key", "op"], "left")
    kept = F.coalesce(F.col("returned_doc_id"), fallback_id(F.col("op"), F.col("doc_key"), F.col("post_id")))
    return j.withColumn("ok", F.coalesce(F.col("_ok"), F.lit(True))).withColumn("result_doc_id", F.when(F.col("ok"), kept)).drop("_ok", "returned_doc_id")


def undelivered_deletes(ops: DataFrame, run: Column, *more: str) -> DataFrame:
    """Failed DELETEs, to be sent again: (post_id, doc_key, error, failed_at) and ``more``.
    The post is gone from every other table, so this is what remembers the document."""
    return ops.where((F.col("op") == OP_DELETE) & ~F.col("ok")).select("post_id", "doc_key", "error", run.alias("failed_at"), *more)


def redelivery(pending: DataFrame) -> DataFrame:
    """DELETE operations of a later run for ``undelivered_deletes`` rows."""
    return pending.select("post_id", F.lit(OP_DELETE).alias("op"), "doc_key").distinct()


def apply_to_index(index: DataFrame, box: DataFrame) -> DataFrame:
    """SNK-5: apply delivered operations (one per document: the latest by
    ``seq``) to the index (doc_id, post_id, html, metadata_json, size_bytes and,
    if both have it, day).

    ``box`` holds successful operations with ``result_doc_id``.  INGEST and
    REINGEST put the document under the id the index returned; a REINGEST also
    removes the one it replaces (``doc_key``).  SET_METADATA replaces metadata
    only, DELETE removes the document; of an unknown one both leave nothing.
    """
    w = Window.partitionBy("doc_key").orderBy(*newest_first())
    return put(index, box.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn"))


def newest_first() -> list[Column]:
    rank = F.create_map(*[x for k, v in OP_RANK.items() for x in (F.lit(k), F.lit(v))])
    return [F.col("seq").desc(), rank[F.col("op")].desc()]


def still_last(box: DataFrame, sent: DataFrame) -> DataFrame:
    """``box`` (an operation per post and document) without those that a later
    one of another post for the same document replaces.  ``sent`` holds the
    keys of all operations: they are compared, the contents stay where they are."""
    w = Window.partitionBy("doc_key").orderBy(*newest_first(), "post_id")
    old = sent.select("post_id", "doc_key", "op", "seq").withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") > 1)
    old = old.groupBy("post_id").agg(F.collect_set(F.struct("doc_key", "seq")).alias("_old"))
    kept = F.col("_old").isNull() | ~F.array_contains("_old", F.struct("doc_key", "seq"))
    return box.join(old, "post_id", "left").where(kept).drop("_old")


def put(index: DataFrame | None, last: DataFrame) -> DataFrame:
    """The index (none: an empty one) after the last operation of each document."""
    content = F.col("op").isin(OP_INGEST, OP_REINGEST)
    day = [c for c in ("day",) if c in last.columns and (index is None or c in index.columns)]
    cols = ["post_id", "html", "metadata_json", "size_bytes", *day]
    made = last.where(content).select(F.col("result_doc_id").alias("doc_id"), *cols)
    if index is None:
        return made
    removed = last.where(content | (F.col("op") == OP_DELETE)).select(F.col("doc_key").alias("doc_id"))
    gone = removed.union(made.select("doc_id")).distinct()
    meta = last.where(F.col("op") == OP_SET_METADATA).select(F.col("doc_key").alias("doc_id"), F.col("metadata_json").alias("n_metadata_json"))
    kept = index.join(gone, "doc_id", "left_anti").join(meta, "doc_id", "left")
    kept = kept.select("doc_id", "post_id", "html", F.coalesce("n_metadata_json", "metadata_json").alias("metadata_json"), "size_bytes", *day)
    return kept.unionByName(made)
