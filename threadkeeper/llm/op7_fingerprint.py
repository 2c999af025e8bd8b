"""Document fingerprints by locally consistent parsing.

A text is cut into phrases where only the neighbourhood decides, the phrases
get names, and the names are parsed again, level by level:

1. runs of equal symbols become one symbol;
2. deterministic coin tossing: each symbol is relabelled by the lowest bit in
   which it differs from its left neighbour, and that bit; a few rounds take
   64-bit names to labels under 8 that still differ between neighbours;
3. a phrase starts at each local maximum of the labels, so phrases have 2 to
   about a dozen symbols; its name is a hash of its symbols.

Cuts depend on a bounded neighbourhood, so equal substrings get equal names
inside, whatever their offset, and an edit changes names near it only.

The fingerprint keeps the two highest levels worth comparing: level h, the
highest with at least ``LEAST`` phrases (or 1), and h - 1, each as its ``KEPT``
smallest names.  The likeness of two fingerprints is the mean over their
common levels of the Jaccard estimate from the smallest names of the union; 1
if both are empty, 0 if they have no level in common.

Documents are put in descending order of doc_id by range buckets (quantiles of
the ids, so buckets hold about equally many rows) and each bucket is streamed
once in order; the document that follows a bucket's last is sent to it as a
guest.  A text crosses the shuffle once.

Defined results: a null text is empty; null doc_ids come last; rows that share
a doc_id are ordered by a hash of the text, and the next of a row is the next
row; a single row is its own next; an empty table gives an empty result.
Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ready, shuffle_partitions, table
from .words import POW, mix, slices

LEAST = 16
KEPT = 64
LEVELS = 12
ROUNDS = 4
BUCKETS = 8  # a shuffle partition


def toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One round of coin tossing; ``first`` marks where a text starts."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    differ = x ^ before
    low = differ & -differ
    return ((np.bitwise_count(low - low.dtype.type(1)).astype(np.uint8) << 1) | ((x & low) != 0)).astype(np.uint8)


def parse(x: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: (names of the phrases, their texts) of symbols and their texts."""
    n = len(x)
    # runs of equal symbols
    head = np.ones(n, bool)
    head[1:] = (x[1:] != x[:-1]) | (text[1:] != text[:-1])
    if not head.all():
        at = np.flatnonzero(head)
        size = np.diff(np.append(at, n))
        x = x[at].astype(np.uint64)
        long = size > 1
        x[long] = mix(x[long] ^ (size[long].astype(np.uint64) << np.uint64(32)))
        text = text[at]
        n = len(x)
    first = np.ones(n, bool)
    first[1:] = text[1:] != text[:-1]
    label = toss(x, first)
    for _ in range(ROUNDS - 1):
        label = toss(label, first)
    start = first.copy()
    start[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:]) & ~first[2:]
    at = np.flatnonzero(start)
    size = np.diff(np.append(at, n))
    place = np.arange(n) - np.repeat(at, size)
    names = np.add.reduceat(mix(x.astype(np.uint64) + np.uint64(1)) * POW[place % len(POW)], at) + size.astype(np.uint64)
    return mix(names), text[at]


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of a bounded number of texts."""
    size = np.array([len(t) for t in texts], np.int64)
    x = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    text = np.repeat(np.arange(len(texts)), size)
    kept: list[list[tuple[int, np.ndarray]]] = [[] for _ in texts]
    for lvl in range(1, LEVELS + 1):
        if not len(x):
            break
        x, text = parse(x, text)
        count = np.bincount(text, minlength=len(texts))
        cut = np.concatenate([[0], np.cumsum(count)])
        go_on = np.zeros(len(texts), bool)
        for i in np.flatnonzero(count):
            if lvl == 1 or count[i] >= LEAST:
                names = np.unique((x[cut[i] : cut[i + 1]] >> np.uint64(32)).astype(np.uint32))[:KEPT]
                kept[i] = [*kept[i][-1:], (lvl, names)]
                go_on[i] = count[i] >= LEAST
        alive = go_on[text]
        x, text = x[alive], text[alive]
    return ["/".join(f"{lvl}:" + names.astype(">u4").tobytes().hex() for lvl, names in reversed(k)) for k in kept]


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    levels = [{int(p.partition(":")[0]): p.partition(":")[2] for p in f.split("/") if p} for f in (a, b)]
    common = levels[0].keys() & levels[1].keys()
    found = []
    for lvl in common:
        sets = [{s[i : i + 8] for i in range(0, len(s), 8)} for s in (levels[0][lvl], levels[1][lvl])]
        union = sorted(sets[0] | sets[1])
        if max(map(len, sets)) >= KEPT:  # smallest names of the union are known up to here
            union = union[:KEPT]
        found.append(sum(n in sets[0] and n in sets[1] for n in union) / max(1, len(union)))
    return float(sum(found) / len(found)) if found else 0.0


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a partition by bucket and order, the guest last in each bucket."""
    last: tuple | None = None  # the row before: bucket, guest, doc_id, text, fingerprint
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    for whole in batches:
        for batch in slices(whole, "text", 1 << 21):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            rows = list(zip(batch.column("bucket").to_pylist(), batch.column("guest").to_pylist(), batch.column("doc_id").to_pylist(), texts, fingerprints(texts), strict=True))
            pairs = [(a, b) for a, b in zip([last, *rows[:-1]], rows, strict=True) if a is not None and a[0] == b[0] and not a[1]]
            last = rows[-1] if rows else last
            edited = []
            for a, b in pairs:
                m = len(a[3]) // 3
                edited.append(a[3][: len(a[3]) - m] + b[3][:m])
            out = [
                (a[2], len(a[3]), hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest(), a[4], f, likeness(a[4], f), likeness(a[4], b[4]))
                for (a, b), e, f in zip(pairs, edited, fingerprints(edited), strict=True)
            ]
            cols = list(zip(*out, strict=True)) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts (doc_id, text), of their edited texts and their likeness to the next text."""
    spark = ready(docs.sparkSession)
    n = shuffle_partitions(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("ord", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("th", F.xxhash64("text"))
    share = [i / (n * BUCKETS) for i in range(1, n * BUCKETS)]
    edges = docs.agg(F.percentile_approx("ord", share, 1_000_000).alias("q")).first()["q"]
    edges = np.unique(np.array(edges or [], np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), "left").astype(np.int32))

    dealt = docs.withColumn("bucket", bucket_of("ord"))
    # the first row of each bucket follows the last row of the next higher bucket; the very first follows the very last
    heads = dealt.groupBy("bucket").agg(F.max(F.struct("ord", "th")).alias("head"))
    order = Window.orderBy("bucket")
    whole = Window.partitionBy()
    heads = heads.withColumn("to", F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(whole)))
    heads = heads.select(F.col("head.ord").alias("ord"), F.col("head.th").alias("th"), "to")
    guests = docs.join(F.broadcast(heads), ["ord", "th"]).select("doc_id", "text", "ord", "th", F.col("to").alias("bucket"), F.lit(True).alias("guest"))
    both = dealt.select("doc_id", "text", "ord", "th", "bucket", F.lit(False).alias("guest")).union(guests)
    dealt = both.repartition(n, "bucket").sortWithinPartitions("bucket", "guest", F.desc("ord"), F.desc("th"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.select("bucket", "guest", "doc_id", "text").mapInArrow(_compare, schema)


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, of their edited texts, and likenesses."""
    return compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))
