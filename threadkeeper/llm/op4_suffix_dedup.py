"""Exact repeats of long byte strings by a depth-limited radix sort of suffixes.

Every position of a text starts a suffix that matters only through its first
``WINDOW`` bytes.  Those windows are ordered by passes from coarse to fine
digits, and a pass only keeps suffixes whose digits so far occur again:

1. first digit: the window's anchor, its smallest hash of ``GRAM`` bytes (the
   leftmost on ties).  Equal windows have equal anchors at equal distances, so
   all windows are kept, grouped into runs that share one anchor: about one
   row for 30 bytes of text;
2. second digit: the run's whole content.  Runs of equal anchor and content
   repeat the earliest of them window by window; a run that is the earliest of
   its content and has no other content under its anchor is unique and ends;
3. last digit: the runs left over, the edges of repeated passages, are opened
   into their windows, and windows of equal content form the final groups.

In each group every suffix but the earliest is a repeat.  Copies within one
Arrow batch are settled before the shuffle, so a passage of very many
documents sends a row per batch.  All positions are those of the input.

Order and defined results: documents order by doc_id, null after all others; a
null text is empty; repeated rows (same doc_id and text) are one document and
give equal results, rows that share a doc_id with different texts are ordered
by position only; texts shorter than the window lose nothing; an empty table
gives an empty result.  Extra columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, lean, shield, table
from .words import BYTE_VALUE, INV, POW, STEP, mix, slices, text_buffer

WINDOW = 100
GRAM = 40
LAST = (1 << 63) - 1
POSITION_BITS = 24  # positions of a piece, below the hash bits that are compared


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span, low = 1, x
    while span * 2 <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < width:
        low = np.minimum(low[: len(x) - width + 1], low[width - span :][: len(x) - width + 1])
    return low


def runs(data: np.ndarray, at: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: (text, first position in it, windows, anchor hash, content hash)."""
    out: list[tuple[np.ndarray, ...]] = []
    n, piece = len(data), STEP - 2 * window
    width = window - gram + 1
    keep = ~np.uint64((1 << POSITION_BITS) - 1)
    for s in range(0, max(0, n - window + 1), piece):
        e = min(s + piece, n - window + 1)  # windows s .. e-1
        part = data[s : e + window - 1]
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[part] * POW[: len(part)], out=total[1:])
        grams = mix((total[gram:] - total[:-gram]) * INV[: len(part) - gram + 1])
        low = _sliding_min((grams & keep) | np.arange(len(grams), dtype=np.uint64), width)
        anchor = (low & ~keep).astype(np.int64)
        # windows that end within their text
        valid = np.ones(e - s, bool)
        for edge in at[np.searchsorted(at, s, "right") : np.searchsorted(at, e + window - 1, "left")]:
            valid[max(0, edge - s - window + 1) : max(0, min(edge, e) - s)] = False
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        p0 = np.flatnonzero(first)
        if not len(p0):
            continue
        last = valid.copy()
        last[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        p1 = np.flatnonzero(last)
        a = anchor[p0]
        content = (total[p1 + window] - total[p0]) * INV[p0]
        shape = ((a - p0) * 4096 + (p1 - p0)).astype(np.uint64)
        text = np.searchsorted(at, p0 + s, "right") - 1
        out.append((text, p0 + s - at[text], p1 - p0 + 1, grams[a], mix(content ^ mix(shape))))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _settle(doc, th, p, n, ah, ch):
    """Splits a batch's runs: (rows that go on, repeats of an earlier run of the batch as merged spans)."""
    key = ah ^ (ch * np.uint64(0x9E3779B97F4A7C15))
    order = np.lexsort((p, doc, key))
    k, d, at = key[order], doc[order], p[order]
    same = np.zeros(len(order), bool)
    same[1:] = (k[1:] == k[:-1]) & (ah[order][1:] == ah[order][:-1])
    head = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    tie = (d == d[head]) & (at == at[head])  # not earlier; a repeated row says nothing new, another text of the id does
    again = same & ~tie
    rest = np.sort(order[~same | (tie & (th[order] != th[order][head]))])
    spans = np.sort(order[again])
    sd, st, sp, sn = doc[spans], th[spans], p[spans], n[spans]
    start = np.ones(len(spans), bool)
    start[1:] = (sd[1:] != sd[:-1]) | (st[1:] != st[:-1]) | (sp[1:] != sp[:-1] + sn[:-1])
    first = np.flatnonzero(start)
    merged = np.add.reduceat(sn, first) if len(first) else sn
    return rest, (sd[first], st[first], sp[first], merged)


def _runs(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in slices(batch, "text"):
                data, at = text_buffer(part.column("text"))
                row, p, n, ah, ch = runs(data, at, window, gram)
                doc, th = part.column("ord").to_numpy(), part.column("th").to_numpy()
                found.append((doc[row], th[row], p, n, ah, ch))
            if not found:
                continue
            doc, th, p, n, ah, ch = (np.concatenate(x) for x in zip(*found, strict=True))
            if not len(doc):
                continue
            rest, (sd, st, sp, sn) = _settle(doc, th, p, n, ah, ch)
            spread = mix((sd.astype(np.uint64) << np.uint64(20)) ^ sp.astype(np.uint64))  # settled spans have no group
            cols = [
                np.concatenate([ah[rest], spread]).view(np.int64),
                np.concatenate([ch[rest], np.zeros(len(sd), np.uint64)]).view(np.int64),
                np.concatenate([doc[rest], sd]),
                np.concatenate([th[rest], st]).astype(np.int32),
                (np.concatenate([p[rest], sp]) << 32) | np.concatenate([n[rest], sn]),
                np.concatenate([np.zeros(len(rest), bool), np.ones(len(sd), bool)]),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["ah", "ch", "ord", "th", "pn", "settled"])

    return lean(run)


def _windows(window: int):
    """All windows of the runs left over: two 64-bit names, and where they start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                data, at = text_buffer(batch.column("text"))
                lists = batch.column("runs")
                pn = lists.flatten().to_numpy()
                row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
                p, n = (pn >> 32) + at[row], pn & 0xFFFFFFFF
                order = np.argsort(p, kind="stable")
                p, n, row = p[order], n[order], row[order]
                start = np.repeat(p - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                row = np.repeat(row, n)
                # rows of repeated documents name the same windows once
                names = [np.empty(len(start), np.uint64) for _ in range(2)]
                i = 0
                while i < len(start):
                    j = int(np.searchsorted(start, start[i] + STEP - window, "left"))
                    lo, hi = start[i], start[j - 1] + window
                    for values, out in zip((BYTE_VALUE, OTHER_VALUE), names, strict=True):
                        total = np.zeros(hi - lo + 1, np.uint64)
                        np.cumsum(values[data[lo:hi]] * POW[: hi - lo], out=total[1:])
                        x = start[i:j] - lo
                        out[i:j] = mix((total[x + window] - total[x]) * INV[x])
                    i = j
                for x in range(0, len(start), 1 << 18):  # bounded batches
                    y = slice(x, x + (1 << 18))
                    cols = [names[0][y].view(np.int64), names[1][y].view(np.int64), batch.column("ord").to_numpy()[row[y]], batch.column("th").to_numpy()[row[y]], (start[y] - at[row[y]]).astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["w1", "w2", "ord", "th", "p"])

    return lean(run)


OTHER_VALUE = mix(BYTE_VALUE + np.uint64(0x51ED270B7A649F53))


def keyed(docs: DataFrame) -> DataFrame:
    """Adds the order of documents (ord) and a name of the text (th)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("text", text).withColumn("ord", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn("th", F.shiftrightunsigned(F.xxhash64("text"), 33).cast("int"))


def repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Repeated windows of ``docs`` (ord, th, text): ord, th and spans, a list of
    p << 32 | n for n windows from position p that all start earlier elsewhere."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffixes")
    first = docs.select("ord", "th", "text").mapInArrow(_runs(window, gram), "ah long, ch long, ord long, th int, pn long, settled boolean")
    contents = Window.partitionBy("ah", "ch").orderBy("ord", F.shiftright("pn", 32))
    anchors = Window.partitionBy("ah")
    second = first.repartition("ah").withColumn("nth", F.rank().over(contents)).withColumn("lo", F.min("ch").over(anchors)).withColumn("hi", F.max("ch").over(anchors))
    again = F.col("settled") | (F.col("nth") > 1)
    second = scratch.cut(second.where(again | (F.col("lo") < F.col("hi"))).select("ord", "th", "pn", again.alias("again")))
    rest = second.where("not again").groupBy("ord", "th").agg(F.collect_set("pn").alias("runs"))
    opened = docs.select("ord", "th", "text").join(rest, ["ord", "th"]).mapInArrow(_windows(window), "w1 long, w2 long, ord long, th int, p int")
    group = Window.partitionBy("w1", "w2").orderBy("ord", "p")
    last = opened.withColumn("nth", F.rank().over(group)).where("nth > 1").select("ord", "th", F.shiftleft(F.col("p").cast("long"), 32).bitwiseOR(F.lit(1)).alias("pn"))
    spans = second.where("again").select("ord", "th", "pn").union(last).groupBy("ord", "th").agg(F.collect_set("pn").alias("spans"))
    spans = scratch.cut(spans)
    scratch.drop(second)
    return spans


def _cover(n: int, spans: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal removed runs (starts, ends) of a text of n bytes."""
    p = np.sort(spans)
    start, end = p >> 32, (p >> 32) + (p & 0xFFFFFFFF) + window - 1
    end = np.maximum.accumulate(end)
    new = np.ones(len(p), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:], len(p)) - 1]


def _remaining(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, int, list[memoryview]]]:
    """Per row: bytes, bytes removed, removed runs, pieces that remain."""
    data, at = text_buffer(batch.column("text"))
    raw = memoryview(np.ascontiguousarray(data))
    lists = batch.column("spans")
    values, cuts, null = lists.values.to_numpy(), lists.offsets.to_numpy(), lists.is_null().to_numpy(zero_copy_only=False)
    for i in range(batch.num_rows):
        lo, hi = int(at[i]), int(at[i + 1])
        if null[i] or cuts[i] == cuts[i + 1]:
            yield hi - lo, 0, 0, [raw[lo:hi]]
            continue
        s, e = _cover(hi - lo, values[cuts[i] : cuts[i + 1]], window)
        pieces = [raw[lo + x : lo + y] for x, y in zip([0, *e.tolist()], [*s.tolist(), hi - lo], strict=True) if y > x]
        yield hi - lo, int((e - s).sum()), len(s), pieces


def _digest(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 22):
                rows = []
                for size, removed, spans, pieces in _remaining(batch, window):
                    sha = hashlib.sha256()
                    for x in pieces:
                        sha.update(x)
                    rows.append((size, removed, spans, sha.hexdigest()))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return lean(run)


def _kept_text(window: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 22):
                # a code point that is cut in two is left out
                kept = [b"".join(pieces).decode("utf-8", "ignore") for *_, pieces in _remaining(batch, window)]
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()) if c == "text" else batch.column(c) for c in names], names=names)

    return lean(run)


def with_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    docs = keyed(docs)
    return docs.join(repeated(docs, window, gram), ["ord", "th"], "left")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``docs`` (doc_id, text and more) with the repeated bytes taken out of the texts."""
    docs, named = shield(docs, "doc_id", "text")
    names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return named(with_spans(docs, window, gram).select(*names, "spans").mapInArrow(_kept_text(window, names), schema))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all documents covered by 100-byte strings that start earlier."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = with_spans(docs).select("doc_id", "text", "spans")
    return found.mapInArrow(_digest(WINDOW), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


OP4_SQL = """
WITH b AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, p, substr(h, (2 * p + 1)::BIGINT, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS p FROM b WHERE n >= 100)
), r AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS nth FROM w) WHERE nth > 1
), g AS (
  SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM r)
), span AS (SELECT doc_id, run, min(p) AS a, max(p) + 100 AS z FROM g GROUP BY doc_id, run
), piece AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS z FROM span
  UNION ALL SELECT b.doc_id, coalesce(max(z), 0), b.n FROM b LEFT JOIN span USING (doc_id) GROUP BY b.doc_id, b.n
), kept AS (
  SELECT doc_id, string_agg(substr(h, (2 * a + 1)::BIGINT, (2 * (z - a))::BIGINT), '' ORDER BY a, z) AS kept FROM piece JOIN b USING (doc_id) GROUP BY doc_id
), t AS (SELECT doc_id, sum(z - a)::BIGINT AS removed, count(*) AS spans FROM span GROUP BY doc_id)
SELECT b.doc_id, n::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM b JOIN kept USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages leave the texts; n_chars follows, rows stay."""
    out = remove_repeats(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
