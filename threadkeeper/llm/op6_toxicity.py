"""Toxicity by maximum-scoring segments of token log-odds.

A feature's weight (a token or its first ``STEM`` code points, for inflected
and compound words) is the log-odds of its presence in toxic against clean
texts, with an informative Dirichlet prior (the background frequencies), kept
only as far as it is significant by the likelihood-ratio test; a token has the
weightier of its two features, and every token also pays ``DRIFT``, so that a
clean text drifts downwards.  A linear scan finds all maximal segments, those
that no shorter or longer stretch beats.  Under clean text the best segment of
n tokens follows an extreme-value law, P(S >= x) = 1 - exp(-k n exp(-l x)),
whose l solves E[exp(l s)] = 1 over clean tokens and whose k is fitted to the
clean training texts.  A segment counts by what it has over the expected
maximum, l S - ln(k n); a text by its best segment and the sum over its
significant ones, which a ridge logistic regression of two features turns into
a probability.

Tokens are runs of letters (all but ASCII non-letters), A-Z folded, of the
whole text.  The fit uses a bounded sample: at most ``SAMPLE`` labelled
training rows (smallest hashes of the id), equal texts once, and the
``WEIGHTS`` most significant tokens.

Defined results: a null or empty text has no segment and gets the score of
"nothing found"; labels other than 0 and 1 are not used, of several labels of
one doc_id the larger holds; without both labels in the training fold all
scores are 0; a null doc_id counts as an empty one for the fold; repeated rows
get equal results; an empty table gives an empty result.  Extra columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ready, table
from .op2_language import fold
from .words import NO_LETTER, mix, slices, span_hashes, text_buffer, word_bounds

SAMPLE = 32_768
WEIGHTS = 50_000
PRIOR = 5_000.0  # presences that the Dirichlet prior weighs
STEM = 4
Z = 3.0  # deviations that don't count
DRIFT = 0.15
RIDGE = 1e-2
THRESHOLD = 0.7


def token_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every token, hash of its stem, first token of each text and the end)."""
    data, at = text_buffer(column)
    starts, ends = word_bounds(data, at, NO_LETTER)
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # where code points start
    nth = np.searchsorted(heads, starts) + STEM
    stop = np.where(nth < len(heads), heads[np.minimum(nth, max(0, len(heads) - 1))], len(data)) if len(heads) else ends
    stems = mix(span_hashes(data, starts, np.minimum(ends, stop)) + np.uint64(1))
    return span_hashes(data, starts, ends), stems, np.searchsorted(starts, at)


def presences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each distinct feature of each text."""
    toks, stems, at = token_features(column)
    words, ids = np.unique(np.concatenate([toks, stems]), return_inverse=True)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    key = np.unique(np.concatenate([row, row]) * max(1, len(words)) + ids)
    return key // max(1, len(words)), words[key % max(1, len(words))] if len(words) else words


def _presence_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 23):
            row, h = presences(batch.column("text"))
            toxic = batch.column("toxic").to_numpy()[row].astype(np.int64)
            words, at = np.unique(h, return_inverse=True)
            n1 = np.bincount(at, weights=toxic, minlength=len(words)).astype(np.int64)
            n = np.bincount(at, minlength=len(words))
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n1), pa.array(n - n1)], names=["h", "toxic", "clean"])


def maximal_segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end) in one scan.

    Only positive scores open a segment, so the scan steps over those; each
    candidate keeps the totals before it (low) and after it (high), and the
    last candidate before it with a smaller low, over which searches jump."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[float, float, int, int, int]] = []  # low, high, start, end, link
    for i in np.flatnonzero(scores > 0).tolist():
        low, high, start, end = total[i], total[i + 1], i, i + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= high:
                break
            low, start = found[j][0], found[j][2]
            del found[j:]
        found.append((low, high, start, end, j))
    return [(high - low, start, end) for low, high, start, end, _ in found]


@dataclass
class Model:
    hashes: np.ndarray
    weights: np.ndarray
    lam: float = 1.0
    k: float = 1.0
    beta: tuple[float, float, float] = (0.0, 0.0, 0.0)
    known: bool = False

    def segments(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[float, int, int]]]]:
        """(tokens, maximal segments) of each text."""
        toks, stems, at = token_features(column)
        s = np.zeros(len(toks))
        if len(self.hashes) and len(toks):
            for found in (toks, stems):
                rank = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
                w = np.where(self.hashes[rank] == found, self.weights[rank], 0.0)
                s = np.where(np.abs(w) > np.abs(s), w, s)
        s -= DRIFT
        some = np.concatenate([[0], np.cumsum(s > 0)])[at]
        for i in range(len(at) - 1):
            n = int(at[i + 1] - at[i])
            yield n, maximal_segments(s[at[i] : at[i + 1]]) if some[i + 1] > some[i] else []

    def features(self, n: int, found: list[tuple[float, int, int]]) -> tuple[float, float]:
        """Best segment over the expected maximum, and the log of the sum of what significant ones have over it."""
        if not found:
            return -1.0, 0.0
        expected = np.log(max(1.0, self.k * n))
        over = np.array([self.lam * s - expected for s, _, _ in found])
        return max(-1.0, float(over.max())), float(np.log1p(np.maximum(over, 0).sum()))

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.zeros(len(x))
        z = self.beta[0] + x @ np.array(self.beta[1:])
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def karlin_lambda(scores: np.ndarray, mass: np.ndarray) -> float:
    """Positive root of sum(mass * exp(l * scores)) = 1; the mean must be negative."""
    low, high = 1e-6, 1.0
    value = lambda x: float((mass * np.exp(np.minimum(x * scores, 700))).sum()) - 1
    while value(high) < 0 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return (low + high) / 2


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(a.shape[1])
    ridge = RIDGE * np.array([0.0, *[1.0] * x.shape[1]]) * len(x) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (y - p) - ridge * beta
        hessian = (a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(b) for b in beta)


def _features(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = [(n, max((s for s, _, _ in found), default=0.0), *model.features(n, found)) for n, found in model.segments(batch.column("text"))]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 4
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(cols[0], pa.int64()), *[pa.array(c, pa.float64()) for c in cols[1:]]], names=[*names, "n_tokens", "best", "x1", "x2"])

    return run


def _scored(shared, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole, "text"):
                x, spans = [], []
                for n, found in model.segments(batch.column("text")):
                    x.append(model.features(n, found))
                    expected = np.log(max(1.0, model.k * n))
                    spans.append([[start, end] for s, start, end in found if model.lam * s > expected])
                p = model.probability(np.array(x, np.float64).reshape(-1, 2))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(p), pa.array(spans, pa.list_(pa.list_(pa.int32())))], names=[*names, "score", "passages"])

    return run


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Model of texts (doc_id, text) with labels (doc_id, toxic); both are the training fold's."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    given = labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    given = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    given = scratch.cut(given)
    # SAMPLE rows at most: broadcast
    texts = docs.select("doc_id", F.xxhash64("text").alias("th")).join(F.broadcast(given), "doc_id").groupBy("th").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic")).select("doc_id", "toxic")
    texts = scratch.cut(texts)
    sample = docs.select("doc_id", "text").join(F.broadcast(texts), "doc_id")
    counts = scratch.cut(sample.select("text", "toxic").mapInArrow(_presence_counts, "h long, toxic long, clean long").groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    total = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    empty = Model(np.zeros(0, np.uint64), np.zeros(0))
    if not total["t"] or not total["c"]:
        return empty
    nt, nc = float(total["t"]), float(total["c"])
    prior = F.lit(PRIOR / (nt + nc)) * (F.col("toxic") + F.col("clean"))
    yt, yc = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(yt / (nt + PRIOR - yt)) - F.log(yc / (nc + PRIOR - yc))
    n = F.col("toxic") + F.col("clean")
    part = lambda y, share: F.when(F.col(y) > 0, F.col(y) * F.log(F.col(y) / (n * share))).otherwise(0.0)
    z = F.sqrt(F.greatest(F.lit(0.0), 2 * (part("toxic", nt / (nt + nc)) + part("clean", nc / (nt + nc)))))
    # of a log-odds only what is beyond chance counts
    kept = counts.withColumn("z", z).where(F.col("z") > Z).select("h", "clean", (odds * (1 - F.lit(Z) / F.col("z"))).alias("weight"), "z")
    rows = kept.orderBy(F.desc("z"), "h").limit(WEIGHTS).toArrow().to_pandas().sort_values("h", key=lambda h: h.to_numpy().view(np.uint64))
    model = Model(rows["h"].to_numpy(np.int64).view(np.uint64), rows["weight"].to_numpy(np.float64))
    scores = np.append(model.weights - DRIFT, -DRIFT)
    clean = rows["clean"].to_numpy(np.float64) + 0.5
    mass = np.append(clean, max(1.0, nc - clean.sum()))
    mass /= mass.sum()
    if not (scores > 0).any() or float((scores * mass).sum()) >= 0:
        return empty
    model.lam = karlin_lambda(scores, mass)
    measured = lambda: sample.mapInArrow(_features(spark.sparkContext.broadcast(model), ["toxic"]), "toxic int, n_tokens long, best double, x1 double, x2 double").toArrow().to_pandas()
    rows = measured()
    null = rows[(rows["toxic"] == 0) & (rows["n_tokens"] > 0)]
    model.k = float(len(null) / max(1e-9, (null["n_tokens"] * np.exp(-model.lam * null["best"])).sum()))
    rows = measured()
    model.beta = logistic(rows[["x1", "x2"]].to_numpy(np.float64), rows["toxic"].to_numpy(np.float64))
    model.known = True
    scratch.drop(given, counts, texts)
    return model


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns with score and passages, the significant segments as [first token, end]."""
    shared = ready(docs.sparkSession).sparkContext.broadcast(model)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double", "passages array<array<int>>"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_scored(shared, keep), schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the fold crc32 mod 3 = 1."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), 3) == 1)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic").where(fold(F.col("doc_id"), 3) != 1)
    found = score(docs, train(docs.where("not held_out"), labels), ["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))
