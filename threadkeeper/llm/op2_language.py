"""Language identification by cross-parsing entropy.

For each language a suffix automaton of a bounded sample of labelled text
recognises every substring of the sample.  A text is parsed into phrases, each
the longest match from where the last one ended; the fewer phrases (normalised
by the text's length, equal for all languages), the closer the language.  A
parse never steps back, so automaton plus "restart at the root and count one
phrase" is one dense transition table, and all languages walk many blocks of
text side by side with one table look-up per symbol.

Symbols are lower-cased letters; what stands between letters is one blank.
Phrases end at the edges of blocks of ``BLOCK`` symbols, in every language
alike, so memory is bounded for texts of any length and whole texts count.

The sample: per language, the ``SAMPLE_TEXTS`` distinct training texts with the
smallest hashes, with equal shares of ``SAMPLE_SYMBOLS`` symbols, and all
languages together have ``ALL_SYMBOLS`` at most.

Defined results: a null text, and one without letters, is ``und`` with score
0; so is every text if nothing was learned; ties go to the first language in
code-point order; a null doc_id counts as an empty one for the fold; repeated
rows give equal results; an empty table gives an empty result.  Extra columns
of the input are not read.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean, ready, shield, table, worker_model
from .words import slices

SAMPLE_TEXTS = 64
SAMPLE_SYMBOLS = 1 << 16
ALL_SYMBOLS = 1 << 20
BLOCK = 2048
FREQUENT = 95  # letters with a symbol of their own; the others share RARE
RARE = 32
BREAK = 1 << 29  # a transition holds the phrases it ends above this bit
UNDETERMINED = "und"


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(n))


_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTER[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols(text: str, ids: np.ndarray) -> np.ndarray:
    """Symbol ids of a text: 0 between letters (once), none before the first."""
    cp = code_points(text)
    s = np.where(letters()[cp], ids[cp], 0).astype(np.uint8)
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    return s[keep]


def symbol_ids(samples: dict[str, list[str]]) -> np.ndarray:
    """Code point -> symbol id: the most frequent letters of the samples, then shared ids."""
    n = Counter()
    for texts in samples.values():
        for t in texts:
            n.update(t.lower())
    ids = (FREQUENT + 1 + np.arange(sys.maxunicode + 1) % RARE).astype(np.uint8)
    for i, (c, _) in enumerate(sorted(((c, k) for c, k in n.items() if c.isalpha()), key=lambda x: (-x[1], x[0]))[:FREQUENT]):
        ids[ord(c)] = i + 1
    return ids


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts all substrings; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p != -1:
            q = go[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and go[p].get(c) == q:
                    go[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return go


class CrossParser:
    """All languages' automata as one table: state * width + symbol -> next state, plus BREAK for each phrase that ends."""

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        self.ids = symbol_ids(samples)
        most = min(SAMPLE_SYMBOLS, ALL_SYMBOLS // max(1, len(samples)))
        texts = {}
        for name in self.languages:
            share = max(1024, most // max(1, len(samples[name])))
            pieces = [np.append(symbols(t, self.ids)[:share], np.uint8(0)) for t in samples[name]]
            texts[name] = np.concatenate(pieces)[:most] if pieces else np.zeros(0, np.uint8)
        # symbols that no sample has share the last column
        seen = np.unique(np.concatenate([np.zeros(0, np.uint8), *texts.values()]))
        self.width = len(seen) + 1
        self.column = np.full(FREQUENT + RARE + 1, len(seen), np.uint8)
        self.column[seen] = np.arange(len(seen))
        parts, roots, base = [], [], 0
        for name in self.languages:
            go = suffix_automaton(self.column[texts[name]])
            # a symbol that doesn't go on ends the phrase; one that the root lacks is a phrase by itself, too
            root = np.array([base + go[0][c] + BREAK if c in go[0] else base + 2 * BREAK for c in range(self.width)], np.int32)
            t = np.broadcast_to(root, (len(go), self.width)).copy()
            t[0] -= BREAK  # at the root no phrase is open
            for state, to in enumerate(go):
                t[state, list(to)] = base + np.fromiter(to.values(), np.int32, len(to))
            parts.append(t.ravel())
            roots.append(base)
            base += len(go)
        self.table = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.roots = np.array(roots, np.int64)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): phrases of each text's parse."""
        owner, blocks = [], []
        for i, t in enumerate(texts):
            for at in range(0, len(t), BLOCK):
                owner.append(i)
                blocks.append(self.column[t[at : at + BLOCK]])
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        if not blocks or not self.languages:
            return out
        size = np.array([len(b) for b in blocks])
        order = np.argsort(-size, kind="stable")
        size = size[order]
        grid = np.zeros((BLOCK, len(blocks)), np.uint8)
        for j, i in enumerate(order):
            grid[: len(blocks[i]), j] = blocks[i]
        state = np.repeat(self.roots[:, None], len(blocks), axis=1)
        count = np.zeros(state.shape, np.int64)
        active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
        for step in range(int(size[0])):
            k = active[step]
            to = self.table[state[:, :k] * self.width + grid[step, :k]]
            count[:, :k] += to >> 29
            state[:, :k] = to & (BREAK - 1)
        count += state != self.roots[:, None]  # the block's end ends the last phrase
        np.add.at(out, np.array(owner)[order], count.T)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score): the score is the share of the language among exp2(-phrases more than the best's)."""
        parsed = [symbols(t, self.ids) if t else np.zeros(0, np.uint8) for t in texts]
        n = self.phrases(parsed)
        some = np.array([bool(len(s)) and bool(self.languages) for s in parsed], bool)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        best = n.argmin(axis=1)
        odds = np.exp2(-np.minimum(n - n.min(axis=1, keepdims=True), 1000).astype(np.float64))
        return [self.languages[b] if ok else UNDETERMINED for b, ok in zip(best, some, strict=True)], np.where(some, 1 / odds.sum(axis=1), 0.0)


def _predict(samples, key: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = worker_model(("language", key), lambda: CrossParser(samples.value))
        for whole in batches:
            for batch in slices(whole, "text", 1 << 22):
                lang, score = parser.predict(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(lang, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    return lean(run)


def learn(docs: DataFrame) -> dict[str, list[str]]:
    """The bounded sample of training rows (text, lang): language -> texts."""
    rows = docs.where("text is not null and lang is not null").withColumn("_h", F.xxhash64("text"))
    names = rows.select("lang", "_h").distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))
    picked = names.withColumn("_n", nth).where(F.col("_n") <= SAMPLE_TEXTS).select("lang", "_h").collect()
    hashes = [r["_h"] for r in picked]
    wanted = {(r["lang"], r["_h"]) for r in picked}
    found: dict[str, dict[int, str]] = {}
    most = SAMPLE_SYMBOLS  # code points that a text can give to the sample
    some = rows.where(F.col("_h").isin(hashes)) if hashes else rows.limit(0)
    for r in some.select("lang", "_h", F.substring("text", 1, most).alias("text")).dropDuplicates(["lang", "_h"]).toLocalIterator():
        if (r["lang"], r["_h"]) in wanted:
            found.setdefault(r["lang"], {})[r["_h"]] = r["text"]
    return {lang: [t for _, t in sorted(texts.items())] for lang, texts in found.items()}


def predict(docs: DataFrame, samples: dict[str, list[str]], keep: list[str]) -> DataFrame:
    """``keep`` columns of ``docs`` (text and more) with lang_pred and score."""
    spark = docs.sparkSession
    shared = ready(spark).sparkContext.broadcast(samples)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string", "score double"])
    key = hash(tuple((k, *v) for k, v in sorted(samples.items())))
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_predict(shared, key, keep), schema)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the fold crc32 mod 4 = 2."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn("held_out", fold(F.col("doc_id"), 4) == 2)
    samples = learn(docs.where("not held_out"))
    return predict(docs, samples, ["doc_id", "held_out"])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a determined language (no text, no letter) go."""
    samples = learn(docs.where(fold(F.col("doc_id"), 4) != 2))
    docs, named = shield(docs, "text")
    return named(predict(docs, samples, docs.columns).where(F.col("lang_pred") != UNDETERMINED))
