"""Language-model scoring from a log-frequency Bloom filter.

Counts of words and word pairs of the training texts are quantised to levels
(``THRESHOLDS``: a count's level is the number of thresholds it reaches), and
an n-gram of level q goes into a Bloom filter q times, once for each level
1..q.  A reader probes level 1, 2, ... until one is missing, so a count costs
bits by the logarithm of its size, and a false positive lifts it one level.
Every n-gram goes in, and the filter has ``BITS`` bits an insertion.

Texts travel in packets of about ``PACKET`` bytes.  A packet sends each hash
range the names (32 bits below the range) of its distinct n-grams with their
counts in training texts.  One group per range, bounded by the size of a range,
adds the counts up, fills its own stretch of the filter, probes it for every
name it got and sends each packet its levels back: one exchange counts, fills
and looks up.  The levels of all tokens are written, and both the model's pair
masses and the scores are read from them.  With ``broadcast`` the stretches go
to the driver and are broadcast whole instead, which gives the same scores;
it is for filters known to be small, and no size switches it on.

    p(w)     = (c(w) + 0.5) / (N + 0.5 * (V + 1))
    p(w | v) = g * c(v w) / c(v) + (1 - l) * p(w)

A level stands for the mean of the counts that have it, so p(w) sums to one
but for false positives.  l and g belong to the level of v: l is the share of
training tokens after such words that would still be found as a pair if the
token itself weren't counted, and g = l / (share of tokens found as a pair),
which hands exactly the mass l to pairs.

The base score needs exact counts of single words.  Words with at least the
count that at most ``HEAD`` words have are broadcast; the others are looked up
by a join on the word, for the few tokens outside the head.

Defined results: a null text is empty and has one token, the end; a null
doc_id counts as an empty one for the fold; a null held_out neither teaches nor
changes a score; repeated rows get equal results; without training texts N is 0
and every token unknown; an empty table gives an empty result.  Extra columns
of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, ready, table
from .op2_language import fold
from .words import mix, slices, text_buffer, word_hashes

BITS = 10
PROBES = 4
PACKET = 1 << 23  # bytes of text whose n-grams are counted and looked up together
RANGE_BYTES = 6 << 20  # bytes of text for each hash range
HEAD = 1 << 19
BASE = 1.5
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
THRESHOLDS = np.array(sorted({int(np.ceil(BASE**i)) for i in range(100)}), np.float64)
LEVELS = len(THRESHOLDS) + 1  # with level 0: not there
CLIP = 1024  # counts told apart when the least one of the head is chosen
LOW = np.uint64(0xFFFFFFFF)


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with an end after each text, first token of each text and the end)."""
    words, at = word_hashes(column)
    n = np.diff(at) + 1
    cuts = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(cuts[-1], np.uint64)
    end = np.zeros(cuts[-1], bool)
    end[cuts[1:] - 1] = True
    out[end] = END
    out[~end] = words
    return out, cuts


def pairs(toks: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it in its text."""
    before = np.empty_like(toks)
    before[1:] = toks[:-1]
    before[cuts[:-1]] = START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + toks)


def level(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(THRESHOLDS, counts, "right")


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", 1 << 24):
            toks = np.concatenate([tokens(part.column("text"))[0] for part in slices(batch, "text")])
            h, n = np.unique(toks, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "c"])


class Filter:
    """The bits of a log-frequency filter: a stretch for each hash range."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        """``bits`` packed by bytes; ``sizes`` of the stretches in bits, multiples of 8."""
        self.bits, self.sizes = bits, sizes.astype(np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def places(keys: np.ndarray, q: int, size: np.ndarray) -> Iterator[np.ndarray]:
        """Where level q of each key is marked, inside its stretch."""
        a = mix(keys + np.uint64(q * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
        b = (a >> np.uint64(32)) | np.uint64(1)
        for i in range(PROBES):
            yield ((a + np.uint64(i) * b & LOW) * size) >> np.uint64(32)

    @classmethod
    def stretch(cls, keys: np.ndarray, levels: np.ndarray, per_insertion: int) -> np.ndarray:
        """The filled bytes of one range."""
        marked = np.zeros(max(8, int(levels.sum()) * per_insertion // 64 + 1) * 64, bool)
        for q in range(1, int(levels.max(initial=0)) + 1):
            keys, levels = keys[levels >= q], levels[levels >= q]
            for place in cls.places(keys, q, np.uint64(len(marked))):
                marked[place] = True
        return np.packbits(marked, bitorder="little")

    def levels(self, keys: np.ndarray, ranges: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.uint8)
        left, base, size = np.arange(len(keys)), self.starts[ranges], self.sizes[ranges]
        for q in range(1, LEVELS):
            hit = np.ones(len(left), bool)
            for place in self.places(keys, q, size):
                at = place + base
                hit &= (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            left, keys, base, size = left[hit], keys[hit], base[hit], size[hit]
            if not len(left):
                break
            out[left] = q
        return out


def names(h: np.ndarray, bits: int) -> np.ndarray:
    """What packets send of a hash: its range and the 32 bits below."""
    return h >> np.uint64(32 - bits)


def key(name: np.ndarray, pair: np.ndarray | bool) -> np.ndarray:
    """A name as the filter of its range knows it; words and pairs are apart."""
    return name & LOW | np.asarray(pair).astype(np.uint64) << np.uint64(32)


def tally(name: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct names, ascending; how often each is in texts to learn from)."""
    x = np.sort(name << np.uint64(1) | learn.astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], x[1:] >> np.uint64(1) != x[:-1] >> np.uint64(1)]))
    return x[first] >> np.uint64(1), np.add.reduceat((x & np.uint64(1)).astype(np.int64), first)


def _packets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by numbered packets, each one compressed Arrow stream, with its bytes of text."""
    part, n = TaskContext.get().partitionId(), 0
    for whole in batches:
        for batch in slices(whole, "text", PACKET):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(batch)
            yield pa.RecordBatch.from_arrays([pa.array([part << 32 | n], pa.int64()), pa.array([len(text_buffer(batch.column("text"))[0])], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["packet", "bytes", "texts"])
            n += 1


def grams(texts: pa.Buffer) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a packet; hashes of their tokens and pairs, and the first token of each text and the end."""
    batch = pa.ipc.open_stream(texts).read_next_batch()
    toks, two, sizes = [], [], []
    for part in slices(batch, "text"):
        t, cuts = tokens(part.column("text"))
        toks.append(t)
        two.append(pairs(t, cuts))
        sizes.append(np.diff(cuts))
    return batch, np.concatenate(toks), np.concatenate(two), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _ask(bits: int):
    """Distinct n-grams of each packet by hash range: words first, then pairs; counts of 255 and more stand in ``big``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32)
        for whole in batches:
            for packet, texts in zip(whole.column("packet").to_pylist(), whole.column("texts"), strict=True):
                batch, toks, two, cuts = grams(texts.as_buffer())
                learn = np.repeat(batch.column("learn").to_numpy(zero_copy_only=False), np.diff(cuts))
                found = []
                for h in (toks, two):
                    name, n = tally(names(h, bits), learn)
                    found.append((name.astype("<u4"), n, np.searchsorted(name, edges)))
                del toks, two, learn
                rows = []
                for part in np.flatnonzero(sum(np.diff(cut) for _, _, cut in found)).tolist():
                    own = [(name[cut[part] : cut[part + 1]], n[cut[part] : cut[part + 1]]) for name, n, cut in found]
                    n = np.concatenate([n for _, n in own])
                    rows.append((part, packet, len(own[0][0]), b"".join(name.tobytes() for name, _ in own), np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype("<i8").tobytes()))
                for i in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + 256], strict=True), ASKED.types, strict=True)], schema=ASKED)

    return run


ASKED = pa.schema([("part", pa.int32()), ("packet", pa.int64()), ("words", pa.int32()), ("names", pa.binary()), ("counts", pa.binary()), ("big", pa.binary())])
ANSWER = pa.schema([("packet", pa.int64()), ("part", pa.int32()), ("words", pa.int32()), ("levels", pa.binary()), ("nums", pa.list_(pa.int64())), ("sums", pa.list_(pa.int64()))])
ANSWERED = "packet long, part int, words int, levels binary, nums array<long>, sums array<long>"


def _answer(whole: bool, per_insertion: int):
    """One range: the levels of the names of each packet, and a row without a packet that tells
    how many n-grams have each level and the sum of their counts (words, then pairs).  With
    ``whole`` only that row, and the bits of the range as its levels."""

    def run(asked: pa.Table) -> pa.Table:
        part = asked.column("part")[0].as_py()
        words = asked.column("words").to_numpy()
        sent = asked.column("names").to_pylist()
        size = np.array([len(x) // 4 for x in sent])
        ends = np.cumsum(size)
        pair = np.arange(ends[-1]) - np.repeat(ends - size, size) >= np.repeat(words, size)
        keys, at = np.unique(key(np.frombuffer(b"".join(sent), "<u4").astype(np.uint64), pair), return_inverse=True)
        n = np.frombuffer(b"".join(asked.column("counts").to_pylist()), np.uint8).astype(np.int64)
        n[n == 255] = np.frombuffer(b"".join(asked.column("big").to_pylist()), "<i8")
        count = np.bincount(at, weights=n).astype(np.int64)
        have = level(count)
        bits = Filter.stretch(keys, have, per_insertion)
        of = have + LEVELS * (keys >> np.uint64(32)).astype(np.int64)
        nums, sums = np.bincount(of, minlength=2 * LEVELS), np.bincount(of, weights=count, minlength=2 * LEVELS).astype(np.int64)
        own = ([None], [part], [None], [bits.tobytes() if whole else None], [nums.tolist()], [sums.tolist()])
        if not whole:
            found = Filter(bits, np.array([8 * len(bits)])).levels(keys, np.zeros(len(keys), np.int64))[at]
            rows = ([x.tobytes() for x in np.split(found, ends[:-1])], [None] * len(sent), [None] * len(sent))
            own = tuple([*x, *y] for x, y in zip((asked.column("packet").to_pylist(), [part] * len(sent), words.tolist(), *rows), own, strict=True))
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(own, ANSWER.types, strict=True)], schema=ANSWER)

    return run


class Head:
    """What reading a packet needs on a worker: N, V and the exact counts of frequent words."""

    def __init__(self, n: int, v: int, h: np.ndarray, counts: np.ndarray):
        self.n, self.v, self.h, self.counts = n, v, h, counts

    def exact(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which words are in the head, their counts or 0)."""
        if not len(self.h):
            return np.zeros(len(words), bool), np.zeros(len(words), np.int64)
        rank = np.minimum(np.searchsorted(self.h, words), len(self.h) - 1)
        there = self.h[rank] == words
        return there, np.where(there, self.counts[rank], 0)


LEVELLED = "doc_id long, held_out boolean, row long, learn boolean, n_tokens long, n_known long, base_score double, rare array<long>, times array<long>, seen binary, two binary"


def _levelled(head: Head, texts: pa.Buffer, bits: int, found) -> pa.RecordBatch:
    """The texts of a packet with the levels of their tokens and pairs; ``found`` gives the levels of distinct names (words, pairs)."""
    batch, toks, two, cuts = grams(texts)
    words, at = np.unique(toks, return_inverse=True)
    name = names(words, bits)
    new = np.concatenate([[True], name[1:] != name[:-1]])
    two, pair_at = np.unique(names(two, bits), return_inverse=True)
    of_words, of_pairs = found(name[new], two)
    seen, two = of_words[np.cumsum(new) - 1][at], of_pairs[pair_at]
    in_head, exact = head.exact(words)
    base = np.log10((exact + 0.5) / (head.n + 0.5 * (head.v + 1)))[at]
    known = (in_head & (exact > 0))[at]
    row = np.repeat(np.arange(batch.num_rows), np.diff(cuts))
    out = ~in_head[at]
    which, times = np.unique(row[out] * (len(words) + 1) + at[out], return_counts=True)
    cut = pa.array(np.searchsorted(which // (len(words) + 1), np.arange(batch.num_rows + 1)).astype(np.int32))
    rare = words[which % (len(words) + 1)].view(np.int64)
    lists = [pa.ListArray.from_arrays(cut, pa.array(x)) for x in (rare, times.astype(np.int64))]
    levels = [pa.array([x[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()) for x in (seen, two)]
    sums = [pa.array(np.diff(cuts)), pa.array(np.add.reduceat(known.astype(np.int64), cuts[:-1])), pa.array(np.add.reduceat(base, cuts[:-1]))]
    keep = ["doc_id", "held_out", "row", "learn"]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *sums, *lists, *levels], names=[*keep, "n_tokens", "n_known", "base_score", "rare", "times", "seen", "two"])


def _with_answers(bits: int, shared: Broadcast):
    def run(packet: pa.Table, answers: pa.Table) -> pa.Table:
        rows = answers.select(["part", "words", "levels"]).sort_by("part").to_pylist()
        levels = [np.frombuffer(b"".join(x), np.uint8) for x in ([r["levels"][: r["words"]] for r in rows], [r["levels"][r["words"] :] for r in rows])]
        return pa.Table.from_batches([_levelled(shared.value, texts.as_buffer(), bits, lambda words, two: levels) for texts in packet.column("texts")])

    return run


def _with_filter(bits: int, shared: Broadcast, filled: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = Filter(*filled.value)

        def found(words: np.ndarray, two: np.ndarray) -> list[np.ndarray]:
            return [whole.levels(key(x, pair), (x >> np.uint64(32)).astype(np.int64)) for x, pair in ((words, False), (two, True))]

        for batch in batches:
            for texts in batch.column("texts"):
                yield _levelled(shared.value, texts.as_buffer(), bits, found)

    return run


class Model:
    """What levels stand for: counts of words and pairs, and the pair mass after each level."""

    def __init__(self, n: int, v: int, texts: int, values: list[np.ndarray]):
        self.n, self.v, self.texts, self.values = n, v, texts, values
        self.pair_mass, self.gain = np.zeros(LEVELS), np.zeros(LEVELS)

    def read(self, batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Per token: its level, that of the token before it, that of the pair; and the first token of each text and the end."""
        seen, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8) for c in ("seen", "two"))
        cuts = np.concatenate([[0], np.cumsum(batch.column("n_tokens").to_numpy())])
        before = np.empty_like(seen)
        before[1:] = seen[:-1]
        before[cuts[:-1]] = level(np.array([self.texts]))[0]  # a text's start was seen as often as there are texts
        return seen, before, two, cuts

    def pair_use(self, batch: pa.RecordBatch) -> np.ndarray:
        """(level of the token before, [tokens, in a known pair, in one that is known without this token])."""
        _, before, two, _ = self.read(batch)
        again = level(np.array([2]))[0]
        return np.stack([np.bincount(before, weights=w, minlength=LEVELS) for w in (np.ones(len(two)), two > 0, two >= again)], axis=1).astype(np.int64)

    def score(self, batch: pa.RecordBatch) -> np.ndarray:
        seen, before, two, cuts = self.read(batch)
        one = ((self.values[0] + 0.5) / (self.n + 0.5 * (self.v + 1)))[seen]
        history = np.maximum(self.values[0], 1.0)[before]
        history[cuts[:-1]] = max(1, self.texts)
        pair = np.minimum(1.0, self.values[1][two] / history)
        logp = np.log10(self.gain[before] * pair + (1 - self.pair_mass[before]) * one)
        return np.minimum(np.add.reduceat(logp, cuts[:-1]), 0.0)


def _tokens_at_once(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    at = np.concatenate([[0], np.cumsum(batch.column("n_tokens").to_numpy())])
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


def _pair_use(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum((model.pair_use(part) for batch in batches for part in _tokens_at_once(batch)), np.zeros((LEVELS, 3), np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS, dtype=np.int32)), *[pa.array(total[:, i]) for i in range(3)]], names=["level", "n", "found", "again"])

    return run


def _scores(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = ["doc_id", "held_out", "row", "n_tokens", "n_known", "base_score"]
        for batch in batches:
            for part in _tokens_at_once(batch):
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(model.score(part))], names=[*kept, "score"])

    return run


def head_floor(words: DataFrame, most: int, clip: int) -> int:
    """A count that at most ``most`` words reach: the least one up to ``clip``, or else the least of ``THRESHOLDS``, the last of which no word reaches."""
    tops = np.zeros(clip + 1, np.int64)
    for r in words.groupBy(F.least("c", F.lit(clip)).alias("c")).count().collect():
        tops[r["c"]] = r["count"]
    reach = np.cumsum(tops[::-1])[::-1]
    if (reach <= most).any():
        return max(1, int(np.argmax(reach <= most)))
    above = [int(t) for t in THRESHOLDS if t > clip]
    reach = words.where(F.col("c") > clip).agg(*[F.count_if(F.col("c") >= t) for t in above]).first()
    return next(t for t, n in zip(above, reach, strict=True) if n <= most)


def levelled(docs: DataFrame, scratch: Scratch, broadcast: bool) -> tuple[DataFrame, Model, DataFrame, int]:
    """All texts with the levels of their tokens, the model, the exact word counts (h, c), and the least count in the broadcast head."""
    spark = scratch.spark
    packets = scratch.cut(docs.mapInArrow(_packets, "packet long, bytes long, texts binary"))
    words = scratch.cut(docs.where("learn").select("text").mapInArrow(_word_counts, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    total = words.agg(F.count("*").alias("v"), F.sum("c").alias("n")).first()
    v, n = total["v"], total["n"] or 0
    size = packets.agg(F.sum("bytes")).first()[0] or 0
    bits = min(20, max(0, int(np.ceil(np.log2(max(1, size) / RANGE_BYTES)))))
    asked = packets.select("packet", "texts").mapInArrow(_ask(bits), "part int, packet long, words int, names binary, counts binary, big binary")
    answers = scratch.cut(asked.groupBy("part").applyInArrow(_answer(broadcast, BITS), ANSWERED))

    values = [np.append(0.0, THRESHOLDS) for _ in range(2)]
    stats = answers.where("packet is null").select(F.posexplode(F.arrays_zip("nums", "sums")))
    for r in stats.groupBy("pos").agg(F.sum("col.nums").alias("n"), F.sum("col.sums").alias("s")).collect():
        if r["n"] and r["pos"] % LEVELS:
            values[r["pos"] // LEVELS][r["pos"] % LEVELS] = r["s"] / r["n"]
    floor = head_floor(words, HEAD, CLIP)
    head = words.where(F.col("c") >= floor).toArrow()
    h, counts = head["h"].to_numpy().view(np.uint64), head["c"].to_numpy()
    order = np.argsort(h)
    ends = words.where(F.col("h") == int(END.view(np.int64))).first()
    model = Model(n, v, ends["c"] if ends else 0, values)

    shared = spark.sparkContext.broadcast(Head(n, v, h[order], counts[order]))
    if broadcast:
        stretches = {r["part"]: r["levels"] for r in answers.select("part", "levels").toLocalIterator()}
        whole = [stretches.get(part, b"\0") for part in range(1 << bits)]
        filled = spark.sparkContext.broadcast((np.frombuffer(b"".join(whole), np.uint8), np.array([8 * len(x) for x in whole])))
        out = packets.select("texts").mapInArrow(_with_filter(bits, shared, filled), LEVELLED)
    else:
        given = answers.where("packet is not null").select("packet", "part", "words", "levels")
        out = packets.select("packet", "texts").groupBy("packet").cogroup(given.groupBy("packet")).applyInArrow(_with_answers(bits, shared), LEVELLED)
    out = scratch.cut(out)
    scratch.drop(packets, answers)
    used = out.where("learn").select("n_tokens", "seen", "two").mapInArrow(_pair_use(model), "level int, n long, found long, again long")
    for r in used.groupBy("level").agg(*[F.sum(c).alias(c) for c in ("n", "found", "again")]).collect():
        if r["again"]:
            model.pair_mass[r["level"]] = r["again"] / (r["n"] + 1)
            model.gain[r["level"]] = r["again"] / r["found"]
    return out, model, words, floor


def score(docs: DataFrame, broadcast: bool = False) -> DataFrame:
    """Scores of texts (doc_id, text, held_out) under the model of those not held out."""
    spark = ready(docs.sparkSession)
    scratch = Scratch(spark, "lm")
    learn = F.coalesce(~F.col("held_out"), F.lit(False))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.xxhash64("doc_id", "text").alias("row"), learn.alias("learn"), "text")
    first, model, words, floor = levelled(keyed, scratch, broadcast)
    id_ = F.coalesce("doc_id", F.lit(-(1 << 63)))
    rare = first.select(id_.alias("id"), "row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("id", "row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    found = rare.join(words.where(F.col("c") < floor), "h").dropDuplicates(["id", "row", "h"])  # repeated rows say the same
    found = found.groupBy("id", "row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10((F.col("c") + 0.5) / 0.5)).alias("gain"))
    scored = first.select("doc_id", "held_out", "row", "n_tokens", "n_known", "base_score", "seen", "two")
    scored = scored.mapInArrow(_scores(model), "doc_id long, held_out boolean, row long, n_tokens long, n_known long, base_score double, score double")
    return scored.withColumn("id", id_).join(found, ["id", "row"], "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by the model of those outside the fold crc32 mod 5 = 1."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", fold(F.col("doc_id"), 5) == 1)
    return score(docs)
