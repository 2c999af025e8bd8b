"""MinHash near-duplicates with odd sketches.

A document's set is its distinct word shingles, held as 64-bit hashes.  Rows
with equal sets form one class; only one row per class goes on, so copies cost
one aggregation that combines map-side.  Bands of ``rows`` MinHash samples are
the candidate keys.  Classes that share a band get an odd sketch: each of
``SAMPLES`` MinHash samples flips one of ``SKETCH_BITS`` bits, so that the
popcount of the XOR of two sketches estimates their similarity closely.

Candidates that share a band are never paired with each other all at once:

1. each band's smallest class is its hub; every other member is paired with
   the hub, tested by sketch and confirmed on full sets; components follow;
2. in bands that still hold several components, the members outside the
   band's largest one get a hub of their own (by hash, so bands differ), and
   every member of another component is paired with it in the same way;
3. in bands that still hold several components, members outside the largest
   one meet the members of other components, each pair in one of the bands it
   shares: semi-joins by sketch first, then those that a sketch paired meet
   once more with their full sets.  Both tests are made inside the joins, so
   that only members and links come out of them.

After these, every candidate pair was confirmed, refused, or lies inside one
component, so the components are those of all candidate pairs.

Defined results: without words (or text) the set is empty and the row is a
component of its own; rows without doc_id take no part (component null, kept);
repeated rows have equal sets and share a component, all rows with its
smallest doc_id are kept; rows that share a doc_id with other texts are linked
each by its own set; an empty table gives an empty result.  Extra columns
of the input are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, lean, release_models, shield, table
from .words import mix, slices, text_buffer, word_hashes

SAMPLES = 1024
SKETCH_BITS = 2048
DEVIATIONS = 4.5  # a pair at the threshold is refused by its sketch beyond so many
SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]
BLOCK = 512  # members of a band that meet as many others in one block
MISS = 1e-5  # chance that no band holds a pair at the threshold


def band_plan(threshold: float, miss: float = MISS, most_bands: int = 32) -> tuple[int, int]:
    """(bands, rows): the most selective bands that miss a pair at the threshold by ``miss`` at most."""
    best = (math.ceil(math.log(miss) / math.log(1 - threshold)), 1)
    for rows in range(2, 9):
        bands = math.ceil(math.log(miss) / math.log(1 - threshold**rows))
        if bands > most_bands:
            break
        best = (bands, rows)
    return best


def sketch_limit(threshold: float) -> int:
    """Most bits in which the sketches of a similar pair differ, but for
    ``DEVIATIONS``: those of the samples that differ and of the bits they hit."""
    d, n = SAMPLES * (1 - threshold), SKETCH_BITS
    p = (1 - (1 - 2 / n) ** (2 * d)) / 2
    per_sample = 2 * (1 - 2 / n) ** (2 * d)
    deviation = math.sqrt(n * p * (1 - p) + SAMPLES * threshold * (1 - threshold) * per_sample**2)
    return math.ceil(n * p + DEVIATIONS * deviation)


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, offsets by text)."""
    words, at = word_hashes(column)
    counts = np.diff(at)
    out, offsets = [], np.zeros(len(counts) + 1, np.int64)
    long = words.copy()
    for k in range(1, size):  # long[i]: the words i .. i+size-1 (meaningless over an edge, never used there)
        long[:-k] = long[:-k] * np.uint64(0x9E3779B97F4A7C15) + words[k:]
    long = mix(long)
    for i, (lo, n) in enumerate(zip(at[:-1], counts, strict=True)):
        if n >= size:
            s = np.unique(long[lo : lo + n - size + 1])
        elif n:
            h = np.uint64(n)
            for w in words[lo : lo + n]:
                h = np.uint64((int(h) * 0xD6E8FEB86659FD93 + int(w)) & 0xFFFFFFFFFFFFFFFF)
            s = mix(np.array([h], np.uint64))
        else:
            s = np.zeros(0, np.uint64)
        out.append(s)
        offsets[i + 1] = offsets[i] + len(s)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), offsets


def set_keys(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set; 0 for an empty one."""
    n = np.diff(offsets)
    full = n > 0
    keys = []
    for salt in (0x632BE59BD9B4E019, 0xA24BAED4963EE407):
        k = np.zeros(len(n), np.uint64)
        if full.any():
            k[full] = mix(np.add.reduceat(mix(values ^ np.uint64(salt)), offsets[:-1][full]) + n[full].astype(np.uint64))
        keys.append(k)
    return keys[0], keys[1]


def min_hashes(values: np.ndarray, offsets: np.ndarray, samples: int) -> np.ndarray:
    """(samples, texts) of 64-bit minima; all ones for an empty set."""
    n = np.diff(offsets)
    out = np.full((samples, len(n)), np.uint64(0xFFFFFFFFFFFFFFFF))
    full = np.flatnonzero(n > 0)
    if not len(full):
        return out
    mult = mix(np.arange(1, samples + 1, dtype=np.uint64)) | np.uint64(1)
    flip = mix(np.arange(samples + 1, 2 * samples + 1, dtype=np.uint64))
    most = 1 << 15  # values at once, so that they stay in cache
    i = 0
    while i < len(full):
        j = max(i + 1, int(np.searchsorted(offsets[full], offsets[full[i]] + most, "right")) - 1)
        j = min(j, len(full))
        own = full[i:j]
        lo, hi = offsets[own[0]], offsets[own[-1] + 1]
        v, cuts = values[lo:hi], offsets[own] - lo
        for s in range(samples):
            out[s, own] = np.minimum.reduceat((v ^ flip[s]) * mult[s], cuts)
        i = j
    return out


def band_keys(minima: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) of 64-bit keys; equal only for the same band and samples."""
    out = np.empty((minima.shape[1], bands), np.uint64)
    for b in range(bands):
        h = np.full(minima.shape[1], np.uint64(b + 1))
        for r in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + minima[b * rows + r])
        out[:, b] = h
    return out


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """(texts, words) of the parity bitmaps: sample s of value m flips bit hash(s, m)."""
    samples, n = minima.shape
    bits = np.zeros((n, SKETCH_BITS), np.uint8)
    row = np.arange(n)
    for s in range(samples):
        bits[row, (mix(minima[s] + np.uint64(s + 1)) % np.uint64(SKETCH_BITS)).astype(np.int64)] ^= 1
    return np.packbits(bits, axis=1).view(np.int64)


def _features(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_models()
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = shingle_sets(part.column("text"), size)
                k1, k2 = set_keys(values, offsets)
                minima = min_hashes(values, offsets, bands * rows)
                keys = band_keys(minima, bands, rows).view(np.int64)
                lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, bands, dtype=np.int32), keys.ravel())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("th"), pa.array(np.diff(offsets)), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), lists],
                    names=["doc_id", "th", "n", "k1", "k2", "bands"],
                )

    return lean(run)


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_models()
        for batch in batches:
            for part in slices(batch, "text"):
                values, offsets = shingle_sets(part.column("text"), size)
                k1, _ = set_keys(values, offsets)
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
                sketch = odd_sketches(min_hashes(values, offsets, SAMPLES))
                cols = [pa.array(k1.view(np.int64)), lists, *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(len(SKETCH))]]
                yield pa.RecordBatch.from_arrays(cols, names=["rep", "members", *SKETCH])

    return lean(run)


def similar(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union of two sets held as arrays."""
    both = F.size(F.array_intersect(a, b))
    return (100 * F.least(F.size(a), F.size(b)) >= percent * F.greatest(F.size(a), F.size(b))) & (100 * both >= percent * (F.size(a) + F.size(b) - both))


def sketch_distance(a: str, b: str) -> Column:
    """Bits in which two sketches (columns ``<a>s0``...) differ."""
    out = F.lit(0)
    for s in SKETCH:
        out = out + F.bit_count(F.col(f"{a}{s}").bitwiseXOR(F.col(f"{b}{s}")))
    return out


def block_count(members: Column) -> Column:
    return F.greatest(F.ceil(members / BLOCK), F.lit(1)).cast("int")


def in_blocks(members: DataFrame, name: str, own: str, others: str) -> DataFrame:
    """Members by their block (own, of as many as column ``own`` says) and once
    for each block of the other side (each)."""
    dealt = members.withColumn("own", F.pmod(F.xxhash64(name), F.col(own)).cast("int"))
    return dealt.withColumn("each", F.explode(F.sequence(F.lit(0), F.col(others) - 1))).drop(own, others)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents (doc_id, text) whose shingle sets have
    100 * intersection >= percent * union, confirmed on the full sets.

    Returns one row per row of ``docs``: doc_id, n_shingles, component_id, kept,
    th, a hash of the text, and group, a name of the component that tells
    components apart whose smallest doc_id is the same, reused one.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    bands, rows = band_plan(percent / 100)
    limit = sketch_limit(percent / 100)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = docs.withColumn("th", F.xxhash64("text"))
    feats = scratch.cut(hashed.mapInArrow(_features(shingle, bands, rows), "doc_id long, th long, n long, k1 long, k2 long, bands array<long>"))
    linked = feats.where("n > 0 and doc_id is not null")
    # one row per class, which goes by the name of its set: a doc_id may be smallest in several; equal sets have equal bands
    low = linked.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "th")).alias("low"), F.first("bands").alias("bands"))
    reps = scratch.cut(low.select(F.col("k1").alias("rep"), "k2", "low.*", "bands"))
    classes = scratch.cut(reps.select(F.col("rep").alias("k1"), "k2", F.col("doc_id").alias("rep"), "th"))
    rows_ = scratch.cut(feats.drop("bands"))
    scratch.drop(feats)
    # dealt by key once, for the hubs and for the join with them
    keys = reps.select(F.explode("bands").alias("key"), "rep").repartition("key")
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").select("key", "hub")
    shared = scratch.cut(keys.join(hubs, "key").distinct())
    wanted = shared.select("rep").distinct()
    near = scratch.cut(reps.select("rep", "doc_id", "th").join(wanted, "rep", "left_semi"))
    scratch.drop(reps)
    # the comparison lets Spark build its runtime Bloom filter of the wanted ids, ahead of the shuffle of texts;
    # a class is computed from its first text, so its set needs no more shuffle
    texts = hashed.join(near.where(F.col("doc_id") >= -(1 << 63)).select("doc_id", "th"), ["doc_id", "th"], "left_semi").distinct()
    sets = scratch.cut(texts.mapInArrow(_sets(shingle), f"rep long, members array<long>, {', '.join(f'{s} long' for s in SKETCH)}"))

    def side(name: str, full: bool = False) -> DataFrame:
        own = [F.col(s).alias(f"{name}_{s}") for s in SKETCH] + [F.col("members").alias(f"{name}_set")] * full
        return sets.select(F.col("rep").alias(name), *own)

    near_enough = sketch_distance("a_", "b_") <= limit

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of candidate pairs (a, b) those that the sketches let by and the full sets confirm."""
        tried = pairs.distinct().join(side("a"), "a").join(side("b"), "b").where(near_enough).select("a", "b")
        full = tried.join(sets.select(F.col("rep").alias("b"), F.col("members").alias("b_set")), "b")
        full = full.join(sets.select(F.col("rep").alias("a"), F.col("members").alias("a_set")), "a")
        return full.where(similar(F.col("a_set"), F.col("b_set"), percent)).select("a", "b")

    def several(labels: DataFrame) -> DataFrame:
        """Members of bands that hold several components: key, rep, label, and the band's largest component."""
        members = shared.select("key", "rep").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        sizes = members.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", "count").alias("largest"), F.count("*").alias("labels"))
        return scratch.cut(members.join(sizes.where("labels > 1").drop("labels"), "key"))

    def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
        """Components (rep, label) after more links, found between the components so far."""
        old = labels.select(F.col("rep").alias("x"), F.col("label").alias("lx"))
        ends = links.join(old.withColumnRenamed("x", "a").withColumnRenamed("lx", "la"), "a", "left").join(old.withColumnRenamed("x", "b").withColumnRenamed("lx", "lb"), "b", "left")
        ends = scratch.cut(ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
        if ends.isEmpty():
            return labels
        found = components(ends, scratch).withColumnRenamed("node", "label").withColumnRenamed("component", "to")
        known = labels.join(found, "label", "left").select("rep", F.coalesce("to", "label").alias("label"))
        fresh = found.join(labels.select(F.col("rep").alias("label")), "label", "left_anti").select(F.col("label").alias("rep"), F.col("to").alias("label"))
        return scratch.cut(known.union(fresh))

    links = scratch.cut(confirmed(shared.where("rep > hub").select(F.col("hub").alias("a"), F.col("rep").alias("b"))))
    labels = scratch.cut(components(links, scratch).select(F.col("node").alias("rep"), F.col("component").alias("label")))
    members = several(labels)
    if not members.isEmpty():
        second = members.where("label <> largest").groupBy("key").agg(F.min_by(F.struct("rep", "label"), F.xxhash64("key", "rep")).alias("hub"))
        pairs = members.join(second, "key").where("label <> hub.label").select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b"))
        labels = joined(labels, confirmed(pairs))
        members = several(labels)
    if not members.isEmpty():
        bands_of = members.groupBy("rep").agg(F.collect_list("key").alias("keys"))
        tagged = scratch.cut(members.join(bands_of, "rep"))

        def sides(some: DataFrame, full: bool) -> tuple[DataFrame, DataFrame, Column]:
            """Members outside the largest component, all members, and when two of other components
            meet: in one of the bands they share, if their sketches let them by."""
            rest = some.where("label <> largest").select("key", F.col("rep").alias("a"), F.col("label").alias("la"), F.col("keys").alias("ka")).join(side("a", full), "a")
            all_ = some.select(F.col("key").alias("other"), F.col("rep").alias("b"), F.col("label").alias("lb"), F.col("keys").alias("kb"), (F.col("label") == F.col("largest")).alias("main")).join(side("b", full), "b")
            pair = (F.col("key") == F.col("other")) & (F.col("la") != F.col("lb")) & (F.col("main") | (F.col("a") < F.col("b"))) & near_enough
            return rest, all_, pair & (F.array_min(F.array_intersect("ka", "kb")) == F.col("key"))

        # by sketch alone first, a member once however many it meets: only these send their full sets to the bands
        rest, all_, meet = sides(tagged, False)
        met = rest.join(all_, meet, "left_semi").select("key", F.col("a").alias("rep"))
        met = met.union(all_.join(rest, meet, "left_semi").select(F.col("other").alias("key"), F.col("b").alias("rep")))
        some = scratch.cut(tagged.join(scratch.cut(met.distinct()), ["key", "rep"], "left_semi"))
        rest, all_, meet = sides(some, True)
        # a band's pairs are dealt in blocks of both sides, so that neither a task nor the number of tasks grows with a band
        blocks = some.groupBy("key").agg(block_count(F.count_if(F.expr("label <> largest"))).alias("n"), block_count(F.count("*")).alias("m"))
        rest = in_blocks(rest.join(blocks, "key"), "a", "n", "m").withColumnsRenamed({"own": "i", "each": "j"}).repartition("key", "i", "j")
        all_ = in_blocks(all_.join(blocks.withColumnRenamed("key", "other"), "other"), "b", "m", "n").withColumnsRenamed({"own": "y", "each": "x"}).repartition("other", "x", "y")
        meet = meet & (F.col("i") == F.col("x")) & (F.col("j") == F.col("y"))
        labels = joined(labels, rest.join(all_, meet & similar(F.col("a_set"), F.col("b_set"), percent)).select("a", "b").distinct())
    least = classes.join(labels.withColumnRenamed("rep", "k1"), "k1").groupBy("label").agg(F.min("rep").alias("component"))
    named = labels.join(least, "label").select(F.col("rep").alias("k1"), "component", "label")
    named = classes.join(named, "k1", "left").select("k1", "k2", F.coalesce("component", "rep").alias("component"), F.coalesce("label", "k1").alias("group"))
    out = rows_.join(named, ["k1", "k2"], "left")
    component = F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "th", "group")
    scratch.drop(shared, near, sets, links, members)
    return out.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents: 3-word shingles, similarity 0.85."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_duplicates(docs, shingle=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


OP3_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS shingle FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), c AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, component_id = d.doc_id AS kept
FROM documents d JOIN comp ON comp.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each group of near-duplicates stays
    (five words a shingle, similarity 0.8)."""
    docs, named = shield(docs, "doc_id", "text")
    found = near_duplicates(docs).where("kept and doc_id is not null")
    one = found.groupBy("doc_id", "group").agg(F.min("th").alias("th"))  # of repeated rows one stays
    kept = docs.withColumn("th", F.xxhash64("text")).join(one, ["doc_id", "th"], "left_semi").dropDuplicates(["doc_id", "th"])
    return named(kept.select(*docs.columns).unionByName(docs.where("doc_id is null")))
