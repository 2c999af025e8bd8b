"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products.

Equal vectors of one label collapse into one weighted row first.  Centroids
are fitted by spherical k-means on a bounded sample (the ``SAMPLE`` vectors
with the smallest hashes); every vector is assigned to its nearest centroid.
Two vectors with cosine >= t are at most ``sqrt(2 - 2t)`` apart, so if they have
different cells, one of the two is within half of that of the plane halfway
between the centroids.  A vector is therefore also compared, as a guest, in every
cell whose plane is that near, and a pair that meets in both cells counts in the
lower one only.  With ``deviations=None`` the whole length of the difference
counts, so no pair is lost whatever the vectors, at the cost of nearly all cells
for unstructured ones.  With a number of ``deviations``, only that many times
1 / sqrt(e) of it does, the share that a difference spread over e dimensions has
along any one line; e comes from the sample, as the square of its covariance's
trace over its square sum (the dimensions that carry the spread).  A pair whose
difference lies along the plane's normal beyond that may then be lost; the README
gives the measured recall.

A cell is cut into blocks of about ``BLOCK`` vectors, and one task compares
two blocks: a product of two bounded matrices.  It returns per vector the
weight of its partners and the smallest vector it hangs together with, never
the pairs, so a cell of thousands of mutual copies gives rows in proportion to
its vectors.

Defined results: a vector that is null, empty, zero, or holds null or
non-finite components, and a row without label or vec_id, links with nothing
and is its own component (kept); vectors of different length don't link;
repeated rows count as other vectors and link with each other, as do rows that
share a vec_id with other contents (a component is named by its smallest
vec_id); an empty table gives an empty result.  Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, components, table

SAMPLE = 20_000
CELL = 2048  # vectors a cell has on average
MOST_CELLS = 4096
BLOCK = 1024
ROUNDS = 12
DEVIATIONS = 4.0  # of a difference along a plane's normal that are searched


def spherical_kmeans(unit: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit vectors; starts from evenly spaced rows, an empty cell keeps its centroid."""
    k = min(k, len(unit))
    c = unit[np.linspace(0, len(unit) - 1, k).astype(np.int64)].copy() if k else unit[:0]
    for _ in range(rounds):
        home = np.empty(len(unit), np.int64)
        for i in range(0, len(unit), 4096):
            home[i : i + 4096] = np.argmax(unit[i : i + 4096] @ c.T, axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, unit)
        norm = np.linalg.norm(total, axis=1)
        ok = norm > 1e-12
        new = c.copy()
        new[ok] = total[ok] / norm[ok, None]
        if np.allclose(new, c, atol=1e-9):
            break
        c = new
    return c


def units(vectors: list | pa.Array) -> np.ndarray:
    m = np.array([np.asarray(v, np.float64) for v in vectors], np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)  # squares neither vanish nor overflow
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def spread_dimensions(unit: np.ndarray) -> float:
    """Dimensions over which unit vectors spread: all of them if alike, fewer if some carry most."""
    around = unit - unit.mean(axis=0)
    c = around.T @ around
    return float(np.trace(c) ** 2 / (c * c).sum()) if (c * c).sum() > 0 else 1.0


def _assign(centroids, reach: float):
    """Home cell of each vector, and the cells it visits: those whose plane is within ``reach``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centroids.value
        gap = np.linalg.norm(c[:, None, :] - c[None, :, :], axis=2) if len(c) * len(c) * c.shape[-1] <= 1 << 22 else None
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = batch.column("dim").to_numpy()
                cell = [[0] for _ in range(batch.num_rows)]
                fits = np.flatnonzero(dims == (c.shape[1] if len(c) else -1))
                if len(fits):
                    dots = units(batch.column("embedding").take(pa.array(fits)).to_pylist()) @ c.T
                    home = dots.argmax(axis=1)
                    for row, i in enumerate(fits):
                        h = home[row]
                        apart = gap[h] if gap is not None else np.linalg.norm(c - c[h], axis=1)
                        # 1e-9: cosines at the threshold itself stay in reach despite rounding
                        guest = np.flatnonzero(dots[row, h] - dots[row] <= reach * apart + 1e-9)
                        cell[i] = [int(h), *guest[guest != h].tolist()]
                n = np.array([len(x) for x in cell])
                rows = np.repeat(np.arange(batch.num_rows), n)
                first = np.zeros(len(rows), bool)
                first[np.cumsum(n) - n] = True
                batch = batch.append_column("visits", pa.array(cell, pa.list_(pa.int32())))
                out = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate(cell), pa.int32()) if len(rows) else pa.array([], pa.int32()), pa.array(first)], names=[*out.schema.names, "cell", "home"])

    return run


def _compare(threshold: float):
    """One pair of blocks: weights of partners, and the smallest vector of each hanging-together set."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h1", "h2"])
        unit = units(rows["embedding"].tolist())
        side, home, w, visits = (rows[x].to_numpy() for x in ("side", "home", "weight", "visits"))
        lives, here = np.array([v[0] for v in visits]), rows["cell"].iloc[0]
        node = rows["h1"].to_numpy()
        own = rows["bi"].iloc[0] == rows["bj"].iloc[0]
        a = np.flatnonzero(side == 0)
        b = a if own else np.flatnonzero(side == 1)
        links = np.zeros(len(rows), np.int64)
        label = np.arange(len(rows))
        if len(a) and len(b):
            near = (unit[a] @ unit[b].T >= threshold) & (home[a][:, None] | home[b][None, :])
            for x, y, met in ((a, b, near), (b, a, near.T)):  # guests x of homes y that also visit the guests' lower cell
                guests = np.flatnonzero(~home[x] & (lives[x] < here) & met.any(axis=1))
                homes = np.flatnonzero(home[y] & met.any(axis=0)) if len(guests) else guests
                for c in np.unique(lives[x[guests]]):
                    both = homes[[c in visits[i] for i in y[homes]]]
                    met[np.ix_(guests[lives[x[guests]] == c], both)] = False
            if own:
                np.fill_diagonal(near, False)
                links[a] = near @ w[a]
            else:
                links[a] = near @ w[b]
                links[b] = near.T @ w[a]
            linked_a, linked_b = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
            far = len(rows)
            while len(linked_a):  # rows ascend by name, so the smallest label is the smallest name
                low = np.where(near[linked_a], label[b][None, :], far).min(axis=1)
                new = label.copy()
                new[a[linked_a]] = np.minimum(new[a[linked_a]], low)
                low = np.where(near[:, linked_b], new[a][:, None], far).min(axis=0)
                new[b[linked_b]] = np.minimum(new[b[linked_b]], low)
                if (new == label).all():
                    break
                label = new
        some = links > 0
        return pd.DataFrame({"h1": node[some], "h2": rows["h2"].to_numpy()[some], "links": links[some], "root": node[label][some]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = 0.93, cell_size: int = CELL, block: int = BLOCK, deviations: float | None = DEVIATIONS) -> DataFrame:
    """Links and components of vectors (vec_id, embedding, label).  A class of
    equal vectors goes by its hash, so a reused vec_id joins nothing.

    Returns one row per input row: vec_id, n_links, component_id, kept.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    sound = F.coalesce(sound, F.lit(False))
    name = [F.xxhash64(F.lit(salt), "label", "embedding") for salt in (1, 2)]
    rows = rows.withColumn("sound", sound).withColumn("h1", F.when(F.col("sound"), name[0])).withColumn("h2", F.when(F.col("sound"), name[1]))
    classes = rows.where("sound").groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    classes = scratch.cut(classes)
    one = rows.where("sound").select("h1", "h2", F.col("vec_id").alias("rep"), "embedding", "label").join(classes, ["h1", "h2", "rep"]).dropDuplicates(["h1", "h2"])
    one = scratch.cut(one.withColumn("dim", F.size("embedding")))

    n = one.count()
    by_dim = one.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    sample = np.zeros((0, 0))
    if by_dim:
        picked = one.where(F.col("dim") == by_dim["dim"]).select("h1", "embedding").orderBy("h1").limit(SAMPLE).select("embedding")
        sample = units([r[0] for r in picked.collect()])
    centroids = spherical_kmeans(sample, max(1, min(MOST_CELLS, -(-n // cell_size)))) if len(sample) else sample
    shared = spark.sparkContext.broadcast(centroids)
    along = 1.0 if deviations is None or not len(sample) else min(1.0, deviations / np.sqrt(spread_dimensions(sample)))
    reach = float(np.sqrt(2 - 2 * threshold)) * along / 2

    placed = one.select("h1", "h2", "weight", "label", "dim", "embedding").mapInArrow(
        _assign(shared, reach), f"h1 long, h2 long, weight long, label {dict(one.dtypes)['label']}, dim int, embedding {dict(one.dtypes)['embedding']}, visits array<int>, cell int, home boolean"
    )
    placed = scratch.cut(placed)
    where = ["label", "dim", "cell"]
    blocks = placed.groupBy(*where).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.max(F.col("home").cast("int")).alias("homes")).where("homes = 1").drop("homes")
    dealt = placed.join(blocks, where).withColumn("b", F.pmod("h2", "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("bi", F.least("b", "other")).withColumn("bj", F.greatest("b", "other")).withColumn("side", (F.col("b") != F.col("bi")).cast("int"))
    found = dealt.select("h1", "h2", "weight", "embedding", "visits", "home", *where, "bi", "bj", "side").groupBy(*where, "bi", "bj")
    found = scratch.cut(found.applyInPandas(_compare(threshold), "h1 long, h2 long, links long, root long"))
    nodes = components(found.select(F.col("h1").alias("a"), F.col("root").alias("b")), scratch)
    nodes = nodes.select(F.col("node").alias("h1"), "component")
    least = classes.join(nodes, "h1").groupBy("component").agg(F.min("rep").alias("component_id"))
    nodes = nodes.join(least, "component").select("h1", "component_id")
    counted = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    named = classes.join(counted, ["h1", "h2"], "left").join(nodes, "h1", "left")
    named = scratch.cut(named.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")))
    scratch.drop(placed, found, one)
    out = rows.select("vec_id", "h1", "h2").join(named, ["h1", "h2"], "left")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all embeddings of equal label, cosine 0.93."""
    return near_vectors(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(x, y) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x
), comp AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x
), n AS (SELECT x, count(*) AS n_links FROM link GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, component_id = vec_id AS kept
FROM embeddings JOIN comp ON comp.x = vec_id LEFT JOIN n ON n.x = vec_id
"""
