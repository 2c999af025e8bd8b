"""Helpers shared by the operators of this subpackage.

Operators read their inputs with ``table`` (one Parquet table of a data
folder), cut lineage by writing Parquet into the shared checkpoint folder
(``Scratch``), and find connected components without gathering links
(``components``).
"""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadkeeper.session import checkpoint_dir, prepare


# Before a shuffle join, rows without a partner are dropped by a Bloom filter of
# the other side's keys (8 MB at most; a fuller filter only lets more rows by).
SESSION = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1m",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10g",
}
_MODEL: dict[object, object] = {}


def worker_model(key: object, build: Callable[[], object]) -> object:
    """The model that a Python worker holds: the last one asked for, so that a
    worker reused by another operator gives its memory back."""
    if key not in _MODEL:
        release_models()
        _MODEL[key] = build()
    return _MODEL[key]


def release_models() -> None:
    """Gives back the memory of a model that a reused worker still holds for an operator before."""
    _MODEL.clear()
    give_back()


def give_back() -> None:
    """Returns what a worker has freed to the system.  Arrow's pool and the C
    heap keep it otherwise, and a reused or idle worker stays as large as its
    largest batch ever made it."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):  # glibc's
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A worker's function over Arrow batches that gives back what was freed before it and by it."""

    def leaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from run(batches)
        give_back()

    return leaner


PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> SparkSession:
    """Engine settings, and this package on the path of the Python workers.

    Workers that find the package elsewhere (a wheel, --py-files) lose nothing
    by one more entry."""
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if PACKAGE_ROOT not in known:
        env["PYTHONPATH"] = ":".join([*known, PACKAGE_ROOT])
    for name, value in SESSION.items():
        spark.conf.set(name, value)
    return prepare(spark)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named table of a data folder, with only ``columns`` if any are given."""
    df = ready(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def shield(df: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` with all columns but ``used`` under neutral names, so that none
    clashes with an operator's own, and the function that names them again."""
    names = {c: c if c in used else f"_x{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(x) for c, x in names.items()]), lambda out: out.select(*[F.col(x).alias(c) for c, x in names.items()])


class Scratch:
    """Tables of one run in the shared checkpoint folder.

    ``cut`` writes a DataFrame as Parquet and reads it back: the files survive
    lost executors and later plans start from them.  ``drop`` deletes tables
    once everything that reads them has itself been written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = ready(spark)
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._n = 0

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self._n}"
        self._n += 1
        df.write.option("compression", "zstd").parquet(path)
        # the schema is known: no footer is read for it, an empty table works too
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for df in tables:
            if path := self._paths.pop(id(df), None):
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"] or 0


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``links`` (a, b: long) by alternating star steps.

    Returns (node, component) for every node of a link; component is the
    smallest node reachable.  Each round rewires neighbours to their smallest
    neighbour (map-side combined minima joined back, so a node with very many
    links is split by the skew-join rule) until no link changes; only the
    link count and a checksum come to the driver.
    """
    big, small = F.greatest("a", "b"), F.least("a", "b")
    edges = scratch.cut(links.where("a <> b").select(big.alias("u"), small.alias("v")).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        star = (
            joined.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after_edges = scratch.cut(star)
        scratch.drop(edges)
        edges, last = after_edges, before
        before = _state(edges)
        if before == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned CRC-32 of an ASCII string (null for null)."""
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END"
    byte = f"list_reduce(range(8)::UBIGINT[], lambda x, k: {bit}, xor(s, c))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT), lambda s, c: {byte}, 4294967295::UBIGINT), 4294967295::UBIGINT)"
