"""Merkle manifest of a dataset: checkpoint and recompute.

Every row is a leaf.  The leaves of a group (a language) in order make a tree
whose node is the hash of every two consecutive nodes below; the group's root
is a leaf of the tree over all groups.  Only every ``STRIDE``-th level is
stored.  A stored node stands for an aligned subtree of at most 2^STRIDE
stored nodes below it, so building the next stored level and extracting proofs
both work on one such subtree at a time: its inner nodes are computed again
from the stored ones, used, and never written.

* ``indexed``: leaves get their place in the group by a range-partitioned sort
  and the row counts of its parts, so one group that holds a third of all rows
  is dealt over many tasks;
* ``build``: the stored levels from the leaves up, until one node is left in
  every group; a subtree is one bounded group (2^STRIDE digests);
* ``prove``: from the root down, each subtree hands every stored node below
  its siblings inside the subtree followed by those of the node above;
* ``verify``: folds a leaf with its siblings up to the root.

Only row counts by part and the root come to the driver.  A path has one entry
per level: the sibling (null if the node has none, as at a level's odd end)
and whether it stands to the left.

Defined results: null values of a row enter its leaf as "-"; rows order by
doc_id (null first), then by leaf, and equal rows are leaves of their own;
null lang is a language of its own and comes first; empty and very long texts
are hashed whole; an empty table has no root and gives no rows; columns that
aren't part of the leaf are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, crc32_sql, shuffle_partitions, table

STRIDE = 8  # levels between stored ones: 256 digests in a subtree
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_MODULUS = 7
PATH = "array<struct<sibling:string,left:boolean>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the concatenated strings."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value in a leaf: "-" if null, else its UTF-8 length, a colon and itself."""
    s = value.cast("string")
    return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf(**changed: Column) -> Column:
    return digest(*[field(changed.get(c, F.col(c))) for c in FIELDS])


def _half(n: Column) -> Column:
    return F.ceil(n / F.lit(2)).cast("long")


def indexed(rows: DataFrame, group: Column, order: list[Column], scratch: Scratch) -> DataFrame:
    """``rows`` with g (the group's key), idx (place in its group by ``order``,
    from 0) and m (rows of the group)."""
    n = shuffle_partitions(rows.sparkSession)
    dealt = rows.withColumn("g", group).withColumn("_row", F.monotonically_increasing_id())
    keys = [F.col("g"), *order, F.col("_row")]  # the last only splits equal rows
    parts = dealt.repartitionByRange(n, *keys).sortWithinPartitions(*keys).drop("_row")
    placed = scratch.cut(parts.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    # a group has one run per part of the sort at most
    runs = placed.groupBy("g", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    whole = Window.partitionBy("g")
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = runs.select("g", "part", (F.coalesce(before, F.lit(0)) - F.col("start")).alias("shift"), F.sum("n").over(whole).alias("m"))
    return placed.join(offsets, ["g", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _levels(digests: Column, m: Column) -> Column:
    """The levels of an aligned subtree, from its stored digests up: at most
    STRIDE more, as long as the group (m nodes at the lowest) has several nodes."""

    def above(state: Column, _: Column) -> Column:
        last, left = F.element_at(state["levels"], -1), state["m"]
        parent = lambda i: F.sha2(F.concat(F.get(last, 2 * i), F.coalesce(F.get(last, 2 * i + 1), F.lit(""))), 256)
        nodes = F.transform(F.sequence(F.lit(0), F.floor((F.size(last) - 1) / F.lit(2)).cast("int")), parent)
        return F.when(left > 1, F.struct(F.concat(state["levels"], F.array(nodes)).alias("levels"), _half(left).alias("m"))).otherwise(state)

    start = F.struct(F.array(digests).cast("array<array<string>>").alias("levels"), m.cast("long").alias("m"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STRIDE)), start, above)["levels"]


def _subtrees(nodes: DataFrame, *more: str) -> DataFrame:
    """One row per aligned subtree: its stored nodes in order, and its levels."""
    block = F.shiftright("idx", STRIDE).alias("block")
    kept = F.struct("idx", "digest", *more)
    rows = nodes.groupBy("g", block).agg(F.first("m").alias("m"), F.sort_array(F.collect_list(kept)).alias("nodes"))
    return rows.withColumn("levels", _levels(F.transform("nodes", lambda x: x["digest"]), F.col("m")))


def build(leaves: DataFrame, scratch: Scratch, *more: str) -> list[DataFrame]:
    """The stored levels of every group's tree, leaves (g, idx, m, digest) first;
    the last has one node per group."""
    stored = [leaves]
    most = leaves.agg(F.max("m").alias("m")).first()["m"] or 0
    while most > 1:
        top = F.element_at(F.element_at("levels", -1), 1)
        shrunk = reduce(lambda n, _: _half(n), range(STRIDE), F.col("m"))
        up = _subtrees(stored[-1]).select("g", F.col("block").alias("idx"), shrunk.alias("m"), top.alias("digest"))
        stored.append(scratch.cut(up))
        most = -(-most >> STRIDE)
    return stored


def _own_path(node: Column, levels: Column) -> Column:
    """Path of a stored node up to the top of its subtree."""
    place = node["idx"].bitwiseAND((1 << STRIDE) - 1).cast("int")

    def step(level: Column, t: Column) -> Column:
        here = F.call_function("shiftright", place, t)
        return F.struct(F.get(level, here.bitwiseXOR(F.lit(1))).alias("sibling"), (here.bitwiseAND(F.lit(1)) == 1).alias("left"))

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), step)


def prove(stored: list[DataFrame], top: DataFrame, scratch: Scratch, out, *more: str) -> DataFrame:
    """Walks the stored levels down from ``top`` (g, path of the group's root)
    and applies ``out(node, path)`` to every leaf; its struct's fields are the
    columns of the result, beside g."""
    paths = top.select("g", F.lit(0).cast("long").alias("block"), "path")
    for level in reversed(stored[1:]):
        down = _subtrees(level).join(paths, ["g", "block"])
        each = F.transform("nodes", lambda x: F.struct(x["idx"].alias("block"), F.concat(_own_path(x, F.col("levels")), F.col("path")).alias("path")))
        paths = scratch.cut(down.select("g", F.inline(each)))
    down = _subtrees(stored[0], *more).join(paths, ["g", "block"])
    return down.select("g", F.inline(F.transform("nodes", lambda x: out(x, F.concat(_own_path(x, F.col("levels")), F.col("path"))))))


def verify(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""

    def fold(node: Column, step: Column) -> Column:
        s = F.coalesce(step["sibling"], F.lit(""))
        return F.sha2(F.when(step["left"], F.concat(s, node)).otherwise(F.concat(node, s)), 256)

    return F.aggregate(path, start, fold)


def manifest(docs: DataFrame, checked: Column | None = None) -> tuple[DataFrame, str | None]:
    """(rows, root): doc_id, leaf, subroot, path (siblings up to the root),
    proof_sha256 and folded_root of every row.  ``checked`` is the leaf that is
    folded in place of a row's own (null: its own)."""
    scratch = Scratch(docs.sparkSession, "manifest")
    key = F.when(F.col("lang").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "lang"))
    other = F.lit(None).cast("string") if checked is None else checked
    rows = docs.select("doc_id", "lang", leaf().alias("digest"), other.alias("checked"))
    leaves = scratch.cut(indexed(rows, key, [F.asc_nulls_first("doc_id"), F.col("digest")], scratch).drop("lang"))
    trees = build(leaves, scratch)
    subroots = trees[-1].select("g", F.col("digest"))
    # the tree over the groups: one group of its own
    tops = scratch.cut(indexed(subroots.select(F.col("g").alias("group"), "digest"), F.lit(""), [F.col("group")], scratch))
    crown = build(tops, scratch)
    last = crown[-1].first()
    root = None if last is None else last["digest"]
    start = docs.sparkSession.createDataFrame([("", [])], f"g string, path {PATH}")
    keep = lambda x, path: F.struct(x["group"].alias("group"), x["digest"].alias("subroot"), path.alias("path"))
    heads = scratch.cut(prove(crown, start, scratch, keep, "group").drop("g").withColumnRenamed("group", "g"))

    def result(x: Column, path: Column) -> Column:
        siblings = F.concat_ws("", F.transform(path, lambda p: p["sibling"]))
        folded = verify(F.coalesce(x["checked"], x["digest"]), path)
        return F.struct(x["doc_id"].alias("doc_id"), x["digest"].alias("leaf"), path.alias("path"), F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))

    proofs = prove(trees, heads.select("g", "path"), scratch, result, "doc_id", "checked")
    return proofs.join(heads.select("g", "subroot"), "g").drop("g"), root


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of all ``documents``, and what a tampered row folds to."""
    docs = table(spark, sf_dir, "documents", *FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPER_MODULUS == 0
    rows, root = manifest(docs, F.when(tampered, leaf(n_chars=F.col("n_chars") + 1)))
    root_col = F.lit(root).cast("string")
    return rows.select("doc_id", "leaf", "subroot", root_col.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root_col).alias("verified"))


def _field_sql(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR) || ':' || ({value}) END"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(n_chars if c == "n_chars" else c) for c in FIELDS) + ")"


OP13_SQL = """
WITH RECURSIVE doc AS (SELECT row_number() OVER () AS r, *, CRC % 7 = 0 AS tampered FROM documents
), leaves AS (SELECT r, doc_id, lang, LEAF AS leaf, CASE WHEN tampered THEN TAMPERED END AS other FROM doc
), placed AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS m FROM leaves
), tree AS (
  SELECT lang, 0 AS lvl, idx, m, leaf AS h FROM placed
  UNION ALL SELECT lang, lvl + 1, idx // 2, (m + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tree WHERE m > 1 GROUP BY lang, lvl, idx // 2, (m + 1) // 2
), sub AS (SELECT lang, lvl AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS m FROM tree WHERE m = 1
), top AS (
  SELECT 0 AS lvl, idx, m, h FROM sub
  UNION ALL SELECT lvl + 1, idx // 2, (m + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE m > 1 GROUP BY lvl, idx // 2, (m + 1) // 2
), root AS (SELECT h, lvl AS height FROM top WHERE m = 1
), steps AS (
  SELECT p.r, t.lvl, (p.idx >> t.lvl) % 2 = 1 AS is_right, s.h
  FROM placed p JOIN sub u ON u.lang IS NOT DISTINCT FROM p.lang JOIN range(64) t(lvl) ON t.lvl < u.height
  LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM p.lang AND s.lvl = t.lvl AND s.idx = xor(p.idx >> t.lvl, 1)
  UNION ALL
  SELECT p.r, u.height + t.lvl, (u.idx >> t.lvl) % 2 = 1, s.h
  FROM placed p JOIN sub u ON u.lang IS NOT DISTINCT FROM p.lang JOIN root ON true JOIN range(64) t(lvl) ON t.lvl < root.height
  LEFT JOIN top s ON s.lvl = t.lvl AND s.idx = xor(u.idx >> t.lvl, 1)
), proof AS (SELECT r, string_agg(coalesce(h, ''), '' ORDER BY lvl) AS p FROM steps GROUP BY r
), fold AS (
  SELECT r, 0 AS lvl, coalesce(other, leaf) AS h FROM leaves
  UNION ALL SELECT f.r, f.lvl + 1, sha256(CASE WHEN s.is_right THEN coalesce(s.h, '') || f.h ELSE f.h || coalesce(s.h, '') END) FROM fold f JOIN steps s ON s.r = f.r AND s.lvl = f.lvl
), folded AS (SELECT r, arg_max(h, lvl) AS h FROM fold GROUP BY r)
SELECT p.doc_id, p.leaf, u.h AS subroot, root.h AS root, sha256(coalesce(proof.p, '')) AS proof_sha256, f.h AS folded_root, f.h = root.h AS verified
FROM placed p JOIN sub u ON u.lang IS NOT DISTINCT FROM p.lang JOIN folded f ON f.r = p.r LEFT JOIN proof ON proof.r = p.r JOIN root ON true
""".replace("CRC", crc32_sql("doc_id::VARCHAR")).replace("LEAF", _leaf_sql("n_chars")).replace("TAMPERED", _leaf_sql("(n_chars + 1)"))
