"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation is a list of turns; a node of the trie is a distinct list of
first turns.  Conversations are sorted by their turns, so the members of a
node stand side by side, and neighbours are linked by an edge that weighs the
number of turns they share from the start (LCP).

``link`` takes the edges of one part of the sort in descending depth.  Every
merge of two components at depth d makes (or widens) the branching node at
depth d; nodes between branching nodes have the members of the one below and
are written out along the edge.  Counts, the smallest member, leaves and saved
tokens add up at the merges.

A part knows a node whole only if the node holds neither its first nor its
last conversation.  The others, all prefixes of those two, stay open: the part
is contracted to these two spines with what is complete below them
(``Item.weights``), and ``FAN`` contracted parts at a time are linked again in
the same way until one is left.  A node that was open gets a key (a chained
digest of its turns), by which its finished children find their parent and the
pieces of its list of ends their place.

Turns travel as 16-byte digests and byte counts, never as texts.  A task holds
one part of the sort, or 2 x FAN spines; copies of a conversation are spread
over parts by conv_id, and the ids that end at a node are hashed as a stream
of pieces in order.  A conversation's own turns must fit a row as digests (16
bytes a turn).

Defined results: rows without conv_id belong to no conversation; turns order
by turn (null first), then by digest; null role or text is empty; repeated
rows are turns of their own; an empty table has no node, not even a root;
other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, crc32_sql, shuffle_partitions, table

FAN = 32  # contracted parts that one task links
PIECE_IDS = 1 << 12  # ids of a list of ends in one row
OUT_ROWS = 1 << 15
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SHARED = 9  # a rebuilt conversation starts with fewer turns than this of its base

NODE = {
    "conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint",
    "saved_tokens": "bigint", "ends_sha256": "string", "key": "binary", "parent_key": "binary",
}
WEIGHT = dict.fromkeys(("depth", "n", "least", "children", "leaves", "saved"), "bigint")


def _ddl(fields: dict[str, str]) -> str:
    return "struct<" + ",".join(f"{n}:{t}" for n, t in fields.items()) + ">"


# what a task puts out: nodes, spines of its contracted part, and pieces of the ends of open nodes
SPINE = {"part": "bigint", "side": "int", "keys": "array<binary>", "sizes": "array<bigint>", "weights": f"array<{_ddl(WEIGHT)}>"}
PIECE = {"key": "binary", "first": "bigint", "ids": "string"}
OUT = f"node {_ddl(NODE)}, spine {_ddl(SPINE)}, piece {_ddl(PIECE)}"


def _arrow(fields: dict[str, str]) -> pa.DataType:
    types = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<binary>": pa.list_(pa.binary()),
        "array<bigint>": pa.list_(pa.int64()), f"array<{_ddl(WEIGHT)}>": pa.list_(pa.struct([(n, pa.int64()) for n in WEIGHT])),
    }
    return pa.struct([(n, types[t]) for n, t in fields.items()])


ARROW = pa.schema([("node", _arrow(NODE)), ("spine", _arrow(SPINE)), ("piece", _arrow(PIECE))])


# ---------------------------------------------------------------------------
# one part of the sort
# ---------------------------------------------------------------------------
@dataclass
class Item:
    """A distinct list of turns: digests, text bytes, and by depth what is
    complete at and below its prefixes: [members, smallest, children, leaves, saved]."""

    keys: list
    sizes: list
    weights: dict = field(default_factory=dict)
    ids: list | None = None  # conversations that end here, ascending (None: a spine)


def _add(a: list, b: list) -> None:
    a[0] += b[0]
    if b[1] is not None and (a[1] is None or b[1] < a[1]):
        a[1] = b[1]
    a[2] += b[2]
    a[3] += b[3]
    a[4] += b[4]


def common(a: list, b: list) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


class Forest:
    """The compressed trie of the items of one part."""

    def __init__(self, items: list[Item], whole: bool):
        """``whole``: the items are all there is, so every node is complete."""
        self.items, self.whole = items, whole
        self.depth: list[int] = []
        self.sums: list[list] = []
        self.item: list[int] = []  # an item that runs through the node
        self.parent: list[int] = []
        self.open: list[bool] = []
        self.bytes_to = [self._running(x.sizes) for x in items]
        self._link()

    @staticmethod
    def _running(sizes: list) -> list[int]:
        out = [0]
        for s in sizes:
            out.append(out[-1] + s)
        return out

    def _node(self, depth: int, item: int, sums: list | None) -> int:
        self.depth.append(depth)
        self.sums.append(sums or [0, None, 0, 0, 0])
        self.item.append(item)
        self.parent.append(-1)
        self.open.append(False)
        return len(self.depth) - 1

    def _finish(self, node: int) -> None:
        """All below the node is known: itself counts now."""
        s = self.sums[node]
        if not s[2]:
            s[3] = 1
        if self.depth[node]:
            to = self.bytes_to[self.item[node]]
            s[4] += (s[0] - 1) * (to[self.depth[node]] - to[self.depth[node] - 1])

    def _attach(self, child: int, parent: int, is_open: bool) -> None:
        self.parent[child] = parent
        self.open[child] = is_open
        if is_open:
            return
        self._finish(child)
        n, least, _, leaves, saved = self.sums[child]
        to = self.bytes_to[self.item[child]]
        along = to[self.depth[child] - 1] - to[self.depth[parent]]  # nodes on the edge
        _add(self.sums[parent], [n, least, 1, leaves, saved + (n - 1) * along])

    def _link(self) -> None:
        items, n = self.items, len(self.items)
        up = list(range(n))
        top, waiting = [], []
        low, high = list(range(n)), list(range(n))
        for i, x in enumerate(items):
            deepest = max(x.weights)
            top.append(self._node(deepest, i, list(x.weights[deepest])))
            waiting.append({d: list(w) for d, w in x.weights.items() if d != deepest})

        def find(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        def is_open(c: int) -> bool:
            return not self.whole and (low[c] == 0 or high[c] == n - 1)

        def lift(c: int, d: int) -> int:
            """The component's top once the weights below depth d have their nodes."""
            for e in sorted((e for e in waiting[c] if e > d), reverse=True):
                node = self._node(e, self.item[top[c]], waiting[c].pop(e))
                self._attach(top[c], node, is_open(c))
                top[c] = node
            return top[c]

        lcp = [0] + [common(items[i - 1].keys, items[i].keys) for i in range(1, n)]
        for e in sorted(range(1, n), key=lambda i: -lcp[i]):
            d, a, b = lcp[e], find(e - 1), find(e)
            left, right = lift(a, d), lift(b, d)
            if self.depth[left] == d:
                node = left
            else:
                node = self._node(d, self.item[left], None)
                self._attach(left, node, is_open(a))
            if self.depth[right] == d:  # only a lone item can end at the edge's depth
                _add(self.sums[node], self.sums[right])
                self.parent[right] = -2 - node
            else:
                self._attach(right, node, is_open(b))
            few, many = sorted((waiting[a], waiting[b]), key=len)
            for depth, w in few.items():
                if depth in many:
                    _add(many[depth], w)
                else:
                    many[depth] = w
            if d in many:
                _add(self.sums[node], many.pop(d))
            up[b] = a
            low[a], high[a] = min(low[a], low[b]), max(high[a], high[b])
            top[a], waiting[a] = node, many
        c = find(0)
        self.rest = waiting[c]
        if self.whole:
            lift(c, 0)
            if self.depth[top[c]]:
                root = self._node(0, self.item[top[c]], self.rest.pop(0, None))
                self._attach(top[c], root, False)
                top[c] = root
            elif 0 in self.rest:
                _add(self.sums[top[c]], self.rest.pop(0))
            self._finish(top[c])
        else:
            self.open[top[c]] = True
        self.top = top[c]

    # -- results -----------------------------------------------------------
    def end_node(self, item: int) -> int:
        """The node at which an item ends."""
        node = item  # the first nodes made are the items' own
        while self.parent[node] <= -2:
            node = -2 - self.parent[node]
        return node

    def nodes(self, ends: dict, keys: dict | None) -> Iterator[tuple]:
        """Rows of the complete nodes.  ``keys``: key of an item's prefix by
        (item, depth) for the nodes that were open, or None in the first round."""
        for node in range(len(self.depth)):
            if self.open[node] or self.parent[node] <= -2:
                continue
            n, least, children, leaves, saved = self.sums[node]
            i, bottom, over = self.item[node], self.depth[node], self.parent[node]
            first = 0 if over < 0 else self.depth[over] + 1
            to = self.bytes_to[i]
            for d in range(bottom, first - 1, -1):
                if d < bottom:
                    saved += (n - 1) * (to[d] - to[d - 1])
                    children = 1
                parent_id, parent_key = least, None
                if d == first:
                    if over < 0:
                        parent_id = None
                    elif self.open[over]:
                        parent_id, parent_key = None, (self.item[over], self.depth[over])
                    else:
                        parent_id = self.sums[over][1]
                sha = ends.get(node, EMPTY_SHA) if d == bottom else EMPTY_SHA
                yield least, d, parent_id, n, children, leaves, saved, sha, (i, d) if keys is not None else None, parent_key

    def spines(self) -> list[Item]:
        """The open nodes as one or two items that stand for the part."""
        ends = [self.items[0]] if len(self.items) == 1 else [self.items[0], self.items[-1]]
        out = [Item(x.keys, x.sizes) for x in ends]
        for node in range(len(self.depth)):
            if self.open[node]:
                s, d = self.sums[node], self.depth[node]
                side = 0 if self.item[node] == 0 or common(self.items[self.item[node]].keys[:d], ends[0].keys[:d]) == d else 1
                _add(out[side].weights.setdefault(d, [0, None, 0, 0, 0]), s)
        for d, w in self.rest.items():
            _add(out[0].weights.setdefault(d, [0, None, 0, 0, 0]), w)
        for x in out:  # an item has its own end, even if nothing is complete there
            x.weights.setdefault(len(x.keys), [0, None, 0, 0, 0])
        return out


def prefix_keys(keys: list) -> list[bytes]:
    """Keys of all prefixes of a list of turns: chained digests."""
    out = [b"\0" * 16]
    for k in keys:
        out.append(hashlib.blake2b(out[-1] + k, digest_size=16).digest())
    return out


def _batches(rows: Iterator[tuple[str, dict]]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for kind, row in rows:
        held.append({kind: row})
        if len(held) >= OUT_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=ARROW)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema=ARROW)


def _results(forest: Forest, part: int, first_round: bool) -> Iterator[tuple[str, dict]]:
    names = list(NODE)
    made: dict[int, list[bytes]] = {}

    def key(at: tuple[int, int] | None) -> bytes | None:
        if at is None:
            return None
        if at[0] not in made:
            made[at[0]] = prefix_keys(forest.items[at[0]].keys)
        return made[at[0]][at[1]]

    ends: dict[int, str] = {}
    if first_round:
        for i, x in enumerate(forest.items):
            node = forest.end_node(i)
            if not forest.open[node]:
                ends[node] = hashlib.sha256(",".join(map(str, x.ids)).encode()).hexdigest()
                continue
            at = key((i, len(x.keys)))
            for j in range(0, len(x.ids), PIECE_IDS):
                yield "piece", {"key": at, "first": x.ids[j], "ids": ",".join(map(str, x.ids[j : j + PIECE_IDS]))}
    for row in forest.nodes(ends, None if first_round else {}):
        r = dict(zip(names, row))
        r["key"], r["parent_key"] = key(r["key"]), key(r["parent_key"])
        yield "node", r
    if not forest.whole:
        for side, x in enumerate(forest.spines()):
            weights = [dict(zip(WEIGHT, (d, *w))) for d, w in sorted(x.weights.items())]
            yield "spine", {"part": part, "side": side, "keys": x.keys, "sizes": x.sizes, "weights": weights}


def _first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations (conv_id, keys, sizes) of one part -> nodes, spines, pieces."""
    from pyspark import TaskContext

    items: list[Item] = []
    for batch in batches:
        for c, keys, sizes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if items and items[-1].keys == keys:
                items[-1].ids.append(c)
            else:
                items.append(Item(keys, sizes, ids=[c]))
    if items:
        for x in items:
            x.weights = {len(x.keys): [len(x.ids), x.ids[0], 0, 0, 0]}
        yield from _batches(_results(Forest(items, whole=False), TaskContext.get().partitionId(), True))


def _next_round(whole: bool):
    def run(group: pa.Table) -> pa.Table:
        """Spines of up to FAN consecutive parts -> nodes and the spines of the joined part."""
        items = []
        rows = sorted(group.select(["to", "part", "side", "keys", "sizes", "weights"]).to_pylist(), key=lambda r: (r["part"], r["side"]))
        for r in rows:
            weights = {w["depth"]: [w["n"], w["least"], w["children"], w["leaves"], w["saved"]] for w in r["weights"]}
            items.append(Item(r["keys"], r["sizes"], weights))
        return pa.Table.from_batches(list(_batches(_results(Forest(items, whole), rows[0]["to"], False))))

    return run


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (key, first, ids) in order -> the digest of each key's whole list."""
    at, state = None, None
    for batch in batches:
        out = []
        for k, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if k != at:
                if state is not None:
                    out.append((at, state.hexdigest()))
                at, state = k, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([s for _, s in out], pa.string())], names=["key", "sha"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "sha"])


# ---------------------------------------------------------------------------
# the jobs
# ---------------------------------------------------------------------------
def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns: list of (key, size)) of (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    listed = F.sort_array(F.collect_list(F.struct("turn", key.alias("key"), F.octet_length(text).cast("long").alias("size"))))
    rows = turns.where("conv_id is not null").groupBy("conv_id").agg(listed.alias("turns"))
    return rows.select("conv_id", F.transform("turns", lambda t: F.struct(t["key"].alias("key"), t["size"].alias("size"))).alias("turns"))


def trie(convs: DataFrame) -> DataFrame:
    """Nodes of the trie over conversations (conv_id, turns: list of (key, size))."""
    spark = convs.sparkSession
    scratch = Scratch(spark, "trie")
    rows = convs.select("conv_id", F.transform("turns", lambda t: t["key"]).alias("keys"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    parts = rows.repartitionByRange(shuffle_partitions(spark), "keys", "conv_id").sortWithinPartitions("keys", "conv_id")
    out = scratch.cut(parts.mapInArrow(_first_round, OUT))
    rounds = [out]
    while True:
        spines = rounds[-1].where("spine is not null").select("spine.*")
        n = spines.agg(F.max("part")).first()[0]
        if n is None:
            break
        step = F.floor(F.col("part") / F.lit(FAN)).cast("long").alias("to")
        merged = spines.select("*", step).groupBy("to").applyInArrow(_next_round(whole=n < FAN), OUT)
        rounds.append(scratch.cut(merged))
        if n < FAN:
            break
    pieces = out.where("piece is not null").select("piece.*")
    ends = pieces.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_hash_pieces, "key binary, sha string")
    nodes = [r.where("node is not null").select("node.*") for r in rounds]
    known = nodes[0].where("parent_key is null").drop("key", "parent_key")
    if len(rounds) == 1:
        return known
    late = nodes[1]
    for more in nodes[2:]:
        late = late.union(more)
    late = scratch.cut(late)  # nodes that were open in some part
    parents = late.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    with_ends = late.join(ends, "key", "left").withColumn("ends_sha256", F.coalesce("sha", F.lit(EMPTY_SHA))).drop("sha")
    waiting = nodes[0].where("parent_key is not null").union(with_ends.select(*NODE).where("parent_key is not null"))
    found = waiting.join(parents, "parent_key").withColumn("parent_conv_id", F.col("found"))
    settled = with_ends.select(*NODE).where("parent_key is null").drop("key", "parent_key")
    return known.union(settled).union(found.select(*known.columns))


def rebuild(convs: DataFrame) -> DataFrame:
    """Every conversation c with its first h turns from conversation c - c % 5,
    h = crc32(c) % 9, followed by its own after the first h."""
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string")) % SHARED).cast("int")
    base = convs.select(c.alias("_base"), F.slice("turns", 1, SHARED - 1).alias("_first"))
    joined = convs.withColumn("_base", c - c % 5).join(base, "_base", "left")
    none = F.array().cast(convs.schema["turns"].dataType)
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return joined.select("conv_id", F.concat(F.slice(F.coalesce("_first", none), F.lit(1), h), own).alias("turns"))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trie of all rebuilt ``conversations``, one row per node."""
    scratch = Scratch(spark, "conversations")
    convs = scratch.cut(conversations(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))
    return trie(rebuild(convs))


OP11_SQL = """
WITH t AS (
  SELECT conv_id AS c, turn, strlen(coalesce(text, '')) AS s,
         substring(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), conv AS (SELECT c, list({'k': k, 's': s} ORDER BY turn NULLS FIRST, k) AS turns, any_value(CRC % 9)::BIGINT AS h FROM t GROUP BY c
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.turns, 1, a.h), []), list_slice(a.turns, a.h + 1, len(a.turns))) AS turns
  FROM conv a LEFT JOIN conv b ON b.c = a.c - a.c % 5
), pre AS (
  SELECT c, d, len(turns) = d AS ends, turns[d].s AS s, coalesce(array_to_string(list_transform(list_slice(turns, 1, d), lambda x: x.k), ''), '') AS p
  FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs, any_value(s) AS s, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM pre GROUP BY p, d
), child AS (SELECT substring(p, 1, length(p) - 32) AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1
), full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (p)
), below AS (
  SELECT pre.p, count(*) FILTER (b.n_children = 0) AS n_leaves, coalesce(sum((b.n_convs - 1) * b.s), 0)::BIGINT AS saved_tokens
  FROM full_node b JOIN pre ON pre.c = b.conv_id AND pre.d <= b.d GROUP BY pre.p
)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, below.n_leaves, below.saved_tokens, n.ends_sha256
FROM full_node n JOIN below USING (p) LEFT JOIN node up ON n.d > 0 AND up.p = substring(n.p, 1, length(n.p) - 32)
""".replace("CRC", crc32_sql("c::VARCHAR"))
