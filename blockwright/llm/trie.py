"""The trie of all prefixes of conversations, from sorted neighbours.

Conversations are sorted by their turns' hashes and cut into ranges. In a range, neighbours and the number of first turns they
share (LCP) are edges; union-find takes them in descending depth, and every merge makes a node where branches meet; nodes
between two merges have one child. What holds a range's first or last conversation may go on in the next range: only these
paths, with sums of what is finished below them, leave the range, and are merged by prefix across all boundaries. Sums over
subtrees that cross boundaries are differences of running sums, since a subtree is a run of paths in sorted order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockwright.llm.shared import forget, written

#: Turns that decide which range a conversation falls in; longer ones that share so many turns stay in one range.
RANGE_TURNS = 1024
RANGE_BYTES = 16 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()

FOREST = "kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, path long, prefix binary, parent binary, bytes long"
_ARROW = pa.schema([("kind", pa.string()), *((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string()), ("path", pa.int64()), ("prefix", pa.binary()), ("parent", pa.binary()), ("bytes", pa.int64())])
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos from 1, a, b, bytes, total) of each turn: its place by turn (null first), role and text, a hash of 128 bits, UTF-8 bytes of its text, turns of its conversation.

    Sorted in ranges that may cut a conversation; what lies before a range is added from one row a range and conversation, so a
    conversation with very many turns is shared out. Null roles and texts are empty; rows without conv_id are left out.
    """
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    n = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", F.asc_nulls_first("turn"), "role"]
    dealt = rows.repartitionByRange(n, *order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    both = F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("turn"), "text", "role").alias("b")
    turns = written(dealt.select("conv_id", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"), *both, F.octet_length("text").cast("long").alias("bytes")), "turns")
    parts = turns.groupBy("conv_id", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("conv_id")
    before = F.coalesce(F.sum("n").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("conv_id", "range", (before - F.col("first") + 1).alias("shift"), F.sum("n").over(own).alias("total"))
    out = written(turns.join(parts, ["conv_id", "range"]).select("conv_id", (F.col("at") + F.col("shift")).alias("pos"), "a", "b", "bytes", "total"), "numbered")
    forget(turns)
    return out


def with_lent_heads(turns: DataFrame, lender: Column, heads: Column) -> DataFrame:
    """Conversations rebuilt from ``numbered_turns``: the first ``heads`` turns (a small number of conv_id) of conversation ``lender``, as many as there are, then a conversation's own turns after its first ``heads``."""
    talks = turns.groupBy("conv_id").agg(F.max("total").alias("n")).select("conv_id", "n", lender.alias("lender"), heads.cast("long").alias("heads"))
    lent = talks.select(F.col("conv_id").alias("lender"), F.col("n").alias("has"))
    talks = talks.join(lent, "lender", "left").withColumn("lent", F.least("heads", F.coalesce("has", F.lit(0)))).drop("has")
    own = turns.join(talks.select("conv_id", "heads", "lent"), "conv_id").where("pos > heads").select("conv_id", (F.col("pos") - F.col("heads") + F.col("lent")).alias("pos"), "a", "b", "bytes")
    most = talks.agg(F.max("heads")).first()[0] or 0
    first = turns.where(F.col("pos") <= most).select(F.col("conv_id").alias("lender"), "pos", "a", "b", "bytes")
    head = first.join(talks.select("conv_id", "lender", "lent"), "lender").where("pos <= lent").select("conv_id", "pos", "a", "b", "bytes")
    none = talks.where("lent + greatest(n - heads, 0) = 0").select("conv_id", F.lit(None).cast("long").alias("pos"), *(F.lit(None).cast("long").alias(c) for c in ("a", "b", "bytes")))
    return own.unionByName(head).unionByName(none)


def sequences(turns: DataFrame) -> DataFrame:
    """One row a conversation: conv_id, keys (two hashes a turn), bytes; a row of ``turns`` with a null pos stands for a conversation without turns. 24 bytes a turn, no texts."""
    placed = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "a", "b", "bytes"))))
    whole = turns.groupBy("conv_id").agg(placed.alias("t"))
    return written(whole.select("conv_id", F.flatten(F.transform("t", lambda t: F.array(t["a"], t["b"]))).alias("keys"), F.transform("t", lambda t: t["bytes"]).alias("bytes")), "sequences")


class Forest:
    """The trie of sorted conversations of one range, made by merging neighbours at their LCP in descending depth.

    A node is a place in the lists below; it holds rows ``left`` to ``right``. Nodes with the first or the last row are open:
    what they pass on to their parent are sums of finished nodes only.
    """

    def __init__(self, conv: np.ndarray, starts: np.ndarray, keys: np.ndarray, bytes_: np.ndarray):
        self.conv, self.starts, self.keys, self.bytes = conv, starts, keys.reshape(-1, 2), bytes_
        self.lens, self.rows = np.diff(starts), len(conv)
        self.lcp = self._shared()
        self.runs = self._equal_runs()
        self.depth, self.count, self.least, self.kids, self.leaves, self.saved, self.left, self.right, self.parent, self.alias = ([] for _ in range(10))
        self.tail: dict[int, int] = {}  # the topmost node of a row that is alone from there on -> row
        self._merge()

    def _shared(self) -> np.ndarray:
        """lcp[k]: first turns that rows k - 1 and k share; -1 at both ends."""
        out = np.full(self.rows + 1, -1, np.int64)
        both = np.minimum(self.lens[1:], self.lens[:-1])
        if not len(both):
            return out
        first = np.concatenate([[0], np.cumsum(both)])
        place = np.arange(first[-1]) - np.repeat(first[:-1], both)
        same = (self.keys[np.repeat(self.starts[:-2], both) + place] == self.keys[np.repeat(self.starts[1:-1], both) + place]).all(axis=1)
        found = both.copy()
        bad = np.flatnonzero(~same)
        pair = np.repeat(np.arange(len(both)), both)[bad]
        pair, at = np.unique(pair, return_index=True)
        found[pair] = place[bad[at]]
        out[1:-1] = found
        return out

    def _equal_runs(self) -> np.ndarray:
        """For each row, where the run of rows equal to it that begins there ends (exclusive)."""
        equal = np.zeros(self.rows + 1, bool)
        equal[1:-1] = (self.lcp[1:-1] == self.lens[1:]) & (self.lens[1:] == self.lens[:-1])
        breaks = np.flatnonzero(~equal)
        return breaks[np.searchsorted(breaks, np.arange(self.rows), "right")]

    def _node(self, depth: int, count: int, least: int, kids: int, leaves: int, saved: int, left: int, right: int) -> int:
        for held, x in ((self.depth, depth), (self.count, count), (self.least, least), (self.kids, kids), (self.leaves, leaves), (self.saved, saved), (self.left, left), (self.right, right), (self.parent, -1), (self.alias, -1)):
            held.append(x)
        return len(self.depth) - 1

    def open(self, node: int) -> bool:
        return self.left[node] == 0 or self.right[node] == self.rows - 1

    def size(self, node: int) -> int:
        return int(self.bytes[self.starts[self.left[node]] + self.depth[node] - 1]) if self.depth[node] else 0

    def _lifted(self, node: int, depth: int) -> int:
        """The ancestor of ``node`` at ``depth``: nodes on the way are finished."""
        while self.depth[node] > depth:
            closed = not self.open(node)
            if closed:
                self.leaves[node] += self.kids[node] == 0 and node not in self.tail
                self.saved[node] += (self.count[node] - 1) * self.size(node)
            up = self._node(self.depth[node] - 1, self.count[node], self.least[node], int(closed), self.leaves[node], self.saved[node], self.left[node], self.right[node])
            self.parent[node] = up
            node = up
        return node

    def _merge(self) -> None:
        group, top = list(range(self.rows)), []
        for k in range(self.rows):
            alone = int(max(self.lcp[k], self.lcp[k + 1])) + 1
            if 0 < k < self.rows - 1 and alone <= self.lens[k]:
                top.append(self._node(alone, 1, int(self.conv[k]), 0, 1, 0, k, k))
                self.tail[top[-1]] = k
            else:
                top.append(self._node(int(self.lens[k]), 1, int(self.conv[k]), 0, 0, 0, k, k))

        def root(x: int) -> int:
            while group[x] != x:
                group[x] = group[group[x]]
                x = group[x]
            return x

        edges = self.lcp[1:-1]
        for e in np.argsort(-edges, kind="stable"):
            one, other, depth = root(int(e)), root(int(e) + 1), int(edges[e])
            a, b = self._lifted(top[one], depth), self._lifted(top[other], depth)
            for held in (self.count, self.kids, self.leaves, self.saved):
                held[a] += held[b]
            self.least[a], self.right[a], self.alias[b] = min(self.least[a], self.least[b]), self.right[b], a
            group[other] = one
            top[one] = a
        self.root = self._lifted(top[root(0)], 0)


def _ends(conv: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, conv.tolist())).encode()).hexdigest() if len(conv) else NO_ENDS


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def contracted(forest: Forest, number: int) -> Iterator[pa.RecordBatch]:
    """A range's finished nodes (kind node), its open paths (path) and the conversations that end on them (end).

    Paths are numbered through all ranges in sorted order: 2 * number is the first conversation's, 2 * number + 1 the last's.
    """
    f, last = forest, forest.rows - 1

    def alive(node: int) -> int:
        while f.alias[node] >= 0:
            node = f.alias[node]
        return node

    def ending(node: int) -> np.ndarray:
        """Conversations with no turn beyond the node: they come first among its rows."""
        k = f.left[node]
        return f.conv[k : f.runs[k]] if f.lens[k] == f.depth[node] else f.conv[:0]

    def path(node: int) -> int:
        return 2 * number + (f.left[node] != 0)

    rows: list[tuple] = []
    first_path, last_path = {}, {}
    for node in range(len(f.depth)):
        if f.alias[node] >= 0:
            continue
        if f.open(node):
            if f.left[node] == 0:
                first_path[f.depth[node]] = node
            if f.right[node] == last:
                last_path[f.depth[node]] = node
        elif node not in f.tail:
            up = alive(f.parent[node])
            above = (None, path(up)) if f.open(up) else (f.least[up], None)
            rows.append((f.least[node], f.depth[node], above[0], f.count[node], f.kids[node], f.leaves[node], f.saved[node], _ends(ending(node)), above[1]))
    for node, k in f.tail.items():
        up, conv, end = alive(f.parent[node]), int(f.conv[k]), int(f.lens[k])
        above = (None, path(up)) if f.open(up) else (f.least[up], None)
        for depth in range(f.depth[node], end + 1):
            rows.append((conv, depth, *((above[0],) if depth == f.depth[node] else (conv,)), 1, int(depth < end), 1, 0, _ends(f.conv[k : k + 1]) if depth == end else NO_ENDS, above[1] if depth == f.depth[node] else None))
            if len(rows) >= 100_000:
                yield _batch(kind=["node"] * len(rows), **dict(zip([*_NODE, "path"], zip(*rows, strict=True), strict=True)))
                rows = []
    if rows:
        yield _batch(kind=["node"] * len(rows), **dict(zip([*_NODE, "path"], zip(*rows, strict=True), strict=True)))

    for number_of_path, nodes, row in ((2 * number, first_path, 0), (2 * number + 1, last_path, last)):
        keys, chain, above, out = f.keys[f.starts[row] : f.starts[row + 1]], hashlib.sha256(), None, []
        for depth in range(len(keys) + 1):
            if depth:
                chain.update(keys[depth - 1].tobytes())
            prefix, node = chain.digest()[:16], nodes[depth]
            if number_of_path % 2 and f.left[node] == 0:  # on the first path too, and counted there
                sums = (None, 0, 0, 0, 0)
            else:
                sums = f.least[node], f.count[node], f.kids[node], f.leaves[node], f.saved[node]
                for ends in np.array_split(ending(node), max(1, len(ending(node)) // 100_000)):
                    if len(ends):
                        yield _batch(kind=["end"] * len(ends), conv_id=ends, prefix=[prefix] * len(ends))
            out.append((depth, prefix, above, f.size(node), *sums))
            above = prefix
        yield _batch(kind=["path"] * len(out), path=[number_of_path] * len(out), **dict(zip(["depth", "prefix", "parent", "bytes", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"], zip(*out, strict=True), strict=True)))


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = [b for b in batches if b.num_rows]
    if whole:
        table = pa.Table.from_batches(whole).combine_chunks()
        keys, sizes = table.column("keys").combine_chunks(), table.column("bytes").combine_chunks()
        starts = sizes.offsets.to_numpy().astype(np.int64)
        number = table.column("number")[0].as_py()
        yield from contracted(Forest(table.column("conv_id").to_numpy(), starts - starts[0], keys.flatten().to_numpy(), sizes.flatten().to_numpy()), number)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by prefix and conv_id to one digest a prefix, as they stream by."""
    now, digest = None, None
    for batch in batches:
        prefixes, convs = batch.column("prefix").to_pylist(), batch.column("conv_id").to_pylist()
        done = []
        for prefix, conv in zip(prefixes, convs, strict=True):
            if prefix != now:
                done += [(now, digest.hexdigest())] if digest else []
                now, digest = prefix, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])], ["prefix", "ends_sha256"])
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["prefix", "ends_sha256"])


def prefix_trie(talks: DataFrame) -> DataFrame:
    """One row a node of the trie of ``sequences`` (conv_id, keys, bytes): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a distinct sequence of first turns, the root that of none; conv_id is the smallest that begins so, n_convs how many do,
    parent_conv_id the parent's conv_id (null at the root). n_leaves and saved_tokens, the sum of (n_convs - 1) times the bytes of a node's last
    text, cover its subtree; ends_sha256 digests the ids, ascending and joined by commas, of the conversations that end at it.

    Conversations without turns belong to the root alone. Equal conversations share all nodes; a node's turns count as equal by hashes of 128
    bits. No conversations give no rows, not even a root. conv_id must be distinct and not null, as ``sequences`` makes it. What one
    row holds grows with one conversation, by 24 bytes a turn; equal conversations, however many, are dealt to as many ranges as they fill.
    """
    spark = talks.sparkSession
    size = talks.agg(F.sum(F.size("keys") * 12 + 40)).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // RANGE_BYTES))
    near = F.when(F.size("keys") <= 2 * RANGE_TURNS, F.col("conv_id"))
    dealt = talks.repartitionByRange(n, F.slice("keys", 1, 2 * RANGE_TURNS), F.asc_nulls_last(near)).sortWithinPartitions("keys", "conv_id").withColumn("number", F.spark_partition_id().cast("long"))
    forest = written(dealt.mapInArrow(_forests, FOREST), "forest")

    paths = forest.where("kind = 'path'").select("path", "depth", "prefix", "parent", "bytes", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = paths.groupBy("prefix").agg(F.max("depth").alias("depth"), F.max("parent").alias("parent"), F.max("bytes").alias("bytes"), F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.min("path").alias("begin"), F.max("path").alias("end"))
    merged = written(merged, "merged")
    kids = merged.where("parent is not null").groupBy(F.col("parent").alias("prefix")).agg(F.count("*").alias("open_kids"))
    nodes = merged.join(kids, "prefix", "left").withColumn("n_children", F.col("n_children") + F.coalesce("open_kids", F.lit(0)))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("long"), "weight": (F.col("n_convs") - 1) * F.col("bytes")})
    # a node's subtree: what is new on its first path from its depth on, and all that is new on the later paths up to its last
    below = Window.partitionBy("begin").orderBy(F.desc("depth"))
    nodes = written(nodes.withColumns({"leaves_below": F.sum("leaf").over(below), "weight_below": F.sum("weight").over(below)}), "open")
    new = nodes.groupBy(F.col("begin").alias("path")).agg(F.sum("leaf").alias("leaves"), F.sum("weight").alias("weight"))
    run = Window.orderBy("path")  # two numbers a path, and two paths a range: as many rows as partitions
    so_far = spark.range(2 * n).select(F.col("id").alias("path")).join(new, "path", "left").select("path", F.sum(F.coalesce("leaves", F.lit(0))).over(run).alias("leaves"), F.sum(F.coalesce("weight", F.lit(0))).over(run).alias("weight"))
    so_far = written(so_far, "paths")
    to = so_far.select(F.col("path").alias("end"), F.col("leaves").alias("leaves_to"), F.col("weight").alias("weight_to"))
    since = so_far.select(F.col("path").alias("begin"), F.col("leaves").alias("leaves_since"), F.col("weight").alias("weight_since"))
    ends = forest.where("kind = 'end'").select("prefix", "conv_id").repartition("prefix").sortWithinPartitions("prefix", "conv_id").mapInArrow(_digests, "prefix binary, ends_sha256 string")
    above = merged.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(to, "end").join(since, "begin").join(ends, "prefix", "left").join(above, "parent", "left")
    whole = whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaves_below") + F.col("leaves_to") - F.col("leaves_since")).alias("n_leaves"),
                         (F.col("saved_tokens") + F.col("weight_below") + F.col("weight_to") - F.col("weight_since")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    finished = forest.where("kind = 'node'")
    inner = finished.where("path is null").select(*_NODE)
    known = paths.select("path", F.col("depth") + 1, "prefix").toDF("path", "depth", "prefix").join(merged.select("prefix", F.col("conv_id").alias("known")), "prefix").drop("prefix")
    under = finished.where("path is not null").join(known, ["path", "depth"]).withColumn("parent_conv_id", F.col("known")).select(*_NODE)
    return inner.unionByName(under).unionByName(whole)
