"""N-gram Jaccard join: documents whose shingle sets overlap by at least a ratio, and their components.

Documents with equal sets become one class. A class of n shingles that has a partner at ratio 0.9 differs from it in at
most n // 9 shingles; the hash space is cut into more parts than that (as many as its size class needs), so a partner
shares at least one part whole, and one that isn't empty but for a chance below MISS. Sets so small that only one shingle can differ
are found through the hashes of the set and of all but one of its shingles, without any chance.

All links come from the product of the class by n-gram incidence with its transpose, computed tile by tile: a pair of a tile is kept when
its overlap count reaches the bound that follows from the two sizes. A part that few classes share gives its pairs of fitting sizes, dealt to tiles of
about TILE_ROWS pairs. Parts meet one slice of their hashes after another, so that disk never holds the shuffles of all. Classes of the other parts, by whatever chain, form blocks; small ones share a tile.
Passages that many texts share chain blocks that grow faster than the input, so the classes of large blocks meet again by the rarest of their n-grams, of which linked sets share one for certain; that gives pairs and blocks as
the parts did. What is still a large block is cut into tiles of about TILE_ROWS classes. Each tile also holds the block's first class; classes linked with it by
their own tile need no more products with each other, and only the others (with all classes) go through the tiles off the diagonal, in rounds that send no more sets than there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockwright.llm.arrays import mix, slices, text_bytes, word_hashes
from blockwright.llm.graph import components
from blockwright.llm.shared import forget, sweep, with_text, written

CLASS_WIDTH = 1.5
MISS = 1e-8
SURE = 1000
FEW = 12
SLICES = 4
TILE_ROWS = 256
LIGHT = 8
ROUND_SETS = 1 << 14
COLUMNS = 4096
BATCH_BYTES = 4 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each document, some megabytes of text at a time."""
    odd = [np.uint64(2 * int(x) + 1) for x in np.random.default_rng(11).integers(1, 1 << 62, words)]
    for i, j in slices(offsets):
        hashes, counts, _ = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            rolled += hashes[k : k + len(rolled)] * odd[k]
        rolled = mix(rolled)
        at = np.concatenate([[0], np.cumsum(counts)])
        for k, n in enumerate(counts):
            if n >= words:
                yield np.unique(rolled[at[k] : at[k + 1] - words + 1])
            elif n:
                short = (hashes[at[k] : at[k + 1]] * np.array(odd[:n])).sum(dtype=np.uint64, keepdims=True)
                yield mix(short + np.full(1, n, np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> np.int64:
    """64 bits that stand for a set: equal for equal sets."""
    sums = np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)])
    return mix(mix(sums[:1] + np.uint64(len(s))) + sums[1:]).view(np.int64)[0]


def _most_apart(n: int, num: int, den: int) -> int:
    """Largest symmetric difference of a set of n with any partner."""
    return n * (den - num) // num


def _level(n: int) -> int:
    return int(math.log(n) / math.log(CLASS_WIDTH) + 1e-9)


@cache
def parts_of(level: int, num: int, den: int) -> int:
    """Into how many parts sets meet whose larger one is of this level; 0: through all but one of their shingles.

    With s shared shingles and d others, at most d parts have one of the others, so no part of only shared ones is left with a chance of
    at most (d / parts)^s. Beyond SURE shingles that is far below MISS anyway.
    """
    top = math.ceil(CLASS_WIDTH ** (level + 1))
    need = _most_apart(top, num, den) + 1
    parts, apart = need + 5 + need // 16, 0
    for n in range(max(1, math.floor(CLASS_WIDTH**level)), top + 1) if top <= SURE else ():
        for shared in range(-(-num * n // den), n + 1):
            d = shared * den // num - shared  # the union is at most shared * den / num
            apart = max(apart, d)
            parts = max(parts, math.ceil(d / MISS ** (1 / shared)))
    return 0 if top <= SURE and apart <= 1 and parts > top else parts


def signed_parts(s: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each part of the set that isn't empty, at its size class and, near the border, the next one; and how many of that size class's
    parts the set shares with any partner, at least: all but those that a difference can touch and the empty ones."""
    n = len(s)
    if not n or not _most_apart(n, num, den):
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    out, asks, inner = [], [], mix(s)
    for level in sorted({_level(n), _level(n * den // num)}):
        parts, tag = parts_of(level, num, den), np.uint64(level << 32)
        if not parts:
            out.append(mix(inner.sum(dtype=np.uint64) - np.append(inner, np.uint64(0)) + mix(np.full(1, tag))))
            asks.append(1)
            continue
        part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        out.append(mix(np.add.reduceat(inner, first) + mix(part[first] + tag)))
        asks.append(max(1, len(first) - _most_apart(n, num, den)))
    return np.concatenate(out), np.repeat(np.array(asks, np.int32), [len(x) for x in out])


def part_signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    return signed_parts(s, num, den)[0]


def _lists(values: list[np.ndarray], kind: type = np.int64) -> pa.Array:
    flat = np.concatenate(values).view(kind) if values else np.zeros(0, kind)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in values])]).astype(np.int32)), pa.array(flat))


def _slice(parts: np.ndarray) -> np.ndarray:
    """The slice of each part's hash, by other bits than those that deal shuffles."""
    return parts >> np.uint64(32) & np.uint64(SLICES - 1)


#: Rows of _profile: the parts of each slice, and how many the class asks for, in columns of their own, so that a slice's readers skip the others.
_SIGNED = "doc_id long, place long, n long, key long, " + ", ".join(f"parts_{k} array<long>, asks_{k} array<int>" for k in range(SLICES))


def _profile(words: int, num: int, den: int):
    """Rows _SIGNED of texts (doc_id, place, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, BATCH_BYTES):
                n, key, sliced = [], [], [([], []) for _ in range(SLICES)]
                for s in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words):
                    n.append(len(s))
                    key.append(set_key(s))
                    parts, asks = signed_parts(s, num, den)
                    own = _slice(parts)
                    for k, (some, few) in enumerate(sliced):
                        some.append(parts[own == k])
                        few.append(asks[own == k])
                columns = {f"{name}_{k}": _lists(x, kind) for k, lists in enumerate(sliced) for name, x, kind in zip(("parts", "asks"), lists, (np.int64, np.int32), strict=True)}
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(i, j - i), "place": batch.column("place").slice(i, j - i), "n": pa.array(n, pa.int64()), "key": pa.array(key, pa.int64()), **columns})

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, BATCH_BYTES):
                sets = list(shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words))
                yield pa.RecordBatch.from_pydict({"key": pa.array([set_key(s) for s in sets], pa.int64()), "s": _lists(sets)})

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The upper triangle of incidence times transpose: how many n-grams each two of the sets share."""
    m = len(sets)
    overlap = np.zeros((m, m), np.int32)
    _, column, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    light = (df[column] > 1) & (df[column] <= LIGHT)
    o, c = owner[light], column[light]
    for step in range(1, LIGHT):  # n-grams of few sets: their pairs of owners
        same = c[step:] == c[:-step]
        np.add.at(overlap, (o[:-step][same], o[step:][same]), 1)
    heavy = np.flatnonzero(df > LIGHT)
    place = np.full(len(df), -1)
    for k in range(0, len(heavy), COLUMNS):  # the others: dense products of bounded width
        some = heavy[k : k + COLUMNS]
        place[:] = -1
        place[some] = np.arange(len(some))
        took = place[column]
        dense = np.zeros((m, len(some)), np.float32)
        dense[owner[took >= 0], took[took >= 0]] = 1
        overlap += np.triu(dense @ dense.T, 1).astype(np.int32)
    return overlap


def tile_links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """(id, smallest id it is linked with inside the tile) for each id but the smallest ones. ``side``: only pairs of different sides count, or of side 2."""
    sizes, overlap = np.array([len(s) for s in sets]), overlaps(sets)
    total = sizes[:, None] + sizes[None, :]
    a, b = np.nonzero((den * overlap >= num * (total - overlap)) & (overlap > 0) & ((side[:, None] != side[None, :]) | (side == 2)[:, None]))
    parent = {int(x): int(x) for x in ids}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(ids[a].tolist(), ids[b].tolist(), strict=True):
        p, q = root(x), root(y)
        parent[max(p, q)] = min(p, q)
    return [(x, root(x)) for x in parent if root(x) != x]


def _tile(num: int, den: int):
    def run(table: pa.Table) -> pa.Table:
        ids, side = table.column("key").to_numpy(), table.column("side").to_numpy()
        flat = table.column("s").combine_chunks()
        at, values = flat.offsets.to_numpy(), flat.values.to_numpy()
        links = tile_links(ids, [values[at[i] : at[i + 1]] for i in range(len(ids))], side, num, den)
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([y for _, y in links], pa.int64())})

    return run


def _dealt(key: str, parts: str | int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts) if isinstance(parts, int) else F.col(parts)).cast("long")


def _products(tiles: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) found in each tile (t, i, j) of rows (t, i, j, key, side)."""
    return tiles.join(sets, "key").groupBy("t", "i", "j").applyInArrow(_tile(num, den), "u long, v long")


def _met(parts: DataFrame) -> DataFrame:
    """(part, hub, m) of the parts that several classes have: the smallest key, and the number of rows."""
    return parts.groupBy("part").agg(F.min("key").alias("hub"), F.max("key").alias("top"), F.count("*").alias("m")).where("hub < top").select("part", "hub", "m")


def _near(signed: DataFrame, k: int) -> DataFrame:
    """Written rows (part, ask, key, n), distinct, of the parts of slice ``k`` that several classes have."""
    met = written(_met(signed.select(F.explode(f"parts_{k}").alias("part"), "key")).select("part"), "met")
    # merge joins at every size: the keys grow with the documents, so no size of theirs is a bound for a broadcast
    rows = signed.select(F.explode(F.arrays_zip(F.col(f"parts_{k}").alias("part"), F.col(f"asks_{k}").alias("ask"))).alias("x"), "key", "n").select("x.part", "x.ask", "key", "n")
    near = written(rows.join(met.hint("merge"), "part").dropDuplicates(["part", "key"]), "near")
    forget(met)
    return near


def _pruned(slices: list[DataFrame]) -> DataFrame:
    """Written rows (part, key, n, ask) of all slices without classes that share fewer parts than they would with any partner, and the parts left with one class; hub and m added.

    Partners' shared parts all stay, so no link is lost; what goes is classes that share a passage or two.
    """
    near = reduce(DataFrame.union, slices)
    enough = near.groupBy("key", "ask").agg(F.count("*").alias("c")).where("c >= ask").select("key", "ask")
    live = written(near.select("part", "key", "n", "ask").join(enough.hint("merge"), ["key", "ask"], "left_semi"), "live")
    met = written(_met(live), "met")
    out = written(live.join(met.hint("merge"), "part"), "near")
    forget(*slices, live, met)
    return out


def _candidates(near: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Written pairs (u, v) of fitting sizes that share a part of up to FEW rows, and written blocks (node, component) of the classes of wider parts. ``near``: written rows (part, key, n, hub, m)."""
    few = near.where(F.col("m") <= FEW).select("part", "key", "n")
    other = few.select("part", F.col("key").alias("v"), F.col("n").alias("y"))
    fits = (F.col("key") < F.col("v")) & (den * F.least("n", "y") >= num * F.greatest("n", "y"))
    pairs = written(few.join(other.hint("merge"), "part").where(fits).select(F.col("key").alias("u"), "v").distinct(), "pairs")
    return pairs, written(components(near.where((F.col("m") > FEW) & (F.col("key") > F.col("hub"))).select(F.col("key").alias("u"), F.col("hub").alias("v"))), "blocks")


def rarest_met(sets: DataFrame, num: int, den: int) -> DataFrame:
    """Written rows (part, key, n, hub, m) as ``_pruned`` gives, the parts being n-grams, of the sets (key, s) that can have a link with each other.

    Of two linked sets each has at most ``n * (den - num) // den`` n-grams that the other lacks. So in one order of all n-grams, they share one of the first of each, that many and one more. The order
    is by the number of sets that hold the n-gram, then by hash: a passage of many sets comes last. N-grams of one set alone come first and meet nothing.
    """
    grams = sets.select("key", F.size("s").cast("long").alias("n"), F.explode("s").alias("part"))
    shared = written(grams.groupBy("part").agg(F.count("*").alias("df")).where("df > 1"), "grams")
    held = grams.join(shared.hint("merge"), "part").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("df", "part"))).alias("x"))
    first = held.select("key", "n", F.explode(F.slice("x", F.lit(1), F.greatest(F.expr(f"n * {den - num} div {den} + 1 - (n - size(x))"), F.lit(0)).cast("int"))).alias("x"))
    rows = written(first.select("x.part", "key", "n"), "rarest")
    met = written(_met(rows), "met")
    out = written(rows.join(met.hint("merge"), "part"), "near")
    forget(shared, rows, met)
    return out


def _thinned(pairs: DataFrame, blocks: DataFrame, sets: DataFrame, num: int, den: int, tile: int = TILE_ROWS) -> tuple[DataFrame, DataFrame]:
    """``pairs`` and ``blocks`` (both written, and gone if replaced) with the classes of blocks of more than ``tile`` met by their rarest n-grams instead."""
    large = written(blocks.groupBy("component").agg(F.count("*").alias("m")).where(F.col("m") > tile).select("component"), "large")
    if large.isEmpty():
        return pairs, blocks
    wide = written(sets.join(blocks.join(large.hint("merge"), "component", "left_semi").select(F.col("node").alias("key")).hint("merge"), "key", "left_semi"), "wide")
    near = rarest_met(wide, num, den)
    more, dense = _candidates(near, num, den)
    both = written(pairs.union(more).distinct(), "pairs")
    rest = written(blocks.join(large.hint("merge"), "component", "left_anti").select("node", "component").union(dense.select("node", "component")), "blocks")
    forget(pairs, blocks, large, wide, near, more, dense)
    return both, rest


def pair_links(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (u, v) among written candidate pairs (u, v): all pairs of one u in one tile, which has each class once."""
    tiles = max(1, pairs.count() // TILE_ROWS)
    t, none = _dealt("u", tiles).alias("t"), F.lit(-2).cast("long")
    rows = pairs.select(t, F.col("u").alias("key")).union(pairs.select(t, F.col("v").alias("key"))).distinct()
    return _products(rows.select("t", none.alias("i"), none.alias("j"), "key", F.lit(2).alias("side")), sets, num, den)


def block_links(blocks: DataFrame, sets: DataFrame, num: int, den: int, tile: int = TILE_ROWS, most: int = ROUND_SETS) -> DataFrame:
    """Links (u, v) between the classes of each block, enough to connect all that linked pairs connect. ``most``: so many sets a round may send, however few there are.

    ``blocks``: written rows (node, component), component being the block's smallest node; ``sets``: written rows (key, s).
    """
    large = written(blocks.groupBy("component").agg(F.count("*").alias("m")).where(F.col("m") > tile).withColumn("g", F.ceil(F.col("m") / tile)), "large")
    shared = max(1, blocks.count() // (tile // 2))  # tiles that all small blocks share
    few = blocks.join(large, "component", "left_anti").select(_dealt("component", shared).alias("t"), F.lit(-1).cast("long").alias("i"), F.lit(-1).cast("long").alias("j"), F.col("node").alias("key"), F.lit(2).alias("side"))
    many = blocks.join(large, "component")
    own = many.where("node <> component").select(F.col("component").alias("t"), _dealt("node", "g").alias("i"), F.lit(0).cast("long").alias("j"), F.col("node").alias("key"), F.lit(2).alias("side"))
    first = large.select(F.col("component").alias("t"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("i"), F.lit(0).cast("long").alias("j"), F.col("component").alias("key"), F.lit(2).alias("side"))
    links = written(_products(few.union(own).union(first), sets, num, den), "links")
    apart = written(many.where("node <> component").join(links, (F.col("node") == F.col("u")) & (F.col("component") == F.col("v")), "left_anti").select("component", "node", "g"), "apart")
    if apart.isEmpty():
        return links
    rest = written(apart.groupBy("component").agg(F.ceil(F.count("*") / tile).alias("h")), "rest")
    rows = apart.join(rest, "component").select("component", _dealt("node", "h").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("g") - 1)).alias("j"), F.col("node").alias("key"), F.lit(0).alias("side"))
    columns = many.join(rest, "component").select("component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("h") - 1)).alias("i"), _dealt("node", "g").alias("j"), F.col("node").alias("key"), F.lit(1).alias("side"))
    tiles = rows.union(columns).withColumnRenamed("component", "t")
    # a block of m classes sends m / tile copies of each: one round after another, so that disk holds about one copy
    sent = (apart.agg(F.sum("g")).first()[0] or 0) + (many.join(rest, "component").agg(F.sum("h")).first()[0] or 0)
    rounds = max(1, -(-sent // max(most, sets.count())))
    for k in range(rounds):
        links = links.union(written(_products(tiles.where(F.pmod(F.xxhash64("t", "i", "j"), F.lit(rounds)) == k), sets, num, den), "links"))
    return links


def jaccard_components(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id, component_id.

    Two documents link when ``den * intersection >= num * union`` of their sets of distinct word shingles; a text with
    fewer words is one shingle. class_id is the smallest doc_id with an equal set, component_id the smallest doc_id
    reachable by links; null doc_ids count only where there is no other. Null and blank texts have no shingles and stand alone.
    Repeated rows keep their rows; rows that share a doc_id but not their texts are linked by their texts alone.
    Nothing is capped: a block of many classes goes through tiles of bounded size.
    """
    spark, src = docs.sparkSession, with_text(docs).withColumn("place", F.xxhash64("text"))
    signed = written(src.mapInArrow(_profile(words, num, den), _SIGNED), "signed")
    rows = written(signed.select("doc_id", "place", "n", "key"), "profile")
    full = rows.where("n > 0")
    classes = written(full.groupBy("key").agg(F.min("doc_id").alias("class_id"), F.min(F.struct("place", F.coalesce("doc_id", F.lit(0)).alias("id"))).alias("rep")), "classes")
    near = [_near(signed, k) for k in range(SLICES)]
    forget(signed)
    near = _pruned(near)
    sweep(spark)
    pairs, blocks = _candidates(near, num, den)
    forget(near)
    sweep(spark)
    needed = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).union(blocks.select("node")).distinct()
    one = classes.join(needed.hint("merge"), F.col("key") == F.col("node")).select(F.col("rep.place").alias("place"), F.col("rep.id").alias("_id"), "key")
    texts = src.withColumn("_id", F.coalesce("doc_id", F.lit(0))).join(one.select("place", "_id").hint("merge"), ["place", "_id"], "left_semi")
    # rows repeated whole go here, where they lie together already; a class's other rows aren't its representative
    sets = written(texts.dropDuplicates(["place", "_id"]).select("text").mapInArrow(_sets(words), "key long, s array<long>"), "sets")
    sweep(spark)
    pairs, blocks = _thinned(pairs, blocks, sets, num, den)
    joined = written(components(pair_links(pairs, sets, num, den).union(block_links(blocks, sets, num, den))), "joined")
    sweep(spark)
    named = classes.select("key", "class_id").join(joined.hint("merge"), F.col("key") == F.col("node"), "left").select("key", "class_id", "component")
    least = written(named.where("component is not null").groupBy("component").agg(F.min("class_id").alias("component_id")), "least")
    # tables of their own, so that the joins with a large component's classes and a hot class's documents can be split
    names = written(named.join(least.hint("merge"), "component", "left").select("key", "class_id", F.coalesce("component_id", "class_id").alias("component_id")), "names")
    forget(classes, pairs, blocks, sets, joined, least)
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    return full.join(names.hint("merge"), "key").select("doc_id", F.col("n").alias("n_shingles"), "class_id", "component_id").union(alone)
