"""Hard negatives by rotated one-bit codes whose error is bounded, so that the filter never loses a row.

A vector is rotated (random signs, then a Hadamard matrix) and kept as the signs of its components: the code vector. With
it is stored how far the vector goes along that code vector (its alignment); what is left over is coded the same way, LEVELS
times. An anchor, rotated alike and rounded to eight bits, meets a code by popcounts over its bit planes. By Cauchy-Schwarz
the true product lies within the last remainder's length times the anchor's length beside the code vector, plus
what rounding adds. Rows whose interval can't reach an anchor's windows or its best rows go; the others are scored in
integers. Anchors and rows meet in cells of a grid of hashed blocks, sized in bytes: no key is hot, whatever the labels.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockwright.llm.shared import forget, written

#: Each takes a bit a component; what is left over shrinks to about 0.6 of itself with each.
LEVELS = 8
ROW_BYTES, ANCHOR_BYTES, LEAST_ROWS = 16 << 20, 2 << 20, 8192
#: Components and lengths beyond these can't be scored in 64 bits.
MOST_COMPONENT, MOST_SQUARE = float(1 << 27), float(1 << 55)
_BITS, _FILTER_FROM = 8, 2
_PLACES = np.float32(2) ** np.arange(_BITS, dtype=np.float32)
#: Covers the rounding of single precision, as a share of the two lengths.
_SLACK = 1e-5

CODED = "row long, vec_id long, label long, anchor boolean, v array<int>, codes array<long>, alignments array<double>"
FOUND = "anchor_row long, place int, row long, vec_id long, score long"


def rotated(x: np.ndarray, level: int) -> np.ndarray:
    """Rows of ``x`` (width a power of two) under the level's rotation, in exact steps, so that every worker gets the same."""
    n, d = x.shape
    x = x * np.random.default_rng(100 + level).choice([-1.0, 1.0], d)
    half = 1
    while half < d:
        pairs = x.reshape(n, d // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, d)
        half *= 2
    return x / math.sqrt(d)


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)


def encode(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows, levels, words) and alignments (rows, levels) of integer vectors."""
    rest, codes, alignments = v.astype(np.float64), [], []
    side = 1 / math.sqrt(v.shape[1])
    for level in range(LEVELS):
        rest = rotated(rest, level)
        positive = rest >= 0
        along = np.abs(rest).sum(axis=1) * side
        rest -= np.where(positive, side, -side) * along[:, None]
        codes.append(_packed(positive))
        alignments.append(along)
    return np.stack(codes, axis=1), np.stack(alignments, axis=1)


class Rows:
    """A block of coded rows, laid out by level and word."""

    def __init__(self, table: pa.Table):
        n = table.num_rows
        column = lambda c: table.column(c).combine_chunks()
        self.row, self.label = column("row").to_numpy(), column("label").to_numpy()
        self.no_id, self.vec_id = column("vec_id").is_null().to_numpy(zero_copy_only=False), column("vec_id").fill_null(0).to_numpy()
        self.v = column("v").flatten().to_numpy().reshape(n, -1)
        self.codes = np.ascontiguousarray(column("codes").flatten().to_numpy().view(np.uint64).reshape(n, LEVELS, -1).transpose(1, 2, 0))
        self.alignments = np.ascontiguousarray(column("alignments").flatten().to_numpy().reshape(n, LEVELS).T)
        square = (self.v.astype(np.float64) ** 2).sum(axis=1)
        left = square - np.cumsum(self.alignments**2, axis=0)
        self.length, self.reach = np.sqrt(square).astype(np.float32), np.cumsum(self.alignments, axis=0).astype(np.float32)
        self.rest = np.sqrt(np.maximum(left, 0) + 1e-9 * square).astype(np.float32)  # of each level; at least the true remainder, up to rounding
        self.alignments = self.alignments.astype(np.float32)
        order = np.argsort(self.label, kind="stable")
        values, starts = np.unique(self.label[order], return_index=True)
        self.by_label = dict(zip(values.tolist(), np.split(order, starts[1:]), strict=True))


class Queries:
    """A block of anchors: their rotations as bit planes, (anchor, level, plane, word)."""

    def __init__(self, v: np.ndarray):
        n, d = v.shape
        self.v, self.length = v.astype(np.int64), np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
        now, half = v.astype(np.float64), 1 << (_BITS - 1)
        planes, steps, totals, offs = [], [], [], []
        for level in range(LEVELS):
            now = rotated(now, level)
            step = np.maximum(np.abs(now).max(axis=1) / (half - 1), 1e-300)
            z = np.rint(now / step[:, None])
            offs.append(np.abs(now - step[:, None] * z).sum(axis=1) / math.sqrt(d))
            planes.append(np.stack([_packed(((z.astype(np.int64) + half) >> j & 1).astype(bool)) for j in range(_BITS)], axis=1))
            steps.append(step / math.sqrt(d))
            totals.append(z.sum(axis=1))
        self.planes, self.steps, self.totals, self.offs = (np.stack(x, axis=1) for x in (planes, steps, totals, offs))

    def products(self, k: int, rows: Rows, level: int, at: np.ndarray) -> np.ndarray:
        """Estimated products of anchor k with the unit code vectors of rows ``at``, right to ``offs``."""
        inside = np.zeros(len(at), np.float32)
        for w, words in enumerate(rows.codes[level]):
            code = words[at]
            inside += _PLACES @ np.bitwise_count(code & self.planes[k, level, :, w, None]).astype(np.float32)
            inside -= np.bitwise_count(code) * np.float32(1 << (_BITS - 1))
        inside += inside  # whole numbers below 2^24, so exact
        inside -= np.float32(self.totals[k, level])
        inside *= np.float32(self.steps[k, level])
        return inside


def survivors(q: Queries, k: int, rows: Rows, at: np.ndarray, low: np.ndarray, high: np.ndarray, best: int) -> np.ndarray:
    """Rows of ``at`` that may be among the ``best`` of one of anchor k's windows [low, high]."""
    floor, top, length = low.astype(np.float64), high.max(), float(q.length[k])
    middle, off = np.zeros(len(at), np.float32), 0.0
    for level in range(LEVELS):
        estimate, off = q.products(k, rows, level, at), max(off, float(q.offs[k, level]))
        middle += rows.alignments[level][at] * estimate
        if level < _FILTER_FROM:  # intervals are too wide to leave anything out
            continue
        np.abs(estimate, out=estimate)
        estimate -= off
        beside = np.sqrt(np.maximum(length * length - np.square(np.maximum(estimate, 0)), 0))
        error = rows.rest[level][at] * beside + rows.reach[level][at] * off + rows.length[at] * (_SLACK * length) + _SLACK
        least, most = middle - error, middle + error
        stay = (most >= floor.min()) & (least <= top)
        if (level - _FILTER_FROM) % 2:  # every other level tells the windows apart
            at, middle, least, most = (x[stay] for x in (at, middle, least, most))
            stay = np.zeros(len(at), bool)
            for j in range(len(low)):
                sure = least[(least >= low[j]) & (most <= high[j])]
                if len(sure) >= best:  # the best-th of these scores at least that much
                    floor[j] = max(floor[j], np.partition(sure, len(sure) - best)[len(sure) - best])
                stay |= (most >= floor[j]) & (least <= high[j])
        at, middle = at[stay], middle[stay]
    return at


def _cell(same: bool, best: int):
    """Each anchor's best rows of one cell in each of its windows."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        kept = []
        if left.num_rows and right.num_rows:
            rows = Rows(left)
            everyone = np.arange(len(rows.row))
            q = Queries(right.column("v").combine_chunks().flatten().to_numpy().reshape(right.num_rows, -1))
            for k, (a, label, low, high) in enumerate(zip(*(right.column(c).to_pylist() for c in ("row", "label", "low", "high")), strict=True)):
                at = rows.by_label.get(label, everyone[:0]) if same else everyone[rows.label != label]
                at = at[rows.row[at] != a]
                if not len(at):
                    continue
                low, high = np.array(low, np.int64), np.array(high, np.int64)
                at = survivors(q, k, rows, at, low, high, best)
                score = rows.v[at].astype(np.int64) @ q.v[k]
                for j in range(len(low)):
                    inside = np.flatnonzero((score >= low[j]) & (score <= high[j]))
                    first = inside[np.lexsort((rows.vec_id[at[inside]], rows.no_id[at[inside]], -score[inside]))[:best]]
                    kept += [(a, j, int(rows.row[x]), None if rows.no_id[x] else int(rows.vec_id[x]), int(s)) for x, s in zip(at[first], score[first], strict=True)]
        names = ["anchor_row", "place", "row", "vec_id", "score"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*kept) if kept else [()] * 5, kinds, strict=True)], names=names)

    return run


def coded(vectors: DataFrame, anchor: Column, scale: int) -> DataFrame:
    """Distinct usable rows as integer vectors with codes and alignments, each with a number of its own (``row``), written."""
    fine = F.coalesce(F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < MOST_COMPONENT / scale, F.lit(False))), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), "embedding")
    rows = rows.where(fine & F.col("label").isNotNull()).withColumn("v", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))).drop("embedding")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rows = rows.where(square < MOST_SQUARE).dropDuplicates(["vec_id", "label", "v"])
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 1
    width = max(64, 1 << (longest - 1).bit_length())

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("v")
            sizes = np.diff(column.offsets.to_numpy())
            v = np.zeros((batch.num_rows, width), np.int32)
            v[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
            codes, alignments = encode(v)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x[0].size, pa.int32()), pa.array(x.ravel())) for x in (v, codes.view(np.int64), alignments)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("vec_id", "label", "anchor")), *lists], ["vec_id", "label", "anchor", "v", "codes", "alignments"])

    made = rows.mapInArrow(run, CODED.removeprefix("row long, "))
    return written(made.withColumn("row", F.monotonically_increasing_id()), "coded")


def _met(rows: DataFrame, anchors: DataFrame, n_rows: int, n_anchors: int, same: bool, best: int) -> DataFrame:
    """Every anchor (row, label, v, low, high) against every row, cell by cell: the best of each cell, then the best of all."""
    spark = rows.sparkSession
    each = len(rows.select("v").first()[0]) * 8  # bytes of a vector, its codes and alignments
    # a block of rows a task, so that small tables use all cores, but none of under LEAST_ROWS; more where ROW_BYTES hold fewer rows
    down = max(math.ceil(n_rows * each / ROW_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / LEAST_ROWS)))
    across = max(1, math.ceil(n_anchors * each / ANCHOR_BYTES))
    dealt = lambda df, n: F.pmod(F.xxhash64(df["row"]), F.lit(n)).cast("int")
    left = rows.withColumn("down", dealt(rows, down)).withColumn("across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    anchors = written(anchors, "anchors")
    right = anchors.withColumn("across", dealt(anchors, across)).withColumn("down", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    found = left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInArrow(_cell(same, best), FOUND)
    order = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    best_of_all = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best), "best")
    forget(anchors)
    return best_of_all


def hard_negatives(vectors: DataFrame, anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, embedding, label).

    Components become floor(scale * x); a score is the integer inner product with the anchor (rows where the Column ``anchor`` holds).
    An anchor's positives are its ``positives`` best other rows of its label; each positive's negatives are the ``negatives`` best
    rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score. Ties go to the smaller
    vec_id, null last. Exact: the codes only leave out rows that can't be in a result.

    Rows with a null label, a null vector, a null or non-finite component take no part, nor do those too long for scores of
    64 bits (a component of 2^27 or more after scaling, or a square length of 2^55). Shorter vectors count as filled up with zeros.
    Rows equal in vec_id, label and scaled vector count once; rows that share a vec_id else are rows of their own, each an anchor
    if one is. A null vec_id is as good as any but is no anchor unless ``anchor`` says so. Other columns are ignored; an empty
    table, or no anchor, gives no rows.
    """
    rows = coded(vectors, anchor, scale)
    shown = {r["anchor"]: r["n"] for r in rows.groupBy("anchor").agg(F.count("*").alias("n")).collect()}
    n, n_anchors = sum(shown.values()), shown.get(True, 0)
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return rows.sparkSession.createDataFrame([], empty)
    anchors = rows.where("anchor").select("row", "label", "v")
    whole = F.array(F.lit(-(1 << 62))), F.array(F.lit(1 << 62))
    best = _met(rows, anchors.withColumns({"low": whole[0], "high": whole[1]}), n, n_anchors, True, positives)
    listed = best.groupBy(F.col("anchor_row").alias("row")).agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("p"))
    # exact in integers: the least score with 100 * score >= low * p, and the largest with 100 * score <= high * p
    windows = listed.select("row", F.transform("p", lambda p: -F.floor(-p["score"] * low / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("low"),
                            F.transform("p", lambda p: F.floor(p["score"] * high / F.lit(100).cast("decimal(3,0)")).cast("long")).alias("high"))
    wrong = _met(rows, anchors.join(windows, "row"), n, n_anchors, False, negatives)
    names = rows.where("anchor").select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    chosen = best.select("anchor_row", (F.col("rank") - 1).cast("int").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = wrong.select("anchor_row", "place", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(chosen, ["anchor_row", "place"]).join(names, "anchor_row")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
