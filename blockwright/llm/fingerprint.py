"""Document fingerprints: improbable features in chained Bloom filters (after Roussev's similarity digests).

Every window of 64 bytes has an entropy; how rare that entropy is among all windows of the table ranks the window. In each run of
64 neighbouring windows the leftmost of the best rank is popular once; windows popular often enough are features (all that are popular at all, where there are few). Features
set 5 bits each in Bloom filters of 2048 bits, at most 160 features a filter. Two fingerprints are compared filter by filter by the
overlap of their bits beyond what chance gives, scaled to 0..1.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwright.llm.arrays import mix
from blockwright.llm.shared import with_text

WINDOW = 64
POPULAR = 16
BITS = 2048
HASHES = 5
FEATURES = 160
FEW = 8
LEVELS = 1000
DOCS_A_RANGE = 1500
_SCALE = 1 << 20


@lru_cache(1)
def _steps() -> np.ndarray:
    """What the c-th equal byte of a window adds to the sum of c * log2(c), in whole units, so that sums are exact."""
    c = np.arange(0, WINDOW + 2, dtype=np.float64)
    total = np.round(np.where(c > 0, c * np.log2(np.maximum(c, 1)), 0) * _SCALE).astype(np.int64)
    return np.diff(total)


def entropy_levels(b: np.ndarray) -> np.ndarray:
    """The entropy of every window of 64 bytes as a whole number below LEVELS."""
    n = len(b)
    if n < WINDOW:
        return np.zeros(0, np.int64)
    before, after = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for lag in range(1, WINDOW):
        same = (b[lag:] == b[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    steps = _steps()
    # equal bytes among the first window so far; the byte that leaves takes its last step back first
    change = steps[before]
    change[WINDOW:] -= steps[after[: n - WINDOW]]
    total = np.cumsum(change)[WINDOW - 1 :]
    entropy = 6 * _SCALE * WINDOW - total
    return np.minimum(entropy * LEVELS // (6 * _SCALE * WINDOW), LEVELS - 1)


def feature_starts(levels: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Starts of the popular windows. rank: the smaller, the rarer; a negative rank never counts."""
    n = len(levels)
    if not n:
        return np.zeros(0, np.int64)
    r = rank[levels]
    key = np.where(r < 0, np.int64(1) << 60, (r << 32) + np.arange(n))
    low, width = key, 1
    while 2 * width <= WINDOW and len(low) > width:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    best = low[low < np.int64(1) << 60] & 0xFFFFFFFF
    votes = np.bincount(best, minlength=1)
    popular = np.flatnonzero(votes >= POPULAR)
    return popular if len(popular) >= FEW else np.flatnonzero(votes)


def filters(b: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, one row of bytes each. A text without features gives all its runs of 8 bytes, a shorter one its whole."""
    at = feature_starts(entropy_levels(b), rank)
    odd = mix(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
    if len(at):
        words = b[at[:, None] + np.arange(WINDOW)].view("<u8")
        h = mix((mix(words) * odd).sum(1, dtype=np.uint64))
        h = h[np.sort(np.unique(h, return_index=True)[1])]
    elif len(b) >= 8:
        h = np.unique(mix(np.lib.stride_tricks.sliding_window_view(b, 8).copy().view("<u8").ravel()))
    else:
        h = np.frombuffer(hashlib.sha256(b.tobytes()).digest()[:8], "<u8")
    chain = np.arange(len(h)) // FEATURES
    out = np.zeros((chain[-1] + 1, BITS), bool)
    for k in range(HASHES):
        out[chain, (h >> np.uint64(11 * k)).astype(np.int64) & (BITS - 1)] = True
    return np.packbits(out, axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: for each filter of the shorter chain the best overlap with one of the other, on average. Equal chains give 1."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if len(a) > len(b):
        a, b = b, a
    ones_a, ones_b = np.bitwise_count(a).sum(1).astype(float), np.bitwise_count(b).sum(1).astype(float)
    total = 0.0
    for row, n in zip(a, ones_a, strict=True):
        shared = np.bitwise_count(row & b).sum(1)
        most = np.minimum(n, ones_b)
        chance = n * ones_b / BITS + 0.3 * (most - n * ones_b / BITS)
        total += float(np.clip((shared - chance) / np.maximum(most - chance, 1e-9), 0, 1).max())
    return total / len(a)


def text_form(chain: np.ndarray) -> str:
    return f"{len(chain)}:{chain.tobytes().hex()}"


def from_text(form: str) -> np.ndarray:
    count, digits = form.split(":")
    return np.frombuffer(bytes.fromhex(digits), np.uint8).reshape(int(count), BITS // 8)


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LEVELS, np.int64)
    for batch in batches:
        for text in batch.column("text"):
            b = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            if len(b) >= WINDOW:
                total += np.bincount(entropy_levels(b), minlength=LEVELS)
    yield pa.RecordBatch.from_pydict({"level": pa.array(np.arange(LEVELS)), "n": pa.array(total)})


def ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy level by how many windows of all texts have it, the rarest first; the dullest windows never count."""
    rows = with_text(docs).mapInArrow(_levels, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()  # LEVELS rows at most
    count = np.zeros(LEVELS, np.int64)
    for level, n in rows:
        count[level] = n
    rank = np.empty(LEVELS, np.int64)
    rank[np.lexsort((np.arange(LEVELS), count))] = np.arange(LEVELS)
    rank[: LEVELS // 6] = -1
    return rank


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _fingerprints(rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

        def chain(t: str) -> np.ndarray:
            return filters(np.frombuffer(t.encode(), np.uint8), rank)

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for doc, rng, ghost, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "range", "ghost", "text")), strict=True):
                own = chain(text)
                if last is not None and last[0] == rng:
                    _, before, t, f = last
                    new = edited_text(t, text)
                    g = chain(new)
                    rows.append((before, len(t), hashlib.sha256(new.encode()).hexdigest(), text_form(f), text_form(g), likeness(f, g), likeness(f, own)))
                last = None if ghost else (rng, doc, text, own)
            yield flush()
            rows = []

    return run


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The following document is the next in descending doc_id (ties: by text; null ids last), after the last the first; a table of
    one row follows itself. Null texts count as empty. Ranges of doc_ids go to tasks by quantiles of that column, so
    texts are shuffled once; each range also gets the first row of the next one.
    """
    rank = ranks(docs)
    src = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    ids = src.where("doc_id is not null").select("doc_id")
    n = max(1, ids.count() // DOCS_A_RANGE)
    cuts = np.array(sorted(set(ids.approxQuantile("doc_id", [k / n for k in range(1, n)], 0.1 / n))), np.float64) if n > 1 else np.zeros(0)

    @F.pandas_udf("int")
    def place(doc_id):
        return len(cuts) - np.searchsorted(cuts, doc_id.fillna(-np.inf).astype("float64"), "left") + 0 * doc_id.fillna(0).astype(int)

    dealt = src.select("doc_id", "text", place("doc_id").cast("int").alias("range"))
    heads = src.select("doc_id", place("doc_id").cast("int").alias("range")).groupBy("range").agg(F.max("doc_id").alias("head")).collect()  # one row a range
    heads = sorted((r["range"], r["head"]) for r in heads)
    after = [(heads[(k + 1) % len(heads)][1], heads[k][0]) for k in range(len(heads))]
    key = F.broadcast(src.sparkSession.createDataFrame(after, "head long, range int"))
    ghosts = src.join(key, F.expr("doc_id <=> head")).groupBy("range").agg(F.max("doc_id").alias("doc_id"), F.min("text").alias("text"))
    rows = dealt.withColumn("ghost", F.lit(False)).unionByName(ghosts.withColumn("ghost", F.lit(True)))
    sorted_ = rows.repartition(max(1, len(heads)), "range").sortWithinPartitions("range", "ghost", F.desc_nulls_last("doc_id"), "text")
    return sorted_.mapInArrow(_fingerprints(rank), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
