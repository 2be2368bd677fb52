"""Benchmark decontamination by q-gram filtering.

Benchmark items are cut into overlapping windows of characters. A window of m characters that occurs with at most k edits
shares at least m - q + 1 - k * q of its q-grams with the text, all on diagonals at most k apart (the q-gram lemma; Jokinen and
Ukkonen, 1991). Hits are counted by window in overlapping bands of diagonals; bands that reach the bound are verified by a banded alignment.
Texts and items are compared in lower case with single blanks between words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwright.llm.shared import with_text

Q = 10
WINDOW = 100
STRIDE = 50
EDITS = 0.05
ITEMS_A_PASS = 20_000
_BITS = 22


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")


def grams(c: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every Q characters in a row."""
    n = len(c) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    k = np.uint64(0x9E3779B97F4A7C15)
    one = c.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        k2 = k * k
        k4, k8 = k2 * k2, k2 * k2 * (k2 * k2)
        two = one[:-1] * k + one[1:]
        four = two[:-2] * k2 + two[2:]
        eight = four[:-4] * k4 + four[4:]
        ten = eight[:n] * k2 + two[8 : 8 + n]
        return (ten ^ (ten >> np.uint64(31))) * k8


@dataclass
class Index:
    """Windows of the items of one pass and where each q-gram stands in them."""

    items: list[int]
    texts: list[str]
    budgets: np.ndarray
    bounds: np.ndarray
    keys: np.ndarray
    first: np.ndarray
    windows: np.ndarray
    places: np.ndarray
    filter: np.ndarray


def index(rows: list[tuple[int, str]], window: int = WINDOW, stride: int = STRIDE, edits: float = EDITS) -> Index:
    """Items shorter than one window are one window; those shorter than 2 * Q characters are left out, as they say too little."""
    items, texts = [], []
    for item, text in rows:
        t = normal(text)
        if len(t) < 2 * Q:
            continue
        starts = [*range(0, max(1, len(t) - window), stride), max(0, len(t) - window)]
        for s in sorted(set(starts)):
            items.append(item)
            texts.append(t[s : s + window])
    budgets = np.array([math.floor(edits * len(t)) for t in texts], np.int64)
    bounds = np.array([max(1, len(t) - Q + 1 - k * Q) for t, k in zip(texts, budgets.tolist(), strict=True)], np.int64)
    found = [grams(codes(t)) for t in texts]
    flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(found)), [len(g) for g in found]).astype(np.int64)
    place = np.concatenate([np.arange(len(g)) for g in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    keys, first = np.unique(flat[order], return_index=True)
    bitmap = np.zeros(1 << _BITS, bool)
    bitmap[(keys >> np.uint64(64 - _BITS)).astype(np.int64)] = True
    return Index(items, texts, budgets, bounds, keys, np.append(first, len(flat)), owner[order], place[order].astype(np.int64), bitmap)


def align(window: str, text: str, budget: int) -> int | None:
    """Least edits that turn ``window`` into some substring of ``text``, over diagonals of the band only; None beyond the budget."""
    if window in text:
        return 0
    m, n, inf = len(window), len(text), budget + 1
    width = n - m + 2 * budget + 1  # diagonals -budget .. n - m + budget
    if width <= 0:
        return None
    a, b = codes(window), codes(text)
    low = -budget
    row = np.where(np.arange(low, low + width) >= 0, 0, inf).astype(np.int64)  # row 0: a substring may begin anywhere
    for i in range(1, m + 1):
        j = np.arange(low, low + width) + i
        ok = (j >= 1) & (j <= n)
        miss = np.ones(width, np.int64)
        miss[ok] = b[j[ok] - 1] != a[i - 1]
        best = np.where(ok, row + miss, inf)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best[j == 0] = i
        best[(j < 0) | (j > n)] = inf
        step = np.arange(width)
        row = np.minimum(np.minimum.accumulate(best - step) + step, inf)
    return int(row.min()) if row.min() <= budget else None


def matches(text: str, c: np.ndarray, ix: Index) -> list[tuple[int, int, int, int]]:
    """(item, windows found, least edits, first place) of each item in one text in normal form."""
    h = grams(c)
    at = np.flatnonzero(ix.filter[(h >> np.uint64(64 - _BITS)).astype(np.int64)]) if len(h) else np.zeros(0, np.int64)
    if not len(at):
        return []
    slot = np.minimum(np.searchsorted(ix.keys, h[at]), len(ix.keys) - 1)
    true = ix.keys[slot] == h[at]
    at, slot = at[true], slot[true]
    many = ix.first[slot + 1] - ix.first[slot]
    if not len(at):
        return []
    posting = np.repeat(ix.first[slot] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    window, diagonal = ix.windows[posting], np.repeat(at, many) - ix.places[posting]
    shared = np.bincount(window, minlength=len(ix.items))
    hopeful = shared[window] >= ix.bounds[window]  # no band can hold more than the whole text
    window, diagonal, place = window[hopeful], diagonal[hopeful], ix.places[posting][hopeful]
    if not len(window):
        return []
    half = ix.budgets[window] + 1
    band = (diagonal + WINDOW) // half  # a band is two neighbouring halves: any half-wide set of diagonals lies inside one
    window, band, place = np.tile(window, 2), np.concatenate([band, band - 1]), np.tile(place, 2)
    one = np.unique(np.column_stack([window, band, place]), axis=0)  # a q-gram of the window counts once a band
    pairs, counts = np.unique(one[:, :2], axis=0, return_counts=True)
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for (w, b), count in zip(pairs.tolist(), counts.tolist(), strict=True):
        if count < ix.bounds[w]:
            continue
        k = int(ix.budgets[w])
        begin = b * (k + 1) - WINDOW
        low, high = max(0, begin - k), begin + 2 * (k + 1) + len(ix.texts[w]) + k
        edits = align(ix.texts[w], text[low:high], k)
        if edits is not None:
            old = found.setdefault(ix.items[w], {}).get(w)
            found[ix.items[w]][w] = (edits, low) if old is None else min(old, (edits, low))
    return [(item, len(x), min(e for e, _ in x.values()), min(s for _, s in x.values())) for item, x in sorted(found.items())]


def _search(ix: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                t = normal(text.as_py())
                rows += [(doc, *m) for m in matches(t, codes(t), ix)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[k], pa.int64()) for k in range(5)], ["doc_id", "item_id", "n_windows", "edits", "place"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, items_a_pass: int = ITEMS_A_PASS) -> DataFrame:
    """Pairs of a document and a benchmark item of which it holds a window: doc_id, item_id, n_windows, edits (least), place (near the
    first, in the text's normal form). Clean documents give no row, nor do null and empty texts; repeated rows give repeated pairs.

    A pass holds at most ``items_a_pass`` items in memory; a larger benchmark is dealt by a hash of item_id over more passes.
    """
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    passes = max(1, math.ceil(items.count() / (items_a_pass / 2)))
    out = None
    for k in range(passes):
        mine = items if passes == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k)
        ix = index(sorted((r["item_id"], r["text"]) for r in mine.collect()))
        found = with_text(docs).mapInArrow(_search(ix), "doc_id long, item_id long, n_windows long, edits long, place long")
        out = found if out is None else out.unionByName(found)
    return out
