"""LM scoring with an Elias-Fano trie of word bigrams.

Words of all training texts are counted by Spark; so are pairs of neighbouring words. The trie has two levels: a pointer
for each context word, and the context's successors. Both are monotone sequences in Elias-Fano form (successors
by adding the context's base, as Pibiri and Venturini do), with probabilities quantised to 8 bits, in one run of bytes. A lookup reads the context's range by two selects, then finds the successor among the
entries that share its upper bits.

P(w | v) = d(v, w) + b(v) * P(w): d is the discounted, rounded-down share of the pair, b what it leaves, P(w) the
smoothed unigram. So the probabilities of all words, the unknown included, add up to at most 1.

Nothing is cut: the model is dealt into shards, each a trie of its own with all words and pairs that fall to it. A context's pairs lie in one shard, those of
the most frequent contexts in all, so that no shard grows with one word. Texts ask in slices: each slice sends every shard one row with its words and pairs there, each once,
and the texts that hold them; the shard looks them up in its trie and answers with what they add to each text. So a shard is looked up where it lies, no row
stands for a pair, and what is sent is in proportion to the texts at every size. Every pair counts, also one seen once.
Texts send their pairs packed to the shards, which add them up; the counts of a shard's words come by one join, a row for each shard and word. Shards are asked in ROUNDS, one part of them after another.
``train`` also packs a head of bounded size, one trie of the words and pairs seen most often, for callers that look up in one process; no score depends on it.
Each step is written and its predecessors' files go, so that disk holds one step at a time.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from blockwright.llm.arrays import freed, freed_group, mix, slices, text_bytes, word_hashes
from blockwright.llm.shared import forget, sweep, with_text, written

VOCABULARY = 1 << 19
PAIRS = 1 << 22
MIN_PAIR = 1  # all of them
ROUNDS = 2
DISCOUNT = 0.75
ADD = 0.1
SHARDS = 64
SHARD_PAIRS = 1 << 21  # a shard has at most about so many pairs, as it gets so many tokens; more than SHARDS times as many tokens make more shards
SPREAD = 8  # contexts with at least one part in so many of a mean shard's words lie in all shards
SLICE_BYTES = 8 << 20
ASK_BYTES = 4 << 20
END = np.uint64(0x1D0C5EED00000001)
_START = 1 << 40  # context of a text's first word
_WHOLE = (1 << 16) - 1  # level of a context that leaves all to the unigrams
_MASS = 1e15  # shares of pairs are added up as integers, so that their order doesn't matter
_LOWEST = 9.0  # decades that 8 bits span


def is_training(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 != 0, F.lit(True))


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with one end after each text, and the offsets of the texts in them."""
    words, counts, _ = word_hashes(data, offsets)
    at = np.concatenate([[0], np.cumsum(counts + 1)]).astype(np.int64)
    out = np.full(at[-1], END, np.uint64)
    place = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)
    out[place] = words
    return out, at


class Bits:
    """A bitmap with select, many at a time. Directory: ones and zeros before every word."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        self.zeros = np.arange(len(self.ones)) * 64 - self.ones

    def select(self, k: np.ndarray, one: bool) -> np.ndarray:
        """Place of the k-th (from 0) one or zero; k below their number."""
        directory = self.ones if one else self.zeros
        word = np.searchsorted(directory, k, "right") - 1
        left = (k - directory[word]).astype(np.uint8)
        w = self.words[word]
        if not one:
            w = ~w
        place = word << 6
        for width in (32, 16, 8, 4, 2, 1):
            low = w & np.uint64((1 << width) - 1)
            n = np.bitwise_count(low)
            on = left >= n
            left -= n * on
            place += on * np.int64(width)
            w = np.where(on, w >> np.uint64(width), low)
        return place

    def test(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1


class EliasFano:
    """A monotone sequence; ``parts`` gives the arrays to store, and any arrays of those shapes make one."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low = n, low_bits, low
        self.high = Bits(high)

    @classmethod
    def pack(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        l = max(0, min(31, int(math.log2(max(1, top // max(1, n))))))  # noqa: E741
        kind = np.uint8 if l <= 8 else np.uint16 if l <= 16 else np.uint32
        high = np.zeros((n + (top >> l) + 2) // 512 * 8 + 8, "<u8")
        at = (values >> l) + np.arange(n)
        np.bitwise_or.at(high, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        return cls(n, l, (values & ((1 << l) - 1)).astype(kind), high)

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self.high.select(i, True) - i) << self.low_bits) | self.low[i].astype(np.int64)

    def find(self, v: np.ndarray) -> np.ndarray:
        """Index of each value, -1 if it isn't there. Values at most the largest."""
        h = v >> self.low_bits
        first = np.zeros(len(v), np.int64)
        later = np.flatnonzero(h > 0)
        first[later] = self.high.select(h[later] - 1, False) - h[later] + 1
        want, out = (v & ((1 << self.low_bits) - 1)).astype(self.low.dtype), np.full(len(v), -1)
        live = np.flatnonzero(self.high.test(first + h))  # entry i has upper bits h where bit i + h is set
        low, high = first[live], self.high.select(h[live], False) - h[live]
        ask = want[live]
        while len(live):  # by halves among the entries with these upper bits: frequent contexts have many
            middle = (low + high) >> 1
            below = self.low[middle] < ask
            low, high = np.where(below, middle + 1, low), np.where(below, high, middle)
            open_ = low < high
            done = ~open_
            at, who, end = low[done], live[done], ask[done]
            hit = (at < self.n) & (self.low[np.minimum(at, self.n - 1)] == end)
            hit[hit] = self.high.test(at[hit] + h[who[hit]])
            out[who[hit]] = at[hit]
            live, low, high, ask = live[open_], low[open_], high[open_], ask[open_]
        return out


def _quantise(p: np.ndarray, levels: int) -> np.ndarray:
    """The level at or just below each probability; 0 for less than all levels."""
    with np.errstate(divide="ignore"):
        return np.clip(np.floor((np.log10(p) / _LOWEST + 1) * (levels - 1)), 0, levels - 1).astype(np.uint8 if levels == 256 else np.uint16)


def _value(q: np.ndarray, levels: int) -> np.ndarray:
    return np.where(q > 0, 10 ** ((q / (levels - 1) - 1) * _LOWEST), 0.0)


def _places(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted vocabulary, -1 if it isn't in it."""
    if not len(words):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    return np.where(words[at] == hashes, at, -1)


def _context_places(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """As ``_places``; the context of first words comes after all."""
    return np.where(hashes == END, len(words), _places(words, hashes))


def pair_hashes(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(context) * np.uint64(0x9E3779B97F4A7C15) + word)


def _shard_of(context: np.ndarray, word: np.ndarray, spread: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each pair: its context's, or that of the pair's own hash if the context is one of those in all shards."""
    x = np.where(_places(spread, context) >= 0, pair_hashes(context, word), mix(context))
    return (((x >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)).astype(np.int64)


class Trie:
    """A head or a shard in one run of bytes. Context ids: places in the sorted vocabulary, and _START. ``spread``: the contexts that lie in all of ``shards`` shards."""

    def __init__(self, raw):
        self.total, self.distinct, self.training_docs, count = struct.unpack_from("<QQQQ", raw)
        at, arrays = 32, []
        for _ in range(count):
            kind, n = struct.unpack_from("<8sQ", raw, at)
            arrays.append(np.frombuffer(raw, kind.decode().strip(), n, at + 16))
            at += 16 + -(-arrays[-1].nbytes // 8) * 8
        self.words, self.counts, meta, p_low, p_high, s_low, s_high, self.prob, self.left, self.spread = arrays
        self.pointers = EliasFano(int(meta[0]), int(meta[1]), p_low, p_high)
        self.successors = EliasFano(int(meta[2]), int(meta[3]), s_low, s_high)
        self.shards = int(meta[4])
        self.denominator = self.total + ADD * (self.distinct + 1)

    @staticmethod
    def pack(words: np.ndarray, counts: np.ndarray, total: int, distinct: int, training_docs: int, context: np.ndarray, word: np.ndarray, prob: np.ndarray, left: np.ndarray, spread: np.ndarray, shards: int) -> bytes:
        """``context``, ``word``: pairs in ascending order, as vocabulary places (the number of words for the context of first words), with levels ``prob``.
        ``left``: level of each word's context and _START's."""
        sizes = np.bincount(context, minlength=len(words) + 1)
        pointers = np.concatenate([[0], np.cumsum(sizes)])
        last = np.zeros(len(words) + 1, np.int64)
        last[context] = word + 1  # ascending, so the largest stays
        base = np.cumsum(last) - last
        ef_p, ef_s = EliasFano.pack(pointers), EliasFano.pack(word + base[context] + 1)
        meta = np.array([ef_p.n, ef_p.low_bits, ef_s.n, ef_s.low_bits, shards], np.int64)
        out = [struct.pack("<QQQQ", total, distinct, training_docs, 10)]
        for a in (words, counts.astype("<u4" if not len(counts) or int(counts.max()) < 1 << 32 else "<i8"), meta, ef_p.low, ef_p.high.words, ef_s.low, ef_s.high.words, prob.astype("u1"), left.astype("<u2"), spread.astype("<u8")):
            raw = a.tobytes()
            out += [struct.pack("<8sQ", a.dtype.str.encode().ljust(8), len(a)), raw, b"\0" * (-len(raw) % 8)]
        return b"".join(out)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        return _places(self.words, hashes)

    def conditional(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """d and b of each pair of places (context _START or -1 for unknown)."""
        pair, left = np.zeros(len(word)), np.ones(len(word))
        known, inverse = np.unique(np.where(context == _START, len(self.words), context), return_inverse=True)
        ok = known >= 0
        begin, end, base = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        begin[ok], end[ok] = self.pointers.access(known[ok]), self.pointers.access(known[ok] + 1)
        some = begin < end
        after = some & (begin > 0)
        base[after] = self.successors.access(begin[after] - 1)
        left[...] = np.where(ok, _value(self.left[np.maximum(known, 0)], 1 << 16), 1.0)[inverse]
        ask = np.flatnonzero(some[inverse] & (word >= 0))
        value = word[ask] + base[inverse[ask]] + 1
        last = self.successors.access(end[some] - 1)
        top = np.zeros(len(known), np.int64)
        top[some] = last
        inside = value <= top[inverse[ask]]
        ask, value = ask[inside], value[inside]
        found = self.successors.find(value) if len(value) else np.zeros(0, int)
        hit = found >= 0
        pair[ask[hit]] = _value(self.prob[found[hit]], 256)
        return pair, left


def _unigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j in slices(offsets, SLICE_BYTES):
            found, _ = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            h, n = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "c": pa.array(n.astype(np.int64))})


def _contexts(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The word before each; END, which no word follows, stands before a text's first."""
    context = np.concatenate([[END], found[:-1]]).astype(np.uint64)
    context[at[:-1]] = END
    return context


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for i, j in slices(offsets, SLICE_BYTES):
            found, at = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            context = _contexts(found, at)
            _, first, n = np.unique(pair_hashes(context, found), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({"v": pa.array(context[first].view(np.int64)), "w": pa.array(found[first].view(np.int64)), "c": pa.array(n.astype(np.int64))})


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The level and mass of each pair's share of its context."""
    for batch in batches:
        q = _quantise((batch.column("c").to_numpy().astype(np.float64) - DISCOUNT) / batch.column("seen").to_numpy(), 256)
        yield pa.RecordBatch.from_pydict({**{x: batch.column(x) for x in "vwc"}, "q": pa.array(q.astype(np.int32)), "mass": pa.array(np.ceil(_value(q, 256) * _MASS).astype(np.int64))})


def _left(mass: np.ndarray) -> np.ndarray:
    """The level of what contexts leave to the unigrams, by the mass of their pairs."""
    return np.maximum(_quantise(1 - mass / _MASS, 1 << 16), 1)


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each context leaves to the unigrams, as a level."""
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"v": batch.column("v"), "left": pa.array(_left(batch.column("mass").to_numpy()).astype(np.int32))})


def _bundle(v: np.ndarray, w: np.ndarray, c: np.ndarray) -> bytes:
    """Pairs and their counts, a context once for all its neighbouring pairs."""
    run = np.ones(len(v), bool)
    run[1:] = v[1:] != v[:-1]
    few = len(c) == 0 or int(c.max()) < 1 << 8
    head = np.array([len(v), int(run.sum()), int(few), 0], "<u4")
    return b"".join(x.tobytes() for x in (head, v[run].astype("<u8"), w.astype("<u8"), np.packbits(run), c.astype("u1" if few else "<i8")))


def _unbundle(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, runs, few, _ = (int(x) for x in np.frombuffer(raw, "<u4", 4))
    v = np.frombuffer(raw, "<u8", runs, 16)
    w = np.frombuffer(raw, "<u8", n, at := 16 + 8 * runs)
    run = np.unpackbits(np.frombuffer(raw, "u1", -(-n // 8), at := at + 8 * n), count=n)
    c = np.frombuffer(raw, "u1" if few else "<i8", n, at + -(-n // 8))
    return v[np.cumsum(run, dtype=np.int64) - 1], w, c.astype(np.int64)


def _by_shard(shard: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that has each shard's rows together, and in it each context's; the ends of the shards in that order."""
    order = np.argsort(shard.astype(np.uint64) << np.uint64(48) | mix(context) >> np.uint64(16))
    own = shard[order]
    return order, np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])) if len(own) else np.zeros(1, np.int64)


def _sent(spread: np.ndarray, shards: int):
    """Pairs of some megabytes of text with their counts there, one row a shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, ASK_BYTES):
                found, at = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                context = _contexts(found, at)
                _, first, n = np.unique(pair_hashes(context, found), return_index=True, return_counts=True)
                v, w = context[first], found[first]
                shard = _shard_of(v, w, spread, shards)
                order, cuts = _by_shard(shard, v)
                v, w, n = v[order], w[order], n[order]
                bodies = [_bundle(v[a:b], w[a:b], n[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_pydict({"shard": pa.array(shard[order][cuts[:-1]].astype(np.int32), pa.int32()), "body": pa.array(bodies, pa.binary())})

    return freed(run)


def _masses(c: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Level and mass of the shares that pairs have of their contexts."""
    q = _quantise((c - DISCOUNT) / seen, 256)
    return q, np.ceil(_value(q, 256) * _MASS).astype(np.int64)


def _added(spread: np.ndarray, seen: np.ndarray):
    """A shard's pairs, each once, and the mass that they have of each context that lies in all shards."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        v, w, c = (np.concatenate(x) for x in zip(*(_unbundle(x.as_py()) for x in table.column("body")), strict=True))
        found = pair_hashes(v, w)
        order = np.argsort(found)
        found = found[order]
        first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
        del found
        c = np.add.reduceat(c[order], first)
        order = order[first]
        v, w = v[order], w[order]
        at, mass = _places(spread, v), np.zeros(len(spread), np.int64)
        np.add.at(mass, at[at >= 0], _masses(c[at >= 0], seen[at[at >= 0]])[1])
        order = np.argsort(v)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "body": pa.array([_bundle(v[order], w[order], c[order])], pa.binary()), "mass": pa.array([mass], pa.list_(pa.int64()))})

    return freed_group(run)


def _held(spread: np.ndarray):
    """The words of each shard: of its pairs, and all contexts that lie in all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, body in zip(batch.column("shard").to_pylist(), batch.column("body"), strict=True):
                v, w, c = _unbundle(body.as_py())
                words = np.unique(np.concatenate([v[np.flatnonzero(np.diff(v, prepend=~v[:1]))], w, spread]))  # neighbours with one context give it once
                del v, w, c
                for k in range(0, len(words), 1 << 16):
                    some = words[k : k + (1 << 16)].view(np.int64)
                    yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(some), shard, np.int32)), "h": pa.array(some)})

    return freed(run)


def _packed(total: int, distinct: int, ends: int, shards: int, spread: np.ndarray, spread_left: np.ndarray):
    """One shard as a trie, from rows of its words (h, c) and one of its pairs (body)."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        pairs = table.filter(table.column("body").is_valid())
        table = table.filter(table.column("h").is_valid()).combine_chunks()
        h = table.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        words, counts = h[order], table.column("c").to_numpy()[order]
        v, w, c = _unbundle(pairs.column("body")[0].as_py())
        q, mass = _masses(c, counts[_places(words, v)])
        context, word = _context_places(words, v), _places(words, w)
        whole, has = np.zeros(len(words) + 1, np.int64), np.zeros(len(words) + 1, bool)
        np.add.at(whole, context, mass)
        has[context] = True
        del table, pairs, h, v, w, c, mass  # the trie is packed beside what is left
        left = np.where(has, _left(whole), _WHOLE)
        left[_context_places(words, spread)] = spread_left
        order = np.lexsort((word, context))
        raw = Trie.pack(words, counts, total, distinct, ends, context[order], word[order], q[order], left, np.zeros(0, np.uint64), shards)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "trie": pa.array([raw], pa.binary())})

    return freed_group(run)


def _rows_at_least(counts: DataFrame, most: int, least: int) -> int:
    """The smallest count, from ``least`` on, that at most ``most`` rows of ``counts`` reach."""
    levels = counts.where(F.col("c") >= least).groupBy(F.least("c", F.lit(1 << 16)).alias("c")).count().collect()  # at most 65,536 rows
    total = 0
    for c, n in sorted(((r["c"], r["count"]) for r in levels), reverse=True):
        total += n
        if total > most:
            return c + 1
    return least


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.select(*names).toArrow()
    return [table.column(n).to_numpy() for n in names]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))


def _counted(docs: DataFrame) -> tuple[DataFrame, tuple[int, int, int]]:
    """Words (h, c) of all of ``docs``; the numbers of tokens, distinct ones and texts."""
    counts = written(_texts(docs).mapInArrow(freed(_unigrams), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")
    end = F.col("h") == int(END.view(np.int64))
    totals = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(end, F.col("c"))), F.lit(0))).first()
    sweep(docs.sparkSession)
    return counts, tuple(totals)


def _tables(docs: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs (v, w, c, level q) and contexts (v, level left) of ``docs`` as rows, for a head."""
    both = written(_texts(docs).mapInArrow(_pairs, "v long, w long, c long").groupBy("v", "w").agg(F.sum("c").alias("c")), "pair-counts")
    sweep(docs.sparkSession)
    graded = written(both.join(counts.select(F.col("h").alias("v"), F.col("c").alias("seen")), "v").mapInArrow(_graded, "v long, w long, c long, q int, mass long"), "pairs")
    forget(both)
    sweep(docs.sparkSession)
    return graded, written(graded.groupBy("v").agg(F.sum("mass").alias("mass")).mapInArrow(_levels, "v long, left int"), "contexts")


def _sharded(docs: DataFrame, counts: DataFrame, totals: tuple[int, int, int], shards: int | None) -> tuple[DataFrame, np.ndarray, int]:
    """The shards (shard, trie), the contexts that lie in all of them, and their number."""
    total = totals[0]
    shards = shards or max(SHARDS, -(-total // SHARD_PAIRS))
    h, seen = _columns(counts.where(F.col("c") * SPREAD * shards >= total), "h", "c")  # at most SPREAD a shard
    order = np.argsort(h.view(np.uint64))
    spread, seen = h.view(np.uint64)[order], seen[order]
    sent = _texts(docs).mapInArrow(_sent(spread, shards), "shard int, body binary")
    added = written(sent.groupBy("shard").applyInArrow(_added(spread, seen), "shard int, body binary, mass array<long>"), "pair-counts")
    sweep(docs.sparkSession)
    place, mass = _columns(added.select(F.posexplode("mass").alias("place", "mass")).groupBy("place").agg(F.sum("mass").alias("mass")), "place", "mass")
    whole = np.zeros(len(spread), np.int64)
    whole[place] = mass
    # the words of a shard are as many as its pairs at most, so neither side has a bound for a broadcast
    words = added.select("shard", "body").mapInArrow(_held(spread), "shard int, h long").join(counts.hint("merge"), "h").select("shard", "h", "c", F.lit(None).cast("binary").alias("body"))
    both = words.union(added.select("shard", F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("c"), "body"))
    found = written(both.groupBy("shard").applyInArrow(_packed(*totals, shards, spread, _left(whole)), "shard int, trie binary"), "shards")
    forget(added)
    sweep(docs.sparkSession)
    return found, spread, shards


def _common(total: int, distinct: int, ends: int, spread: np.ndarray, shards: int) -> bytes:
    """What all shards share, as a trie without words."""
    none = np.zeros(0, np.int64)
    return Trie.pack(none.astype(np.uint64), none, total, distinct, ends, none, none, none, np.full(1, _WHOLE), spread, shards)


def learn(docs: DataFrame, shards: int | None = None) -> tuple[bytes, DataFrame]:
    """What all shards share (an empty trie with the totals and the contexts that lie in all shards), and the shards learnt from all of ``docs`` (doc_id, text)."""
    counts, totals = _counted(docs)
    found, spread, n = _sharded(docs, counts, totals, shards)
    forget(counts)
    sweep(docs.sparkSession)
    return _common(*totals, spread, n), found


def train(docs: DataFrame, vocabulary: int = VOCABULARY, pairs: int = PAIRS, shards: int | None = None) -> tuple[bytes, DataFrame]:
    """As ``learn``, with a head instead of the empty trie: the words seen most often, at most ``vocabulary``, and the most frequent pairs of them, at most ``pairs``.
    They bound the head only; no score depends on them."""
    counts, totals = _counted(docs)
    found, spread, n = _sharded(docs, counts, totals, shards)
    graded, contexts = _tables(docs, counts)
    least = _rows_at_least(counts, vocabulary, 1)
    top = counts.where((F.col("c") >= least) | (F.col("h") == int(END.view(np.int64))))
    h, c = _columns(top, "h", "c")
    order = np.argsort(h.view(np.uint64))
    words, seen = h.view(np.uint64)[order], c[order]
    known = graded.join(top.select(F.col("h").alias("v")), "v", "left_semi").join(top.select(F.col("h").alias("w")), "w", "left_semi")
    v, w, q = _columns(known.where(F.col("c") >= _rows_at_least(known, pairs, MIN_PAIR)), "v", "w", "q")
    at, level = _columns(contexts.join(top.select(F.col("h").alias("v")), "v", "left_semi"), "v", "left")
    context, word = _context_places(words, v.view(np.uint64)), _places(words, w.view(np.uint64))
    order = np.lexsort((word, context))
    left = np.full(len(words) + 1, _WHOLE)
    left[_context_places(words, at.view(np.uint64))] = level
    forget(counts, graded, contexts)
    sweep(docs.sparkSession)
    return Trie.pack(words, seen, *totals, context[order], word[order], q[order], left, spread, n), found


def _asked(shared: Trie, kind: pa.DataType, turn: int = 0, rounds: int = 1):
    """Rows for the shards of one round: of each slice of texts one for each shard, see ``_ask``, and in the first round one that holds its doc_ids and numbers of tokens, which its shard passes on.
    A slice is known by its place and its words, so that rows of another order in a later round would match nothing rather than another text."""
    spread, shards = np.array(shared.spread), shared.shards

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at_slice = part << 36
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for i, j in slices(offsets, ASK_BYTES):
                found, at = tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                context, size = _contexts(found, at), np.diff(at)
                known = mix(np.array([at_slice], np.uint64) + mix(found ^ mix(np.arange(len(found), dtype=np.uint64))).sum(dtype=np.uint64)).view(np.int64)[0]
                shard = _shard_of(context, found, spread, shards)
                mine = np.flatnonzero(shard % rounds == turn)
                shard, context, found = shard[mine], context[mine], found[mine]
                key = shard.astype(np.uint64) << np.uint64(48)
                key |= mix(context) >> np.uint64(40) << np.uint64(24)
                key |= mix(found) >> np.uint64(40)
                order = np.argsort(key)
                del key
                shard, context, found = shard[order], context[order], found[order]
                owner = np.repeat(np.arange(j - i, dtype="<u4"), size)[mine][order]
                cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, np.int64)
                asks = [_ask(context[a:b], found[a:b], owner[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                n, top = len(asks), int(turn == 0)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.concatenate([[(part + at_slice) % shards] * top, shard[cuts[:-1]]]).astype(np.int32)), "step": pa.array(np.repeat([1, 2], [top, n]).astype(np.int32)), "slice": pa.array(np.full(n + top, known)), "docs": pa.array(np.full(n + top, j - i)),
                    "ids": pa.array([*[batch.column("doc_id").slice(i, j - i).to_pylist()] * top, *[None] * n], pa.list_(kind)), "body": pa.array([*[size.astype("<i8").tobytes()] * top, *asks], pa.binary()),
                })
                at_slice += 1

    return freed(run)


def _ask(context: np.ndarray, word: np.ndarray, owner: np.ndarray) -> bytes:
    """Each context once, each pair once, in order, and the text of every occurrence. Rows of a pair, and pairs of a context, are neighbours; where they aren't it is sent again."""
    pair, run = np.ones(len(word), bool), np.ones(len(word), bool)
    run[1:] = context[1:] != context[:-1]
    pair[1:] = run[1:] | (word[1:] != word[:-1])
    first = np.flatnonzero(pair)
    head = np.array([len(word), len(first), int(run.sum())], "<u4")
    few = len(owner) == 0 or int(owner.max()) < 1 << 16
    return b"".join(a.tobytes() for a in (head, np.uint32(few), context[run].astype("<u8"), word[first].astype("<u8"), np.packbits(pair), np.packbits(run[first]), owner.astype("<u2" if few else "<u4")))


def _read_ask(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, the place of each pair's among them, the pairs' words, the place of each occurrence's pair, its text."""
    n, pairs, runs, few = (int(x) for x in np.frombuffer(raw, "<u4", 4))
    at = 16
    context = np.frombuffer(raw, "<u8", runs, at)
    word = np.frombuffer(raw, "<u8", pairs, at := at + 8 * runs)
    pair = np.unpackbits(np.frombuffer(raw, "u1", -(-n // 8), at := at + 8 * pairs), count=n)
    run = np.unpackbits(np.frombuffer(raw, "u1", -(-pairs // 8), at := at + -(-n // 8)), count=pairs)
    owner = np.frombuffer(raw, "<u2" if few else "<u4", n, at + -(-pairs // 8))
    return context, np.cumsum(run, dtype=np.int64) - 1, word, np.cumsum(pair, dtype=np.int64) - 1, owner


def _answered(raw: bytes):
    """What a shard's words and pairs add to each text of a slice: known words, base score, score. ``raw``: what all shards share, and answers where a shard has nothing."""

    def answer(trie: Trie, ask: bytes) -> bytes:
        context, of, word, pair, owner = _read_ask(ask)
        v, w = trie.places(context), trie.places(word)
        first, seen = context == END, v >= 0
        counts = np.append(trie.counts, 0)  # the last for place -1
        base = np.where(first, 0.0, np.log10((counts[v] + ADD) / trie.denominator))
        share, left = trie.conditional(np.where(first, _START, v)[of], w)
        rest = left * (counts[w] + ADD) / trie.denominator
        score = base[of] + np.log10(left) + np.where(share > 0, np.log10((share + rest) / rest), 0.0)
        texts, owner = np.unique(owner, return_inverse=True)  # only texts with a word here, so that short ones cost little
        sums = [np.bincount(owner, x[pair]) for x in ((seen & ~first)[of], base[of], score)]
        return b"".join(x.astype(kind).tobytes() for x, kind in zip((texts, *sums), ("<u4", "<u4", "<f8", "<f8"), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = Trie(raw)
        trie, at = empty, -1
        for batch in batches:
            out = []
            for shard, step, body in zip(*(batch.column(x).to_pylist() for x in ("shard", "step")), batch.column("body"), strict=True):
                if step == 0:
                    trie, at = Trie(body.as_py()), shard
                else:
                    out.append(body.as_py() if step == 1 else answer(trie if shard == at else empty, body.as_py()))
            keep = pa.array(batch.column("step").to_numpy() > 0)
            yield pa.RecordBatch.from_pydict({**{x: batch.column(x).filter(keep) for x in ("step", "slice", "docs", "ids")}, "body": pa.array(out, pa.binary())})

    return freed(run)


def _summed(shared: Trie, kind: pa.DataType):
    """A slice's texts with the sums of all shards' answers, and the ends that each text has."""
    ends, denominator = shared.training_docs, shared.denominator

    def run(table: pa.Table) -> pa.Table:
        docs = table.column("docs")[0].as_py()
        known, base, score = np.full(docs, int(ends > 0), np.int64), np.full(docs, math.log10((ends + ADD) / denominator)), np.full(docs, math.log10((ends + ADD) / denominator))
        bodies = sorted(x.as_py() for x, step in zip(table.column("body"), table.column("step").to_pylist(), strict=True) if step == 2)  # one order of the sums, whatever the shuffle's
        for body in bodies:
            n = len(body) // 24
            texts = np.frombuffer(body, "<u4", n)
            known[texts] += np.frombuffer(body, "<u4", n, 4 * n)
            base[texts] += np.frombuffer(body, "<f8", n, 8 * n)
            score[texts] += np.frombuffer(body, "<f8", n, 16 * n)
        top = table.filter(pa.array(table.column("step").to_numpy() == 1))
        return pa.table({"doc_id": pa.array(top.column("ids")[0].as_py(), kind), "n_tokens": pa.array(np.frombuffer(top.column("body")[0].as_py(), "<i8")), "n_known": pa.array(known), "base_score": pa.array(base), "score": pa.array(score)})

    return run


def score(docs: DataFrame, model: bytes, shards: DataFrame) -> DataFrame:
    """For each row of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score. Null texts count as empty: the end alone.
    ``model``, ``shards``: from ``learn`` or ``train``; of a head only what all shards share is used."""
    head, src = Trie(model), with_text(docs)
    raw = _common(head.total, head.distinct, head.training_docs, head.spread, head.shards)
    shared, kind = Trie(raw), to_arrow_type(src.schema["doc_id"].dataType)
    ids = f"array<{src.schema['doc_id'].dataType.simpleString()}>"
    tries = shards.select("shard", F.lit(0).alias("step"), F.lit(None).cast("long").alias("slice"), F.lit(None).cast("long").alias("docs"), F.lit(None).cast(ids).alias("ids"), F.col("trie").alias("body"))
    answers = []
    for turn in range(ROUNDS):  # so that disk holds the asks of a part of the shards at once
        asks = src.mapInArrow(_asked(shared, kind, turn, ROUNDS), f"shard int, step int, slice long, docs long, ids {ids}, body binary")
        met = tries.where(F.col("shard") % ROUNDS == turn).union(asks).repartition(4 * head.shards, "shard").sortWithinPartitions("shard", "step")
        answers.append(written(met.mapInArrow(_answered(raw), f"step int, slice long, docs long, ids {ids}, body binary"), "answers"))
        sweep(docs.sparkSession)
    answers = reduce(DataFrame.union, answers)
    out = answers.groupBy("slice").applyInArrow(_summed(shared, kind), f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "n_tokens", "n_known", F.lit(int(head.total)).cast("long").alias("train_tokens"), "base_score", "score")
