"""Toxicity: a convolutional text classifier in numpy over hashed word embeddings.

A word's vector is the sum of the embeddings of its hash and of the hash of its first bytes. Filters one to three words wide
slide over the whole text, each keeps its largest response, a logistic unit weighs them. Because filters are linear, their
response tables by bucket are made once and a text is scored by gathers, sums and one maximum a filter.

Every labelled text of the training folds takes part. They are dealt to shards; in each epoch each shard goes on from the common parameters over its own texts, and what the shards found is averaged, an
embedding over the shards that moved it (iterative parameter mixing). Few texts are one shard. The threshold
of each language, found on labelled rows kept out of training, is moved to one common score; a text's language is
guessed from its own words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockwright.llm.arrays import slices, text_bytes, word_hashes
from blockwright.llm.shared import forget, with_text, written

BITS = 17
DIM = 8
FILTERS = 8
WIDTHS = (1, 2, 3)
PREFIX = 4
SHARD_TEXTS = 5000
SHARD_BYTES = 64 << 20
CHUNK = 1 << 12
BROADCAST = 1 << 20  # labels that may be sent to every executor
EPOCHS = 6
RATE = 0.05
STEPS = 1000  # a unit of the logit, in which thresholds are found
PRIOR = 8.0
THRESHOLD = 0.7


def buckets(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of each word, of each word's first bytes (after those of the words), and words a text."""
    words, counts, heads = word_hashes(data, offsets, PREFIX)
    low = np.uint64(64 - bits)
    return (words >> low).astype(np.int32), (heads >> low).astype(np.int32) + (1 << bits), counts


@dataclass
class Model:
    embedding: np.ndarray  # 2 * buckets x DIM
    filters: list[np.ndarray]  # for each width: width x DIM x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    languages: list[str]
    language_table: np.ndarray  # buckets x languages, log-likelihoods of words
    shift: np.ndarray  # of the logit, by language

    def tables(self) -> list[list[np.ndarray]]:
        return [[(self.embedding @ f[k]).astype(np.float32) for k in range(len(f))] for f in self.filters]

    def pooled(self, word: np.ndarray, head: np.ndarray, at: np.ndarray, tables) -> np.ndarray:
        """texts x filters: the largest response of each; 0 where a text has too few words for the filter."""
        out = np.zeros((len(at) - 1, len(WIDTHS) * FILTERS), np.float32)
        sizes = np.diff(at)
        for w, (width, table) in enumerate(zip(WIDTHS, tables, strict=True)):
            n = len(word) - width + 1
            has = np.flatnonzero(sizes >= width)
            if n <= 0 or not len(has):
                continue
            y = table[0][word[:n]] + table[0][head[:n]]
            for k in range(1, width):
                y += table[k][word[k : k + n]]
                y += table[k][head[k : k + n]]
            crossing = (at[1:-1][:, None] - np.arange(1, width)[None, :]).ravel()
            if width > 1:
                y[crossing[(crossing >= 0) & (crossing < n)]] = -1e30
            # between the starts of texts that have a window there are only texts without one, all of them masked
            out[has, w * FILTERS : (w + 1) * FILTERS] = np.maximum.reduceat(y, np.minimum(at[has], n - 1), axis=0)
        return out

    def logits(self, word: np.ndarray, head: np.ndarray, at: np.ndarray, tables) -> np.ndarray:
        z = np.maximum(self.pooled(word, head, at, tables) + self.bias, 0) @ self.out + self.out_bias
        full = np.flatnonzero(np.diff(at))
        if len(full) and len(self.languages):
            guess = np.add.reduceat(self.language_table[word], at[full], axis=0).argmax(1)
            z[full] += self.shift[guess]
        return z


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _start(seen: np.ndarray, texts: int, toxic: int, bits: int) -> list[np.ndarray]:
    """Embedding, filters, bias, weights of the filters and their bias. ``seen``: of each bucket (clean, toxic) texts that have it."""
    rng, size = np.random.default_rng(17), 1 << bits
    emb = rng.normal(0, 0.02, (2 * size, DIM))
    share = min(max(toxic / texts if texts else 0.5, 0.01), 0.99)
    # a warm start: how toxic the bucket's texts are, drawn to the average where they are few
    emb[:, 0] = np.clip(np.log((seen[1] + PRIOR * share) / (seen[0] + PRIOR * (1 - share))) - np.log(share / (1 - share)), -1, 4) / 2
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] = np.abs(f[:, 0, :])
    return [emb, *filters, np.full(len(WIDTHS) * FILTERS, -0.5), np.full(len(WIDTHS) * FILTERS, 0.1), np.array([-1.0])]


def train(params: list[np.ndarray], squares: list[np.ndarray], texts: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, toxic_weight: float, seed: list[int]) -> np.ndarray:
    """One epoch of Adagrad over single texts, all of them, in place; which buckets it moved."""
    emb, filters, (bias, out, out_bias) = params[0], params[1 : 1 + len(WIDTHS)], params[1 + len(WIDTHS) :]
    moved = np.zeros(len(emb), bool)

    def step(i: int, g: np.ndarray, at=slice(None)) -> None:
        if isinstance(at, np.ndarray):
            moved[at[g.any(1)]] = True
            np.add.at(squares[i], at, g * g)
            np.add.at(params[i], at, -RATE * g / np.sqrt(squares[i][at]))
        else:
            squares[i] += g * g
            params[i] -= RATE * g / np.sqrt(squares[i])

    for k in np.random.default_rng(seed).permutation(len(texts)):
        word, head = texts[k]
        x = emb[word] + emb[head]
        best, pool = [], np.zeros(len(WIDTHS) * FILTERS)
        for w, width in enumerate(WIDTHS):
            n = len(x) - width + 1
            if n <= 0:
                best.append(None)
                continue
            y = sum(x[j : j + n] @ filters[w][j] for j in range(width))
            best.append(y.argmax(0))
            pool[w * FILTERS : (w + 1) * FILTERS] = y[best[-1], np.arange(FILTERS)]
        h = np.maximum(pool + bias, 0)
        err = (_sigmoid(h @ out + out_bias[0]) - toxic[k]) * (toxic_weight if toxic[k] else 1.0)
        dh = err * out * (h > 0)
        step(5, err * h)
        step(6, np.array([err]))
        step(4, dh)
        for w, width in enumerate(WIDTHS):
            if best[w] is None:
                continue
            d = dh[w * FILTERS : (w + 1) * FILTERS]
            grads, at, moves = np.zeros_like(filters[w]), [], []
            for j in range(width):
                grads[j] = x[best[w] + j].T * d
                at += [word[best[w] + j], head[best[w] + j]]
                moves += [(filters[w][j] * d).T] * 2
            step(0, np.concatenate(moves), np.concatenate(at))
            step(1 + w, grads)
    return moved


def _read_shard(raw: bytes) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """The texts' buckets (words, heads) and labels."""
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes, toxic = np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, "<i8", n, 8 + 8 * n)
    flat, at = np.frombuffer(raw, "<i4", -1, 8 + 16 * n), np.concatenate([[0], np.cumsum(2 * sizes)])
    return [(flat[i : i + m], flat[i + m : i + 2 * m]) for i, m in zip(at[:-1], sizes, strict=True)], toxic


def _packed(key: tuple, table: pa.Table) -> pa.Table:
    """A shard's texts as one row."""
    table = table.sort_by([("doc_id", "ascending"), ("word", "ascending")])
    word, head = table.column("word").to_pylist(), table.column("head").to_pylist()
    parts = [np.array([len(word)], "<i8").tobytes(), np.array([len(w) // 4 for w in word], "<i8").tobytes(), table.column("toxic").to_numpy().astype("<i8").tobytes()]
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "body": pa.array([b"".join([*parts, *[x for pair in zip(word, head, strict=True) for x in pair]])], pa.binary())})


_FOUND = "chunk int, at binary, value binary, square binary"


def _flat(arrays: list[np.ndarray]) -> bytes:
    return np.concatenate([a.ravel() for a in arrays]).astype("<f8").tobytes()


def _epoch(common: Broadcast, weight: float, epoch: int):
    """Each shard's parameters after one more epoch: the buckets it moved by chunks, all others as chunk -1. ``common``: parameters and squares that all shards go on from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        params, squares = common.value
        for batch in batches:
            for shard, body in zip(batch.column("shard").to_pylist(), batch.column("body"), strict=True):
                own, second = [a.astype(np.float64) for a in params], [a.astype(np.float64) for a in squares]
                moved = np.flatnonzero(train(own, second, *_read_shard(body.as_py()), weight, [17, epoch, shard]))
                cuts = np.searchsorted(moved, np.arange(0, len(own[0]) + 1, CHUNK))
                rows = [(-1, b"", _flat(own[1:]), _flat(second[1:]))]
                for c, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    at = moved[i:j]
                    if len(at):
                        rows.append((c, at.astype("<i4").tobytes(), own[0][at].astype("<f4").tobytes(), second[0][at].astype("<f4").tobytes()))
                yield pa.RecordBatch.from_pydict({name: pa.array(x, kind) for name, x, kind in zip(("chunk", "at", "value", "square"), zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)})

    return run


def _mixed(key: tuple, table: pa.Table) -> pa.Table:
    """Means over the shards, of each bucket over those that moved it."""
    chunk = key[0].as_py()
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("at", "value", "square")), strict=True))  # one order of the sums
    if chunk < 0:
        means = [np.mean([np.frombuffer(r[k], "<f8") for r in rows], axis=0).tobytes() for k in (1, 2)]
        return pa.table({"chunk": pa.array([chunk], pa.int32()), "at": pa.array([b""]), "value": pa.array([means[0]]), "square": pa.array([means[1]])})
    hits, sums = np.zeros(CHUNK), np.zeros((2, CHUNK, DIM))
    for at, *both in rows:
        place = np.frombuffer(at, "<i4") - chunk * CHUNK
        hits[place] += 1
        for k, x in enumerate(both):
            sums[k, place] += np.frombuffer(x, "<f4").reshape(-1, DIM)
    at = np.flatnonzero(hits)
    value, square = ((x[at] / hits[at, None]).astype("<f4").tobytes() for x in sums)
    return pa.table({"chunk": pa.array([chunk], pa.int32()), "at": pa.array([(at + chunk * CHUNK).astype("<i4").tobytes()]), "value": pa.array([value]), "square": pa.array([square])})


def _learnt(shards: DataFrame, params: list[np.ndarray], weight: float) -> list[np.ndarray]:
    """The parameters after EPOCHS epochs over all shards; what comes to the driver is one model an epoch, whatever the texts."""
    squares = [np.full_like(a, 0.1) for a in params]
    for epoch in range(EPOCHS):
        common = shards.sparkSession.sparkContext.broadcast(tuple([a[0].astype(np.float32), *a[1:]] for a in (params, squares)))
        mixed = written(shards.mapInArrow(_epoch(common, weight, epoch), _FOUND).groupBy("chunk").applyInArrow(_mixed, _FOUND), "mixed")
        common.destroy()  # else the files of all epochs stay until the driver's JVM is collected
        for r in mixed.toLocalIterator():
            for a, raw in ((params, r["value"]), (squares, r["square"])):
                if r["chunk"] >= 0:
                    a[0][np.frombuffer(r["at"], "<i4")] = np.frombuffer(raw, "<f4").reshape(-1, DIM)
                else:
                    cuts = np.cumsum([x.size for x in a[1:]])[:-1]
                    a[1:] = [x.reshape(old.shape).copy() for x, old in zip(np.split(np.frombuffer(raw, "<f8"), cuts), a[1:], strict=True)]
        forget(mixed)
    return params


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many training texts of a label have each bucket (kind 0, 1), and how often each language's texts have each word (kind 2)."""
    for batch in batches:
        kinds, names, buckets_, counts = [], [], [], []
        word, head = ([np.frombuffer(x.as_py(), "<i4") for x in batch.column(c)] for c in ("word", "head"))
        toxic, kept, lang = batch.column("toxic").to_numpy(), batch.column("kept").to_numpy(zero_copy_only=False), np.array([x or "" for x in batch.column("lang").to_pylist()], object)
        groups = [(k, "", [np.unique(np.concatenate([word[i], head[i]])) for i in np.flatnonzero(~kept & (toxic == k))]) for k in (0, 1)]
        groups += [(2, name, [word[i] for i in np.flatnonzero(lang == name)]) for name in sorted(set(lang) - {""})]
        for kind, name, arrays in groups:
            at, n = np.unique(np.concatenate(arrays), return_counts=True) if arrays else (np.zeros(0, int), np.zeros(0, int))
            kinds.append(np.full(len(at), kind, np.int32))
            names += [name] * len(at)
            buckets_.append(at.astype(np.int32))
            counts.append(n.astype(np.int64))
        yield pa.RecordBatch.from_pydict({"kind": pa.array(np.concatenate(kinds)), "lang": pa.array(names, pa.string()), "bucket": pa.array(np.concatenate(buckets_)), "n": pa.array(np.concatenate(counts))})


def _levels(model: Model):
    """Of each text kept out the guessed language (-1: none) and the logit in STEPS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables()
        for batch in batches:
            word, head = ([np.frombuffer(x.as_py(), "<i4") for x in batch.column(c)] for c in ("word", "head"))
            guess, level = np.full(len(word), -1), np.zeros(len(word))
            for k, (w, h) in enumerate(zip(word, head, strict=True)):
                level[k] = model.logits(w, h, np.array([0, len(w)]), tables)[0]
                if len(w) and len(model.languages):
                    guess[k] = model.language_table[w].sum(0).argmax()
            yield pa.RecordBatch.from_pydict({"guess": pa.array(guess.astype(np.int32)), "level": pa.array(np.rint(level.clip(-1000, 1000) * STEPS).astype(np.int64)), "toxic": batch.column("toxic")})

    return run


def _shifts(model: Model, kept: DataFrame) -> np.ndarray:
    """For each language what moves its best threshold (by F1, the middle of the gap) to THRESHOLD; few labels lean on all languages together.
    Texts are counted by logit, so that the driver gets no row a text."""
    common = np.log(THRESHOLD / (1 - THRESHOLD))
    found = kept.select("word", "head", "toxic").mapInArrow(_levels(model), "guess int, level long, toxic int").groupBy("guess", "level").agg(F.count("*").alias("n"), F.sum("toxic").alias("y")).toArrow()
    guess, level, n, y = (found.column(c).to_numpy() for c in ("guess", "level", "n", "y"))

    def best(some: np.ndarray) -> float | None:
        at, place = np.unique(level[some], return_inverse=True)
        all_, toxic = (np.bincount(place, x[some], len(at))[::-1] for x in (n, y))
        if toxic.sum() < 3 or (all_ - toxic).sum() < 3:
            return None
        z, f1 = at[::-1] / STEPS, 2 * np.cumsum(toxic) / (np.cumsum(all_) + toxic.sum())
        k = int(f1.argmax())
        return float(z[k] + (z[k + 1] if k + 1 < len(z) else z[k] - 1)) / 2

    whole = best(np.ones(len(level), bool))
    own = [best(guess == i) for i in range(max(1, len(model.languages)))]
    own = [whole if x is None else x for x in own]
    return np.array([0.0 if x is None else common - x for x in own])


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 3 == 1


def _featurised(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            word, head, counts = buckets(data, offsets, bits)
            at = np.concatenate([[0], np.cumsum(counts)]).astype(int)
            pick = lambda a: pa.array([a[i:j].astype("<i4").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "toxic": batch.column("toxic"), "word": pick(word), "head": pick(head)})

    return run


def fit(docs: DataFrame, labels: DataFrame, bits: int = BITS) -> Model | None:
    """Learn from every labelled row of the training folds (whole texts); None if there are none. A fifth of them, by a hash of doc_id, is kept out for the thresholds.

    Rows with null doc_id, text or label are left out; of repeated labels of a document the largest counts.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).where(~is_held_out(F.col("doc_id")))
    n = known.count()
    if not n:
        return None
    rows = with_text(docs, "lang").where("text is not null").join(known.hint("broadcast" if n <= BROADCAST else "merge"), "doc_id").select("doc_id", "text", "lang", F.greatest(F.least("toxic", F.lit(1)), F.lit(0)).alias("toxic"))
    marked = rows.mapInArrow(_featurised(bits), "doc_id long, lang string, toxic int, word binary, head binary").withColumn("kept", F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(5)) == 4)
    features = written(marked, "features")
    own = features.where("not kept")
    texts, toxic, size = (x or 0 for x in own.agg(F.count("*"), F.sum("toxic"), F.sum(F.length("word"))).first())
    if features.isEmpty():
        forget(features)
        return None
    wide = 1 << bits
    counts = features.select("lang", "toxic", "word", "head", "kept").mapInArrow(_counted, "kind int, lang string, bucket int, n long").groupBy("kind", "lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    kind, name, bucket, seen_n = (counts.column(c).to_numpy() for c in ("kind", "lang", "bucket", "n"))
    seen = np.array([np.bincount(bucket[kind == k], seen_n[kind == k], 2 * wide) for k in (0, 1)])
    languages = sorted(set(name[kind == 2]))
    table = np.zeros((2 * wide, len(languages)), np.float32)
    for i, x in enumerate(languages):
        some = (kind == 2) & (name == x)
        count = np.bincount(bucket[some], seen_n[some], wide) + 0.5
        table[:wide, i] = np.log(count / count.sum())
    params = _start(seen, texts, toxic, bits)
    if texts:
        shards = max(-(-texts // SHARD_TEXTS), -(-2 * size // SHARD_BYTES))
        packed = written(own.select(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(shards)).cast("int").alias("shard"), "doc_id", "toxic", "word", "head").groupBy("shard").applyInArrow(_packed, "shard int, body binary"), "packed")
        params = _learnt(packed, params, max(1.0, (texts - toxic) / max(1, toxic)))
        forget(packed)
    emb, filters, (bias, out, out_bias) = params[0], params[1 : 1 + len(WIDTHS)], params[1 + len(WIDTHS) :]
    model = Model(emb.astype(np.float32), filters, bias, out, float(out_bias[0]), languages, table, np.zeros(max(1, len(languages))))
    model.shift = _shifts(model, features.where("kept"))
    forget(features)
    return model


def _scored(model: Model | None, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables() if model else None
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            score = np.full(batch.num_rows, 0.0)
            for i, j in slices(offsets, 1 << 20) if model else ():
                word, head, counts = buckets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)
                score[i:j] = _sigmoid(model.logits(word, head, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), tables))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": pa.array(score, pa.float64())})

    return run


def score_toxicity(docs: DataFrame, model: Model | None, bits: int = BITS) -> DataFrame:
    """doc_id, score, predicted (1 from 0.7 on) for each row of ``docs``, in place. A null or empty text has no words and gets the
    score of no response; without a model every score is 0."""
    out = with_text(docs).mapInArrow(_scored(model, bits), "doc_id long, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).cast("int"))
