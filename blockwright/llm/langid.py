"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all training texts, added up on the executors. The classifier is fitted on a bounded sample (by
hash, a fixed number a language) with follow-the-regularised-leader and elastic-net penalties (FTRL-proximal, McMahan et
al., 2013); a temperature fitted on texts kept out of that sample calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockwright.llm.shared import with_text

BITS = 13
ORDERS = 3
PER_CLASS = 600
OPEN_QUANTILE, OPEN_MARGIN = 0.01, 1.0  # the open-set floor lies this many nats a gram below that quantile of training texts
_LETTER = regex.compile(r"\p{L}")
_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


def gram_counts(text: str, bits: int = BITS) -> np.ndarray:
    """Counts of the hashed character 1- to 3-grams of the whole text, lower case."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    total = np.zeros(1 << bits, np.float32)
    rolled = np.zeros(len(c), np.uint32)
    for n in range(ORDERS):
        if len(c) <= n:
            break
        rolled = rolled[: len(c) - n] + (c[n:] + np.uint32(n)) * _MULTIPLY[n]
        total += np.bincount(((rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits), minlength=1 << bits)
    return total


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # language x (bucket + bias)
    temperature: float = 1.0
    likely: np.ndarray | None = None  # language x bucket, log of the share of grams
    floor: float = -np.inf

    def likelihood(self, counts: np.ndarray) -> np.ndarray:
        """Mean log-likelihood of each text's grams under the language that explains them best."""
        return (counts @ self.likely.T).max(1) / np.maximum(counts.sum(1), 1)

    def logits(self, counts: np.ndarray) -> np.ndarray:
        """counts: texts x buckets."""
        x = np.log1p(counts) * self.idf
        x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-12)
        return x @ self.weights[:, :-1].T + self.weights[:, -1]

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        z = self.logits(counts) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def fit_ftrl(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, classes: int, size: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-3, epochs: int = 3) -> np.ndarray:
    """FTRL-proximal, one example at a time; x: (buckets, values) of each example. Returns classes x (size + 1), the last being the bias."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(at):
        zz, nn = z[at], n[at]
        return np.where(np.abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(nn)) / alpha + l2))

    order = np.random.default_rng(5)
    for _ in range(epochs):
        for k in order.permutation(len(x)):
            at, v = x[k]
            at, v = np.append(at, size), np.append(v, 1.0)
            w = weights(at)
            p = v @ w
            p = np.exp(p - p.max())
            p /= p.sum()
            p[y[k]] -= 1
            g = v[:, None] * p[None, :]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(size + 1)).T


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least cross-entropy against targets of (n + 1) / (n + 2), so that texts told apart without an error don't give certainty."""
    n, classes = logits.shape
    spread = 1 / (n + 2) / max(1, classes - 1)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        z = z - np.log(np.exp(z).sum(1, keepdims=True))
        return -float((z[np.arange(n), y] * (1 - 1 / (n + 2) - spread) + z.sum(1) * spread).mean())

    return float(min(np.exp(np.linspace(np.log(0.02), np.log(5), 60)), key=loss)) if n else 1.0


def is_training(doc_id: Column, folds: int = 5) -> Column:
    return F.crc32(doc_id.cast("string")) % folds != 0


def _frequencies(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << bits, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                df += gram_counts(text.as_py() or "", bits) > 0
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.append(at, -1), pa.int64()), "df": pa.array(np.append(df[at], n), pa.int64())})

    return run


def _featurised(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, counts = [], []
            for text in batch.column("text"):
                c = gram_counts(text.as_py() or "", bits)
                k = np.flatnonzero(c)
                at.append(k.astype("<u2").tobytes())
                counts.append(c[k].astype("<f4").tobytes())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "lang": batch.column("lang"), "at": pa.array(at, pa.binary()), "counts": pa.array(counts, pa.binary())})

    return run


def fit(docs: DataFrame, per_class: int = PER_CLASS, bits: int = BITS, folds: int = 5) -> Model | None:
    """A model learnt from the rows of ``docs`` (doc_id, text, lang) of the training folds that have a text and a lang.

    At most ``per_class`` texts a language reach the classifier, the smallest by a hash of doc_id; a quarter of them set the
    temperature. None if there are no such rows.
    """
    train = with_text(docs, "lang").where(is_training(F.col("doc_id"), folds) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = train.mapInArrow(_frequencies(bits), "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()  # at most 2^bits + 1 rows
    df, n = np.zeros(1 << bits), 0
    for bucket, count in rows:
        if bucket < 0:
            n = count
        else:
            df[bucket] = count
    if not n:
        return None
    key = F.xxhash64("doc_id", F.lit(3))
    ids = train.select("doc_id", "lang", key.alias("h")).groupBy("lang").agg(F.count("*").alias("n")).collect()
    total = {r["lang"]: r["n"] for r in ids}
    cut = F.lit(False)
    for lang, count in sorted(total.items()):  # a share of hashes that gives about per_class rows of each language
        share = min(1.0, per_class / count)
        cut = cut | ((F.col("lang") == lang) & (F.pmod(key, F.lit(1 << 20)) < int(share * (1 << 20)) + (share == 1.0)))
    sample = train.where(cut).mapInArrow(_featurised(bits), "doc_id long, lang string, at binary, counts binary").toPandas().sort_values(["doc_id", "at"])
    languages = sorted(sample["lang"].unique())
    y = np.array([languages.index(x) for x in sample["lang"]])
    idf = np.log((1 + n) / (1 + df)) + 1
    x = []
    for at, counts in zip(sample["at"], sample["counts"], strict=True):
        k = np.frombuffer(at, "<u2").astype(np.int64)
        v = np.log1p(np.frombuffer(counts, "<f4")) * idf[k]
        x.append((k, v / max(np.sqrt((v * v).sum()), 1e-12)))
    kept = np.arange(len(x)) % 4 == 3 if len(x) >= 8 * len(languages) else np.zeros(len(x), bool)
    used = np.flatnonzero(~kept)
    model = Model(languages, idf.astype(np.float32), fit_ftrl([x[k] for k in used], y[used], len(languages), 1 << bits).astype(np.float32))
    if kept.any():
        w = model.weights
        logits = np.array([w[:, x[k][0]] @ x[k][1] + w[:, -1] for k in np.flatnonzero(kept)])
        model.temperature = temperature(logits, y[kept])
    grams = np.full((len(languages), 1 << bits), 0.1)
    raw = [(k, np.frombuffer(counts, "<f4")) for (k, _), counts in zip(x, sample["counts"], strict=True)]
    for k in used:
        grams[y[k], raw[k][0]] += raw[k][1]
    model.likely = np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32)
    known = [float((model.likely[:, at] @ n).max() / n.sum()) for at, n in (raw[k] for k in (np.flatnonzero(kept) if kept.any() else used)) if len(n)]
    if known:
        model.floor = float(np.quantile(known, OPEN_QUANTILE)) - OPEN_MARGIN
    return model


def _predicted(model: Model | None, open_set: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = int(np.log2(len(model.idf))) if model else BITS
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                texts = [t.as_py() for t in part.column("text")]
                lettered = [t is not None and _LETTER.search(t) is not None for t in texts]
                lang, score = ["und"] * len(texts), [0.0] * len(texts)
                live = [k for k, x in enumerate(lettered) if x]
                if live and model:
                    counts = np.array([gram_counts(texts[k], bits) for k in live])
                    inside = model.likelihood(counts) >= model.floor if open_set else np.ones(len(live), bool)
                    for k, row, ok in zip(live, model.probabilities(counts), inside, strict=True):
                        if not ok:
                            continue
                        best = int(row.argmax())
                        lang[k], score[k] = model.languages[best], float(row[best])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*part.schema.names, "lang_pred", "score"])

    return run


def predict_languages(docs: DataFrame, model: Model | None, keep: tuple[str, ...] | list[str] = ("doc_id", "text"), open_set: bool = False) -> DataFrame:
    """The columns ``keep`` (text among them), lang_pred and score for each row of ``docs``, in place. A null text or one without a letter is ``und`` with score 0;
    so is every text if there was nothing to learn from, and with ``open_set`` one whose grams no learnt language explains (mean log-likelihood below the model's floor)."""
    rows = docs.select(*keep)
    return rows.mapInArrow(_predicted(model, open_set), T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
