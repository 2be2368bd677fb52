"""Repetition coverage: how much of a text lies inside repeats of its own n-word windows and lines.

Per batch everything is arrays: word hashes from one pass over the bytes, window hashes of length n rolled on from those
of length n - 1, repeats by sorting (document, hash) keys. A repeated window of n words starts with a repeated window of
n - 1, so only the starts that repeated at one length are looked at in the next: clean text costs one sort.
Words are case-sensitive. Windows and lines count as equal by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockwright.llm.arrays import SPACE, mix, powers, slices, text_bytes
from blockwright.llm.shared import with_text

#: Window lengths and the highest share (percent) of word characters that may lie in second and later copies of a window.
LIMITS = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
#: The same for characters of lines that repeat an earlier line.
LINE_LIMIT = 20
MIN_WORDS, REPEAT_LIMIT = 10, 20

_ROLL = np.uint64(0xD1342543DE82EF95)
_BYTES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", "dup_line_chars", *(f"dup{n}_chars" for n in LIMITS)]


def _run_hashes(data: np.ndarray, begins: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each run; run k goes from ``begins[k]`` to the next begin, bytes outside ``inside`` don't count."""
    where = np.arange(len(data)) - np.repeat(begins, np.diff(np.append(begins, len(data))))
    values = np.where(inside, _BYTES[data], 0).astype(np.uint64)
    values *= powers(int(where.max()) + 1)[where]
    return mix(np.add.reduceat(values, begins))


def _repeats(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: it occurs twice or more; it occurred before."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    twice, later = np.empty(len(keys), bool), np.empty(len(keys), bool)
    twice[order], later[order] = same[1:] | same[:-1], same[:-1]
    return twice, later


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in one of the windows of n words."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + n, -1)
    return np.cumsum(change[:-1]) > 0


def measure(data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of COUNTS for documents whose bytes lie end to end, document k from ``at[k]`` to ``at[k + 1]``."""
    n_docs = len(at) - 1
    out = {c: np.zeros(n_docs, np.int64) for c in COUNTS}
    if not len(data):
        return out
    solid, lead = ~SPACE[data], (data & 0xC0) != 0x80

    def per_doc(doc: np.ndarray, amount: np.ndarray) -> np.ndarray:
        found = np.zeros(n_docs, np.int64)
        np.add.at(found, doc, amount)
        return found

    inner = at[:-1][at[:-1] < at[1:]]
    marks = np.flatnonzero(_SYMBOL[data])
    out["n_symbols"] = np.diff(np.searchsorted(marks, at))

    # lines: from a document's start or after a newline, without the newline itself
    newline = data == 10
    begin = np.zeros(len(data), bool)
    begin[1:] = newline[:-1]
    begin[inner] = True
    begins = np.flatnonzero(begin)
    worded = np.maximum.reduceat(solid, begins)
    doc = np.searchsorted(at, begins, "right") - 1
    chars = np.add.reduceat((lead & ~newline).astype(np.int64), begins)[worded]
    hashes, doc = _run_hashes(data, begins, ~newline)[worded], doc[worded]
    later = _repeats(mix(hashes ^ mix(doc.astype(np.uint64))))[1]
    out["n_dup_lines"], out["line_chars"], out["dup_line_chars"] = per_doc(doc, later.astype(np.int64)), per_doc(doc, chars), per_doc(doc, np.where(later, chars, 0))

    # words
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    begin[inner] = solid[inner]
    begins = np.flatnonzero(begin)
    if not len(begins):
        return out
    doc = np.searchsorted(at, begins, "right") - 1
    chars = np.add.reduceat((lead & solid).astype(np.int64), begins)
    hashes = _run_hashes(data[begins[0] :], begins - begins[0], solid[begins[0] :])
    out["n_words"], out["word_chars"] = np.diff(np.searchsorted(begins, at)), per_doc(doc, chars)
    salt, size = mix(doc.astype(np.uint64) + np.uint64(1)), len(begins)
    rolled, starts = hashes.copy(), np.arange(size)
    for n in range(2, max(LIMITS) + 1):
        starts = starts[starts + n <= size]
        starts = starts[doc[starts] == doc[starts + n - 1]]
        rolled = rolled[: size - n + 1] * _ROLL + hashes[n - 1 :]
        if n not in LIMITS:
            continue
        twice, later = _repeats(mix(rolled[starts] ^ salt[starts]))
        inside = _covered(starts[later], n, size)
        out[f"dup{n}_chars"] = per_doc(doc[inside], chars[inside])
        starts = starts[twice]
        if n == 5:
            out["n_repeat_words"] = per_doc(doc, _covered(starts, n, size).astype(np.int64))
    return out


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = text_bytes(batch.column("text"))
        for i, j in slices(at):
            found = measure(data[at[i] : at[j]], at[i : j + 1] - at[i])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(i, j - i), **{c: pa.array(found[c]) for c in COUNTS}})


def repetition(docs: DataFrame) -> DataFrame:
    """One row a document (doc_id, text): the counts of COUNTS, base_failed and kept; no shuffle.

    n_dup_lines and dup_line_chars count lines with a word that equal an earlier line of the text; n_repeat_words counts the
    words in 5-word windows found twice or more, first copies included; dupN_chars counts the characters of words in second
    and later copies of N-word windows. base_failed: under MIN_WORDS words, or over REPEAT_LIMIT percent repeated words.
    kept: not base_failed, and no share over its limit (LIMITS of word_chars, LINE_LIMIT of line_chars).

    A null or empty text, or one of white space alone, has no word: all zeros and base_failed. Rows are judged one by
    one, so repeated rows, a null doc_id or one doc_id with several texts give a row each; other columns are ignored; an
    empty table gives no rows. Texts of any length are measured whole.
    """
    found = with_text(docs).mapInArrow(_measured, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_LIMIT)
    repeats = F.col("dup_line_chars") * 100 > F.col("line_chars") * LINE_LIMIT
    for n, limit in LIMITS.items():
        repeats = repeats | (F.col(f"dup{n}_chars") * 100 > F.col("word_chars") * limit)
    return found.withColumns({"base_failed": failed, "kept": ~failed & ~repeats})
