"""Repetition coverage against a brute-force version, and on awkward rows."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from blockwright.llm import arrays, quality

ROWS = [(0, None), (1, ""), (2, "  \n\t "), (3, "one"), (4, "a b c d e f g h i j"), (5, "word " * 5000 + "x" * 20_000), (6, "same line here\n" * 9), (6, "same line here\n" * 9),
        (6, "another text of the same id that has enough words to stay"), (None, "a row without any id that has enough words to stay"), (7, "é日本 # \x00 ü\né日本 # \x00 ü\r\né日本 # \x00 ü")]


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    out = {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "line_chars": sum(map(len, lines))}
    again = [x for k, x in enumerate(lines) if x in lines[:k]]
    out |= {"n_dup_lines": len(again), "dup_line_chars": sum(map(len, again)), "n_repeat_words": 0}
    for n in quality.LIMITS:
        seen, twice, later = {}, set(), set()
        for k in range(len(w) - n + 1):
            first = seen.setdefault(tuple(w[k : k + n]), k)
            if first < k:
                twice |= {*range(first, first + n), *range(k, k + n)}
                later |= {*range(k, k + n)}
        out[f"dup{n}_chars"] = sum(len(w[k]) for k in later)
        if n == 5:
            out["n_repeat_words"] = len(twice)
    return out


def verdict(m):
    failed = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
    return failed, not failed and 100 * m["dup_line_chars"] <= 20 * m["line_chars"] and all(100 * m[f"dup{n}_chars"] <= x * m["word_chars"] for n, x in quality.LIMITS.items())


def texts(seed):
    r = random.Random(seed)
    out = []
    for _ in range(150):
        pool = [r.choice(["ab", "é", "Ab", "日本語", "x#", "…"]) + str(r.randrange(r.choice([2, 5, 300]))) for _ in range(300)]
        lines = [" ".join(r.choice(pool) for _ in range(r.randrange(0, 12))) for _ in range(r.randrange(0, 8))]
        lines += [r.choice(lines) for _ in range(r.randrange(0, 4))] if lines else []
        out.append(r.choice(["\n", " \n", "\n\n", " "]).join(lines))
    return [*out, None, "", "\n", " ", "a", *out[:3]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_measures_equal_brute_force(seed):
    t = texts(seed)
    data, at = arrays.text_bytes(pa.array(t))
    got = quality.measure(data, at)
    for k, x in enumerate(t):
        want = brute(x)
        assert {c: int(got[c][k]) for c in quality.COUNTS} == want, x


def test_rows(spark):
    df = spark.createDataFrame([(i, t, 1, True, "x") for i, t in ROWS], "doc_id long, text string, n_words long, kept boolean, batch string")
    got = sorted(map(str, ([r["doc_id"], {c: r[c] for c in sorted(quality.COUNTS)}, r["base_failed"], r["kept"]] for r in quality.repetition(df).collect())))
    want = []
    for i, t in ROWS:
        m = brute(t)
        want.append(str([i, dict(sorted(m.items())), *verdict(m)]))
    assert got == sorted(want)
    assert quality.repetition(df.limit(0)).count() == 0


def test_the_method_fails_texts_that_the_base_keeps():
    """Long lines repeated inside a text whose five-word windows differ: single long words aren't in any window twice."""
    lines = [f"{'x' * 200}{k}" for k in range(6)]
    m = brute("\n".join([*lines, *lines[:3], *(f"other{k} words{k} to{k} fill{k} the{k} page{k}" for k in range(3))]))
    assert verdict(m) == (False, False)


def test_one_batch_equals_single_documents():
    t = texts(9)
    data, at = arrays.text_bytes(pa.array(t))
    whole = quality.measure(data, at)
    for k in range(len(t)):
        alone = quality.measure(data[at[k] : at[k + 1]], np.array([0, at[k + 1] - at[k]]))
        assert all(alone[c][0] == whole[c][k] for c in quality.COUNTS)
