"""The language model holds every pair, also one seen once."""

import numpy as np
import pytest

from blockwright.llm import lm


def test_language_model_counts_pairs_seen_once(spark):
    """A pair of one training text lifts the score of its words in that order over their other order."""
    train = spark.createDataFrame([(k, t) for k, t in enumerate(["p q", "q r", "r p", "x y", "y x"])], "doc_id long, text string")
    asked = spark.createDataFrame([(0, "p q r"), (1, "r q p")], "doc_id long, text string")
    for shards in (1, 5):
        got = {r["doc_id"]: r for r in lm.score(asked, *lm.learn(train, shards=shards)).collect()}
        assert got[0]["base_score"] == pytest.approx(got[1]["base_score"]) and got[0]["score"] > got[1]["score"] + 0.1
        # the tokens: p, q, r, x, y twice each and five ends; all pairs were seen once
        base, share, left = lambda n: (n + 0.1) / (15 + 0.1 * 7), lambda n: 0.25 / n, lambda n, pairs: 1 - pairs * 0.25 / n
        want = sum(np.log10(share(n) + left(n, pairs) * base(c)) for n, pairs, c in ((5, 5, 2), (2, 2, 2), (2, 2, 2), (2, 2, 5)))
        assert got[0]["score"] == pytest.approx(want, abs=0.05)  # shares are rounded down to 256 levels of nine decades


def test_bundles_of_pairs():
    r = np.random.default_rng(2)
    for n, most in ((0, 9), (1, 9), (1000, 9), (1000, 5000)):
        v, w, c = np.sort(r.integers(0, 50, n).astype(np.uint64)), r.integers(0, 1 << 60, n).astype(np.uint64), r.integers(1, most, n)
        raw = lm._bundle(v, w, c)
        assert all((a == b).all() for a, b in zip(lm._unbundle(raw), (v, w, c), strict=True))
        assert len(raw) <= 16 + 8 * len(np.unique(v)) + (9 if most < 256 else 16) * n + n // 8 + 1
