"""The toxicity model learns from every label of the training folds."""

import zlib

import numpy as np
import pyarrow as pa

from blockwright.llm import toxicity


def test_every_label_is_learnt_from(spark, monkeypatch):
    r = np.random.default_rng(9)
    texts = [" ".join([*(f"w{i}" for i in r.integers(0, 60, 12)), *(["vile", "scum"] if k % 4 == 0 else [])]) for k in range(900)]
    docs, labels = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts)], "doc_id long, text string, lang string"), spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(900)], "doc_id long, toxic int")
    seen, learnt, shifts = [], toxicity._learnt, toxicity._shifts
    monkeypatch.setattr(toxicity, "SHARD_TEXTS", 100)
    monkeypatch.setattr(toxicity, "_learnt", lambda shards, *more: seen.append([toxicity._read_shard(x["body"])[1] for x in shards.collect()]) or learnt(shards, *more))
    monkeypatch.setattr(toxicity, "_shifts", lambda model, kept: seen.append(kept.count()) or shifts(model, kept))
    model = toxicity.fit(docs, labels)
    held = [zlib.crc32(str(k).encode()) % 3 == 1 for k in range(900)]
    shards, kept = seen
    assert len(shards) > 3 and sum(map(len, shards)) + kept == 900 - sum(held) and sum(x.sum() for x in shards) > 50
    got = {x["doc_id"]: x["predicted"] for x in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([got[k] == (k % 4 == 0) for k in range(900) if held[k]]) > 0.97


def test_an_epoch_moves_the_model_by_every_text():
    params = toxicity._start(np.zeros((2, 32)), 4, 2, 4)
    params[0][:, 0] = 2  # so that filters respond
    squares, start = [np.full_like(a, 0.1) for a in params], params[0].copy()
    texts = [(np.array([k, k + 4], np.int32), np.array([16 + k, 20 + k], np.int32)) for k in range(4)]
    moved = toxicity.train(params, squares, texts, np.array([0, 1, 0, 1]), 1.0, [1])
    assert moved.sum() and (params[0][moved] != start[moved]).any(1).all() and (params[0][~moved] == start[~moved]).all()
    assert all(moved[np.concatenate(t)].any() for t in texts)


def test_means_are_over_the_shards_that_moved_a_bucket():
    rows = [(0, [1, 3], 2.0), (0, [3, 9], 4.0)]
    table = pa.table({"chunk": [c for c, *_ in rows], "at": [np.array(a, "<i4").tobytes() for _, a, _ in rows], **{n: [np.full((len(a), toxicity.DIM), x, "<f4").tobytes() for _, a, x in rows] for n in ("value", "square")}})
    out = toxicity._mixed((pa.scalar(0),), table).to_pylist()[0]
    assert np.frombuffer(out["at"], "<i4").tolist() == [1, 3, 9]
    assert np.frombuffer(out["value"], "<f4").reshape(-1, toxicity.DIM)[:, 0].tolist() == [2.0, 3.0, 4.0]
