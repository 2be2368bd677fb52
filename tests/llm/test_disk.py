"""What the operators hold on disk at once."""

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from blockwright.llm import jaccard
from blockwright.llm.arrays import text_bytes
from blockwright.llm.shared import written


def test_written_leaves_no_shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = manager.getAllBlocks()
        return {name for name in (blocks.apply(i).name() for i in range(blocks.size())) if name.startswith("shuffle_")}

    before, grouped = shuffles(), spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).agg(F.count("*").alias("c"))
    kept = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    table = written(grouped, "grouped")  # ``grouped`` is still held here, so no collection of the JVM can have taken its files
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert table.count() == 1000 and grouped.count() == 1000 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept


def test_parts_meet_slice_by_slice():
    texts = [" ".join(f"w{i * k % 997}" for i in range(n)) for k, n in ((3, 40), (5, 400), (7, 2000), (3, 40))] + ["one two", ""]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(6), pa.int64()), "place": pa.array(range(6), pa.int64()), "text": texts})
    rows = [r for out in jaccard._profile(5, 80, 100)(iter([batch])) for r in out.to_pylist()]
    where = {}
    for row, s in zip(rows, jaccard.shingle_sets(*text_bytes(batch.column("text")), 5), strict=True):
        parts, asks = jaccard.signed_parts(s, 80, 100)
        got = [(p, a) for k in range(jaccard.SLICES) for p, a in zip(row[f"parts_{k}"], row[f"asks_{k}"], strict=True)]
        assert sorted(got) == sorted(zip(parts.view(np.int64).tolist(), asks.tolist(), strict=True))
        for k in range(jaccard.SLICES):
            for p in row[f"parts_{k}"]:
                assert where.setdefault(p, k) == k
    shares = [len(rows[2][f"parts_{k}"]) / sum(len(rows[2][f"parts_{j}"]) for j in range(jaccard.SLICES)) for k in range(jaccard.SLICES)]
    assert max(shares) < 0.4


def _chained(r, n):
    """Sets of 100 n-grams, of which 45 are of passages that many sets have; every tenth one has a partner. No two others are linked."""
    passages, sets = [r.integers(0, 1 << 40, 15) for _ in range(6)], {}
    for k in range(n):
        own = np.concatenate([r.integers(0, 1 << 40, 55), *[passages[i] for i in r.permutation(6)[:3]]])
        sets[10 * k] = np.unique(own)
        if k % 10 == 0:
            sets[10 * k + 1] = np.unique(np.append(own[4:], r.integers(0, 1 << 40, 3)))
    return sets


def _tables(sets, blocks):
    spark = blocks.sparkSession
    return jaccard.written(blocks, "test-blocks"), jaccard.written(spark.createDataFrame([(k, s.tolist()) for k, s in sets.items()], "key long, s array<long>"), "test-sets")


def test_chains_of_passages_are_no_large_block(spark):
    sets = _chained(np.random.default_rng(4), 200)
    blocks, rows = _tables(sets, spark.createDataFrame([(k, 0) for k in sets], "node long, component long"))
    pairs = jaccard.written(spark.createDataFrame([], "u long, v long"), "test-pairs")
    pairs, blocks = jaccard._thinned(pairs, blocks, rows, 80, 100, 16)
    assert {tuple(x) for x in pairs.collect()} >= {(10 * k, 10 * k + 1) for k in range(0, 200, 10)}
    assert pairs.count() < 40 and blocks.groupBy("component").count().where("count > 16").isEmpty()


def test_rarest_ngrams_lose_no_link(spark):
    r = np.random.default_rng(6)
    pool = [np.unique(r.integers(0, 1 << 40, 50)) for _ in range(4)]
    sets = {k: np.unique(np.concatenate([r.permutation(pool[k % 4])[: r.integers(36, 51)], r.integers(0, 40, r.integers(0, 9))])) for k in range(160)}
    blocks, rows = _tables(sets, spark.createDataFrame([(k, 0) for k in sets], "node long, component long"))
    pairs, blocks = jaccard._thinned(jaccard.written(spark.createDataFrame([], "u long, v long"), "test-pairs"), blocks, rows, 80, 100, 16)
    near, block = {tuple(x) for x in pairs.collect()}, {x["node"]: x["component"] for x in blocks.collect()}
    linked = [(a, b) for a in sets for b in sets if a < b and 100 * (o := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - o)]
    assert len(linked) > 100
    assert all((a, b) in near or block.get(a, a) == block.get(b, -b - 1) for a, b in linked)


def test_rounds_send_no_more_sets_than_allowed(spark, monkeypatch):
    sets = _chained(np.random.default_rng(4), 60)
    blocks, rows = _tables(sets, spark.createDataFrame([(k, 0) for k in sets], "node long, component long"))
    sent, plain = [], jaccard._products
    monkeypatch.setattr(jaccard, "_products", lambda tiles, *more: sent.append(tiles.count()) or plain(tiles, *more))
    links = {(x["u"], x["v"]) for x in jaccard.block_links(blocks, rows, 80, 100, 4, most=400).collect()}
    assert {(10 * k + 1, 10 * k) for k in range(0, 60, 10)} <= links
    assert len(sent) > 4 and max(sent) <= 600 and sum(sent) > 2000
