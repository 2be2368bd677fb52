"""The prefix trie against a brute-force version: random tries cut anywhere, hot groups, long conversations, awkward rows."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from blockwright.llm import trie
from blockwright.llm.queries import QUERIES


def rebuilt(rows):
    """conv_id -> its turns after the heads are lent, from rows (conv_id, turn, role, text)."""
    talks = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        talks.setdefault(c, []).append((role or "", text or ""))
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = talks.get(c - c % 5, [])[:h] + own[h:]
    return out


def brute(talks):
    members, ends = {}, {}
    for c, turns in sorted(talks.items()):
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    kids = {p: 0 for p in members}
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(str((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest())) for p, m in members.items())


def found(df):
    return sorted(str(tuple(r)) for r in df.select(*trie._NODE).collect())


def whole(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"path": F.lit(1), "kind": F.lit("x"), "pos": F.lit(None)})
    conv = F.col("conv_id")
    return trie.prefix_trie(trie.sequences(trie.with_lent_heads(trie.numbered_turns(df), conv - conv % 5, F.crc32(conv.cast("string").cast("binary")) % 9)))


def tree(seed, n, fan, deep):
    r = random.Random(seed)
    return {c: [(r.choice("ab"), "é" * r.randrange(fan)) for _ in range(r.randrange(deep))] for c in r.sample(range(10 * n), n)}


def as_sequences(spark, talks):
    rows = [(c, k + 1, *t) for c, turns in talks.items() for k, t in enumerate(turns)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    none = spark.createDataFrame([(c,) for c, t in talks.items() if not t], "conv_id long")
    return trie.sequences(trie.numbered_turns(turns).drop("total").unionByName(none, allowMissingColumns=True))


@pytest.mark.parametrize(("seed", "n", "fan", "deep"), [(1, 300, 2, 6), (2, 300, 1, 9), (3, 40, 3, 60), (4, 3, 2, 3), (5, 1, 2, 4)])
@pytest.mark.parametrize("ranges", ["1", "8", "60"])
def test_any_cut_gives_the_same_trie(spark, seed, n, fan, deep, ranges):
    talks = tree(seed, n, fan, deep)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert found(trie.prefix_trie(as_sequences(spark, talks))) == brute(talks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_hot_groups_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(trie, "RANGE_TURNS", 4)
    long = [("a", str(k % 7)) for k in range(400)]
    talks = {c: [("a", "hot"), ("b", "same")] for c in range(200)} | {300 + c: long[: 390 + c] for c in range(10)} | {400 + c: [*long[:200], ("b", str(c))] for c in range(5)} | {500: [], 501: [], 502: [("a", "hot")]}
    assert found(trie.prefix_trie(as_sequences(spark, talks))) == brute(talks)


def test_odd_rows(spark):
    rows = [(0, None, None, None), (0, 0, "user", "x"), (0, 0, "user", "x"), (0, 0, None, "y"), (5, 1, "", ""), (None, 1, "user", "lost"), (7, 3, "user", "w" * 50_000), (7, 1, "a", "é日本"), (-3, 1, "u", "n"), (-3, 2, "u", "m"), (1, 1, "q", "r")]
    rows += [(c, k, "user", f"t{k}") for c in range(10, 40) for k in range(c % 12)] + [(3, k, "r", str(k)) for k in range(300)]
    want = {}
    for c, turns in rebuilt([r for r in rows if r[0] is None or r[0] >= 0]).items():
        want[c] = turns
    neg = rebuilt([(abs(r[0]), *r[1:]) for r in rows if r[0] is not None and r[0] < 0])  # the lender of -3 is 0, as remainders keep the sign
    h = zlib.crc32(b"-3") % 9
    lent = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == 0))
    want[-3] = [x[2:] for x in lent][:h] + neg[3][h:] if h > len(neg[3]) else [x[2:] for x in lent][:h] + [("u", "n"), ("u", "m")][h:]
    assert found(whole(spark, rows)) == brute(want)
    assert whole(spark, []).count() == 0


def test_query_on_the_small_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op13_prefix_trie"](spark, sf)) == brute(rebuilt(rows))
