"""Rules on small hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blockwright.functions import labels as L
from blockwright.functions import parse as P
from blockwright.functions import schema as S
from blockwright.operators import aggregates
from blockwright.operators import changelog as G
from blockwright.operators import flatten as FL
from blockwright.operators import forks, joins, layout, outcome, quality
from blockwright.plans import market as M
from blockwright.sources import tables as ST
from blockwright.streaming import ingest


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reorg_history(spark):
    steps = [(1, 100, "A", "NEW"), (2, 100, "A", "UNDO"), (3, 100, "B", "NEW"), (4, 101, "C", "NEW"), (5, 101, "C", "UNDO"), (6, 101, "C", "NEW"), (7, 102, "D", "NEW"), (8, 102, "D", "UNDO")]
    e = spark.createDataFrame(steps, "stream_ordinal long, block_num long, block_id string, fork_step string")
    head = forks.live_head(e)
    assert rows(head.select("block_num", "block_id", "stream_ordinal")) == [(100, "B", 3), (101, "C", 6)]
    assert rows(forks.live_rows(e, head).select("stream_ordinal")) == [(3,), (6,)]


def fill(i, side, user, tid=7, coin="BTC", **more):
    base = dict(block_num=1, fill_index=i, coin=coin, side=side, user=user, transaction_id=tid, direction="BUY", hash="h", price=1, size=1, crossed=False)
    return base | more


def test_trade_groups(spark):
    data = [fill(0, "BUY", "a"), fill(1, "ASK", "b"), fill(2, "BUY", "a", 8), fill(3, "BUY", "b", 8), *[fill(4 + k, "BUY" if k else "ASK", "c", 9) for k in range(3)], fill(7, "BUY", "s", 10), fill(8, "ASK", "s", 10), fill(9, "BUY", "z", 0), fill(10, "ASK", "y", 0)]
    got = {r["fill_index"]: r["counterparty"] for r in M.with_counterparty(spark.createDataFrame(data)).collect()}
    assert got == {0: "b", 1: "a", 2: None, 3: None, 4: None, 5: None, 6: None, 7: "s", 8: "s", 9: None, 10: None}


def test_coin_forms(spark):
    coins = ["BTC", "xyz:XYZ100", "@107", "PURR/USDC", "#99731", "odd coin!", "#99999999999999999999999", None]
    df = spark.createDataFrame([(c,) for c in coins], "c string").select("c", L.market_type(F.col("c")), L.dex(F.col("c")))
    assert {r[0]: (r[1], r[2]) for r in df.collect()} == {"BTC": ("perp", ""), "xyz:XYZ100": ("perp", "xyz"), "@107": ("spot", None), "PURR/USDC": ("spot", None), "#99731": ("outcome", None), "odd coin!": (None, None), "#99999999999999999999999": (None, None), None: (None, None)}


@pytest.mark.parametrize(("text", "value", "issue"), [("N/A", None, "sentinel"), ("xxxx", None, "sentinel"), ("-", None, "sentinel"), ("1.2345678", "1.234568", "rounded"), ("-0.5000005", "-0.500001", "rounded"), ("9" * 40, None, "out_of_range"), ("１２", None, "unparseable"), ("", None, None), (None, None, None), (".5", "0.500000", None), ("1.", "1.000000", None), ("1,2", None, "unparseable"), ("0.9999999", "1.000000", "rounded")])
def test_parse_decimal(spark, text, value, issue):
    r = spark.createDataFrame([(text,)], "t string").select(P.parse_decimal(F.col("t"), 6).alias("p")).select("p.*").first()
    assert (str(r[0]) if r[0] is not None else None, r[1]) == (value, issue)


@pytest.mark.parametrize(("text", "value", "issue"), [("2014-06-30-05:00", dt.date(2014, 6, 30), "tz_dropped"), ("6/5/2026", dt.date(2026, 6, 5), None), ("12-31-1999", dt.date(1999, 12, 31), None), ("2021-02-30", None, "out_of_range"), ("0999-01-01", None, "out_of_range"), ("soon", None, "unparseable"), ("NONE", None, "sentinel"), ("2020-1-2", dt.date(2020, 1, 2), None)])
def test_parse_date(spark, text, value, issue):
    r = spark.createDataFrame([(text,)], "t string").select(P.parse_date(F.col("t")).alias("p")).select("p.*").first()
    assert tuple(r) == (value, issue)


def test_continuity(spark):
    data = [(1, "a", "z", 10), (2, "b", "a", None), (3, "c", "x", 5), (3, "d", "b", 20), (6, "e", "d", None), (7, "f", "e", 15)]
    b = spark.createDataFrame(data, "block_num long, block_id string, parent_id string, ts long")
    for width in (2, 1000):
        found = rows(quality.validate_blocks(b, width=width).select("kind", "block_num"))
        assert found == [("broken_parent", 3), ("duplicate", 3), ("gap", 6), ("time_reversal", 3), ("time_reversal", 7)]
    assert rows(quality.block_runs(b, width=2)) == [(1, 3), (6, 7)]
    assert rows(quality.seal_range(b.where("block_num < 3"), 1, 3).select("kind")) == []
    assert rows(quality.seal_range(b.where("block_num < 3"), 0, 4).select("kind")) == [("missing_end",), ("missing_start",)]


def test_failed_transaction_keeps(spark):
    c = "block_num long, tx_index long, call_index long, parent_index long, ordinal long, kind string, reason string, address string, state_reverted boolean"
    data = [(1, 0, 1, 0, 1, "balance", "GAS_BUY", "s", True), (1, 0, 1, 0, 2, "nonce", None, "s", True), (1, 0, 1, 0, 3, "nonce", None, "auth1", True), (1, 0, 1, 0, 4, "code", None, "auth1", True), (1, 0, 1, 0, 5, "nonce", None, "auth2", True),
            (1, 0, 2, 1, 6, "balance", "GAS_BUY", "s", True), (1, 0, 1, 0, 7, "balance", "TRANSFER", "s", True), (1, 0, 1, 0, 8, "nonce", None, "auth1", True), (1, 1, 1, 0, 9, "storage", None, "x", True), (1, 1, 1, 0, 10, "storage", None, "x", False)]
    tx = spark.createDataFrame([(1, 0, False), (1, 1, True)], "block_num long, tx_index long, transaction_success boolean")
    auth = spark.createDataFrame([(1, 0, "auth1", False), (1, 0, "auth2", True)], "block_num long, tx_index long, authority string, discarded boolean")
    got = {r["ordinal"] for r in outcome.persistent_changes(spark.createDataFrame(data, c), tx, auth).where("persisted").collect()}
    assert got == {1, 2, 3, 4, 10}


def test_flatten_and_nesting(spark):
    blocks = spark.createDataFrame([(1, [("a", [1, 2]), ("b", [])]), (2, None), (3, [("bad", [3])])], "block_num long, txs array<struct<h: string, v: array<int>>>")
    spec = FL.FlattenSpec("t", (FL.TableSpec("blocks"), FL.TableSpec("txs", (FL.Level("txs", "i"),), {"h": "e0.h"}), FL.TableSpec("vals", (FL.Level("txs", "i"), FL.Level("v", "j", outer=True)), {"v": "e1"})), errors="transform(filter(txs, t -> t.h = 'bad'), t -> 'bad')")
    out = FL.flatten(blocks, spec)  # block 2 has no list, so no list of errors either, and isn't lost
    assert rows(out["txs"]) == [(1, 0, "a"), (1, 1, "b")]
    assert rows(out["vals"]) == [(1, 0, 0, 1), (1, 0, 1, 2), (1, 1, None, None)]
    assert rows(out["quarantine"]) == [(3, "bad")]
    assert rows(out["blocks"].select("block_num")) == [(1,), (2,)]


@pytest.mark.parametrize("width", [None, 2, 1000])
def test_last_known_in_ranges(spark, width):
    data = [("k", 0, None), ("k", 1, "a"), ("k", 5, None), ("k", 9, None), ("k", 10, "b"), ("k", 11, None), (None, 3, "n"), (None, 8, None), ("l", 4, None)]
    df = spark.createDataFrame(data, "k string, t long, v string")
    got = {(r["k"], r["t"]): r["v"] for r in aggregates.filled_forward(df, ["k"], "t", ["v"], width).collect()}
    assert got == {("k", 0): None, ("k", 1): "a", ("k", 5): "a", ("k", 9): "a", ("k", 10): "b", ("k", 11): "b", (None, 3): "n", (None, 8): "n", ("l", 4): None}
    facts = spark.createDataFrame([("k", 5), ("k", 1), ("other", 9), ("k", 3)], "k string, t long")
    hist = spark.createDataFrame([("k", 3, "x"), ("k", 5, "y"), ("k", 4, None)], "k string, v long, name string")
    assert rows(joins.asof_join(facts, hist, ["k"], "t", "v", ["name"], width)) == [("k", 1, None), ("k", 3, "x"), ("k", 5, "y"), ("other", 9, None)]


def test_long_chains_and_cycles(spark):
    links = [(k, k + 1) for k in range(100)] + [(100, None), (200, 201), (201, 202), (202, 200), (203, 200)]
    got = {r[0]: (r[1], r[2]) for r in joins.last_in_chain(spark.createDataFrame(links, "node long, next long")).collect()}
    assert got == {k: (100, 100 - k) for k in range(101)}
    edges = spark.createDataFrame([(k, k + 1) for k in range(70)], "parent long, child long")
    assert joins.descendants(edges, spark.createDataFrame([(0,)], "node long")).agg(F.max("depth"), F.count("*")).first() == (70, 71)


def test_asof_and_chains(spark):
    facts = spark.createDataFrame([("k", 5), ("k", 1), ("other", 9), ("k", 3)], "k string, t long")
    hist = spark.createDataFrame([("k", 3, "x"), ("k", 5, "y")], "k string, v long, name string")
    assert rows(joins.asof_join(facts, hist, ["k"], "t", "v", ["name"])) == [("k", 1, None), ("k", 3, "x"), ("k", 5, "y"), ("other", 9, None)]
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "parent long, child long")
    assert rows(joins.descendants(edges, spark.createDataFrame([(1,)], "node long"))) == [(1, 1, 0), (1, 2, 1), (1, 3, 2), (1, 4, 3)]
    links = spark.createDataFrame([(1, 2), (2, 3), (3, None), (5, 9), (7, 8), (8, 7)], "node long, next long")
    assert rows(joins.last_in_chain(links)) == [(1, 3, 2), (2, 3, 1), (3, 3, 0), (5, None, 1)]


def test_change_log(spark):
    c = "entity long, observed_at long, kind string"
    log = G.shaped(spark.createDataFrame([(k, 1, "a") for k in range(40)], c), ["entity"], "s")
    snap = G.shaped(spark.createDataFrame([(k, 2, "b" if k == 3 else "a") for k in range(38)] + [(99, 2, "n")], c), ["entity"], "s")
    out = G.append(log, snap, ["entity"], 2)
    assert rows(out.select("entity", "kind", "listed")) == [(3, "b", True), (38, "a", False), (39, "a", False), (99, "n", True)]
    few = snap.where("entity < 5")
    with pytest.raises(G.MassRemoval, match="40 listed"):
        G.append(log, few, ["entity"], 2)
    assert G.append(log, few, ["entity"], 2, allow_removals=True).where("not listed").count() == 35
    with pytest.raises(ValueError, match="only columns at the end"):
        G.evolve(log, {"x": "string"})
    assert G.evolve(log, {**{x: "string" for x in log.columns}, "more": "long"}).where("more is not null").count() == 0


def test_unsigned_and_bits(spark):
    df = spark.createDataFrame([("9223372036854775807",)], "t string").select(F.col("t").cast("decimal(20,0)").alias("v"))
    assert df.select(S.checked_long(F.col("v"))).first()[0] == (1 << 63) - 1
    with pytest.raises(Exception, match="unsigned"):
        df.select(S.checked_long(F.col("v") + 1)).collect()
    assert spark.range(1).select(L.committee_indices(F.lit("0x0102"))).first()[0] == [0, 9]


def test_write_read_and_compact(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("block_num"), (F.col("id") % 3).alias("fill_index"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") / 400).cast("int")).alias("date"))
    ST.write_tables({"blocks": df.drop("fill_index"), "fills": df}, str(tmp_path), lookups={"fills": ["block_num"]})
    ST.write_metadata(spark, str(tmp_path), {"chain": "x"})
    assert ST.read_metadata(spark, str(tmp_path)) == {"chain": "x"}
    back = ST.table(spark, str(tmp_path), "fills")
    assert back.count() == 1000
    days = ST.closed_dates(back)
    assert rows(days) == [(dt.date(2026, 1, 1),), (dt.date(2026, 1, 2),)]
    assert rows(layout.compact_closed_dates(spark, str(tmp_path), "fills", f"{tmp_path}/c", days)) == [(dt.date(2026, 1, 1), 400), (dt.date(2026, 1, 2), 400)]
    again = spark.read.parquet(f"{tmp_path}/c/fills")
    assert layout.order_breaks(again, ["block_num", "fill_index"]).count() == 0
    assert sum(f.stat().st_size for f in tmp_path.glob("fills/**/*.parquet")) < 100_000  # the lookup filters stay small
    with pytest.raises(KeyError):
        layout.row_order_key("votes")


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    schema = "block_num long, timestamp timestamp, items array<struct<v: int>>"
    blocks = spark.createDataFrame([(k, dt.datetime(2026, 1, 1 + k % 2), [(j,) for j in range(k % 4)]) for k in range(30)], schema)
    blocks.where("block_num < 20").coalesce(1).write.parquet(f"{tmp_path}/in")
    spec = FL.FlattenSpec("t", (FL.TableSpec("blocks"), FL.TableSpec("items", (FL.Level("items", "i"),), {"v": "e0.v"})))
    run = lambda: ingest.ingest_stream(ST.stream_blocks(spark, f"{tmp_path}/in", schema), spec, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    run()
    run()  # nothing new: nothing twice
    blocks.where("block_num >= 20").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    got = spark.read.parquet(f"{tmp_path}/out/items").select("block_num", "i", "v")
    assert rows(got) == rows(FL.flatten(blocks, spec)["items"].select("block_num", "i", "v"))


def test_live_head_stream(spark, tmp_path):
    schema = "stream_ordinal long, block_num long, block_id string, fork_step string"
    data = [(1, 100, "A", "NEW"), (2, 100, "A", "UNDO"), (3, 100, "B", "NEW"), (4, 101, "C", "NEW")]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/in")
    q = ingest.live_head_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in")).writeStream.outputMode("complete").format("memory").queryName("heads").trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("heads").where("fork_step <> 'UNDO'").select("block_num", "block_id")) == [(100, "B"), (101, "C")]


def test_ordinals_and_days(spark):
    df = ingest.assign_ordinal(spark.range(100).select((F.lit(200) - F.col("id")).alias("o")), ["o"], after=50)
    got = [r["stream_ordinal"] for r in df.orderBy("o").collect()]
    assert got == list(range(51, 151))
    t = lambda d: dt.datetime(2026, 1, d, 12)
    b = spark.createDataFrame([(1, None), (2, t(3)), (3, None), (9, None), (10, t(5))], "block_num long, ts timestamp")
    for width in (2, 1000):
        assert [r["date"].day for r in ingest.routing_day(b, width=width).orderBy("block_num").collect()] == [3, 3, 3, 3, 5]


CHANGES = "entity long, observed_at long, kind string"


def snapshots(spark, *batches):
    return [G.shaped(spark.createDataFrame(b, CHANGES), ["entity"], "s") for b in batches]


def change_writer(root, schema, run=None):
    return ingest.changelog_writer(str(root), ["entity"], lambda log, snap: G.append(log, snap, ["entity"], 9), schema, run)


def logged(spark, root, schema):
    return spark.read.schema(schema).parquet(str(root)).select("entity", "observed_at", "kind")


def test_change_log_stream_reads_only_the_newest_rows(spark, tmp_path):
    batches = snapshots(spark, [(1, 1, "a"), (2, 1, "b")], [(1, 2, "a"), (2, 2, "c")], [(1, 3, "z"), (2, 3, "c")], [(1, 4, "z"), (2, 4, "c")])
    schema = batches[0].schema
    write = change_writer(tmp_path, schema)
    for k, b in enumerate(batches):
        write(b, k)
    assert rows(logged(spark, tmp_path, schema)) == [(1, 1, "a"), (1, 3, "z"), (2, 1, "b"), (2, 2, "c")]
    assert len(ST.children(spark, f"{tmp_path}/_newest")) == 2
    log = spark.read.schema(schema).parquet(str(tmp_path))
    assert G.verify(log, ["entity"], ["kind"]).count() == 0
    bad = log.where("entity = 1").withColumn("kind", F.lit("q")).unionByName(log.where("entity = 2").limit(1).withColumns({"listed": F.lit(False), "entity": F.lit(7).cast("long")}))
    assert {r["kind"] for r in G.verify(bad, ["entity"], ["kind"]).collect()} == {"hash_mismatch", "orphan_removal"}


def test_change_log_writer_replays_and_resumes(spark, tmp_path):
    one, two, three = snapshots(spark, [(1, 1, "a"), (2, 1, "b")], [(1, 2, "a"), (2, 2, "c")], [(1, 3, "a"), (2, 3, "c"), (3, 3, "n")])
    write = change_writer(tmp_path, one.schema, "first")
    write(one, 0)
    write(two, 1)
    write(two, 1)  # the same batch again
    want = [(1, 1, "a"), (2, 1, "b"), (2, 2, "c")]
    assert rows(logged(spark, tmp_path, one.schema)) == want
    again = change_writer(tmp_path, one.schema, "second")  # a new checkpoint counts its batches from 0
    again(two, 0)
    assert rows(logged(spark, tmp_path, one.schema)) == want
    again(three, 1)
    assert rows(logged(spark, tmp_path, one.schema)) == [*want, (3, 3, "n")]
    ST.remove(spark, f"{tmp_path}/_newest")
    change_writer(tmp_path, one.schema, "third")(three, 0)
    assert rows(logged(spark, tmp_path, one.schema)) == [*want, (3, 3, "n")]
    half = next(iter(tmp_path.glob("_newest/*/_SUCCESS")))
    half.unlink()  # a state whose write did not end
    change_writer(tmp_path, one.schema, "third")(three, 0)
    assert rows(logged(spark, tmp_path, one.schema)) == [*want, (3, 3, "n")]


def test_change_log_stream_restarts_with_and_without_its_checkpoint(spark, tmp_path):
    shape = snapshots(spark, [(1, 1, "a")])[0].schema

    def run(checkpoint):
        write = change_writer(f"{tmp_path}/log", shape)
        source = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        source.writeStream.foreachBatch(lambda b, k: write(G.shaped(b, ["entity"], "s"), k)).option("checkpointLocation", f"{tmp_path}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()

    spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], CHANGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run("cp1")
    spark.createDataFrame([(1, 2, "a"), (2, 2, "c")], CHANGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run("cp1")
    want = [(1, 1, "a"), (2, 1, "b"), (2, 2, "c")]
    assert rows(logged(spark, f"{tmp_path}/log", shape)) == want
    ST.remove(spark, f"{tmp_path}/in")
    spark.createDataFrame([(1, 3, "a"), (2, 3, "c")], CHANGES).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run("cp2")
    assert rows(logged(spark, f"{tmp_path}/log", shape)) == want


def test_an_entity_twice_in_a_snapshot_counts_once(spark):
    (snap,) = snapshots(spark, [(1, 5, "a"), (1, 7, "b"), (1, 7, "b"), (2, 1, "x")])
    assert rows(G.changes(snap.limit(0), snap, ["entity"]).select("entity", "observed_at", "kind")) == [(1, 7, "b"), (2, 1, "x")]


def test_temporary_tables_go(spark):
    with ST.temporary_tables(spark):
        held = ST.stored_table(spark.range(3).toDF("x"), "held")
        path = held.inputFiles()[0].rsplit("/", 1)[0]
        assert held.count() == 3 and ST.children(spark, path)
    assert not ST.children(spark, path)


def test_days_of_a_stream_equal_the_batch(spark, tmp_path):
    shape = "block_num long, ts timestamp"
    t = lambda d, h=12: dt.datetime(2026, 1, d, h)
    times = [None, None, None, None, t(3), None, None, None, t(5), None, t(4), None, None, None, None, None, t(9), t(9), None, None]
    blocks = list(enumerate(times))
    want = sorted((r["block_num"], r["date"]) for r in ingest.routing_day(spark.createDataFrame(blocks, shape)).collect())
    parts = [blocks[:2], blocks[2:3], blocks[3:7], blocks[7:12], blocks[12:15], blocks[15:]]

    def run(checkpoint):
        def write(df, k):
            df.select("block_num", "date").write.mode("overwrite").parquet(f"{tmp_path}/out/{checkpoint}-{k}")

        source = spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        source.writeStream.foreachBatch(ingest.day_router(f"{tmp_path}/state", write, spark.createDataFrame([], shape).schema)).option("checkpointLocation", f"{tmp_path}/{checkpoint}").trigger(availableNow=True).start().awaitTermination()

    for k, part in enumerate(parts):
        if k == 4:
            ST.remove(spark, f"{tmp_path}/in")  # a new checkpoint must not see old files again
        spark.createDataFrame(part, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        run("a" if k < 4 else "b")
    got = spark.read.parquet(*map(str, tmp_path.glob("out/*")))
    assert sorted((r["block_num"], r["date"]) for r in got.collect()) == want
    assert len(ST.children(spark, f"{tmp_path}/state/_days")) == 2
    # a replay of a batch gives its rows again
    seen = []
    router = ingest.day_router(f"{tmp_path}/again", lambda df, k: seen.append(sorted((r["block_num"], r["date"]) for r in df.collect())), spark.createDataFrame([], shape).schema, "r")
    one, two = spark.createDataFrame(blocks[:3], shape), spark.createDataFrame(blocks[3:7], shape)
    router(one, 0)
    router(two, 1)
    router(two, 1)
    assert len(seen) == 2 and seen[0] == seen[1] == want[:7]
