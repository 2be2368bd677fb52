import json

from pyspark.sql import functions as F

from blockwright.operators import changelog as G
from blockwright.plans import reference_tables as R
from blockwright.streaming import ingest


def docs(spark, *bodies, **more):
    return spark.createDataFrame([(k + 1, json.dumps(b)) for k, b in enumerate(bodies)], "observed_at long, body string").withColumns({k: F.lit(v) for k, v in more.items()})


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_spot(spark):
    meta = {"universe": [{"tokens": [1, 0], "name": "PURR/USDC", "index": 0, "isCanonical": True}, {"tokens": [2, 0], "name": "@1", "index": 1, "isCanonical": False}], "tokens": [{"name": n, "index": k, "szDecimals": 1, "weiDecimals": 2, "tokenId": "0x"} for k, n in enumerate(("USDC", "PURR", "HFUN"))]}
    out = R.spot_meta(docs(spark, meta))
    assert rows(out["hl_spot_pairs"], "coin", "base_symbol", "quote_symbol") == [("@1", "HFUN", "USDC"), ("PURR/USDC", "PURR", "USDC")]
    d = R.token_details(docs(spark, {"name": "PURR", "deployer": "0xd", "deployTime": "t"}, token_index=1))
    assert rows(R.tokens_current(out["hl_spot_tokens"], d).where("deployer is not null"), "token_index", "deployer") == [(1, "0xd")]


def test_perps_and_as_of(spark):
    dexs = R.perp_dexs(docs(spark, [None, {"name": "xyz", "fullName": "XYZ"}]))
    assert rows(dexs, "dex_index", "name") == [(0, ""), (1, "xyz")]
    meta = lambda lev: [{"universe": [{"name": "BTC", "maxLeverage": lev}]}, {"universe": [{"name": "xyz:A", "maxLeverage": 5, "isDelisted": True}]}]
    assets = R.perp_assets(docs(spark, meta(40), meta(50)), dexs)
    assert rows(R.current("hl_perp_assets", assets), "coin", "dex", "max_leverage") == [("BTC", "", 50), ("xyz:A", "xyz", 5)]
    fills = spark.createDataFrame([("BTC", 0), ("BTC", 1), ("BTC", 9), ("none", 9)], "coin string, t long")
    assert rows(R.leverage_at(fills, assets, "t"), "coin", "t", "max_leverage") == [("BTC", 0, None), ("BTC", 1, 40), ("BTC", 9, 50), ("none", 9, None)]


def test_outcomes(spark):
    t0 = {"outcomes": [{"outcome": 7, "name": "o", "description": "a:1|b:2", "sideSpecs": [{"name": "Yes"}, {"name": "No"}]}], "questions": [{"question": 3, "name": "q", "fallbackOutcome": 9, "namedOutcomes": [7]}]}
    t1 = {"outcomes": t0["outcomes"], "questions": [{"question": 3, "name": "q2"}]}
    out = R.outcome_meta(docs(spark, t0, t1))
    questions = R.current("hl_questions", out["hl_questions"])
    assert rows(questions, "question_id", "name", "fallback_outcome_id") == [(3, "q2", 9)]
    sides = R.outcome_sides(R.outcomes_current(out["hl_outcomes"], out["hl_questions"]), questions)
    assert rows(sides, "coin", "side_name", "question_name") == [("#70", "Yes", "q2"), ("#71", "No", "q2")]
    assert out["hl_outcomes"].first()["description_kv"] == {"a": "1", "b": "2"}


def test_funding(spark):
    f = R.funding_history(docs(spark, [{"coin": "BTC", "fundingRate": "0.0000125", "premium": "-0.5", "time": 1000}, {"coin": "BTC", "fundingRate": "0.1", "premium": "x", "time": 5000}]))
    assert [(str(a), b) for a, b in rows(R.current("hl_funding_history", f), "funding_rate", "premium")] == [("0.100000000000000000", None)]


def test_sweep(spark):
    log = spark.createDataFrame([(0, 1, True, True), (1, 1, True, False), (4, 1, True, False)], "id long, observed_at long, listed boolean, settled boolean")
    snap = spark.createDataFrame([(1,)], "id long")
    assert [tuple(r) for r in G.sweep_candidates(log, snap, "id", "settled", ahead=2).collect()] == [(0, 0), (4, 0), (1, 1), (2, 2), (3, 2), (5, 2), (6, 2)]


def test_change_log_stream(spark, tmp_path):
    c = "entity long, observed_at long, kind string"
    shape = G.shaped(spark.createDataFrame([], c), ["entity"], "s").schema
    for k, kind in enumerate(("a", "a", "b")):
        spark.createDataFrame([(1, k, kind)], c).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        write = ingest.changelog_writer(f"{tmp_path}/log", ["entity"], lambda log, snap: G.changes(log, G.shaped(snap, ["entity"], "s"), ["entity"]), shape)
        spark.readStream.schema(c).parquet(f"{tmp_path}/in").writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/log"), "observed_at", "kind") == [(0, "a"), (2, "b")]


def test_observed_metrics(spark):
    from pyspark.sql import Observation

    o = Observation("blocks")
    df = spark.range(5).select(F.col("id").alias("block_num"), F.timestamp_seconds("id").alias("timestamp"))
    df.observe(o, F.count(F.lit(1)).alias("rows"), F.max("block_num").alias("latest_block")).count()
    assert o.get == {"rows": 5, "latest_block": 4}
    assert ingest.observed(df, "x").count() == 5
