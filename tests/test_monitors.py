"""Every monitor on rows that break it alone, and on sound rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blockwright.functions.labels import ZERO_HASH
from blockwright.operators.monitors import coins_without_rate, monitors

T0 = dt.datetime(2026, 1, 1, 5)
U, V = "0x" + "a" * 40, "0x" + "b" * 40


def sound_hash(block):
    return "0x" + "0" * 20 + "04" + f"{block:08x}" + "0" * 34


def fill(block, i, **x):
    odd = i % 2
    base = dict(block_num=block, fill_index=i, timestamp=T0, fill_time=T0, coin="BTC", user=V if odd else U, counterparty=U if odd else V, hash=sound_hash(block), price=1.0, size=2.0, side="ASK" if odd else "BUY", transaction_id=7, crossed=bool(odd),
                market_type="perp", dex="", builder=None, client_order_id=None, liquidated_user=None, liquidation_method=None, extra_json=None)
    return base | x


def event(block, i, **x):
    base = dict(block_num=block, event_index=i, event_type="ledger_update", ledger_type="send", table_name="transfers", hash=sound_hash(block), event_time_ns=1, users=[U], user=U, destination=V, vault=None, validator=None, sub_account=None, token="USDC",
                fee=0, fee_token=None, item_count=None, previous_winner_ip=None, end_gas=None, extra_json=None)
    return base | x


FILL = "block_num long, fill_index long, timestamp timestamp, fill_time timestamp, coin string, user string, counterparty string, hash string, price double, size double, side string, transaction_id long, crossed boolean, market_type string, dex string, builder string, client_order_id string, liquidated_user string, liquidation_method string, extra_json string"
EVENT = "block_num long, event_index long, event_type string, ledger_type string, table_name string, hash string, event_time_ns long, users array<string>, user string, destination string, vault string, validator string, sub_account string, token string, fee long, fee_token string, item_count long, previous_winner_ip string, end_gas long, extra_json string"
RATE = "block_num long, event_index long, dex_index long, dex string, coin string, timestamp timestamp, funding_rate double, long_size double, short_size double, open_interest double, extra_json string"


def tables(spark, fills=None, events=None, counts=None, rates=None, items=(), links=()):
    fills = [fill(1, 0), fill(1, 1)] if fills is None else fills
    events = [event(1, 0)] if events is None else events
    rates = [(1, 0, 0, "", "BTC", T0 + dt.timedelta(minutes=30), 0.1, 1.0, 1.0, 2.0, None)] if rates is None else rates
    numbers = sorted({r["block_num"] for r in [*fills, *events]})
    blocks = [(b, 1, *(counts or (sum(r["block_num"] == b for r in fills), sum(r["block_num"] == b for r in events))), None) for b in numbers]
    row = lambda data, shape: spark.createDataFrame([tuple(r.values()) for r in data], shape)
    return {"blocks": spark.createDataFrame(blocks, "block_num long, block_time_ns long, fill_count long, event_count long, extra_json string"), "fills": row(fills, FILL), "events": row(events, EVENT), "funding_rates": spark.createDataFrame(rates, RATE),
            "items": spark.createDataFrame(list(items), "block_num long, event_index long"), "links": spark.createDataFrame(list(links), "block_num long, ledger_event_index long")}


def two(**x):
    return [fill(1, 0, **x), fill(1, 1, **x)]


GOSSIP = dict(event_type="gossip_priority_auction_restart", ledger_type=None, table_name="other_events")
LIQUIDATION = dict(ledger_type="liquidation", table_name="other_events")
FUNDING = dict(event_type="funding", ledger_type=None, table_name="other_events")
CASES = {
    "M1": dict(fills=two(fill_time=T0 + dt.timedelta(seconds=1))), "M2": dict(events=[event(1, 0, event_time_ns=2)]), "M3": dict(events=[event(1, 1, **FUNDING)]), "M4": dict(fills=two(hash=sound_hash(2))),
    "M4e": dict(events=[event(1, 0, hash=sound_hash(2))]), "M5": dict(fills=[fill(1, 0, client_order_id="0x1"), fill(1, 1)]), "M5e": dict(events=[event(1, 0, users=[U, "0x1"])]), "M6": dict(events=[event(1, 0, users=[U] * 3)]),
    "M7": dict(fills=[fill(1, 0, builder="0x" + "A" * 40), fill(1, 1)]), "M8f": dict(counts=(3, 1)), "M8e": dict(counts=(2, 2)), "M8i": dict(events=[event(1, 0, item_count=2, **FUNDING)], items=[(1, 0)]),
    "M9": dict(fills=[fill(1, 0, side="ASK"), fill(1, 1, side="BUY")]), "M10": dict(events=[event(1, 0, end_gas=1, **GOSSIP)]), "M11": dict(fills=[fill(1, 0, liquidation_method="m", transaction_id=0, counterparty=None, crossed=False)]),
    "M12": dict(events=[event(1, 0, fee=1)]), "M13": dict(fills=[fill(1, 0, extra_json="{}"), fill(1, 1)]), "M14": dict(fills=[fill(1, 0, price=3.0), fill(1, 1)]), "M15": dict(fills=[fill(1, 0, counterparty=None), fill(1, 1, counterparty=None)]),
    "M16": dict(fills=two(liquidation_method="m", liquidated_user="0x" + "c" * 40)), "M16e": dict(events=[event(1, 0, **LIQUIDATION), event(1, 1, **LIQUIDATION)], links=[(1, 1)]),
    "M17": dict(rates=[(1, 0, 0, "", "BTC", T0, None, 1.0, 1.0, 2.0, None)]), "M18": dict(rates=[(1, 0, 0, "", "BTC", T0, 0.1, 1.0, 1.0, 2.0, None), (1, 1, 0, "x", "x:A", T0, 0.1, 1.0, 1.0, 2.0, None)]), "M19": dict(fills=two(dex="other")),
    "M20": dict(rates=[(1, 0, 0, "", "BTC", T0, 0.1, 1.0, 2.0, 2.0, None)]), "M21": dict(events=[event(1, 0, table_name="vault_events")]), "M22": dict(rates=[(1, 0, 0, "", "ETH", T0 + dt.timedelta(hours=1), 0.1, 1.0, 1.0, 2.0, None)]), "M23": dict(events=[event(1, 0, token="+12")]),
}


@pytest.mark.parametrize("name", ["sound", *CASES])
def test_each_monitor(spark, name):
    got = {r["monitor"] for r in monitors(tables(spark, **CASES.get(name, {}))).collect()}
    assert got == ({name} if name != "sound" else set())


def test_the_hour_before_equals_brute_force(spark):
    import random

    r = random.Random(4)
    fills = [(k, r.choice("ABC"), r.randrange(20_000)) for k in range(300)]
    rates = [(1000 + k, r.choice("ABC"), 600 * k) for k in range(40)]
    rates += [(b, "Z", t) for b, _, t in rates]
    want = {(b, c) for b, _, t in rates for _, c, s in fills if t - 3600 <= s < t} - {(b, c) for b, c, _ in rates}
    f = spark.createDataFrame(fills, "block_num long, coin string, s long").select("coin", F.timestamp_seconds("s").alias("timestamp"), F.lit("perp").alias("market_type"))
    p = spark.createDataFrame(rates, "block_num long, coin string, s long").select("block_num", "coin", F.timestamp_seconds("s").alias("timestamp"))
    assert {tuple(x) for x in coins_without_rate(f, p).collect()} == want


def test_zero_hashes_and_outcome_trades_are_no_violations(spark):
    legs = [fill(1, 0, hash=ZERO_HASH, coin="#10", market_type="outcome", dex=None, transaction_id=9, counterparty=None, crossed=False)]
    assert monitors(tables(spark, fills=legs)).count() == 0


def test_rows_are_not_shuffled_for_rules_of_their_own(spark):
    from blockwright.operators.monitors import with_match

    given = tables(spark)
    given["fills"] = with_match(given["fills"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = monitors(given)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert monitors(given).count() == 0
    assert plan.count("windowspecdefinition(block_num") > 0 and len({x for x in plan.splitlines() if "Window [" in x}) == 1  # matches once, as they were given
    assert not [x for x in plan.splitlines() if "SortMergeJoin" in x and "LeftOuter" in x and "event_index" in x and "ledger_type" in x]
    assert "SortAggregate" not in plan
