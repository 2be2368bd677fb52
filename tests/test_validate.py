"""Error rules over nested blocks: every kind, positions in the paths, quarantine of whole blocks, raw bodies."""

from decimal import Decimal

from pyspark.sql import functions as F

from blockwright.operators.validate import Checks, quarantine, with_errors
from blockwright.plans.specs import CHECKS, flatten_family

RAW = """block_num long, block_header struct<block_number: long, block_time: struct<seconds: long, nanos: int>>,
  fills array<struct<user: string, coin: string, price: string, side: int, time: struct<seconds: long, nanos: int>, builder_fee: string, transaction_id: decimal(20,0), liquidation: struct<mark_px: string, method: string>>>,
  events array<struct<time: struct<seconds: long, nanos: int>, hash: string, events: array<struct<
    ledger_update: struct<users: array<string>, delta: struct<send: struct<user: string, token: string, amount: string, fee_token: string>, deposit: struct<usdc: string>>>,
    funding: struct<deltas: array<struct<user: string, coin: string, funding_amount: string, szi: string, funding_rate: string>>>,
    c_deposit: struct<user: string, amount: string>>>>>"""


def fill(**x):
    base = {"user": "u", "coin": "BTC", "price": "1.5", "side": 2, "time": (0, 5_000_000), "builder_fee": "", "transaction_id": Decimal(1), "liquidation": None}
    return tuple((base | x).values())


def event(body=None, bodies=1, time=(5, 6), hash="h"):
    return (time, hash, [body or (None, None, ("u", "1"))] * bodies)


def block(n, fills=(), events=(), header=True):
    return (n, (n, (7, 0)) if header is True else header, list(fills), list(events))


def errors(spark, *blocks):
    df = with_errors(spark.createDataFrame(blocks, RAW), CHECKS["hypercore"])
    return {(r["block_num"], r["path"]): r["reason"] for r in quarantine(df, ["block_num"]).collect()}


def test_every_kind_names_its_place(spark):
    good = block(1, [fill(), fill(price="-0012.12345678900000", builder_fee="2", liquidation=("3", "m"))], [event(), event((None, ([("u", "BTC", "1", "2", "0.1")],), None)), event(((["a"], (None, ("1",))), None, None))])
    bad = [fill(user=""), fill(coin=None), fill(price="1e5"), fill(price="0.12345678901"), fill(price="1" * 29), fill(price=""), fill(side=0), fill(side=3), fill(time=None), fill(time=(0, 1)), fill(time=(0, -1)), fill(time=(10**12, 0)), fill(builder_fee="x"),
           fill(transaction_id=Decimal(1 << 63)), fill(liquidation=("", ""))]
    wrong = [event(bodies=2), event(bodies=0), event((None, None, None)), event(hash=""), event(time=(1 << 40, 0)), event(((["a", ""], None), None, None)), event(((None, (("u", "", "", ""), None)), None, None)), event((None, ([("u", "BTC", "1", "2", "0.1"), ("u", "BTC", "1", "2", "")],), None))]
    got = errors(spark, good, block(2, bad), block(3, [], wrong), block(4, header=None), block(5, header=(6, (7, 0))), (6, (6, None), None, None))
    assert {k: v for k, v in got.items() if k[0] == 2} == {
        (2, "fills[0].user"): "empty", (2, "fills[1].coin"): "empty", (2, "fills[2].price"): "not a plain decimal", (2, "fills[3].price"): "more than 10 fractional digits", (2, "fills[4].price"): "more than 28 integer digits",
        (2, "fills[5].price"): "empty", (2, "fills[6].side"): "no side: 0", (2, "fills[7].side"): "no side: 3", (2, "fills[8].time"): "missing", (2, "fills[9].time"): "not a whole millisecond", (2, "fills[10].time"): "nanoseconds outside a second",
        (2, "fills[11].time"): "out of the calendar", (2, "fills[12].builder_fee"): "not a plain decimal", (2, "fills[13].transaction_id"): "out of range of a long", (2, "fills[14].liquidation.mark_px"): "empty", (2, "fills[14].liquidation.method"): "empty"}
    assert {k: v for k, v in got.items() if k[0] == 3} == {
        (3, "events[0].events"): "2 items, not 1", (3, "events[1].events"): "0 items, not 1", (3, "events[2].events[0]"): "no case", (3, "events[3].hash"): "empty", (3, "events[4].time"): "out of range of nanoseconds",
        (3, "events[5].events[0].ledger_update.users[1]"): "empty", (3, "events[5].events[0].ledger_update.delta"): "no case", (3, "events[6].events[0].ledger_update.delta.send.token"): "empty",
        (3, "events[6].events[0].ledger_update.delta.send.amount"): "empty", (3, "events[7].events[0].funding.deltas[1].funding_rate"): "empty"}
    assert {k: v for k, v in got.items() if k[0] in (1, 4, 5, 6)} == {(4, "block_header"): "missing", (5, "block_header.block_number"): "differs from block_num", (6, "block_header.block_time"): "missing"}


def test_quarantined_blocks_give_no_row_and_raw_bodies_are_flattened(spark):
    funding = (None, ([("u", "BTC", "1", "2", "0.1"), ("v", "BTC", "-1", "-3", "0.1"), ("u", "d:X", "1", "2", "0.2"), ("v", "d:X", "1", "2", "0.3")],), None)
    blocks = [block(1, [fill(), fill(side=1)], [event(), event(funding), event((None, ([],), None)), event(((["a"], (("u", "T", "5", ""), None)), None, None)), event(((["a"], (None, ("7",))), None, None))]), block(2, [fill(), fill(price="")], [event(funding)])]
    out = flatten_family(spark.createDataFrame(blocks, RAW), "hypercore")
    assert [(r["block_num"], r["error"]["path"]) for r in out["quarantine"].collect()] == [(2, "fills[1].price")]
    assert sorted((r["fill_index"], r["side"], r["price"], r["builder_fee"]) for r in out["fills"].collect()) == [(0, "BUY", Decimal("1.5000000000"), None), (1, "ASK", Decimal("1.5000000000"), None)]
    assert [(r["event_index"], r["ledger_type"], r["user"], r["amount"]) for r in out["transfers"].collect()] == [(3, "send", "u", Decimal(5))]
    assert [(r["event_index"], r["ledger_type"], r["usdc"], r["users"]) for r in out["bridge_transfers"].collect()] == [(4, "deposit", Decimal(7), ["a"])]
    assert [(r["event_index"], r["event_type"], r["user"]) for r in out["staking_events"].collect()] == [(0, "c_deposit", "u")]
    rates = {(r["event_index"], r["coin"]): (r["dex_index"], r["dex"], r["funding_rate"], r["positions"], r["open_interest"], r["long_size"], r["short_size"]) for r in out["funding_rates"].collect()}
    assert rates == {(1, "BTC"): (0, "", Decimal("0.1"), 2, 5, 2, 3), (1, "d:X"): (0, "d", None, 2, 4, 4, 0)}


def test_names_without_a_kind_and_schemas_without_fields(spark):
    df = spark.createDataFrame([(1, [("x",)])], "block_num long, odd array<struct<thing: string>>")
    assert with_errors(df, CHECKS["hypercore"]).where(F.size("_errors") > 0).count() == 0
    nested = spark.createDataFrame([(1, [["a", ""], None, [None]])], "block_num long, odd array<array<string>>")
    got = quarantine(with_errors(nested, Checks({"odd[][]": "text"})), ["block_num"]).collect()
    assert {(r["path"], r["reason"]) for r in got} == {("odd[0][1]", "empty"), ("odd[2][0]", "empty")}
