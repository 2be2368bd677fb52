from blockwright.functions.labels import BODY_TABLES, LEDGER_TABLES
from blockwright.plans.specs import FAMILIES, flatten_family

EVM = """block_num long, block_id string, transactions array<struct<hash: string, status: string, receipt: struct<logs: array<struct<address: string, topics: array<string>>>>,
  calls: array<struct<index: long, depth: long, balance_changes: array<struct<address: string, ordinal: long>>>>>>, system_calls array<struct<index: long, balance_changes: array<struct<address: string>>>>"""


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_evm(spark):
    tx = [("0x1", "OK", ([("a", ["t0", "t1"]), ("b", [])],), [(1, 0, [("a", 5), ("b", 6)]), (2, 1, [])]), ("0x2", "FAILED", ([],), [])]
    b = spark.createDataFrame([(1, "b1", tx, [(9, [("s",)])]), (2, "b2", [], None)], EVM)
    out = flatten_family(b, "evm")
    assert rows(out["transactions"], "block_num", "index", "hash", "status") == [(1, 0, "0x1", "OK"), (1, 1, "0x2", "FAILED")]
    assert rows(out["logs"], "tx_index", "log_index", "tx_hash", "address", "topic0", "topic2") == [(0, 0, "0x1", "a", "t0", None), (0, 1, "0x1", "b", None, None)]
    assert rows(out["balance_changes"], "tx_index", "call_index", "address", "ordinal") == [(0, 1, "a", 5), (0, 1, "b", 6)]
    assert rows(out["system_balance_changes"], "call_index", "address") == [(9, "s")]
    assert out["blocks"].count() == 2 and "withdrawals" not in out
    assert set(flatten_family(b, "evm", only={"blocks", "logs"})) == {"blocks", "logs"}


def test_cosmos_keeps_events_without_attributes(spark):
    b = spark.createDataFrame([(1, [("x", [("k", "v")]), ("y", [])])], "block_num long, events array<struct<type: string, attributes: array<struct<key: string, value: string>>>>")
    assert rows(flatten_family(b, "cosmos")["events"], "event_index", "attribute_index", "type", "key") == [(0, 0, "x", "k"), (1, None, "y", None)]


def test_nested_messages_are_joined_by_name(spark):
    b = spark.createDataFrame([(1, ([(7, (3, "r"))],))], "block_num long, body struct<attestations: array<struct<slot: long, source: struct<epoch: long, root: string>>>>")
    assert rows(flatten_family(b, "beacon")["attestations"], "attestation_index", "slot", "source_epoch", "source_root") == [(0, 7, 3, "r")]


def test_every_family_has_its_tables():
    assert {f: len(t) for f, t in FAMILIES.items()}.keys() == {"evm", "bitcoin", "solana", "near", "antelope", "cosmos", "tron", "beacon", "hypercore", "sec"}
    assert len(FAMILIES["evm"]) == 20 and sum(map(len, FAMILIES.values())) > 100


def test_cosmos_unites_block_and_transaction_events(spark):
    shape = "block_num long, events array<struct<type: string, attributes: array<struct<key: string, value: string>>>>, txs array<struct<hash: string, events: array<struct<type: string, attributes: array<struct<key: string, value: string>>>>>>"
    b = spark.createDataFrame([(1, [("x", [("k", "v")])], [("h0", []), ("h1", [("y", []), ("z", [("a", "b"), ("c", "d")])])]), (2, None, None)], shape)
    out = flatten_family(b, "cosmos")
    assert "tx_events" not in out
    assert rows(out["events"], "source", "tx_hash", "tx_index", "event_index", "type", "attribute_index", "key") == sorted([("block", None, None, 0, "x", 0, "k"), ("transaction", "h1", 1, 0, "y", None, None), ("transaction", "h1", 1, 1, "z", 0, "a"), ("transaction", "h1", 1, 1, "z", 1, "c")], key=str)


def test_hypercore_routes_events_and_derives_from_fills(spark):
    shape = """block_num long, events array<struct<event_type: string, ledger_type: string, amount: long>>,
      fills array<struct<coin: string, side: string, user: string, transaction_id: long, direction: string, size: long, liquidation_method: string, liquidated_user: string, liquidation_mark_px: long, fill_time: long>>"""
    kinds = [(t, None) for types in BODY_TABLES.values() for t in types] + [("ledger_update", t) for types in LEDGER_TABLES.values() for t in types] + [("news", None), ("ledger_update", "odd")]
    fills = [("BTC", "BUY", "a", 7, "BUY", 1, "market", "a", 5, 0), ("BTC", "ASK", "b", 7, "SELL", 1, None, None, None, 0), ("#120", "BUY", "c", 0, "BUY", 1, None, None, None, 0)]
    out = flatten_family(spark.createDataFrame([(1, [(e, l, k) for k, (e, l) in enumerate(kinds)], fills)], shape), "hypercore")
    assert "events" not in out
    tables = {*LEDGER_TABLES, *BODY_TABLES, "other_events"}
    got = {t: {r["amount"] for r in out[t].collect()} for t in tables}
    assert sum(map(len, got.values())) == len(kinds) and set.union(*got.values()) == set(range(len(kinds)))
    assert {len(kinds) - 1, len(kinds) - 2} <= got["other_events"]
    assert rows(out["fills"], "fill_index", "market_type", "counterparty") == [(0, "perp", "b"), (1, "perp", "a"), (2, "outcome", None)]
    assert rows(out["outcome_fills"], "fill_index", "outcome_id", "side_index") == [(2, 12, 0)]
    assert rows(out["liquidations"], "fill_index", "mark_price", "counterparty") == [(0, 5, "b")]


def test_solana_numbers_two_lists_and_sets_votes_apart(spark):
    call = "program: string, instruction_kind: string"
    shape = f"""block_num long, rewards array<struct<pubkey: string>>, transactions array<struct<sig: string, err: string, num_signatures: int, versioned: boolean, address_table_lookups: array<struct<key: string>>,
      instructions: array<struct<{call}>>, inner_instructions: array<struct<index: int, instructions: array<struct<{call}>>>>, rewards: array<struct<pubkey: string>>, token_balances: array<struct<mint: string>>>>"""
    vote = [("vote", "TowerSync")]
    plain = ("a", None, 1, False, [("k",)], [("x", "A"), ("y", "B")], [(1, [("z", "C"), ("w", "D")]), (0, [("v", "E")])], [("p",)], [("m",)])
    txs = [plain, ("b", "boom", 1, False, [], vote, None, [("q",)], [("n",)]), ("c", "", 3, False, None, vote, [], None, None), ("d", None, 1, True, None, vote, None, None, None), ("e", "", 2, None, None, [("vote", "Withdraw")], None, [("r",)], None)]
    out = flatten_family(spark.createDataFrame([(1, [("s",), ("t",)], txs), (2, None, None)], shape), "solana")
    assert rows(out["transactions"], "transaction_index", "sig", "transaction_success") == [(0, "a", True), (2, "c", True), (3, "d", True), (4, "e", True)]
    assert rows(out["vote_transactions"], "transaction_index", "sig", "transaction_success") == [(1, "b", False)]
    got = rows(out["instructions"].where("transaction_index = 0"), "instruction_index", "program", "is_inner", "parent_instruction_index", "inner_index", "inner_instruction_index")
    assert got == [(0, "x", False, None, None, None), (1, "y", False, None, None, None), (2, "z", True, 1, 1, 0), (3, "w", True, 1, 1, 1), (4, "v", True, 0, 0, 0)]
    assert rows(out["rewards"], "reward_index", "source", "transaction_index", "transaction_success", "pubkey") == sorted([(0, "transaction", 0, True, "p"), (1, "transaction", 4, True, "r"), (2, "block", None, None, "s"), (3, "block", None, None, "t")], key=str)
    assert rows(out["token_balances"], "transaction_index", "mint") == [(0, "m")] and "is_vote" not in out["instructions"].columns
