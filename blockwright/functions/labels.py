"""Rules on labels, coins, votes, hashes and logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO_HASH = "0x" + "0" * 64

# Directions that are no trade, forced directions, enum labels in the order of their numbers from 1, and the table of each ledger type.
NON_TRADE = ["SPOT_DUST_CONVERSION", "SETTLEMENT", "NET_CHILD_VAULTS", "SPLIT_OUTCOME", "MERGE_OUTCOME", "MERGE_QUESTION", "NEGATE_OUTCOME"]
FORCED = ["AUTO_DELEVERAGING", "LIQUIDATED_CROSS_LONG", "LIQUIDATED_CROSS_SHORT", "LIQUIDATED_ISOLATED_LONG", "LIQUIDATED_ISOLATED_SHORT", "BACKSTOP_BORROW_LIQUIDATION", "PARTIAL_BORROW_LIQUIDATION"]
SIDES = ["ASK", "BUY"]
DIRECTIONS = [
    "BUY", "SELL", "OPEN_LONG", "CLOSE_LONG", "OPEN_SHORT", "CLOSE_SHORT", "LONG_TO_SHORT", "SHORT_TO_LONG", "SPOT_DUST_CONVERSION",
    "LIQUIDATED_CROSS_LONG", "LIQUIDATED_CROSS_SHORT", "LIQUIDATED_ISOLATED_LONG", "LIQUIDATED_ISOLATED_SHORT", "AUTO_DELEVERAGING", "SETTLEMENT",
    "NET_CHILD_VAULTS", "BACKSTOP_BORROW_LIQUIDATION", "PARTIAL_BORROW_LIQUIDATION", "SPLIT_OUTCOME", "MERGE_OUTCOME", "MERGE_QUESTION", "NEGATE_OUTCOME",
]
LEVERAGE_TYPES = ["CROSS", "ISOLATED"]
LEDGER_TABLES = {
    "transfers": ["send", "spot_transfer", "internal_transfer", "sub_account_transfer", "account_class_transfer"],
    "bridge_transfers": ["deposit", "withdraw"],
    "vault_events": ["vault_create", "vault_deposit", "vault_withdraw", "vault_distribution", "vault_leader_commission"],
    "staking_events": ["c_staking_transfer"],
    "other_events": ["rewards_claim", "deploy_gas_auction", "account_activation_gas", "activate_dex_abstraction", "liquidation", "spot_genesis", "borrow_lend", "gossip_priority_gas_auction", "hip3_liquidator_deposit"],
}
BODY_TABLES = {
    "staking_events": ["c_deposit", "c_withdrawal", "delegation"],
    "other_events": ["funding", "validator_rewards", "gossip_priority_auction_restart", "create_sub_account"],
}


def market_type(coin: Column) -> Column:
    return (F.when(coin.rlike("^#[0-9]+$") & F.substring(coin, 2, 40).try_cast("decimal(20,0)").isNotNull(), "outcome")
            .when(coin.rlike("^(@[0-9]+|[A-Za-z0-9]+/[A-Za-z0-9]+)$"), "spot")
            .when(coin.rlike("^([a-z][a-z0-9]*:)?[A-Za-z0-9]+$"), "perp"))


def dex(coin: Column) -> Column:
    """The name before the colon of a perpetual's coin, '' for the first exchange, null for other markets."""
    return F.when(market_type(coin) == "perp", F.regexp_extract(coin, "^([a-z0-9]+):", 1))


def event_table(event_type: Column, ledger_type: Column) -> Column:
    """The one table an event goes to; null for labels outside the lists."""
    out = F.when(F.lit(False), F.lit(""))
    for table, types in LEDGER_TABLES.items():
        out = out.when((event_type == "ledger_update") & ledger_type.isin(types), table)
    for table, types in BODY_TABLES.items():
        out = out.when((event_type != "ledger_update") & ledger_type.isNull() & event_type.isin(types), table)
    return out


def vote_clean(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.trim(c), r"\s+", " "))


# Spellings of votes.
VOTES = {
    "FOR": ["FOR", "F", "FOR ALL"],
    "AGAINST": ["AGAINST", "AGANST"],
    "WITHHOLD": ["WITHHOLD", "WITHHELD", "WITHOLD"],
    "ABSTAIN": ["ABSTAIN"],
    "DID_NOT_VOTE": ["TNA", "DO NOT VOTE", "DID NOT VOTE", "NO VOTE", "NOT VOTED", "UNVOTED", "NON-VOTING"],
    "SPLIT": ["SPLIT"],
    "NONE": ["NONE", "N/A"],
}


def how_voted(c: Column) -> Column:
    """One of eleven labels for any spelling, null where there is none; yearly frequencies are told first."""
    t = vote_clean(c)
    out = F.when(c.isNull() | (F.trim(c) == ""), None)
    for n, word in ((1, "ONE"), (2, "TWO"), (3, "THREE")):
        out = out.when(t.rlike(rf"(^|[^0-9])({n}|{word})[ -]?(YEAR|YR)"), f"FREQUENCY_{n}Y")
    for label, spellings in VOTES.items():
        hit = t.isin(spellings)
        out = out.when(hit | F.startswith(t, F.lit("TAKE")) if label == "DID_NOT_VOTE" else hit, label)
    return out.otherwise("OTHER")


def against_management(vote: Column, recommendation: Column) -> Column:
    """Whether a decisive vote differs from a decisive recommendation; null where either isn't decisive."""
    v, r = how_voted(vote), F.upper(F.trim(recommendation))
    return F.when(v.isin("FOR", "AGAINST", "WITHHOLD") & r.isin("FOR", "AGAINST"), (v == "FOR") != (r == "FOR"))


def committee_indices(bits_hex: Column) -> Column:
    """Set positions of a bit vector given in hex: bit i is bit i % 8 of byte i div 8."""
    raw = F.regexp_replace(bits_hex, "^0x", "")
    nibble = lambda i: F.conv(F.substring(raw, F.floor(i / 8).cast("int") * 2 + 1, F.lit(2)), 16, 10).cast("int")
    places = F.sequence(F.lit(0), F.greatest(F.length(raw) * 4 - 1, F.lit(0)))
    return F.when(F.length(raw) > 0, F.filter(places, lambda i: F.getbit(nibble(i), (i % 8).cast("int")) == 1)).otherwise(F.array().cast("array<int>"))


def system_address_index(address: Column) -> Column:
    """The number in the last bytes of a system address 0x20 00 .. nn."""
    return F.when(address.rlike("^0x20[0-9a-f]{38}$"), F.conv(F.substring(address, 5, 38), 16, 10).cast("long"))


def event_log(line: Column) -> Column:
    """The JSON after 'EVENT_JSON:' as standard and event name; null for other lines and broken JSON."""
    body = F.when(F.startswith(line, F.lit("EVENT_JSON:")), F.substring(line, 12, 1 << 30))
    return F.struct(F.get_json_object(body, "$.standard").alias("standard"), F.get_json_object(body, "$.event").alias("event"))


def content_id(raw: Column) -> Column:
    return F.upper(F.sha2(raw, 256))


def payload_json(columns: list[str]) -> Column:
    """The row as JSON with its keys in order, nulls left out."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]))


def payload_hash(columns: list[str]) -> Column:
    return F.sha2(payload_json(columns), 256)


def window_number(ts: Column, seconds: int = 600) -> Column:
    return F.floor(F.unix_timestamp(ts) / seconds).cast("long")


def in_window(ts: Column, window: Column, seconds: int = 600) -> Column:
    s = F.unix_timestamp(ts)
    return (s >= window * seconds) & (s < (window + 1) * seconds)
