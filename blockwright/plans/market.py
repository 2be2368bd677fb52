"""Facts and views of an order-book chain: fills, liquidations, funding, outcome markets, ledger events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockwright.functions.labels import FORCED, NON_TRADE, ZERO_HASH, dex, market_type
from blockwright.functions.schema import AMOUNT
from blockwright.operators.aggregates import change_within, checked_sum, constant_or_null

OUTCOME_LEFT_OUT = ["fill_time", "market_type", "dex", "liquidated_user", "liquidation_mark_px", "liquidation_method"]


def with_market(fills: DataFrame) -> DataFrame:
    return fills.withColumns({"market_type": market_type(F.col("coin")), "dex": dex(F.col("coin"))})


def with_counterparty(fills: DataFrame) -> DataFrame:
    """counterparty, counterparty_direction, counterparty_fill_index: of two legs with one trade id in a block and coin, on different sides.

    Trade id 0 pairs nothing; those fills get a key of their own, so that a block of dust conversions is no hot group.
    """
    lone = F.when(F.col("transaction_id") == 0, F.col("fill_index"))
    w = Window.partitionBy("block_num", "coin", "transaction_id", lone)
    paired = (F.col("transaction_id") != 0) & (F.count("*").over(w) == 2) & (F.min("side").over(w) != F.max("side").over(w))
    ends = {"u": F.struct("fill_index", "user", "direction")}
    low, high = F.min(ends["u"]).over(w), F.max(ends["u"]).over(w)
    out = fills.withColumns({"_p": paired, "_low": low, "_high": high})
    other = F.when(F.col("_p"), F.when(F.col("_low.fill_index") == F.col("fill_index"), F.col("_high")).otherwise(F.col("_low")))
    out = out.withColumn("_o", other)
    return out.withColumns({"counterparty": F.col("_o.user"), "counterparty_direction": F.col("_o.direction"), "counterparty_fill_index": F.col("_o.fill_index")}).drop("_p", "_low", "_high", "_o")


def outcome_fills(fills: DataFrame) -> DataFrame:
    """Fills of outcome markets with their outcome and side numbers; needs with_market and with_counterparty."""
    n = F.substring("coin", 2, 40).try_cast("decimal(20,0)")
    rows = fills.where("market_type = 'outcome'").withColumns({"outcome_id": F.floor(n / 10).cast("long"), "side_index": (n % 10).cast("long")})
    return rows.drop(*OUTCOME_LEFT_OUT, "counterparty_direction", "counterparty_fill_index")


def liquidations(fills: DataFrame) -> DataFrame:
    """The liquidated legs with what their paired leg says."""
    return fills.where("liquidation_method is not null and user = liquidated_user").withColumnRenamed("liquidation_mark_px", "mark_price")


def funding_rates(deltas: DataFrame, headers: DataFrame) -> DataFrame:
    """Deltas rolled up by event and coin, with the event's ordinal among the funding events of its block, empty ones included.

    Both sides are dealt by block once, and a block's events are one list: a coin has few deltas an event, so sums made before a shuffle would be wider than
    the deltas and no fewer.
    """
    listed = headers.select("block_num", "event_index").repartition("block_num").groupBy("block_num").agg(F.sort_array(F.collect_list(F.struct("event_index"))).alias("_events"))
    size, amount = F.col("szi"), F.col("funding_amount")
    side = lambda when, x: checked_sum(F.when(when, x).otherwise(F.lit(0).cast(AMOUNT))).cast(AMOUNT)
    rolled = deltas.repartition("block_num").groupBy("block_num", "event_index", "coin").agg(
        constant_or_null(F.col("funding_rate")).alias("funding_rate"), F.count("*").alias("positions"),
        F.count_if(size > 0).alias("long_positions"), F.count_if(size < 0).alias("short_positions"),
        checked_sum(F.abs(size)).cast(AMOUNT).alias("open_interest"), side(size > 0, size).alias("long_size"), side(size < 0, -size).alias("short_size"),
        side(amount > 0, amount).alias("positive_funding"), side(amount < 0, amount).alias("negative_funding"))
    places = F.filter(F.transform("_events", lambda x, i: F.when(x["event_index"] == F.col("event_index"), i.cast("long"))), lambda i: i.isNotNull())
    return rolled.join(listed, "block_num").withColumn("dex_index", F.explode(places)).drop("_events").withColumn("dex", dex(F.col("coin")))


def fills_enriched(fills: DataFrame) -> DataFrame:
    """trade_id, tx_hash, side_bid_ask, is_taker, is_liquidated_side, is_non_trade, is_forced, notional beside each fill."""
    return fills.withColumns({
        "trade_id": F.nullif("transaction_id", F.lit(0)), "tx_hash": F.nullif("hash", F.lit(ZERO_HASH)),
        "side_bid_ask": F.when(F.col("side") == "BUY", "BID").otherwise("ASK"), "is_taker": F.col("crossed"),
        "is_liquidated_side": F.coalesce(F.col("liquidation_method").isNotNull() & (F.col("user") == F.col("liquidated_user")), F.lit(False)),
        "is_non_trade": F.col("direction").isin(NON_TRADE), "is_forced": F.col("direction").isin(FORCED), "notional": F.col("price") * F.col("size"),
    })


def trades(fills: DataFrame) -> DataFrame:
    """One row for each paired taker leg, settlements kept and flagged."""
    kind = F.col("market_type")
    family = F.when((kind == "perp") & (F.col("dex") == ""), "core").when(kind == "perp", "hip3").when(kind == "spot", "spot").when(kind == "outcome", "hip4")
    return fills.where("crossed and counterparty is not null").select(
        "block_num", "fill_index", "coin", family.alias("family"), "market_type", "dex", F.col("transaction_id").alias("trade_id"), F.nullif("hash", F.lit(ZERO_HASH)).alias("tx_hash"),
        "price", "size", (F.col("price") * F.col("size")).alias("notional"), F.col("side").alias("taker_side"), F.col("direction").alias("taker_direction"),
        (F.col("direction") == "SETTLEMENT").alias("is_settlement"), F.col("direction").isin(NON_TRADE).alias("is_non_trade"), F.col("user").alias("taker"), F.col("counterparty").alias("maker"), F.col("fee").alias("taker_fee"), F.col("fee_token").alias("taker_fee_token"))


def funding_rates_view(rates: DataFrame) -> DataFrame:
    """net_funding, net_position, the price the payments imply, and the change of open interest (null across a missing hour); ``ts``: epoch seconds, no earlier in a later block."""
    out = change_within(rates, ["coin"], "block_num", "ts", "open_interest", 61 * 60, "open_interest_change", width=24 * 60 * 60)
    rate, held = F.col("funding_rate").cast("double"), F.col("open_interest").cast("double")
    implied = F.when((F.col("funding_rate") != 0) & (F.col("open_interest") > 0), (F.col("positive_funding") - F.col("negative_funding")).cast("double") / (held * F.abs(rate)))
    return out.withColumns({"net_funding": F.col("positive_funding") + F.col("negative_funding"), "net_position": F.col("long_size") - F.col("short_size"), "funding_price_derived": implied})


def liquidations_view(legs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Kind, notional and the one ledger event of the same block, hash and account."""
    key = ["block_num", "hash", "account"]
    taken = ["event_index", "liquidated_ntl_pos", "account_value", "leverage_type"]
    events = ledger.where((F.col("ledger_type") == "liquidation") & (F.col("hash") != ZERO_HASH)).withColumn("account", F.get("users", F.lit(0)))
    single = events.groupBy(*key).agg(F.count("*").alias("_n"), *[F.any_value(c).alias(c) for c in taken]).where("_n = 1").drop("_n").withColumnRenamed("event_index", "ledger_event_index").withColumnRenamed("account", "liquidated_user")
    other = F.col("counterparty_direction")
    kind = F.when(F.col("liquidation_method") == "market", "market").when(other == "AUTO_DELEVERAGING", "adl").when(other.like("LIQUIDATED_%"), "backstop_takeover")
    return legs.withColumns({"notional": F.col("price") * F.col("size"), "liquidation_kind": kind}).join(single, ["block_num", "hash", "liquidated_user"], "left")


def liquidation_orders(view: DataFrame) -> DataFrame:
    return view.groupBy("block_num", "hash", "liquidated_user", "coin").agg(
        F.any_value("side").alias("side"), F.any_value("liquidation_kind").alias("liquidation_kind"), F.count("*").alias("fills"), F.sum("size").alias("size"), F.sum("notional").alias("notional"),
        (F.sum("notional").cast("double") / F.sum("size").cast("double")).alias("average_price"), F.any_value("mark_price").alias("mark_price"), F.any_value("ledger_event_index").alias("ledger_event_index"))


def outcome_matches(legs: DataFrame) -> DataFrame:
    """Pairs of a trade or settlement, and mints and burns: two adjacent single legs of one outcome's two sides whose prices add to 1."""
    w = Window.partitionBy("block_num", "coin", "transaction_id")
    pair = legs.where("counterparty is not null").withColumn("_all", F.collect_list(F.struct("fill_index", "user", "crossed")).over(w))
    maker = F.get(F.filter("_all", lambda x: x["fill_index"] != F.col("fill_index")), 0)
    pairs = pair.where("crossed").withColumn("_m", maker).where("_m is not null").select(
        "block_num", "hash", "outcome_id", F.when(F.col("direction") == "SETTLEMENT", "settlement").otherwise("trade").alias("match_type"), F.col("fill_index").alias("taker_fill_index"),
        F.col("_m.fill_index").alias("maker_fill_index"), F.col("user").alias("taker"), F.col("_m.user").alias("maker"), F.col("coin").alias("taker_coin"), F.col("price").alias("taker_price"), "size")
    single = legs.where("counterparty is null and direction in ('BUY', 'SELL')")
    key = ["block_num", "hash", "side", "size", "outcome_id"]
    a = single.select(*key, *[F.col(c).alias(f"a_{c}") for c in ("fill_index", "side_index", "price", "crossed", "user", "coin")])
    b = single.select(*key, *[F.col(c).alias(f"b_{c}") for c in ("fill_index", "side_index", "price", "crossed", "user", "coin")], (F.col("fill_index") - 1).alias("a_fill_index"))
    shape = F.expr("(side = 'BUY' AND NOT a_crossed AND b_crossed) OR (side = 'ASK' AND a_crossed AND NOT b_crossed)")
    two = a.join(b, [*key, "a_fill_index"]).where((F.col("a_side_index") != F.col("b_side_index")) & (F.col("a_price") + F.col("b_price") == 1) & shape)
    pick = lambda c, taker: F.when(F.col("a_crossed") == F.lit(taker), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}"))
    minted = two.select("block_num", "hash", "outcome_id", F.when(F.col("side") == "BUY", "mint").otherwise("burn").alias("match_type"), pick("fill_index", True).alias("taker_fill_index"), pick("fill_index", False).alias("maker_fill_index"),
                        pick("user", True).alias("taker"), pick("user", False).alias("maker"), pick("coin", True).alias("taker_coin"), pick("price", True).alias("taker_price"), "size")
    return pairs.unionByName(minted)


def outcome_actions(legs: DataFrame) -> DataFrame:
    chosen = legs.where(F.col("direction").isin("SPLIT_OUTCOME", "MERGE_OUTCOME", "NEGATE_OUTCOME", "MERGE_QUESTION"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("fill_index", "coin", "side", "price", "fee"))), lambda x: F.struct(x["coin"].alias("coin"), x["side"].alias("side"), x["price"].alias("price"), x["fee"].alias("fee")))
    return chosen.groupBy("block_num", "hash", "direction").agg(F.min_by("user", "fill_index").alias("account"), F.min_by("size", "fill_index").alias("size"), F.count("*").alias("legs"), F.array_sort(F.collect_set("outcome_id")).alias("outcome_ids"), rows.alias("leg_list")).withColumn("action_type", F.lower("direction")).drop("direction")


def outcome_settlements(legs: DataFrame) -> DataFrame:
    """The settle fraction is the price of side 0's settlement, or what side 1's leaves of 1."""
    asked = F.col("side") == "ASK"
    price = lambda side: F.max(F.when(asked & (F.col("side_index") == side), F.col("price")))
    return legs.where("direction = 'SETTLEMENT'").groupBy("outcome_id").agg(F.min("block_num").alias("settled_block"), F.coalesce(price(0), 1 - price(1)).alias("settle_fraction"), F.count_if(asked).alias("settled_positions"), F.sum(F.when(asked, F.col("size"))).alias("settled_shares"))


def outcome_positions(legs: DataFrame) -> DataFrame:
    """Shares of each account and side after its latest fill; the buying leg of a settlement retires shares and is left out."""
    after = F.col("start_position") + F.when(F.col("side") == "BUY", F.col("size")).otherwise(-F.col("size"))
    held = legs.where("NOT (direction = 'SETTLEMENT' AND side = 'BUY')")
    return held.groupBy("user", "coin", "outcome_id", "side_index").agg(F.max_by(after, F.struct("block_num", "fill_index")).alias("shares"), F.max("block_num").alias("last_block_num"))


def outcome_open_interest(positions: DataFrame) -> DataFrame:
    return positions.where("shares > 0").groupBy("coin", "outcome_id", "side_index").agg(F.sum("shares").alias("open_interest"), F.count("*").alias("holders"))


def _user(i: int) -> Column:
    return F.get("users", F.lit(i))


def transfers_view(t: DataFrame) -> DataFrame:
    kind = F.col("ledger_type")
    balance = lambda own, perp, spot: F.when(kind == "send", F.col(own)).when(kind == "spot_transfer", "spot").when(kind == "account_class_transfer", F.when(F.col("to_perp"), perp).otherwise(spot)).otherwise("")
    return t.select("block_num", "event_index", kind.alias("transfer_type"), F.coalesce("user", _user(0)).alias("sender"), F.coalesce("destination", _user(0)).alias("recipient"), balance("source_dex", "spot", "").alias("source_balance"), balance("destination_dex", "", "spot").alias("destination_balance"),
                    F.coalesce("token", F.lit("USDC")).alias("token"), F.coalesce("amount", "usdc").alias("quantity"), F.coalesce("fee_token", F.when(kind == "internal_transfer", "USDC")).alias("fee_token"))


def bridge_transfers_view(t: DataFrame) -> DataFrame:
    return t.select("block_num", "event_index", "ledger_type", _user(0).alias("account"), F.when(F.col("ledger_type") == "deposit", F.col("usdc")).otherwise(-F.col("usdc")).alias("signed_usdc"))


def vault_events_view(v: DataFrame) -> DataFrame:
    """The vault (a leader's commission takes that of the withdrawal with its hash, if it is one vault), the account, the vault's own total."""
    known = v.where((F.col("ledger_type") == "vault_withdraw") & (F.col("hash") != ZERO_HASH)).groupBy("block_num", "hash").agg(F.min("vault").alias("_v"), F.count_distinct("vault").alias("_n")).where("_n = 1")
    both = v.join(known.withColumn("ledger_type", F.lit("vault_leader_commission")), ["block_num", "hash", "ledger_type"], "left")
    spread = F.col("ledger_type") == "vault_distribution"
    account = F.when(spread, F.nullif(_user(0), F.col("vault"))).otherwise(F.coalesce(F.col("user"), F.get(F.filter("users", lambda u: u != F.col("vault")), 0)))
    return both.select("block_num", "event_index", "ledger_type", F.coalesce("vault", "_v").alias("vault"), account.alias("account"), F.coalesce(spread & (_user(0) == F.col("vault")), F.lit(False)).alias("is_vault_total"), "usdc")


def staking_flows(s: DataFrame) -> DataFrame:
    moved = s.where("ledger_type = 'c_staking_transfer'").select("block_num", "event_index", _user(0).alias("account"), F.when(F.col("is_deposit"), "stake").otherwise("unstake").alias("flow"), "token", "amount")
    given = s.where("event_type = 'delegation'").select("block_num", "event_index", F.col("user").alias("account"), F.when(F.col("is_undelegate"), "undelegate").otherwise("delegate").alias("flow"), F.lit("HYPE").alias("token"), "amount")
    return moved.unionAll(given)


def account_events(events: DataFrame) -> DataFrame:
    """One row for each event and account it names."""
    kept = ["block_num", "event_index", "event_type", "ledger_type"]
    listed = events.where("event_type = 'ledger_update'").select(*kept, F.explode("users").alias("account"))
    own = events.where("event_type IN ('c_deposit', 'c_withdrawal', 'delegation', 'create_sub_account')").select(*kept, F.col("user").alias("account"))
    return listed.unionAll(own)


# The body columns of each ledger type, beside block, event and users.
LEDGER_COLUMNS = {
    "spot_transfer": "token amount usdc_value user destination fee native_token_fee nonce fee_token", "c_staking_transfer": "token amount is_deposit", "account_class_transfer": "usdc to_perp",
    "internal_transfer": "usdc user destination fee", "sub_account_transfer": "usdc user destination", "send": "user destination source_dex destination_dex token amount usdc_value fee native_token_fee nonce fee_token",
    "deposit": "usdc", "withdraw": "usdc nonce fee", "vault_deposit": "vault usdc", "rewards_claim": "amount token", "vault_withdraw": "vault user requested_usd commission closing_cost basis net_withdrawn_usd",
    "vault_leader_commission": "user usdc", "deploy_gas_auction": "token amount", "account_activation_gas": "amount token", "activate_dex_abstraction": "dex token amount",
    "liquidation": "liquidated_ntl_pos account_value leverage_type liquidated_positions", "spot_genesis": "token amount", "vault_distribution": "vault usdc", "borrow_lend": "token amount interest_amount operation",
    "vault_create": "vault usdc fee", "gossip_priority_gas_auction": "token amount", "hip3_liquidator_deposit": "dex token amount",
}
BODY_COLUMNS = {
    "c_deposit": "user amount", "c_withdrawal": "user amount is_finalized", "delegation": "user validator amount is_undelegate", "gossip_priority_auction_restart": "slot_id previous_winner_ip end_gas", "create_sub_account": "user sub_account sub_account_name",
}


def ledger_view(events: DataFrame, ledger_type: str) -> DataFrame:
    """The events of one ledger type with its own columns; a liquidation names its account."""
    more = [_user(0).alias("liquidated_account")] if ledger_type == "liquidation" else []
    own = [c for c in LEDGER_COLUMNS[ledger_type].split() if c in events.columns]
    return events.where(F.col("ledger_type") == ledger_type).select("block_num", "event_index", "hash", "users", *more, *own)


def body_view(events: DataFrame, event_type: str) -> DataFrame:
    own = [c for c in BODY_COLUMNS[event_type].split() if c in events.columns]
    return events.where(F.col("event_type") == event_type).select("block_num", "event_index", "hash", *own)
