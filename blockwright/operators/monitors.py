"""Data-quality monitors of an order-book chain: observations that hold in sound tables, each violation a row.

A row's violated rules are one array, exploded once. Rules that look at the row alone shuffle nothing; those that look at groups
(legs of a match, child rows, links) meet them with the few columns that they compare. Rules are SQL over the source's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockwright.functions.labels import ZERO_HASH, dex, event_table, market_type

_HASH = "hash <> '{zero}' AND (substr(hash, 23, 2) <> '04' OR substr(hash, 25, 8) <> lpad(lower(hex(block_num)), 8, '0'))".format(zero=ZERO_HASH)

# What breaks each observation, by source.
FILLS = {
    "M1": "fill_time <> timestamp",
    "M4": _HASH,
    "M5": "length(user) <> 42 OR length(hash) <> 66 OR length(client_order_id) <> 34 OR length(liquidated_user) <> 42 OR length(counterparty) <> 42",
    "M7": "builder IS NOT NULL AND NOT builder RLIKE '^0x[0-9a-f]{40}$'",
    "M11": "liquidation_method IS NOT NULL AND liquidated_user IS NULL",
    "M13": "extra_json IS NOT NULL",
    "M14": "counterparty IS NOT NULL AND _legs > 1 AND (NOT _agree OR _crossed <> 1 OR _apart <> 1 OR _other <> counterparty)",
    "M15": "transaction_id <> 0 AND counterparty IS NULL AND NOT market_type <=> 'outcome'",
    "M16": "liquidation_method IS NOT NULL AND transaction_id <> 0 AND fill_index = _first_liquidated AND _liquidated <> 1",
    "M19": "market_type IS NULL OR NOT market_type <=> _market_type OR NOT dex <=> _dex",
}
EVENTS = {
    "M4e": f"coalesce(ledger_type, '') NOT IN ('deposit', 'withdraw') AND {_HASH}",
    "M5e": "length(hash) <> 66 OR length(user) <> 42 OR length(destination) <> 42 OR length(vault) <> 42 OR length(validator) <> 42 OR length(sub_account) <> 42 OR exists(users, u -> length(u) <> 42)",
    "M6": "event_type = 'ledger_update' AND size(users) NOT IN (1, 2)",
    "M10": "event_type = 'gossip_priority_auction_restart' AND (previous_winner_ip IS NULL) <> (end_gas IS NULL)",
    "M12": "ledger_type IN ('send', 'spot_transfer') AND (fee_token IS NULL) <> (fee = 0)",
    "M13": "extra_json IS NOT NULL",
    "M21": "NOT _table <=> table_name",
    "M23": "token RLIKE '^[+#][0-9]+$'",
}
# ... and of events beside what their block, their child rows and their link say.
TIMES = {"M2": "event_time_ns <> block_time_ns"}
ITEMS = {"M8i": "item_count <> coalesce(_items, 0)"}
BLOCKS = {"M8f": "fill_count <> coalesce(_fills, 0)", "M8e": "event_count <> coalesce(_events, 0)", "M13": "extra_json IS NOT NULL"}
RATES = {"M17": "funding_rate IS NULL", "M20": "abs(long_size - short_size) > open_interest * 0.000001", "M13": "extra_json IS NOT NULL"}


def violations(df: DataFrame, rules: dict[str, str], key: str) -> DataFrame:
    """monitor, block_num and key of every rule a row breaks; a rule that can't tell (null) isn't broken."""
    broken = F.array_compact(F.array(*[F.when(F.expr(sql), F.lit(name)) for name, sql in rules.items()]))
    return df.select("block_num", F.col(key).cast("string").alias("key"), F.explode(broken).alias("monitor")).select("monitor", F.col("block_num").cast("long").alias("block_num"), "key")


def with_match(fills: DataFrame) -> DataFrame:
    """Each fill with what its match (block, coin, trade id; a fill without trade id is alone) looks like, in one window."""
    w = Window.partitionBy("block_num", "coin", "transaction_id", F.when(F.col("transaction_id") == 0, F.col("fill_index")))
    leg = F.struct("fill_index", "user")
    low, high = F.min(leg).over(w), F.max(leg).over(w)
    liquidated = F.col("liquidation_method").isNotNull()
    agree = [F.coalesce(F.min(c).over(w) == F.max(c).over(w), F.lit(True)) for c in ("price", "size", "hash")]
    return fills.withColumns({
        "_legs": F.count("*").over(w), "_agree": agree[0] & agree[1] & agree[2], "_crossed": F.count_if("crossed").over(w), "_apart": high["fill_index"] - low["fill_index"],
        "_other": F.when(low["fill_index"] == F.col("fill_index"), high["user"]).otherwise(low["user"]),
        "_first_liquidated": F.min(F.when(liquidated, F.col("fill_index"))).over(w), "_liquidated": F.count_if(liquidated & (F.col("user") == F.col("liquidated_user"))).over(w),
        "_market_type": market_type(F.col("coin")), "_dex": dex(F.col("coin")),
    })


def unpaired_trades(fills: DataFrame) -> DataFrame:
    """M9: trade ids outside outcome markets that aren't two neighbouring legs, the buyer first and one crossed."""
    legs = fills.where("transaction_id <> 0 AND NOT market_type <=> 'outcome'").groupBy("block_num", "transaction_id").agg(
        F.count("*").alias("n"), F.count_if("crossed").alias("crossed"), F.min_by(F.col("side") != "BUY", "fill_index").alias("first"), (F.max("fill_index") - F.min("fill_index")).alias("apart"))
    return violations(legs, {"M9": "n <> 2 OR crossed <> 1 OR first OR apart <> 1"}, "transaction_id")


def coins_without_rate(fills: DataFrame, rates: DataFrame, hour: int = 3600) -> DataFrame:
    """M22: (block_num, coin) of perps traded in the hour before a funding block that has no rate of theirs.

    Trades are cut down to each coin's first and last second in every hour, which is all the range needs: a funding block's hour
    before it spans the rest of one clock hour and the start of the next. So the join has an equality key and no pairs of fills.
    """
    seconds = lambda c: F.unix_timestamp(c)
    spans = fills.where("market_type = 'perp'").groupBy("coin", F.floor(seconds(F.col("timestamp")) / hour).alias("h")).agg(F.min(seconds(F.col("timestamp"))).alias("first"), F.max(seconds(F.col("timestamp"))).alias("last"))
    paid = rates.select("block_num", seconds(F.col("timestamp")).alias("t")).distinct()
    own = F.floor(F.col("t") / hour)
    at = paid.withColumn("h", F.explode(F.array(own, own - 1)))
    near = at.join(spans, "h").where((F.col("h") == own) & (F.col("first") < F.col("t")) | (F.col("h") < own) & (F.col("last") >= F.col("t") - hour))
    return near.select("block_num", "coin").distinct().join(rates.select("block_num", "coin"), ["block_num", "coin"], "left_anti")


def monitors(tables: dict[str, DataFrame]) -> DataFrame:
    """All violations: monitor, block_num, key (the row's index, trade id, coin or dex index).

    ``tables``: blocks, fills, events (all event tables, told apart by ``table_name``), funding_rates, and of these as many as there
    are: ``items`` (block_num, event_index of every child row of events), ``links`` (block_num, ledger_event_index), and other tables with
    extra_json and an index, as name -> (table, index). A match of other than two legs that claims a counterparty breaks M14. Fills that went
    through ``with_match`` already, say in the pass that paired them, are taken as they are.
    """
    blocks, fills, events, rates = (tables[n] for n in ("blocks", "fills", "events", "funding_rates"))
    matched = fills if "_legs" in fills.columns else with_match(fills)
    place = ["block_num", "event_index"]
    timed = events.select(*place, "event_time_ns").join(blocks.select("block_num", "block_time_ns"), "block_num")
    beside = [violations(timed, TIMES, "event_index")]
    if "items" in tables:
        counts = tables["items"].select(*place).repartition(*place).groupBy(*place).agg(F.count("*").alias("_items"))
        beside.append(violations(events.where("item_count IS NOT NULL").select(*place, "item_count").join(counts, place, "left"), ITEMS, "event_index"))
    if "links" in tables:
        linked = tables["links"].select("block_num", F.col("ledger_event_index").alias("event_index"))
        beside.append(violations(events.where("ledger_type = 'liquidation'").select(*place).join(linked, place, "left_anti"), {"M16e": "true"}, "event_index"))
    routed = events.withColumn("_table", event_table(F.col("event_type"), F.col("ledger_type")))
    counted = blocks.join(fills.groupBy("block_num").agg(F.count("*").alias("_fills")), "block_num", "left").join(events.groupBy("block_num").agg(F.count("*").alias("_events")), "block_num", "left")
    funding = events.where("event_type = 'funding'").groupBy("block_num").agg(F.max("event_index").alias("last"), F.count("*").alias("n"))
    dexes = rates.groupBy("dex_index").agg(F.count_distinct("dex").alias("n"), F.min("block_num").alias("block_num"))
    parts = [
        violations(matched, FILLS, "fill_index"), violations(routed, EVENTS, "event_index"), *beside, violations(counted, BLOCKS, "block_num"), violations(rates, RATES, "coin"), unpaired_trades(fills),
        violations(funding, {"M3": "last <> n - 1"}, "n"), violations(dexes, {"M18": "n > 1"}, "dex_index"), violations(coins_without_rate(fills, rates), {"M22": "true"}, "coin"),
    ]
    parts += [violations(df, {"M13": "extra_json IS NOT NULL"}, index) for df, index in (x for x in tables.values() if isinstance(x, tuple))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
