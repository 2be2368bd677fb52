"""Facts of the chain against reference tables, and links between change logs over the time they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blockwright.operators.changelog import history
from blockwright.operators.joins import asof_join

FOREVER = (1 << 63) - 1
#: Addresses that move a token between ledgers are this prefix and the token's index in hex.
SYSTEM_PREFIX, INDEX_FROM = "0x20000000000000000000000000000000000", 35


def spot_pair_differences(fills: DataFrame, pairs: DataFrame) -> DataFrame:
    """Coins whose fee tokens, where each side has one only, aren't their pair's symbols, and coins of no pair (coin, base_symbol, quote_symbol)."""
    taken = fills.where("crossed AND market_type = 'spot'")
    tokens = lambda side: F.array_sort(F.collect_set(F.when(F.col("side") == side, F.col("fee_token"))))
    seen = taken.groupBy("coin").agg(tokens("BUY").alias("base_fee_tokens"), tokens("ASK").alias("quote_fee_tokens"))
    both = seen.join(pairs.select("coin", "base_symbol", "quote_symbol", F.lit(True).alias("_pair")), "coin", "left")
    differs = lambda tokens, symbol: (F.size(tokens) == 1) & (F.get(tokens, F.lit(0)) != F.col(symbol))
    bad = F.col("_pair").isNull() | F.coalesce(differs("base_fee_tokens", "base_symbol"), F.lit(False)) | F.coalesce(differs("quote_fee_tokens", "quote_symbol"), F.lit(False))
    return both.where(bad).drop("_pair")


def settlement_differences(settlements: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcomes whose settle fraction isn't the reference's: outcome_id, lake_fraction, settle_fraction (null where it has none)."""
    lake = settlements.select("outcome_id", F.col("settle_fraction").alias("lake_fraction"))
    return lake.join(outcomes.select("outcome_id", "settle_fraction"), "outcome_id", "left").where(~F.col("settle_fraction").eqNullSafe(F.col("lake_fraction")))


def dex_differences(rates: DataFrame, dexes: DataFrame) -> DataFrame:
    """Funding indexes that carry several exchanges' names, or another name than the reference's: dex_index, lake_names, name."""
    lake = rates.groupBy("dex_index").agg(F.array_sort(F.collect_set("dex")).alias("lake_names"))
    both = lake.join(dexes.select("dex_index", "name"), "dex_index", "left")
    return both.where((F.size("lake_names") != 1) | ~F.get("lake_names", F.lit(0)).eqNullSafe(F.col("name")))


def token_differences(events: DataFrame, tokens: DataFrame) -> DataFrame:
    """Tokens moved by a system address that isn't that of their index in the reference: token, lake_index."""
    moved = events.where("ledger_type IN ('spot_transfer', 'send')")
    address = moved.select("token", F.explode(F.array("user", "destination")).alias("address")).where(F.startswith("address", F.lit(SYSTEM_PREFIX)))
    seen = address.groupBy("token").agg(F.min(F.conv(F.substring("address", INDEX_FROM, 64), 16, 10).cast("long")).alias("lake_index"))
    return seen.join(tokens.select(F.col("name").alias("token"), F.col("token_index").alias("lake_index")), ["token", "lake_index"], "left_anti")


def unknown_links(child: DataFrame, parent: DataFrame, link: str, parent_key: str) -> DataFrame:
    """Links of a change log that no row of the other ever had: link, rows."""
    named = child.where(F.col(link).isNotNull()).groupBy(link).agg(F.count("*").alias("rows"))
    return named.join(parent.select(F.col(parent_key).alias(link)).distinct(), link, "left_anti")


def uncovered_links(child: DataFrame, parent: DataFrame, key: list[str], link: str, parent_key: str, time: str = "observed_at", width: int | None = None) -> DataFrame:
    """Times at which a listed entity named a parent that wasn't listed: key, link, valid_from, valid_to, covered.

    Each row of a change log holds until the entity's next. A parent's listed intervals don't overlap, so what it was listed up to a time is the sum of
    those before and the part of the last one up to there, and a child's interval is covered by the difference between its ends. So each end looks up one
    interval, whatever the number of rows of a link; ``width`` (in units of time) as in ``asof_join``. An interval that never ends has no valid_to.
    """
    def spans(log: DataFrame, by: list[str]) -> DataFrame:
        return history(log, by, time).where("listed").withColumn("_to", F.coalesce(F.col("valid_to").cast("long"), F.lit(FOREVER))).withColumn("_from", F.col("valid_from").cast("long")).where("_from < _to")

    exact = lambda c: F.col(c).cast("decimal(38,0)")
    own = spans(child, key).where(F.col(link).isNotNull()).select(*key, link, "valid_from", "valid_to", "_from", "_to")
    over = spans(parent, [parent_key]).select(F.col(parent_key).alias(link), F.col("_from").alias("_a"), F.col("_to").alias("_b"))
    earlier = Window.partitionBy(link).orderBy("_a").rowsBetween(Window.unboundedPreceding, -1)
    over = over.withColumn("_sum", F.coalesce(F.sum(exact("_b") - exact("_a")).over(earlier), F.lit(0)).cast("decimal(38,0)"))
    ends = own.withColumn("_end", F.explode(F.array(F.struct(F.lit(-1).alias("sign"), F.col("_from").alias("at")), F.struct(F.lit(1).alias("sign"), F.col("_to").alias("at"))))).withColumn("_at", F.col("_end.at"))
    seen = asof_join(ends, over, [link], "_at", "_a", ["_a", "_b", "_sum"], width)
    listed = F.coalesce(F.col("_sum") + F.least(exact("_at"), exact("_b")) - exact("_a"), F.lit(0))
    both = seen.groupBy(*key, link, "valid_from", "valid_to", "_from", "_to").agg(F.sum(F.col("_end.sign") * listed).alias("covered"))
    return both.where(F.col("covered") < (exact("_to") - exact("_from"))).select(*key, link, "valid_from", "valid_to", F.col("covered").cast("long").alias("covered"))
