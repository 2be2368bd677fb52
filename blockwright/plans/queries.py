"""Registered queries: each applies operators of the library to whole tables; its oracle is SQL written apart from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockwright.functions import labels as L
from blockwright.functions import parse as P
from blockwright.functions import schema as S
from blockwright.operators import aggregates as A
from blockwright.operators import changelog as G
from blockwright.operators import flatten as FL
from blockwright.operators import forks, joins, layout, outcome, quality
from blockwright.plans import filings as SEC
from blockwright.plans import market as M
from blockwright.plans.adapters import adapted, with_adapters
from blockwright.sources import tables as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and lists as text, so that results of two engines compare."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            out[f.name] = F.col(f.name).cast("long")
        elif isinstance(f.dataType, T.DateType):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.ArrayType):
            out[f.name] = F.array_join(F.col(f.name).cast("array<string>"), ",")
    return df.withColumns(out) if out else df


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            S.configure(spark)
            return plain(f(spark, sf_dir))

        QUERIES[name] = run
        if sql:
            ORACLE[name] = with_adapters(sql)
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.with_counterparty(M.with_market(adapted(spark, sf_dir, "fills")))


# ---- SQL of the fact tables, for the oracles ----
_FACTS = r"""facts AS (SELECT f.*,
  CASE WHEN regexp_full_match(coin, '#[0-9]+') THEN 'outcome' WHEN regexp_full_match(coin, '@[0-9]+|[A-Za-z0-9]+/[A-Za-z0-9]+') THEN 'spot' WHEN regexp_full_match(coin, '([a-z][a-z0-9]*:)?[A-Za-z0-9]+') THEN 'perp' END AS market_type,
  CASE WHEN regexp_full_match(coin, '([a-z][a-z0-9]*:)?[A-Za-z0-9]+') THEN CASE WHEN position(':' IN coin) > 0 THEN split_part(coin, ':', 1) ELSE '' END END AS dex,
  o.user AS counterparty, o.direction AS counterparty_direction, o.fill_index AS counterparty_fill_index
  FROM fills f LEFT JOIN (SELECT block_num, coin, transaction_id FROM fills WHERE transaction_id <> 0 GROUP BY ALL HAVING count(*) = 2 AND count(DISTINCT side) = 2) g USING (block_num, coin, transaction_id)
  LEFT JOIN fills o ON g.block_num IS NOT NULL AND o.block_num = f.block_num AND o.coin = f.coin AND o.transaction_id = f.transaction_id AND o.fill_index <> f.fill_index)"""
_LEGS = r"""legs4 AS (SELECT *, CAST(substr(coin, 2) AS BIGINT) // 10 AS outcome_id, CAST(substr(coin, 2) AS BIGINT) % 10 AS side_index FROM facts WHERE market_type = 'outcome')"""
_RATES = r"""rates AS (SELECT d.block_num, d.event_index, coin, CASE WHEN count(DISTINCT funding_rate) = 1 THEN min(funding_rate) END AS funding_rate, count(*) AS positions, count(*) FILTER (WHERE szi > 0) AS long_positions, count(*) FILTER (WHERE szi < 0) AS short_positions,
  sum(abs(szi)) AS open_interest, coalesce(sum(szi) FILTER (WHERE szi > 0), 0) AS long_size, coalesce(-sum(szi) FILTER (WHERE szi < 0), 0) AS short_size, coalesce(sum(funding_amount) FILTER (WHERE funding_amount > 0), 0) AS positive_funding, coalesce(sum(funding_amount) FILTER (WHERE funding_amount < 0), 0) AS negative_funding,
  any_value(h.dex_index) AS dex_index FROM funding_deltas d JOIN (SELECT block_num, event_index, row_number() OVER (PARTITION BY block_num ORDER BY event_index) - 1 AS dex_index FROM funding_headers) h USING (block_num, event_index) GROUP BY ALL)"""


def outcome_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.outcome_fills(fills(spark, sf_dir))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.funding_rates(adapted(spark, sf_dir, "funding_deltas"), adapted(spark, sf_dir, "funding_headers"))


# ---- fork history ----
@query("v1_live_head", "SELECT block_num, block_id, stream_ordinal, event_type FROM (SELECT *, row_number() OVER (PARTITION BY block_num ORDER BY stream_ordinal DESC) AS r FROM (SELECT *, row_number() OVER (PARTITION BY block_num, block_id ORDER BY stream_ordinal DESC) AS n FROM hist) WHERE n = 1 AND fork_step <> 'UNDO') WHERE r = 1")
def v1(spark, d):
    return forks.live_head(adapted(spark, d, "hist")).select("block_num", "block_id", "stream_ordinal", "event_type")


@query("v1_live_rows", "SELECT h.stream_ordinal, h.user_id FROM hist h WHERE EXISTS (SELECT 1 FROM (SELECT block_num, max(stream_ordinal) AS o FROM (SELECT block_num, block_id, max(stream_ordinal) AS stream_ordinal, arg_max(fork_step, stream_ordinal) AS s FROM hist GROUP BY ALL) WHERE s <> 'UNDO' GROUP BY ALL) x WHERE x.o = h.stream_ordinal)")
def v1_rows(spark, d):
    h = adapted(spark, d, "hist")
    return forks.live_rows(h, forks.live_head(h)).select("stream_ordinal", "user_id")


@query("st5_skip_below", "SELECT count(*) AS n, min(block_num) AS low FROM hist WHERE block_num >= 40")
def st5(spark, d):
    return forks.skip_below(adapted(spark, d, "hist"), 40).agg(F.count("*").alias("n"), F.min("block_num").alias("low"))


# ---- facts inside a block ----
@query("d1_market_class", "WITH " + _FACTS + " SELECT block_num, fill_index, market_type, dex FROM facts")
def d1(spark, d):
    return M.with_market(adapted(spark, d, "fills")).select("block_num", "fill_index", "market_type", "dex")


@query("d2_counterparty", "WITH " + _FACTS + " SELECT block_num, fill_index, counterparty, counterparty_fill_index FROM facts")
def d2(spark, d):
    return fills(spark, d).select("block_num", "fill_index", "counterparty", "counterparty_fill_index")


@query("d3_outcome_fills", "WITH " + _FACTS + ", " + _LEGS + " SELECT block_num, fill_index, outcome_id, side_index, price::DOUBLE AS price FROM legs4")
def d3(spark, d):
    return outcome_legs(spark, d).select("block_num", "fill_index", "outcome_id", "side_index", "price")


@query("d4_liquidations", "WITH " + _FACTS + " SELECT block_num, fill_index, liquidated_user, counterparty, counterparty_direction, liquidation_mark_px::DOUBLE AS mark_price FROM facts WHERE liquidation_method IS NOT NULL AND \"user\" = liquidated_user")
def d4(spark, d):
    return M.liquidations(fills(spark, d)).select("block_num", "fill_index", "liquidated_user", "counterparty", "counterparty_direction", "mark_price")


@query("d5_funding_rates", "WITH " + _RATES + " SELECT block_num, event_index, coin, dex_index, funding_rate::DOUBLE AS funding_rate, positions, long_positions, short_positions, open_interest::DOUBLE AS open_interest, long_size::DOUBLE AS long_size, short_size::DOUBLE AS short_size, positive_funding::DOUBLE AS positive_funding, negative_funding::DOUBLE AS negative_funding, '' AS dex FROM rates")
def d5(spark, d):
    return rates(spark, d)


@query("d6_child_counts", "SELECT conv_id, count(*) AS item_count FROM conversations GROUP BY conv_id")
def d6(spark, d):
    return FL.with_child_counts(nested(spark, d), {"item_count": "items"}).select("conv_id", "item_count")


@query("d7_ownership_facts", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey WHEN o_orderkey % 3 = 1 THEN -o_custkey END::DOUBLE AS signed_shares, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey * CAST(round(o_totalprice, 2) AS DECIMAL(18,2)) END::DOUBLE AS value_usd, o_orderkey % 2 = 0 AND o_orderkey % 5 IN (0, 1) AS is_open_market, o_orderkey % 7 = 1 OR o_orderkey % 7 = 3 AS any_owner_is_officer, CASE WHEN o_orderkey % 7 = 1 THEN 'CEO' WHEN o_orderkey % 7 = 3 THEN 'CFO' ELSE '' END AS officer_titles FROM orders")
def d7(spark, d):
    rows = read(spark, d, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'D' END AS acquired_disposed_code", "cast(o_custkey AS decimal(38,6)) AS shares", "CASE WHEN o_orderkey % 4 <> 0 THEN cast(cast(round(o_totalprice, 2) AS decimal(18,2)) AS decimal(38,6)) END AS price_per_share",
        "o_orderkey % 2 <> 0 AS is_derivative", "CASE o_orderkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'S' WHEN 2 THEN 'G' END AS transaction_code", "cast(o_orderdate AS date) AS filing_date", "cast(o_orderdate AS date) AS transaction_date",
        "array(named_struct('cik', cast(o_custkey AS string), 'is_officer', o_orderkey % 7 = 1, 'is_director', false, 'title', 'CEO'), named_struct('cik', 'x', 'is_officer', o_orderkey % 7 = 3, 'is_director', true, 'title', 'CFO')) AS owners")
    return SEC.ownership_facts(rows).select("o_orderkey", "signed_shares", "value_usd", "is_open_market", "any_owner_is_officer", "officer_titles")


@query("d8_header_party", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'i' WHEN o_orderkey % 2 = 0 THEN 'f' END AS cik FROM orders")
def d8(spark, d):
    parties = "filter(array(named_struct('role', 'FILER', 'cik', 'f'), named_struct('role', CASE WHEN o_orderkey % 3 = 0 THEN 'ISSUER' END, 'cik', 'i'), named_struct('role', 'SUBJECT-COMPANY', 'cik', CASE WHEN o_orderkey % 3 = 0 THEN 's' END)), p -> p.cik IS NOT NULL AND p.role IS NOT NULL)"
    rows = read(spark, d, "orders").select("o_orderkey", F.expr(parties).alias("parties"))
    return rows.select("o_orderkey", SEC.header_party(F.col("parties"), ["ISSUER", "SUBJECT-COMPANY"], "FILER", F.col("o_orderkey") % 2 == 0)["cik"].alias("cik"))


@query("d9_value_multiplier", "SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) < DATE '2023-01-03' THEN 1000 ELSE 1 END::BIGINT AS m FROM orders")
def d9(spark, d):
    return read(spark, d, "orders").select("o_orderkey", SEC.value_multiplier_rule(F.col("o_orderdate").cast("date"), F.lit(None).cast("date")).alias("m"))


@query("d10_holdings_totals", "SELECT o.o_orderkey, coalesce(n, 0) AS holdings_count, s AS holdings_value_sum, coalesce(n, 0) >= 4 AS holdings_complete FROM (SELECT DISTINCT o_orderkey FROM orders) o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_partkey)::BIGINT AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def d10(spark, d):
    r = read(spark, d, "orders").select(F.col("o_orderkey").alias("block_num"), F.lit(0).alias("filing_index"), F.lit(4).alias("table_entry_total")).distinct()
    h = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("block_num"), F.lit(0).alias("filing_index"), F.col("l_partkey").alias("value"))
    return SEC.holdings_totals(r, h).select(F.col("block_num").alias("o_orderkey"), "holdings_count", "holdings_value_sum", "holdings_complete")


@query("d11_notice_totals", "SELECT l_orderkey, sum(CAST(round(l_quantity, 2) AS DECIMAL(18,2)))::DOUBLE AS total FROM lineitem GROUP BY 1")
def d11(spark, d):
    lots = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.round("l_quantity", 2).cast("decimal(38,6)").alias("units"))).alias("lots"))
    return SEC.notice_totals(lots, F.col("lots"), "units").select("l_orderkey", "total")


# ---- market views ----
@query("v2_fills_enriched", "WITH " + _FACTS + " SELECT block_num, fill_index, nullif(transaction_id, 0) AS trade_id, CASE side WHEN 'BUY' THEN 'BID' ELSE 'ASK' END AS side_bid_ask, coalesce(liquidation_method IS NOT NULL AND \"user\" = liquidated_user, false) AS is_liquidated_side, direction IN ('SETTLEMENT', 'SPLIT_OUTCOME', 'SPOT_DUST_CONVERSION') AS is_non_trade, (price * size)::DOUBLE AS notional FROM facts")
def v2(spark, d):
    return M.fills_enriched(fills(spark, d)).select("block_num", "fill_index", "trade_id", "side_bid_ask", "is_liquidated_side", "is_non_trade", "notional")


@query("v3_trades", "WITH " + _FACTS + " SELECT block_num, fill_index, CASE WHEN market_type = 'perp' AND dex = '' THEN 'core' WHEN market_type = 'perp' THEN 'hip3' WHEN market_type = 'spot' THEN 'spot' WHEN market_type = 'outcome' THEN 'hip4' END AS family, \"user\" AS taker, counterparty AS maker, direction = 'SETTLEMENT' AS is_settlement, (price * size)::DOUBLE AS notional FROM facts WHERE crossed AND counterparty IS NOT NULL")
def v3(spark, d):
    return M.trades(fills(spark, d)).select("block_num", "fill_index", "family", "taker", "maker", "is_settlement", "notional")


@query("v4_funding_events", "SELECT block_num, event_index, item_count, row_number() OVER (PARTITION BY block_num ORDER BY event_index) - 1 AS dex_index FROM funding_headers")
def v4(spark, d):
    return A.ordinal_in_block(adapted(spark, d, "funding_headers"), "event_index", "dex_index")


@query("v4_funding", "WITH " + _RATES + " SELECT f.block_num, f.event_index, f.coin, f.\"user\", f.szi::DOUBLE AS szi, r.dex_index FROM funding_deltas f JOIN rates r USING (block_num, event_index, coin)")
def v4f(spark, d):
    key = ["block_num", "event_index", "coin"]
    return adapted(spark, d, "funding_deltas").join(rates(spark, d).select(*key, "dex_index"), key).select(*key, "user", "szi", "dex_index")


_ONE = "coin_hours AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY coin, block_num ORDER BY event_index) AS n FROM rates) WHERE n = 1)"


def coin_hours(spark, d):
    return forks.latest(rates(spark, d), ["coin", "block_num"], ["event_index"]).withColumn("ts", F.col("block_num") * 600)


@query("v5_funding_rates_view", "WITH " + _RATES + ", " + _ONE + " SELECT block_num, coin, (positive_funding + negative_funding)::DOUBLE AS net_funding, (long_size - short_size)::DOUBLE AS net_position, CASE WHEN lag(block_num) OVER w * 600 >= block_num * 600 - 3660 THEN open_interest - lag(open_interest) OVER w END::DOUBLE AS open_interest_change FROM coin_hours WINDOW w AS (PARTITION BY coin ORDER BY block_num)")
def v5(spark, d):
    return M.funding_rates_view(coin_hours(spark, d)).select("block_num", "coin", "net_funding", "net_position", "open_interest_change")


@query("c11_hourly_series", "WITH " + _RATES + ", " + _ONE + " SELECT block_num, funding_rate::DOUBLE AS funding_rate, open_interest::DOUBLE AS open_interest, positive_funding::DOUBLE AS funding_volume FROM coin_hours WHERE coin = 'C1'")
def c11(spark, d):
    return M.funding_rates_view(coin_hours(spark, d)).where("coin = 'C1'").select("block_num", "funding_rate", "open_interest", F.col("positive_funding").alias("funding_volume"))


_LIQ = "liq AS (SELECT * FROM facts WHERE liquidation_method IS NOT NULL AND \"user\" = liquidated_user)"
_KIND = "CASE WHEN liquidation_method = 'market' THEN 'market' WHEN counterparty_direction = 'AUTO_DELEVERAGING' THEN 'adl' WHEN counterparty_direction LIKE 'LIQUIDATED_%' THEN 'backstop_takeover' END"


def ledger_for_fills(spark, d):
    f = adapted(spark, d, "fills").where("liquidated_user = user and fill_index < 4")
    return f.select("block_num", "hash", F.array("user").alias("users"), F.lit("liquidation").alias("ledger_type"), (F.col("fill_index") + 100).alias("event_index"), F.col("price").alias("liquidated_ntl_pos"), F.col("size").alias("account_value"), F.lit("cross").alias("leverage_type"))


@query("v6_liquidations_view", "WITH " + _FACTS + ", " + _LIQ + f", ev AS (SELECT block_num, hash, \"user\" AS account, min(fill_index) + 100 AS event_index, min(price) AS p FROM fills WHERE liquidated_user = \"user\" AND fill_index < 4 AND hash <> '0x' || repeat('0', 64) GROUP BY ALL HAVING count(*) = 1) SELECT l.block_num, l.fill_index, {_KIND} AS liquidation_kind, (l.price * l.size)::DOUBLE AS notional, ev.event_index AS ledger_event_index, ev.p::DOUBLE AS liquidated_ntl_pos FROM liq l LEFT JOIN ev ON ev.block_num = l.block_num AND ev.hash = l.hash AND ev.account = l.liquidated_user")
def v6(spark, d):
    return M.liquidations_view(M.liquidations(fills(spark, d)), ledger_for_fills(spark, d)).select("block_num", "fill_index", "liquidation_kind", "notional", "ledger_event_index", "liquidated_ntl_pos")


@query("v7_liquidation_orders", "WITH " + _FACTS + ", " + _LIQ + " SELECT block_num, hash, liquidated_user, coin, count(*) AS fills, sum(size)::DOUBLE AS size, sum(price * size)::DOUBLE AS notional FROM liq GROUP BY ALL")
def v7(spark, d):
    return M.liquidation_orders(M.liquidations_view(M.liquidations(fills(spark, d)), ledger_for_fills(spark, d))).select("block_num", "hash", "liquidated_user", "coin", "fills", "size", "notional")


_SINGLE = """single AS (SELECT block_num, outcome_id, side_index, side, hash, size, price, crossed, fill_index, lead(fill_index) OVER w - fill_index AS step,
  lead({'side': side, 'hash': hash, 'size': size, 'outcome': outcome_id, 'index': side_index, 'price': price, 'crossed': crossed}) OVER w AS nxt
  FROM legs4 WHERE counterparty IS NULL AND direction IN ('BUY', 'SELL') WINDOW w AS (PARTITION BY block_num ORDER BY fill_index))"""
_MATCHES = """SELECT block_num, outcome_id, if(direction = 'SETTLEMENT', 'settlement', 'trade') AS match_type, fill_index AS taker_fill_index, both_indexes - fill_index AS maker_fill_index, size::DOUBLE AS size
  FROM (SELECT *, sum(fill_index) OVER (PARTITION BY block_num, coin, transaction_id) AS both_indexes FROM legs4 WHERE counterparty IS NOT NULL) WHERE crossed
UNION ALL SELECT block_num, outcome_id, if(side = 'BUY', 'mint', 'burn'), fill_index + if(side = 'BUY', 1, 0), fill_index + if(side = 'BUY', 0, 1), size::DOUBLE
  FROM single WHERE step = 1 AND (nxt.side, nxt.hash, nxt.size, nxt.outcome) = (side, hash, size, outcome_id) AND nxt.index <> side_index AND nxt.price = 1 - price AND crossed = (side = 'ASK') AND nxt.crossed = (side = 'BUY')"""


@query("v8_outcome_matches", "WITH " + _FACTS + ", " + _LEGS + ", " + _SINGLE + " " + _MATCHES)
def v8(spark, d):
    return M.outcome_matches(outcome_legs(spark, d)).select("block_num", "outcome_id", "match_type", "taker_fill_index", "maker_fill_index", "size")


@query("c16_matches_by_outcome", "WITH " + _FACTS + ", " + _LEGS + ", " + _SINGLE + ", m8 AS (" + _MATCHES + ") SELECT outcome_id, match_type, count(*) AS matches, sum(size) AS shares FROM m8 GROUP BY ALL")
def c16(spark, d):
    return M.outcome_matches(outcome_legs(spark, d)).groupBy("outcome_id", "match_type").agg(F.count("*").alias("matches"), F.sum("size").alias("shares"))


@query("v9_outcome_actions", "WITH " + _FACTS + ", " + _LEGS + " SELECT block_num, hash, lower(direction) AS action_type, count(*) AS legs, arg_min(\"user\", fill_index) AS account, array_to_string(list_sort(list(DISTINCT outcome_id)), ',') AS outcome_ids FROM legs4 WHERE direction IN ('SPLIT_OUTCOME', 'MERGE_OUTCOME', 'NEGATE_OUTCOME', 'MERGE_QUESTION') GROUP BY block_num, hash, direction")
def v9(spark, d):
    return M.outcome_actions(outcome_legs(spark, d)).select("block_num", "hash", "action_type", "legs", "account", "outcome_ids")


_SETTLED = """closing AS (SELECT * FROM legs4 WHERE direction = 'SETTLEMENT'),
paid AS (SELECT outcome_id, side_index, count(*) AS positions, max(price) AS price FROM closing WHERE side = 'ASK' GROUP BY outcome_id, side_index),
settled AS (SELECT c.outcome_id, c.settled_block, ifnull(first.price, 1 - second.price) AS settle_fraction, (SELECT ifnull(sum(positions), 0)::BIGINT FROM paid p WHERE p.outcome_id = c.outcome_id) AS settled_positions
  FROM (SELECT outcome_id, min(block_num) AS settled_block FROM closing GROUP BY outcome_id) c
  LEFT JOIN paid AS first ON first.outcome_id = c.outcome_id AND first.side_index = 0 LEFT JOIN paid AS second ON second.outcome_id = c.outcome_id AND second.side_index = 1)"""


@query("v10_outcome_settlements", "WITH " + _FACTS + ", " + _LEGS + ", " + _SETTLED + " SELECT outcome_id, settled_block, settle_fraction::DOUBLE AS settle_fraction, settled_positions FROM settled")
def v10(spark, d):
    return M.outcome_settlements(outcome_legs(spark, d)).select("outcome_id", "settled_block", "settle_fraction", "settled_positions")


_HELD = """held AS (SELECT "user", coin, outcome_id, side_index, if(side = 'BUY', start_position + size, start_position - size) AS shares, block_num AS last_block_num
  FROM legs4 WHERE NOT (direction = 'SETTLEMENT' AND side = 'BUY') QUALIFY row_number() OVER (PARTITION BY "user", coin, outcome_id, side_index ORDER BY block_num DESC, fill_index DESC) = 1)"""


@query("v11_outcome_positions", "WITH " + _FACTS + ", " + _LEGS + ", " + _HELD + " SELECT \"user\", coin, outcome_id, side_index, shares::DOUBLE AS shares, last_block_num FROM held")
def v11(spark, d):
    return M.outcome_positions(outcome_legs(spark, d))


@query("v11_outcome_open_interest", "WITH " + _FACTS + ", " + _LEGS + ", " + _HELD + " SELECT coin, outcome_id, side_index, sum(shares)::DOUBLE AS open_interest, count(*) AS holders FROM held WHERE shares > 0 GROUP BY ALL")
def v11o(spark, d):
    return M.outcome_open_interest(M.outcome_positions(outcome_legs(spark, d)))


@query("c17_open_outcomes", "WITH " + _FACTS + ", " + _LEGS + ", " + _HELD + ", " + _SETTLED + " SELECT outcome_id, side_index, coin, sum(shares)::DOUBLE AS open_interest, count(*) AS holders FROM held WHERE shares > 0 AND outcome_id NOT IN (SELECT outcome_id FROM settled) GROUP BY ALL")
def c17(spark, d):
    legs = outcome_legs(spark, d)
    return M.outcome_open_interest(M.outcome_positions(legs)).join(M.outcome_settlements(legs), "outcome_id", "left_anti").select("outcome_id", "side_index", "coin", "open_interest", "holders")


@query("c18_balances", "WITH " + _FACTS + ", " + _LEGS + ", " + _HELD + " SELECT coin, outcome_id, side_index, shares::DOUBLE AS shares, last_block_num FROM held WHERE \"user\" = '0x' || lpad('3', 40, '0') AND shares <> 0")
def c18(spark, d):
    return M.outcome_positions(outcome_legs(spark, d)).where((F.col("user") == "0x" + "3".rjust(40, "0")) & (F.col("shares") != 0)).drop("user")


def ledger(spark, d):
    return adapted(spark, d, "ledger")


def of_table(spark, d, name):
    e = ledger(spark, d)
    return FL.routed(e, L.event_table(F.col("event_type"), F.col("ledger_type")), [name])[name]


@query("f6_routing", "SELECT CASE WHEN ledger_type IN ('send', 'spot_transfer', 'internal_transfer', 'sub_account_transfer', 'account_class_transfer') THEN 'transfers' WHEN ledger_type IN ('deposit', 'withdraw') THEN 'bridge_transfers' WHEN ledger_type LIKE 'vault%' THEN 'vault_events' WHEN ledger_type = 'c_staking_transfer' OR event_type IN ('c_deposit', 'c_withdrawal', 'delegation') THEN 'staking_events' ELSE 'other_events' END AS tbl, count(*) AS n FROM ledger GROUP BY 1")
def f6(spark, d):
    e = ledger(spark, d)
    names = list(L.LEDGER_TABLES)
    parts = FL.routed(e, L.event_table(F.col("event_type"), F.col("ledger_type")), names, other="other_events")
    return quality.all_monitors([parts[n].select(F.lit(n).alias("tbl")) for n in names]).groupBy("tbl").agg(F.count("*").alias("n"))


@query("v17_events_union", "SELECT block_num, event_index, event_type, ledger_type, CASE WHEN coalesce(ledger_type, '') IN ('send', 'spot_transfer', 'internal_transfer', 'sub_account_transfer', 'account_class_transfer', 'deposit', 'withdraw') THEN NULL ELSE vault END AS vault, amount::DOUBLE AS amount FROM ledger")
def v17(spark, d):
    e = ledger(spark, d)
    cols = {"transfers": ["amount"], "bridge_transfers": ["amount"], "vault_events": ["vault", "amount"], "staking_events": ["vault", "amount"], "other_events": ["vault", "amount"]}
    parts = FL.routed(e, L.event_table(F.col("event_type"), F.col("ledger_type")), list(cols))
    shown = ["block_num", "event_index", "event_type", "ledger_type"]
    return FL.union_by_name([parts[n].select(*shown, *cols[n]) for n in cols], [*shown, "vault", "amount"])


@query("v12_transfers_view", "SELECT block_num, event_index, coalesce(\"user\", users[1]) AS sender, coalesce(destination, users[1]) AS recipient, CASE ledger_type WHEN 'send' THEN source_dex WHEN 'spot_transfer' THEN 'spot' WHEN 'account_class_transfer' THEN CASE WHEN to_perp THEN 'spot' ELSE '' END ELSE '' END AS source_balance, coalesce(token, 'USDC') AS token, coalesce(amount, usdc)::DOUBLE AS quantity FROM ledger WHERE ledger_type IN ('send', 'spot_transfer', 'internal_transfer', 'sub_account_transfer', 'account_class_transfer')")
def v12(spark, d):
    return M.transfers_view(of_table(spark, d, "transfers")).select("block_num", "event_index", "sender", "recipient", "source_balance", "token", "quantity")


@query("v12_bridge_view", "SELECT block_num, event_index, ledger_type, users[1] AS account, CASE ledger_type WHEN 'deposit' THEN usdc ELSE -usdc END::DOUBLE AS signed_usdc FROM ledger WHERE ledger_type IN ('deposit', 'withdraw')")
def v12b(spark, d):
    return M.bridge_transfers_view(of_table(spark, d, "bridge_transfers"))


@query("v13_vault_events_view", "WITH w AS (SELECT block_num, hash, min(vault) AS v FROM ledger WHERE ledger_type = 'vault_withdraw' AND hash <> '0x' || repeat('0', 64) GROUP BY ALL HAVING count(DISTINCT vault) = 1) SELECT e.block_num, e.event_index, e.ledger_type, coalesce(e.vault, w.v) AS vault, CASE WHEN e.ledger_type = 'vault_distribution' THEN nullif(e.users[1], e.vault) ELSE coalesce(e.\"user\", list_filter(e.users, lambda u: u <> e.vault)[1]) END AS account, coalesce(e.ledger_type = 'vault_distribution' AND e.users[1] = e.vault, false) AS is_vault_total, e.usdc::DOUBLE AS usdc FROM ledger e LEFT JOIN w ON e.ledger_type = 'vault_leader_commission' AND w.block_num = e.block_num AND w.hash = e.hash WHERE e.ledger_type LIKE 'vault%'")
def v13(spark, d):
    return M.vault_events_view(of_table(spark, d, "vault_events"))


@query("c15_vault_flows", "SELECT ledger_type, vault, count(*) AS n, sum(usdc)::DOUBLE AS usdc FROM ledger WHERE ledger_type LIKE 'vault%' AND ledger_type <> 'vault_leader_commission' AND NOT coalesce(ledger_type = 'vault_distribution' AND users[1] = vault, false) GROUP BY ALL")
def c15(spark, d):
    return M.vault_events_view(of_table(spark, d, "vault_events")).where("NOT is_vault_total AND ledger_type <> 'vault_leader_commission'").groupBy("ledger_type", "vault").agg(F.count("*").alias("n"), F.sum("usdc").alias("usdc"))


@query("v14_staking_flows", "SELECT block_num, event_index, users[1] AS account, CASE WHEN is_deposit THEN 'stake' ELSE 'unstake' END AS flow, amount::DOUBLE AS amount FROM ledger WHERE ledger_type = 'c_staking_transfer' UNION ALL SELECT block_num, event_index, \"user\", CASE WHEN is_undelegate THEN 'undelegate' ELSE 'delegate' END, amount::DOUBLE FROM ledger WHERE event_type = 'delegation'")
def v14(spark, d):
    return M.staking_flows(of_table(spark, d, "staking_events")).select("block_num", "event_index", "account", "flow", "amount")


@query("c14_staking_totals", "SELECT flow, sum(amount)::DOUBLE AS hype, count(*) AS moves FROM (SELECT CASE WHEN ledger_type IS NOT NULL THEN CASE WHEN is_deposit THEN 'stake' ELSE 'unstake' END WHEN is_undelegate THEN 'undelegate' ELSE 'delegate' END AS flow, amount FROM ledger WHERE ledger_type = 'c_staking_transfer' OR event_type = 'delegation') GROUP BY 1")
def c14(spark, d):
    return M.staking_flows(of_table(spark, d, "staking_events")).groupBy("flow").agg(F.sum("amount").alias("hype"), F.count("*").alias("moves"))


@query("v15_account_events", "SELECT block_num, event_index, unnest(users) AS account FROM ledger WHERE event_type = 'ledger_update' UNION ALL SELECT block_num, event_index, \"user\" FROM ledger WHERE event_type IN ('c_deposit', 'c_withdrawal', 'delegation', 'create_sub_account')")
def v15(spark, d):
    return M.account_events(ledger(spark, d)).select("block_num", "event_index", "account")


@query("c7_account_history", "SELECT e.block_num, e.event_index, e.ledger_type, e.amount::DOUBLE AS amount FROM ledger e WHERE (event_type = 'ledger_update' AND list_contains(users, 'v3'))")
def c7(spark, d):
    e = ledger(spark, d)
    mine = M.account_events(e).where("account = 'v3'").select("block_num", "event_index")
    return e.join(mine, ["block_num", "event_index"]).select("block_num", "event_index", "ledger_type", "amount")


for _kind in M.LEDGER_COLUMNS:
    _own = [c for c in ("amount", "usdc", "token", "vault", "destination", "is_deposit", "to_perp") if c in M.LEDGER_COLUMNS[_kind].split()]
    _shown = ", ".join(f"{c}::DOUBLE AS {c}" if c in ("amount", "usdc") else c for c in _own)
    query(f"v16_ledger_{_kind}", f"SELECT block_num, event_index, users[1] AS first_user{', ' + _shown if _shown else ''} FROM ledger WHERE ledger_type = '{_kind}'")(
        lambda spark, d, k=_kind, own=_own: M.ledger_view(ledger(spark, d), k).select("block_num", "event_index", F.get("users", F.lit(0)).alias("first_user"), *own))
for _kind in M.BODY_COLUMNS:
    _own = [c for c in ("user", "amount", "is_undelegate") if c in M.BODY_COLUMNS[_kind].split()]
    _shown = ", ".join("amount::DOUBLE AS amount" if c == "amount" else f'"{c}"' for c in _own)
    query(f"v16_body_{_kind}", f"SELECT block_num, event_index{', ' + _shown if _shown else ''} FROM ledger WHERE event_type = '{_kind}'")(
        lambda spark, d, k=_kind, own=_own: M.body_view(ledger(spark, d), k).select("block_num", "event_index", *own))


# ---- cookbook ----
@query("c1_taker_notional", "WITH " + _FACTS + " SELECT block_num % 30 AS day, market_type, dex, sum(price * size)::DOUBLE AS taker_notional, count(*) AS trades FROM facts WHERE crossed AND direction NOT IN ('SETTLEMENT', 'SPLIT_OUTCOME', 'SPOT_DUST_CONVERSION') GROUP BY ALL")
def c1(spark, d):
    e = M.fills_enriched(M.with_market(adapted(spark, d, "fills"))).where("is_taker AND NOT is_non_trade")
    return e.groupBy((F.col("block_num") % 30).alias("day"), "market_type", "dex").agg(F.sum("notional").alias("taker_notional"), F.count("*").alias("trades"))


@query("c2_dex_trades", "WITH " + _FACTS + " SELECT block_num, coin, transaction_id AS trade_id, side AS taker_side, \"user\" AS taker, counterparty AS maker FROM facts WHERE crossed AND counterparty IS NOT NULL AND dex = 'xyz'")
def c2(spark, d):
    return M.trades(fills(spark, d)).where("family = 'hip3' AND dex = 'xyz' AND NOT is_non_trade").orderBy("block_num", "fill_index").select("block_num", "coin", "trade_id", "taker_side", "taker", "maker")


@query("c4_buyer_seller", "WITH " + _FACTS + " SELECT block_num, transaction_id, \"user\" AS buyer, counterparty AS seller, crossed AS buyer_is_taker FROM facts WHERE side = 'BUY' AND counterparty IS NOT NULL AND direction NOT IN ('SETTLEMENT', 'SPLIT_OUTCOME', 'SPOT_DUST_CONVERSION')")
def c4(spark, d):
    return M.fills_enriched(fills(spark, d)).where("side = 'BUY' AND counterparty IS NOT NULL AND NOT is_non_trade").select("block_num", "transaction_id", F.col("user").alias("buyer"), F.col("counterparty").alias("seller"), F.col("crossed").alias("buyer_is_taker"))


@query("c5_takeovers", "WITH " + _FACTS + ", " + _LIQ + f" SELECT block_num, fill_index, liquidated_user FROM liq WHERE ({_KIND}) = 'backstop_takeover'")
def c5(spark, d):
    return M.liquidations_view(M.liquidations(fills(spark, d)), ledger_for_fills(spark, d)).where("liquidation_kind = 'backstop_takeover'").select("block_num", "fill_index", "liquidated_user")


@query("c6_liquidated_notional", "WITH " + _FACTS + ", " + _LIQ + f" SELECT block_num % 30 AS day, {_KIND} AS liquidation_kind, dex, count(*) AS legs, sum(price * size)::DOUBLE AS notional FROM liq GROUP BY ALL")
def c6(spark, d):
    v = M.liquidations_view(M.liquidations(fills(spark, d)), ledger_for_fills(spark, d))
    return v.groupBy((F.col("block_num") % 30).alias("day"), "liquidation_kind", "dex").agg(F.count("*").alias("legs"), F.sum("notional").alias("notional"))


@query("c8_latest_snapshot", "SELECT \"user\", coin, szi::DOUBLE AS szi FROM funding_deltas WHERE block_num = (SELECT max(block_num) FROM funding_headers)")
def c8(spark, d):
    top = adapted(spark, d, "funding_headers").agg(F.max("block_num").alias("block_num"))
    return adapted(spark, d, "funding_deltas").join(F.broadcast(top), "block_num", "left_semi").select("user", "coin", "szi")


@query("c9_funding_per_dex", "WITH " + _RATES + " SELECT h.block_num, h.event_index, h.item_count, coalesce(sum(r.positive_funding), 0)::DOUBLE AS received, coalesce(-sum(r.negative_funding), 0)::DOUBLE AS paid FROM funding_headers h LEFT JOIN rates r USING (block_num, event_index) GROUP BY ALL")
def c9(spark, d):
    h = adapted(spark, d, "funding_headers")
    r = rates(spark, d).groupBy("block_num", "event_index").agg(F.sum("positive_funding").alias("p"), F.sum("negative_funding").alias("n"))
    zero = F.lit(0).cast(S.AMOUNT)
    return h.join(r, ["block_num", "event_index"], "left").select("block_num", "event_index", "item_count", F.coalesce("p", zero).alias("received"), F.coalesce(-F.col("n"), zero).alias("paid"))


@query("c10_latest_open_interest", "WITH " + _RATES + " SELECT event_index, coin, open_interest::DOUBLE AS open_interest, long_positions FROM rates WHERE block_num = (SELECT max(block_num) FROM rates)")
def c10(spark, d):
    r = rates(spark, d)
    return r.join(F.broadcast(r.agg(F.max("block_num").alias("block_num"))), "block_num", "left_semi").orderBy(F.desc("open_interest")).select("event_index", "coin", "open_interest", "long_positions")


@query("c12_builder_revenue", "SELECT builder, fee_token, sum(builder_fee)::DOUBLE AS revenue, count(*) AS fills FROM fills WHERE builder IS NOT NULL GROUP BY ALL")
def c12(spark, d):
    return adapted(spark, d, "fills").where("builder is not null").groupBy("builder", "fee_token").agg(F.sum("builder_fee").alias("revenue"), F.count("*").alias("fills")).orderBy(F.desc_nulls_last("revenue"))


@query("c13_products", "SELECT coin, sum(CAST(CAST(szi * funding_rate AS DECIMAL(38,10)) * CAST(szi AS DECIMAL(28,10)) AS DECIMAL(38,10)))::DOUBLE AS rounded_sum, sum(CAST(szi * funding_rate AS DECIMAL(38,10)))::DOUBLE AS pair_sum FROM funding_deltas GROUP BY 1")
def c13(spark, d):
    pair = (F.col("szi") * F.col("funding_rate")).cast(S.AMOUNT)
    return adapted(spark, d, "funding_deltas").groupBy("coin").agg(F.sum((pair * F.col("szi").cast("decimal(28,10)")).cast(S.AMOUNT)).alias("rounded_sum"), F.sum(pair).alias("pair_sum"))


# ---- flatten ----
def nested(spark, d):
    rows = read(spark, d, "conversations")
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("items")).select("conv_id", F.col("conv_id").alias("block_num"), "items")


@query("f1_flatten", "SELECT conv_id AS block_num, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS item_index, role, length(text) AS n FROM conversations")
def f1(spark, d):
    spec = FL.FlattenSpec("talk", (FL.TableSpec("items", (FL.Level("items", "item_index"),), {"role": "e0.role", "n": "cast(length(e0.text) AS bigint)"}),))
    return FL.flatten(nested(spark, d), spec)["items"]


@query("f2_outer_explode", "SELECT conv_id AS block_num, CASE WHEN conv_id % 3 <> 0 THEN item END AS item_index, CASE WHEN conv_id % 3 <> 0 THEN role END AS role FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS item, role FROM conversations) WHERE conv_id % 3 <> 0 OR item = 0")
def f2(spark, d):
    n = nested(spark, d).withColumn("items", F.when(F.col("conv_id") % 3 != 0, F.col("items")).otherwise(F.slice("items", 1, 0)))
    return FL.flatten_table(n, FL.TableSpec("items", (FL.Level("items", "item_index", outer=True),), {"role": "e0.role"}))


@query("f3_source_positions", "SELECT conv_id AS block_num, item AS item_index FROM (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS item, role FROM conversations) WHERE role = 'assistant'")
def f3(spark, d):
    return FL.flatten_table(nested(spark, d), FL.TableSpec("items", (FL.Level("items", "item_index", where="e0.role = 'assistant'"),)))


@query("f4_two_lists", "SELECT conv_id, source, row_number() OVER (PARTITION BY conv_id ORDER BY source, turn) - 1 AS idx, role FROM (SELECT *, CASE WHEN role = 'user' THEN 0 ELSE 1 END::BIGINT AS source FROM conversations)")
def f4(spark, d):
    n = nested(spark, d)
    own = lambda keep: F.transform(F.filter("items", keep), lambda x: x["role"])
    rows = FL.numbered_over_lists(n, own(lambda x: x["role"] == "user"), own(lambda x: x["role"] != "user"), "idx")
    return rows.select("conv_id", "source", "idx", F.col("element").alias("role"))


@query("f5_all_or_nothing", "SELECT conv_id AS block_num, count(*) AS n FROM conversations GROUP BY conv_id HAVING count(*) FILTER (WHERE role = 'system') = 0")
def f5(spark, d):
    spec = FL.FlattenSpec("talk", (FL.TableSpec("items", (FL.Level("items", "item_index"),)),), errors="transform(filter(items, x -> x.role = 'system'), x -> 'system turn')")
    return FL.flatten(nested(spark, d), spec)["items"].groupBy("block_num").agg(F.count("*").alias("n"))


@query("f8_fixed_columns", "SELECT conv_id, max(role) FILTER (WHERE i = 0) AS topic0, max(role) FILTER (WHERE i = 1) AS topic1, max(role) FILTER (WHERE i = 5) AS topic5 FROM (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i FROM conversations) GROUP BY 1")
def f8(spark, d):
    roles = F.transform("items", lambda x: x["role"])
    return nested(spark, d).select("conv_id", *FL.fixed_columns(roles, ["topic0", "topic1", "t2", "t3", "t4", "topic5"])).drop("t2", "t3", "t4")


@query("f9_fork_variants", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'a' WHEN doc_id % 3 = 1 THEN 'b' END AS v FROM documents")
def f9(spark, d):
    rows = read(spark, d, "documents").selectExpr("doc_id", "if(doc_id % 3 = 0, named_struct('v', 'a'), null) AS phase0", "if(doc_id % 3 = 1, named_struct('v', 'b'), null) AS altair")
    return rows.select("doc_id", FL.first_variant(F.col("phase0"), F.col("altair"))["v"].alias("v"))


@query("f10_unrolled", "SELECT doc_id, 0::BIGINT AS nesting_level, 'top' AS name FROM documents UNION ALL SELECT doc_id, 1, 'under' FROM documents WHERE doc_id % 2 = 0")
def f10(spark, d):
    rows = read(spark, d, "documents").selectExpr("doc_id", "named_struct('name', 'top', 'nested', if(doc_id % 2 = 0, named_struct('name', 'under'), null)) AS m")
    return FL.unrolled(rows, "m", "nested", 2)


@query("k7_roundtrip", "SELECT conv_id FROM conversations WHERE false")
def k7(spark, d):
    n = nested(spark, d)
    child = FL.flatten_table(n.drop("conv_id"), FL.TableSpec("items", (FL.Level("items", "item_index"),), {"role": "e0.role", "text": "e0.text"})).withColumnRenamed("block_num", "conv_id")
    return FL.roundtrip_differences(n, child, ["conv_id"], "item_index", "items")


@query("k8_child_counts", "SELECT o_orderkey, stored, actual FROM (SELECT o.o_orderkey, 4::BIGINT AS stored, count(l.l_orderkey) AS actual FROM (SELECT DISTINCT o_orderkey FROM orders) o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY 1) WHERE actual <> 4")
def k8(spark, d):
    o = read(spark, d, "orders").select("o_orderkey").distinct().withColumn("n", F.lit(4).cast("long"))
    return quality.count_disagreements(o, read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"], "n")
