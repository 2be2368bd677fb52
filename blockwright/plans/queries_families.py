"""Registered queries over whole families: nested blocks made of the given tables, flattened, checked and typed by their specs."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockwright.operators import crosschecks as C
from blockwright.operators import quality
from blockwright.operators.validate import with_errors
from blockwright.plans import market as M
from blockwright.plans.adapters import adapted
from blockwright.plans.queries import _FACTS, _LEGS, _RATES, _SETTLED, outcome_legs, query, rates, read
from blockwright.plans.queries_more import _PROBLEMS
from blockwright.plans.specs import CHECKS, evm_changes, flatten_family
from blockwright.sources import tables as ST

#: One row a fill and event with odd values here and there, in SQL that both engines compute alike.
_ROUGH = """SELECT block_num, fill_index,
  CASE WHEN (l_partkey + l_suppkey) % 301 = 0 THEN NULL ELSE concat('u', CAST(l_suppkey AS STRING)) END AS usr,
  CASE l_partkey % 211 WHEN 0 THEN '' WHEN 1 THEN '1e5' WHEN 2 THEN '0.12345678901' WHEN 3 THEN concat('1', repeat('0', 28)) WHEN 4 THEN '007.10000000000000' ELSE CAST(l_partkey AS STRING) END AS price,
  CASE WHEN l_suppkey % 97 = 0 THEN 3 ELSE 1 + l_linenumber % 2 END AS side, CASE WHEN l_partkey % 173 = 0 THEN 1 ELSE 5000000 END AS nanos,
  fill_index % 4 AS kind, CASE WHEN l_suppkey % 89 = 0 THEN 2 ELSE 1 END AS bodies, CASE WHEN l_partkey % 83 = 0 THEN '' ELSE CAST(l_linenumber AS STRING) END AS amount
FROM legs"""


def order_book_blocks(spark, d):
    """Blocks of fills and of events with one body each: funding, send, deposit and none."""
    rough = spark.sql(_ROUGH.replace("FROM legs", "FROM {legs}"), legs=adapted(spark, d, "legs"))
    fill = "named_struct('user', usr, 'coin', 'BTC', 'price', price, 'side', CAST(side AS INT), 'time', named_struct('seconds', 1L, 'nanos', CAST(nanos AS INT)))"
    empty = "CAST(NULL AS STRUCT<users: ARRAY<STRING>, delta: STRUCT<send: STRUCT<user: STRING, token: STRING, amount: STRING>, deposit: STRUCT<usdc: STRING>>>)"
    none = "CAST(NULL AS STRUCT<deltas: ARRAY<STRUCT<user: STRING, coin: STRING, funding_amount: STRING, szi: STRING, funding_rate: STRING>>>)"
    body = f"""named_struct(
      'ledger_update', CASE kind WHEN 1 THEN named_struct('users', array(usr), 'delta', named_struct('send', named_struct('user', 'a', 'token', 'T', 'amount', amount), 'deposit', CAST(NULL AS STRUCT<usdc: STRING>)))
        WHEN 2 THEN named_struct('users', array(usr), 'delta', named_struct('send', CAST(NULL AS STRUCT<user: STRING, token: STRING, amount: STRING>), 'deposit', named_struct('usdc', amount))) ELSE {empty} END,
      'funding', CASE kind WHEN 0 THEN named_struct('deltas', array(named_struct('user', 'a', 'coin', 'BTC', 'funding_amount', '1', 'szi', '2', 'funding_rate', '0.5'), named_struct('user', 'b', 'coin', 'BTC', 'funding_amount', amount, 'szi', '-3', 'funding_rate', '0.5'))) ELSE {none} END)"""
    event = f"named_struct('time', named_struct('seconds', 1L, 'nanos', 0), 'hash', 'h', 'events', CASE WHEN bodies = 2 THEN array({body}, {body}) ELSE array({body}) END)"
    rows = rough.selectExpr("block_num", f"named_struct('i', fill_index, 'fill', {fill}, 'event', {event}) AS x")
    nested = rows.groupBy("block_num").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return nested.selectExpr("block_num", "transform(x, y -> y.fill) AS fills", "transform(x, y -> y.event) AS events")


_ERRORS = f"""rough AS ({_ROUGH}), faults AS (
SELECT block_num, 'fills[' || fill_index || '].user' AS path, 'empty' AS reason FROM rough WHERE usr IS NULL
UNION ALL SELECT block_num, 'fills[' || fill_index || '].price', CASE WHEN price = '' THEN 'empty' WHEN price = '1e5' THEN 'not a plain decimal' WHEN length(price) = 13 THEN 'more than 10 fractional digits' ELSE 'more than 28 integer digits' END FROM rough WHERE price IN ('', '1e5', '0.12345678901') OR length(price) = 29
UNION ALL SELECT block_num, 'fills[' || fill_index || '].side', 'no side: 3' FROM rough WHERE side = 3
UNION ALL SELECT block_num, 'fills[' || fill_index || '].time', 'not a whole millisecond' FROM rough WHERE nanos = 1
UNION ALL SELECT block_num, 'events[' || fill_index || '].events', '2 items, not 1' FROM rough WHERE bodies = 2
UNION ALL SELECT block_num, 'events[' || fill_index || '].events[' || b || ']' || CASE kind WHEN 0 THEN '.funding.deltas[1].funding_amount' WHEN 1 THEN '.ledger_update.delta.send.amount' WHEN 2 THEN '.ledger_update.delta.deposit.usdc' ELSE '' END, CASE kind WHEN 3 THEN 'no case' ELSE 'empty' END
  FROM rough, range(0, 2) t(b) WHERE b < bodies AND (kind = 3 OR amount = '')
UNION ALL SELECT block_num, 'events[' || fill_index || '].events[' || b || '].ledger_update.users[0]', 'empty' FROM rough, range(0, 2) t(b) WHERE b < bodies AND kind IN (1, 2) AND usr IS NULL)"""


@query("f5_hypercore_quarantine", f"WITH {_ERRORS} SELECT * FROM faults")
def f5_quarantine(spark, d):
    return flatten_family(order_book_blocks(spark, d), "hypercore")["quarantine"].select("block_num", "error.path", "error.reason")


_SOUND = f"{_ERRORS}, sound AS (SELECT r.* FROM rough r WHERE block_num NOT IN (SELECT block_num FROM faults))"


@query("f5_hypercore_sound_fills", f"WITH {_SOUND} SELECT block_num, fill_index, usr AS \"user\", price::DOUBLE AS price, CASE side WHEN 1 THEN 'ASK' ELSE 'BUY' END AS side FROM sound")
def f5_sound(spark, d):
    return flatten_family(order_book_blocks(spark, d), "hypercore")["fills"].select("block_num", "fill_index", "user", F.col("price").cast("double").alias("price"), "side")


@query("f_hypercore_funding_rates", f"WITH {_SOUND} SELECT block_num, fill_index AS event_index, (row_number() OVER (PARTITION BY block_num ORDER BY fill_index) - 1)::BIGINT AS dex_index, 'BTC' AS coin, '' AS dex, 2::BIGINT AS positions, 5.0::DOUBLE AS open_interest, (1 + amount::INT)::DOUBLE AS positive_funding FROM sound WHERE kind = 0")
def f_funding_rates(spark, d):
    checked = with_errors(order_book_blocks(spark, d), CHECKS["hypercore"])
    # rates come from two tables of the blocks, which are checked once and leave their fills behind
    sound = ST.stored_table(checked.where("size(_errors) = 0").select("block_num", "events", "_errors"), "sound-events")
    rates = flatten_family(sound, "hypercore")["funding_rates"]
    return rates.select("block_num", "event_index", F.col("dex_index").cast("long").alias("dex_index"), "coin", "dex", "positions", F.col("open_interest").cast("double").alias("open_interest"), F.col("positive_funding").cast("double").alias("positive_funding"))


# ---- filings ----
#: One filing a row, its texts odd here and there.
_FILED = """SELECT block_num, fill_index,
  CASE l_partkey % 13 WHEN 0 THEN 'N/A' WHEN 1 THEN concat(CAST(l_suppkey AS STRING), '.1234567') WHEN 2 THEN '' WHEN 3 THEN '1,5' ELSE CAST(l_partkey AS STRING) END AS shares,
  CASE l_suppkey % 11 WHEN 0 THEN '2020-01-02-05:00' WHEN 1 THEN '6/5/2026' WHEN 2 THEN '2020-13-01' WHEN 3 THEN 'soon' ELSE '2021-03-04' END AS day,
  CASE l_partkey % 7 WHEN 0 THEN 'XXXX' WHEN 1 THEN '1.5' WHEN 2 THEN '12.000' ELSE CAST(l_linenumber AS STRING) END AS held
FROM legs"""


def filed_blocks(spark, d):
    """Blocks of filings: ownership forms with two plain transactions and a derivative one, and a report of two holdings."""
    filed = spark.sql(_FILED.replace("FROM legs", "FROM {legs}"), legs=adapted(spark, d, "legs"))
    owner = "named_struct('non_derivative_transactions', array(named_struct('shares', shares, 'transaction_date', day), named_struct('shares', '1', 'transaction_date', '')), 'derivative_transactions', array(named_struct('shares', '2', 'exercise_date', day)))"
    report = "named_struct('holdings', array(named_struct('value', held, 'cusip', '37833100'), named_struct('value', '7', 'cusip', '0')))"
    rows = filed.selectExpr("block_num", f"named_struct('i', fill_index, 'f', named_struct('accession_number', concat('a', CAST(fill_index AS STRING)), 'ownership', {owner}, 'form13f', {report})) AS x")
    nested = rows.groupBy("block_num").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return nested.selectExpr("block_num", "transform(x, y -> y.f) AS filings")


_FILED_ISSUES = f"""filed AS ({_FILED}), found AS (
SELECT block_num, fill_index, 'ownership_transactions' AS table_name, 'shares' AS column_name, 0 AS index_1, shares AS raw_value, CASE WHEN shares = 'N/A' THEN 'sentinel' WHEN shares = '1,5' THEN 'unparseable' ELSE 'rounded' END AS issue FROM filed WHERE shares IN ('N/A', '1,5') OR shares LIKE '%.1234567'
UNION ALL SELECT block_num, fill_index, 'ownership_transactions', CASE i WHEN 0 THEN 'transaction_date' ELSE 'exercise_date' END, i, day, CASE day WHEN 'soon' THEN 'unparseable' WHEN '2020-13-01' THEN 'out_of_range' ELSE 'tz_dropped' END FROM filed, (VALUES (0), (2)) t(i) WHERE day IN ('soon', '2020-13-01', '2020-01-02-05:00')
UNION ALL SELECT block_num, fill_index, 'form13f_holdings', 'value', 0, held, CASE held WHEN 'XXXX' THEN 'sentinel' ELSE 'unparseable' END FROM filed WHERE held IN ('XXXX', '1.5'))"""


@query("t10_sec_parse_issues", f"WITH {_FILED_ISSUES} SELECT block_num, fill_index AS filing_index, 'a' || fill_index AS accession_number, table_name, column_name, index_1::BIGINT AS index_1, raw_value, issue FROM found")
def t10_sec(spark, d):
    return flatten_family(filed_blocks(spark, d), "sec", only={"parse_issues"})["parse_issues"].select("block_num", F.col("filing_index").cast("long").alias("filing_index"), "accession_number", "table_name", "column_name", "index_1", "raw_value", "issue")


@query("f_sec_ownership_transactions", f"WITH {_FILED_ISSUES} SELECT block_num, fill_index AS filing_index, i AS transaction_index, CASE i WHEN 2 THEN 'derivative' ELSE 'non_derivative' END AS security_kind, CASE i WHEN 0 THEN CASE WHEN shares LIKE '%.1234567' THEN (split_part(shares, '.', 1) || '.123457')::DOUBLE WHEN shares NOT IN ('', 'N/A', '1,5') THEN shares::DOUBLE END ELSE i::DOUBLE END AS shares, CASE i WHEN 0 THEN CASE day WHEN '6/5/2026' THEN '2026-06-05' WHEN '2020-01-02-05:00' THEN '2020-01-02' WHEN '2021-03-04' THEN day END END AS transaction_date, EXISTS (SELECT 1 FROM found f WHERE f.block_num = filed.block_num AND f.fill_index = filed.fill_index AND f.table_name = 'ownership_transactions' AND f.index_1 = i) AS has_parse_issues FROM filed, range(0, 3) t(i)")
def f_sec_transactions(spark, d):
    return flatten_family(filed_blocks(spark, d), "sec", only={"ownership_transactions"})["ownership_transactions"].select("block_num", "filing_index", "transaction_index", "security_kind", "shares", "transaction_date", "has_parse_issues")


@query("f_sec_form13f_holdings", f"WITH {_FILED_ISSUES} SELECT block_num, fill_index AS filing_index, i AS holding_index, CASE i WHEN 1 THEN 7 ELSE CASE WHEN held NOT IN ('XXXX', '1.5') THEN split_part(held, '.', 1)::BIGINT END END::BIGINT AS value, CASE i WHEN 0 THEN '037833100' END AS cusip_norm FROM filed, range(0, 2) t(i)")
def f_sec_holdings(spark, d):
    return flatten_family(filed_blocks(spark, d), "sec", only={"form13f_holdings"})["form13f_holdings"].select("block_num", "filing_index", "holding_index", "value", "cusip_norm")


# ---- EVM ----
_TRADES = """SELECT block_num, fill_index, CASE (block_num + fill_index) % 3 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'FAILED' ELSE 'REVERTED' END AS status,
  l_partkey % 5 AS o0, l_suppkey % 5 AS o1, l_linenumber % 5 AS o2, (l_partkey + l_suppkey) % 5 AS o3, l_partkey % 2 = 0 AS gone_a, l_suppkey % 3 = 0 AS gone_b, l_suppkey % 4 = 0 AS undone
FROM legs"""


def trade_blocks(spark, d):
    """Blocks of transactions that succeed, fail or revert, with two calls, authorizations and changes, and one block-level change."""
    rows = spark.sql(_TRADES.replace("FROM legs", "FROM {legs}"), legs=adapted(spark, d, "legs"))

    def changes(order):
        return "array(" + ", ".join(f"named_struct('ordinal', CAST(o{o} AS BIGINT), 'address', '{a}')" for o, a in zip(order, "abab", strict=True)) + ")"

    def balance(*reasons):
        return "array(" + ", ".join(f"named_struct('ordinal', CAST({i} AS BIGINT), 'address', 'a', 'reason', '{r}')" for i, r in enumerate(reasons)) + ")"

    none = "CAST(array() AS ARRAY<STRUCT<ordinal: BIGINT, address: STRING>>)"
    calls = f"array(named_struct('index', 1L, 'state_reverted', status <> 'SUCCEEDED', 'balance_changes', {balance('GAS_BUY', 'TRANSFER')}, 'nonce_changes', {changes([0, 1, 2, 3])}, 'code_changes', {changes([3, 2, 1, 0])}), named_struct('index', 2L, 'state_reverted', undone, 'balance_changes', {balance('TRANSFER')}, 'nonce_changes', {none}, 'code_changes', {none}))"
    auths = "array(named_struct('authority', 'a', 'discarded', gone_a), named_struct('authority', 'a', 'discarded', false), named_struct('authority', 'b', 'discarded', gone_b))"
    tx = rows.selectExpr("block_num", f"named_struct('i', fill_index, 't', named_struct('status', status, 'set_code_authorizations', {auths}, 'calls', {calls})) AS x")
    nested = tx.groupBy("block_num").agg(F.sort_array(F.collect_list("x")).alias("x"))
    system = "array(named_struct('index', 9L, 'balance_changes', array(named_struct('ordinal', block_num % 7, 'address', 's'))))"
    return nested.selectExpr("block_num", "transform(x, y -> y.t) AS transactions", "array(named_struct('ordinal', block_num % 5, 'address', 'r')) AS balance_changes", f"{system} AS system_calls")


@query("f_evm_persisted_changes", f"""WITH trade AS ({_TRADES}),

many AS (SELECT block_num, fill_index, status, gone_a, gone_b, kind, i, CASE i % 2 WHEN 0 THEN 'a' ELSE 'b' END AS addr, CASE CASE kind WHEN 'nonce' THEN i ELSE 3 - i END WHEN 0 THEN o0 WHEN 1 THEN o1 WHEN 2 THEN o2 ELSE o3 END AS ordinal FROM trade, (VALUES ('nonce'), ('code')) k(kind), range(0, 4) t(i)),
placed AS (SELECT *, row_number() OVER (PARTITION BY block_num, fill_index, kind ORDER BY ordinal, i) AS n FROM many),
others AS (SELECT *, CASE WHEN kind = 'nonce' AND n = 1 THEN 0 ELSE row_number() OVER (PARTITION BY block_num, fill_index, kind, addr, kind = 'nonce' AND n = 1 ORDER BY n) END AS k FROM placed),
lasting AS (SELECT block_num, fill_index, kind, 1 AS call_index, ordinal, addr FROM others WHERE status = 'SUCCEEDED' OR k <= CASE addr WHEN 'a' THEN 1 + (NOT gone_a)::INT ELSE (NOT gone_b)::INT END)
SELECT block_num, fill_index AS tx_index, kind, call_index::BIGINT AS call_index, ordinal::BIGINT AS ordinal, addr AS address, true AS persisted FROM lasting
UNION ALL SELECT block_num, fill_index, 'balance', 1, 0, 'a', true FROM trade UNION ALL SELECT block_num, fill_index, 'balance', 1, 1, 'a', true FROM trade WHERE status = 'SUCCEEDED'
UNION ALL SELECT block_num, fill_index, 'balance', 2, 0, 'a', NOT undone FROM trade WHERE status = 'SUCCEEDED'""")
def f_evm_persisted(spark, d):
    return evm_changes(trade_blocks(spark, d), ["balance", "nonce", "code"]).select("block_num", "tx_index", "kind", "call_index", "ordinal", "address", "persisted")


@query("f_evm_system_balance_changes", f"WITH trade AS ({_TRADES}) SELECT DISTINCT block_num, NULL::BIGINT AS call_index, 'r' AS address, block_num % 5 AS ordinal FROM trade UNION ALL SELECT DISTINCT block_num, 9, 's', block_num % 7 FROM trade")
def f_evm_system(spark, d):
    return flatten_family(trade_blocks(spark, d), "evm", only={"system_balance_changes"})["system_balance_changes"].select("block_num", "call_index", "address", "ordinal")


# ---- cross-checks ----
@query("k5_settlements", "WITH " + _FACTS + ", " + _LEGS + ", " + _SETTLED + ", told AS (SELECT outcome_id, CASE WHEN outcome_id % 3 = 0 THEN settle_fraction + 1 ELSE settle_fraction END AS settle_fraction FROM settled WHERE outcome_id % 5 <> 0) SELECT s.outcome_id, s.settle_fraction::DOUBLE AS lake_fraction, t.settle_fraction::DOUBLE AS settle_fraction FROM settled s LEFT JOIN told t USING (outcome_id) WHERE t.settle_fraction IS DISTINCT FROM s.settle_fraction")
def k5_settlements(spark, d):
    lake = M.outcome_settlements(outcome_legs(spark, d))
    told = lake.where("outcome_id % 5 <> 0").withColumn("settle_fraction", F.when(F.col("outcome_id") % 3 == 0, F.col("settle_fraction") + 1).otherwise(F.col("settle_fraction")))
    return C.settlement_differences(lake, told)


@query("k5_dexes", "WITH " + _RATES + ", named AS (SELECT dex_index, CASE WHEN dex_index = 1 AND block_num % 3 = 0 THEN 'abc' ELSE '' END AS dex FROM rates), lake AS (SELECT dex_index, list_sort(list(DISTINCT dex)) AS names FROM named GROUP BY 1) SELECT dex_index, array_to_string(names, ',') AS lake_names, CASE WHEN r_regionkey % 2 = 0 THEN '' WHEN r_regionkey IS NOT NULL THEN 'x' END AS name FROM lake LEFT JOIN region ON r_regionkey = dex_index WHERE len(names) <> 1 OR names[1] IS DISTINCT FROM CASE WHEN r_regionkey % 2 = 0 THEN '' WHEN r_regionkey IS NOT NULL THEN 'x' END")
def k5_dexes(spark, d):
    named = rates(spark, d).withColumn("dex", F.expr("CASE WHEN dex_index = 1 AND block_num % 3 = 0 THEN 'abc' ELSE '' END"))
    return C.dex_differences(named, read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("dex_index"), F.when(F.col("r_regionkey") % 2 == 0, "").otherwise("x").alias("name")))


@query("k5_tokens", "SELECT 'T' || t AS token, min(i)::BIGINT AS lake_index FROM (SELECT o_custkey % 20 AS t, o_custkey % 20 + o_custkey % 2 AS i FROM orders WHERE o_orderkey % 3 <> 0) GROUP BY t HAVING NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = t AND n_nationkey + CASE WHEN n_nationkey % 7 = 0 THEN 1 ELSE 0 END = min(i))")
def k5_tokens(spark, d):
    moved = read(spark, d, "orders").select(F.when(F.col("o_orderkey") % 3 == 0, "deposit").when(F.col("o_orderkey") % 3 == 1, "send").otherwise("spot_transfer").alias("ledger_type"), F.concat(F.lit("T"), F.col("o_custkey") % 20).alias("token"),
                                            F.concat(F.lit("0x2"), F.lpad(F.lower(F.hex(F.col("o_custkey") % 20 + F.col("o_custkey") % 2)), 39, "0")).alias("user"), F.lit("d").alias("destination"))
    told = read(spark, d, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("name"), (F.col("n_nationkey") + F.when(F.col("n_nationkey") % 7 == 0, 1).otherwise(0)).cast("long").alias("token_index"))
    return C.token_differences(moved, told)


@query("k6_uncovered_links", "WITH child AS (SELECT entity, level, listed, observed_at AS a, coalesce(lead(observed_at) OVER (PARTITION BY entity ORDER BY observed_at), 9223372036854775807) AS b FROM log), parent AS (SELECT user_id % 60 AS level, event_type <> 'signup' AS listed, event_id AS a, coalesce(lead(event_id) OVER (PARTITION BY user_id % 60 ORDER BY event_id), 9223372036854775807) AS b FROM events), spans AS (SELECT c.entity, c.level, c.a, c.b, sum(CASE WHEN p.level IS NOT NULL THEN greatest(least(c.b, p.b)::HUGEINT - greatest(c.a, p.a), 0) ELSE 0 END) AS covered FROM child c LEFT JOIN parent p ON p.level = c.level AND p.listed WHERE c.listed AND c.level IS NOT NULL GROUP BY ALL) SELECT entity, level, a AS valid_from, CASE WHEN b < 9223372036854775807 THEN b END AS valid_to, covered::BIGINT AS covered FROM spans WHERE covered < b::HUGEINT - a")
def k6_links(spark, d):
    parent = read(spark, d, "events").select((F.col("user_id") % 60).alias("name"), F.col("event_id").alias("observed_at"), (F.col("event_type") != "signup").alias("listed"))
    return C.uncovered_links(adapted(spark, d, "log"), parent, ["entity"], "level", "name", width=1 << 16)


@query("k1_validate_by_day", "WITH " + _PROBLEMS + " SELECT kind, block_num, previous, CASE kind WHEN 'time_reversal' THEN 'warning' ELSE 'error' END AS severity FROM problems")
def k1_by_day(spark, d):
    blocks = adapted(spark, d, "blocks").withColumn("day", F.floor(F.col("block_num") / 1440))
    summaries = quality.part_summaries(blocks, "day")
    return quality.part_problems(blocks, "day").unionByName(quality.joined_problems(summaries, "day")).drop("day")
