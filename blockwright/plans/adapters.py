"""The driver's tables as block-shaped tables, in SQL that both engines compute alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from blockwright.plans.market import BODY_COLUMNS, LEDGER_COLUMNS

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
_LEG = "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
_ZERO = "0x" + "0" * 64


def _money(c: str) -> str:
    return f"CAST(CAST(round({c}, 2) AS DECIMAL(18,2)) AS DECIMAL(38,10))"


def _case(c: str, values: list[str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values)) + " END"


KINDS = [*LEDGER_COLUMNS, *BODY_COLUMNS]

#: name -> (SQL over the driver's tables and earlier names)
ADAPTERS = {
    "hist": """
SELECT event_id AS stream_ordinal, event_id % 97 AS block_num, concat('b', CAST(user_id % 3 AS STRING)) AS block_id,
  CASE event_type WHEN 'error' THEN 'UNDO' WHEN 'signup' THEN 'FINAL' ELSE 'NEW' END AS fork_step, event_type, user_id
FROM events""",
    "blocks": """
SELECT o_orderkey AS block_num, concat('b', CAST(o_orderkey AS STRING)) AS block_id, concat('b', CAST(o_orderkey - 1 - (CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END) AS STRING)) AS parent_id,
  CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 1767225600 + o_orderkey * 60 - (CASE WHEN o_orderkey % 70 = 1 THEN 500 ELSE 0 END) END AS ts
FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 40 <> 3)
UNION ALL SELECT o_orderkey, concat('c', CAST(o_orderkey AS STRING)), concat('b', CAST(o_orderkey - 1 AS STRING)), 1767225600 + o_orderkey * 60 FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey % 33 = 5)""",
    "legs": f"""
SELECT l_orderkey AS block_num, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LEG}) - 1 AS BIGINT) AS fill_index, {_LEG} FROM lineitem""",
    "paired": """
SELECT *, CAST(floor(fill_index / 2) AS BIGINT) AS pair, CAST((block_num + floor(fill_index / 2)) % 6 AS BIGINT) AS form, CASE WHEN block_num % 7 = 0 THEN 0 ELSE block_num * 100 + CAST(floor(fill_index / 2) AS BIGINT) END AS transaction_id FROM legs""",
    "fills": f"""
SELECT block_num, fill_index, 1767225600 + block_num * 60 AS ts, concat('0x', lpad(CAST(l_suppkey AS STRING), 40, '0')) AS user,
  CASE form WHEN 0 THEN 'BTC' WHEN 1 THEN 'xyz:XYZ100' WHEN 2 THEN concat('@', CAST(block_num % 50 AS STRING)) WHEN 3 THEN 'PURR/USDC'
    WHEN 4 THEN concat('#', CAST(10 * (block_num % 20) + (CASE WHEN transaction_id = 0 THEN fill_index % 2 ELSE 0 END) AS STRING)) ELSE 'odd coin!' END AS coin,
  CASE WHEN form = 4 AND transaction_id = 0 THEN CAST(CASE WHEN fill_index % 2 = 0 THEN '0.4' ELSE '0.6' END AS DECIMAL(38,10)) ELSE {_money("l_extendedprice")} END AS price,
  CASE WHEN form = 4 AND transaction_id = 0 THEN CAST(5 AS DECIMAL(38,10)) ELSE {_money("l_quantity")} END AS size,
  CASE WHEN form = 4 AND transaction_id = 0 THEN 'BUY' WHEN fill_index % 2 = 0 THEN 'BUY' ELSE 'ASK' END AS side,
  CASE WHEN form = 4 AND block_num % 11 = 0 THEN 'SETTLEMENT' WHEN form = 4 AND block_num % 17 = 0 THEN 'SPLIT_OUTCOME' WHEN form < 2 AND block_num % 13 = 0 AND fill_index % 2 = 1 THEN CASE block_num % 3 WHEN 0 THEN 'AUTO_DELEVERAGING' WHEN 1 THEN 'LIQUIDATED_CROSS_LONG' ELSE 'BUY' END
    WHEN form = 3 AND block_num % 19 = 0 THEN 'SPOT_DUST_CONVERSION' WHEN form = 4 AND transaction_id = 0 THEN 'BUY' WHEN fill_index % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS direction,
  CASE WHEN transaction_id = 0 AND form <> 4 THEN '{_ZERO}' ELSE concat('0x', lpad(CAST(block_num * 10 + pair AS STRING), 64, '0')) END AS hash,
  transaction_id, fill_index % 2 = 1 AS crossed, {_money("l_tax")} AS fee, CASE WHEN fill_index % 2 = 0 THEN 'PURR' ELSE 'USDC' END AS fee_token, CAST(l_partkey % 40 AS DECIMAL(38,10)) AS start_position,
  CASE WHEN form < 2 AND block_num % 13 = 0 THEN CASE WHEN fill_index % 2 = 0 THEN concat('0x', lpad(CAST(l_suppkey AS STRING), 40, '0')) ELSE 'other' END END AS liquidated_user,
  CASE WHEN form < 2 AND block_num % 13 = 0 THEN CASE WHEN block_num % 2 = 0 THEN 'market' ELSE 'backstop' END END AS liquidation_method,
  CASE WHEN form < 2 AND block_num % 13 = 0 THEN {_money("l_extendedprice")} END AS liquidation_mark_px,
  CASE WHEN l_partkey % 5 = 0 THEN concat('0x', lpad(CAST(l_partkey % 9 AS STRING), 40, 'a')) END AS builder, CASE WHEN l_partkey % 5 = 0 THEN {_money("l_tax")} END AS builder_fee
FROM paired""",
    "ledger": f"""
SELECT o_orderkey % 1000 AS block_num, CAST(row_number() OVER (PARTITION BY o_orderkey % 1000 ORDER BY o_orderkey, o_custkey, o_totalprice) - 1 AS BIGINT) AS event_index,
  CASE WHEN o_orderkey % 27 < {len(LEDGER_COLUMNS)} THEN 'ledger_update' ELSE {_case("o_orderkey % 27 - " + str(len(LEDGER_COLUMNS)), list(BODY_COLUMNS))} END AS event_type,
  CASE WHEN o_orderkey % 27 < {len(LEDGER_COLUMNS)} THEN {_case("o_orderkey % 27", list(LEDGER_COLUMNS))} END AS ledger_type,
  CASE WHEN o_orderkey % 5 = 0 THEN '{_ZERO}' ELSE concat('0x', lpad(CAST((o_orderkey % 1000) * 10 + o_custkey % 3 AS STRING), 64, '0')) END AS hash,
  CASE WHEN o_custkey % 2 = 0 THEN array_of(concat('u', CAST(o_custkey AS STRING))) ELSE array_of(concat('u', CAST(o_custkey AS STRING)), concat('v', CAST(o_custkey % 11 AS STRING))) END AS users,
  CASE WHEN o_custkey % 3 = 0 THEN concat('u', CAST(o_custkey AS STRING)) END AS user, CASE WHEN o_custkey % 4 = 1 THEN concat('d', CAST(o_custkey % 50 AS STRING)) END AS destination,
  CASE WHEN o_custkey % 3 <> 1 THEN concat('v', CAST(o_custkey % 11 AS STRING)) END AS vault, CASE WHEN o_custkey % 5 = 0 THEN 'HYPE' END AS token,
  {_money("o_totalprice")} AS amount, CASE WHEN o_custkey % 2 = 0 THEN {_money("o_totalprice")} END AS usdc, CASE WHEN o_custkey % 4 = 0 THEN 'USDC' END AS fee_token,
  CASE WHEN o_custkey % 6 = 0 THEN CAST(0 AS DECIMAL(38,10)) ELSE CAST(1 AS DECIMAL(38,10)) END AS fee, concat('dex', CAST(o_custkey % 3 AS STRING)) AS source_dex, '' AS destination_dex, o_custkey % 2 = 0 AS is_deposit, o_custkey % 3 = 0 AS to_perp, o_custkey % 4 = 0 AS is_undelegate,
  {_money("o_totalprice")} AS liquidated_ntl_pos, {_money("o_totalprice")} AS account_value, o_orderpriority AS leverage_type
FROM orders""",
    "funding_headers": "SELECT l_orderkey AS block_num, CAST(l_linenumber AS BIGINT) AS event_index, CAST(count(*) AS BIGINT) AS item_count FROM lineitem GROUP BY l_orderkey, l_linenumber UNION ALL SELECT DISTINCT l_orderkey, 99, 0 FROM lineitem",
    "funding_deltas": f"""
SELECT l_orderkey AS block_num, CAST(l_linenumber AS BIGINT) AS event_index, concat('C', CAST(l_partkey % 4 AS STRING)) AS coin, concat('u', CAST(l_suppkey AS STRING)) AS user,
  CASE WHEN l_returnflag = 'R' THEN -{_money("l_quantity")} ELSE {_money("l_quantity")} END AS szi, CASE WHEN l_linestatus = 'O' THEN {_money("l_tax")} ELSE -{_money("l_tax")} END AS funding_amount, CAST(CAST(l_partkey % 3 AS DECIMAL(18,2)) AS DECIMAL(38,10)) AS funding_rate
FROM lineitem""",
    "log": """
SELECT user_id % 200 AS entity, event_id AS observed_at, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 50 AS BIGINT) END AS level, event_type <> 'error' AS listed FROM events""",
    "filings": """
SELECT doc_id AS block_num, CAST(doc_id % 3 AS BIGINT) AS filing_index, CAST(floor(doc_id / 3) * 2 + doc_id % 2 AS BIGINT) AS acc, n_chars, concat('m', CAST(doc_id % 40 AS STRING)) AS manager_cik, doc_id % 4 AS period_of_report,
  doc_id % 13 = 0 AS is_deletion_notice, doc_id % 17 = 0 AS corrected, CASE doc_id % 5 WHEN 0 THEN '13F NOTICE' WHEN 1 THEN '13F COMBINATION REPORT' ELSE '13F HOLDINGS REPORT' END AS report_type,
  CASE WHEN doc_id % 6 = 0 THEN 'NEW HOLDINGS' WHEN doc_id % 6 = 1 THEN 'RESTATEMENT' END AS amendment_type, (doc_id * 7919) % 1000 AS acceptance_datetime, concat('s', CAST(doc_id % 30 AS STRING)) AS series_id
FROM documents""",
    "tree": "SELECT doc_id AS node, CASE WHEN doc_id > 0 THEN CAST(floor(doc_id / 2) AS BIGINT) END AS parent, CASE WHEN doc_id % 10 = 9 THEN NULL ELSE doc_id + 3 END AS next FROM documents",
    "dirty": """
SELECT o_orderkey AS id, CASE o_orderkey % 12 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' WHEN 2 THEN concat(CAST(o_custkey AS STRING), '.12345678') WHEN 3 THEN concat('-', CAST(o_custkey AS STRING), '.5') WHEN 4 THEN '1,234' WHEN 5 THEN concat('99999999999999999999999999999999999', CAST(o_custkey AS STRING))
    WHEN 6 THEN ' 12 ' WHEN 7 THEN 'xxxx' WHEN 8 THEN '' WHEN 9 THEN concat('+', CAST(o_custkey AS STRING)) WHEN 10 THEN '.5' ELSE concat('000', CAST(o_custkey AS STRING), '.0000000') END AS number,
  CASE o_orderkey % 9 WHEN 0 THEN '2014-06-30-05:00' WHEN 1 THEN '6/5/2026' WHEN 2 THEN concat('2020-', CAST(1 + o_custkey % 14 AS STRING), '-', CAST(1 + o_custkey % 31 AS STRING)) WHEN 3 THEN '0999-01-01' WHEN 4 THEN 'NONE' WHEN 5 THEN '12-31-1999' WHEN 6 THEN 'soon' WHEN 7 THEN '2021-02-03Z' ELSE '9999-12-31' END AS day,
  CASE o_orderkey % 7 WHEN 0 THEN 'Y' WHEN 1 THEN 'no' WHEN 2 THEN 'True' WHEN 3 THEN '0' WHEN 4 THEN 'N/A' WHEN 5 THEN '' ELSE 'maybe' END AS flag,
  CASE o_orderkey % 6 WHEN 0 THEN ' for ' WHEN 1 THEN 'Aganst' WHEN 2 THEN '1 Year' WHEN 3 THEN 'take no action' WHEN 4 THEN 'n/a' ELSE 'Withhold' END AS vote, CASE o_orderkey % 4 WHEN 0 THEN 'FOR' WHEN 1 THEN 'against' WHEN 2 THEN 'NONE' END AS advice
FROM orders""",
}

#: name -> (table, column) that rows are dealt by before its SQL, so that windows and groups by block further on find them together without another shuffle
_DEALT = {"legs": ("lineitem", "l_orderkey")}
_NEEDS = {"paired": ["legs"], "fills": ["paired"]}


def _chain(name: str) -> list[str]:
    out: list[str] = []
    for n in _NEEDS.get(name, []):
        out += _chain(n)
    return [*out, name]


def adapted(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One block-shaped table over the driver's files."""
    made: dict[str, DataFrame] = {}
    for n in _chain(name):
        sql = ADAPTERS[n].replace("array_of(", "array(").replace("{", "{{").replace("}", "}}")
        used = {}
        for t in [*TABLES, *made]:
            if re.search(rf"\bFROM {t}\b", sql):
                used[t] = made[t] if t in made else spark.read.parquet(f"{sf_dir}/{t}.parquet")
                if _DEALT.get(n, ("",))[0] == t:
                    used[t] = used[t].repartition(_DEALT[n][1])
                sql = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", sql)
        made[n] = spark.sql(sql, **used)
    return made[name]


def with_adapters(sql: str) -> str:
    """DuckDB SQL over adapted tables: the ones it names come before it as common table expressions."""
    names: list[str] = []
    for n in ADAPTERS:
        if re.search(rf"\b(FROM|JOIN) {n}\b", sql):
            names += [x for x in _chain(n) if x not in names]
    ctes = ", ".join(f"{n} AS ({ADAPTERS[n].replace('array_of(', 'list_value(')})" for n in names)
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    return f"WITH {ctes}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes} {body}"
