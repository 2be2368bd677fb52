"""More registered queries: projections, joins, aggregates, windows, typed parsing, filings, chains, quality, change logs, storage."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockwright.functions import labels as L
from blockwright.functions import parse as P
from blockwright.functions import schema as S
from blockwright.operators import aggregates as A
from blockwright.operators import changelog as G
from blockwright.operators import forks, joins, layout, outcome, quality
from blockwright.operators.monitors import monitors, with_match
from blockwright.plans import filings as SEC
from blockwright.plans import market as M
from blockwright.plans.adapters import adapted
from blockwright.plans.queries import _FACTS, _LEGS, _RATES, _SETTLED, fills, outcome_legs, query, rates, read
from blockwright.sources import tables as ST

_D2 = "CAST(CAST(round({c}, 2) AS DECIMAL(18,2)) AS DECIMAL(38,10))"


def money(c: str):
    return F.expr(_D2.format(c=c))


# ---- projections and outcomes ----
@query("p1_filter_failed", "SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def p1(spark, d):
    tx = read(spark, d, "orders").select(F.col("o_orderkey").alias("block_num"), (F.col("o_orderstatus") != "F").alias("transaction_success"))
    _, kept = outcome.filter_failed(tx, {"logs": read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "block_num")}, ["block_num"])
    return kept["logs"].groupBy(F.col("block_num").alias("l_orderkey")).agg(F.count("*").alias("n"))


@query("p2_outcomes", "SELECT event_type, count(*) FILTER (WHERE event_type <> 'error') AS evm, count(*) FILTER (WHERE user_id % 3 = 0 OR user_id % 3 IS NULL) AS cosmos FROM events GROUP BY 1")
def p2(spark, d):
    e = read(spark, d, "events").withColumns({"status": F.when(F.col("event_type") == "error", "REVERTED").otherwise("SUCCEEDED"), "code": F.col("user_id") % 3})
    return e.groupBy("event_type").agg(F.count_if(outcome.transaction_success("evm")).alias("evm"), F.count_if(outcome.transaction_success("cosmos")).alias("cosmos"))


@query("p3_persistent_changes", "SELECT l_orderkey, l_linenumber, count(*) AS n, count(*) FILTER (WHERE CASE WHEN l_orderkey % 3 <> 0 THEN l_suppkey % 5 <> 0 ELSE l_partkey % 2 = 0 AND l_linenumber % 2 = 0 END) AS persisted FROM lineitem GROUP BY ALL")
def p3(spark, d):
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("block_num"), F.col("l_linenumber").alias("tx_index"), F.lit(1).alias("call_index"), F.when(F.col("l_linenumber") % 2 == 0, 0).otherwise(1).alias("parent_index"),
                                             F.col("l_partkey").alias("ordinal"), F.lit("balance").alias("kind"), F.when(F.col("l_partkey") % 2 == 0, "GAS_BUY").otherwise("TRANSFER").alias("reason"), F.lit("a").alias("address"), (F.col("l_suppkey") % 5 == 0).alias("state_reverted"))
    tx = rows.select("block_num", "tx_index").distinct().withColumn("transaction_success", F.col("block_num") % 3 != 0)
    none = tx.limit(0).select("block_num", "tx_index", F.lit("a").alias("authority"), F.lit(False).alias("discarded"))
    out = outcome.persistent_changes(rows, tx, none)
    return out.groupBy(F.col("block_num").alias("l_orderkey"), F.col("tx_index").alias("l_linenumber")).agg(F.count("*").alias("n"), F.count_if("persisted").alias("persisted"))


@query("p4_propagated_outcome", "SELECT l_orderkey, l_partkey, o_orderstatus FROM lineitem LEFT JOIN (SELECT o_orderkey, o_orderstatus FROM orders) ON o_orderkey = l_orderkey")
def p4(spark, d):
    child = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey")
    return outcome.propagate_outcome(child, read(spark, d, "orders").withColumnRenamed("o_orderkey", "k"), ["k"], "o_orderstatus").withColumnRenamed("k", "l_orderkey")


@query("p5_split_votes", "SELECT is_vote, count(*) AS n FROM (SELECT o.o_orderkey, coalesce(n = 1 AND o.o_custkey % 3 = 1, false) AS is_vote FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o.o_orderkey) GROUP BY 1")
def p5(spark, d):
    tx = read(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 3).alias("num_signatures"), F.lit(0).alias("num_lookups")).withColumn("num_signatures", F.when(F.col("num_signatures") == 1, 1).otherwise(9))
    ins = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.lit("vote").alias("program"), F.lit("tower_sync").alias("instruction_kind"))
    rest, votes = outcome.split_votes(tx, ins, ["o_orderkey"])
    return rest.select(F.lit(False).alias("is_vote")).unionAll(votes.select(F.lit(True).alias("is_vote"))).groupBy("is_vote").agg(F.count("*").alias("n"))


@query("p7_rpc_log_export", "SELECT l_orderkey AS block_num, l_linenumber::BIGINT AS \"transactionIndex\", l_partkey AS \"logIndex\", l_suppkey AS \"transactionLogIndex\" FROM lineitem")
def p7(spark, d):
    logs = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("block_num"), F.col("l_linenumber").alias("tx_index"), F.col("l_partkey").alias("block_index"), F.col("l_suppkey").alias("log_index"), F.lit("a").alias("address"), F.lit("").alias("data"))
    return outcome.rpc_log_export(logs).drop("address", "data")


@query("p8_preferred_address", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'modern' WHEN o_orderkey % 3 = 1 THEN 'old1' END AS address FROM orders")
def p8(spark, d):
    rows = read(spark, d, "orders").selectExpr("o_orderkey", "CASE o_orderkey % 3 WHEN 0 THEN 'modern' WHEN 1 THEN '' END AS m", "CASE o_orderkey % 3 WHEN 2 THEN array() ELSE array('old1', 'old2') END AS l")
    return rows.select("o_orderkey", S.preferred_address(F.col("m"), F.col("l")).alias("address"))


@query("p9_enum_labels", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'NEW' WHEN 1 THEN 'UNDO' ELSE 'UNKNOWN' END AS step FROM orders")
def p9(spark, d):
    return read(spark, d, "orders").select("o_orderkey", S.enum_label((F.col("o_orderkey") % 3).cast("int"), {0: "STEP_NEW", 1: "STEP_UNDO"}, "STEP_").alias("step"))


@query("p10_identifier_hex", "SELECT c_custkey, '0x' || lower(hex(c_name)) AS id FROM customer")
def p10(spark, d):
    return S.identifier_hex(read(spark, d, "customer").select("c_custkey", F.encode("c_name", "utf-8").alias("id")), ["id"])


# ---- joins ----
@query("j1_child_parent", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O'")
def j1(spark, d):
    o = read(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber").join(o, "l_orderkey")


@query("j2_left_dimension", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0")
def j2(spark, d):
    n = joins.bounded_broadcast(read(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"))
    return read(spark, d, "customer").select("c_custkey", "c_nationkey").join(n, "c_nationkey", "left").select("c_custkey", "n_name")


@query("j3_semi_j4_anti", "SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') AS has_return FROM orders")
def j34(spark, d):
    o = read(spark, d, "orders").select("o_orderkey")
    r = read(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return o.join(r, "o_orderkey", "left_semi").withColumn("has_return", F.lit(True)).unionByName(o.join(r, "o_orderkey", "left_anti").withColumn("has_return", F.lit(False)))


@query("j5_band_join", "SELECT e.event_id, r.lo FROM events e JOIN (SELECT DISTINCT user_id % 10 AS k, (event_id - event_id % 50) AS lo, (event_id - event_id % 50) + 4 AS hi FROM events) r ON e.user_id % 10 = r.k AND e.event_id BETWEEN r.lo AND r.hi")
def j5(spark, d):
    e = read(spark, d, "events").select("event_id", (F.col("user_id") % 10).alias("k"))
    r = e.select("k", (F.col("event_id") - F.col("event_id") % 50).alias("lo")).distinct().withColumn("hi", F.col("lo") + 4)
    return joins.band_join(e, r, ["k"], "event_id", "lo", "hi").select("event_id", "lo")


@query("j6_asof_join", "SELECT f.event_id, h.kind FROM (SELECT event_id, user_id % 200 AS entity FROM events) f ASOF LEFT JOIN log h ON h.entity = f.entity AND h.observed_at <= f.event_id")
def j6(spark, d):
    f = read(spark, d, "events").select("event_id", (F.col("user_id") % 200).alias("entity"))
    return joins.asof_join(f, adapted(spark, d, "log"), ["entity"], "event_id", "observed_at", ["kind"], width=1 << 16).select("event_id", "kind")


@query("j6_asof_join_whole", "SELECT f.event_id, h.kind FROM (SELECT event_id, user_id % 200 AS entity FROM events) f ASOF LEFT JOIN log h ON h.entity = f.entity AND h.observed_at <= f.event_id")
def j6_whole(spark, d):
    f = read(spark, d, "events").select("event_id", (F.col("user_id") % 200).alias("entity"))
    return joins.asof_join(f, adapted(spark, d, "log"), ["entity"], "event_id", "observed_at", ["kind"], width=1 << 16).select("event_id", "kind")


@query("r4_leverage_at_time", "SELECT f.block_num, f.fill_index, h.level FROM (SELECT block_num, fill_index, block_num % 200 AS entity FROM fills) f ASOF LEFT JOIN (SELECT entity, observed_at AS valid_from, level FROM log) h ON h.entity = f.entity AND h.valid_from <= f.block_num")
def r4(spark, d):
    f = adapted(spark, d, "fills").select("block_num", "fill_index", (F.col("block_num") % 200).alias("entity"))
    return joins.asof_join(f, G.history(adapted(spark, d, "log"), ["entity"]), ["entity"], "block_num", "valid_from", ["level"]).drop("entity")


@query("j7_time_range", "SELECT a.a, count(*) AS n FROM (SELECT DISTINCT event_id * 100 AS a FROM events) a JOIN (SELECT event_id * 100 + user_id % 90 AS t FROM events) e ON e.t >= a.a - 3600 AND e.t < a.a GROUP BY 1")
def j7(spark, d):
    e = read(spark, d, "events")
    facts = e.select((F.col("event_id") * 100 + F.col("user_id") % 90).alias("t"))
    anchors = e.select((F.col("event_id") * 100).alias("a")).distinct()
    return joins.range_join(facts, anchors, "t", "a", 3600).groupBy("a").agg(F.count("*").alias("n"))


@query("j7_time_range_whole", "SELECT a.a, count(*) AS n FROM (SELECT DISTINCT event_id * 100 AS a FROM events) a JOIN (SELECT event_id * 100 + user_id % 90 AS t FROM events) e ON e.t >= a.a - 3600 AND e.t < a.a GROUP BY 1")
def j7_whole(spark, d):
    e = read(spark, d, "events")
    facts = e.select((F.col("event_id") * 100 + F.col("user_id") % 90).alias("t"))
    anchors = e.select((F.col("event_id") * 100).alias("a")).distinct()
    return joins.range_join(facts, anchors, "t", "a", 3600).groupBy("a").agg(F.count("*").alias("n"))


@query("j8_same_block_lineage", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'tx' || doc_id END AS tx_hash FROM documents")
def j8(spark, d):
    docs = read(spark, d, "documents")
    r = docs.select("doc_id", (F.col("doc_id") % 50).alias("block_num"), F.concat(F.lit("r"), "doc_id").alias("receipt_id"))
    t = docs.where("doc_id % 3 = 0").select((F.col("doc_id") % 50).alias("block_num"), F.concat(F.lit("r"), "doc_id").alias("converted_into_receipt_id"), F.concat(F.lit("tx"), "doc_id").alias("hash"))
    return joins.same_block_lineage(r, t).select("doc_id", "tx_hash")


@query("j9_adjacent_legs", "SELECT a.block_num, a.fill_index FROM fills a JOIN fills b ON b.block_num = a.block_num AND b.fill_index = a.fill_index + 1 AND b.hash = a.hash AND b.coin = a.coin")
def j9(spark, d):
    return joins.adjacent_legs(adapted(spark, d, "fills").select("block_num", "fill_index", "hash", "coin"), ["block_num"], "fill_index", ["hash", "coin"]).select("a.block_num", "a.fill_index")


@query("j10_spend_join", "SELECT i.l_orderkey, i.l_partkey, o.o_totalprice FROM lineitem i JOIN orders o ON o.o_orderkey = i.l_orderkey AND o.o_custkey % 5 = i.l_suppkey % 5 WHERE i.l_partkey % 4 <> 0")
def j10(spark, d):
    i = read(spark, d, "lineitem").select("l_partkey", F.when(F.col("l_partkey") % 4 != 0, F.col("l_orderkey")).alias("prev_txid"), (F.col("l_suppkey") % 5).alias("prev_vout"))
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("tx_hash"), (F.col("o_custkey") % 5).alias("output_index"), F.col("o_totalprice").alias("value_sats"))
    return joins.spend_join(i, o).select(F.col("prev_txid").alias("l_orderkey"), "l_partkey", F.col("spent_sats").alias("o_totalprice"))


@query("j11_descendants", "WITH RECURSIVE w AS (SELECT node AS root, node, 0::BIGINT AS depth FROM tree WHERE node BETWEEN 1 AND 3 UNION SELECT w.root, t.node, w.depth + 1 FROM w JOIN tree t ON t.parent = w.node AND t.node <> w.node) SELECT * FROM w")
def j11(spark, d):
    t = adapted(spark, d, "tree")
    return joins.descendants(t.where("parent is not null and parent <> node").select("parent", F.col("node").alias("child")), t.where("node between 1 and 3").select("node"))


@query("q10_receipt_lineage_counts", "WITH RECURSIVE w AS (SELECT node AS root, node FROM tree WHERE node BETWEEN 1 AND 3 UNION SELECT w.root, t.node FROM w JOIN tree t ON t.parent = w.node AND t.node <> w.node) SELECT root, count(*) AS receipts, count(*) FILTER (WHERE node % 7 = 0) AS failed FROM w GROUP BY 1")
def q10(spark, d):
    t = adapted(spark, d, "tree")
    all_ = joins.descendants(t.where("parent is not null and parent <> node").select("parent", F.col("node").alias("child")), t.where("node between 1 and 3").select("node"))
    return all_.groupBy("root").agg(F.count("*").alias("receipts"), F.count_if(F.col("node") % 7 == 0).alias("failed"))


@query("j12_last_in_chain", "WITH RECURSIVE w AS (SELECT node, node AS cur, next, 0::BIGINT AS depth FROM tree UNION ALL SELECT w.node, t.node, t.next, w.depth + 1 FROM w JOIN tree t ON t.node = w.next) SELECT node, max(cur) FILTER (WHERE next IS NULL) AS last FROM w GROUP BY node")
def j12(spark, d):
    return joins.last_in_chain(adapted(spark, d, "tree").select("node", "next")).select("node", "last")


@query("j13_null_safe", "SELECT count(*) FILTER (WHERE a IS DISTINCT FROM b) AS n FROM (SELECT level AS a, lag(level) OVER (PARTITION BY entity ORDER BY observed_at) AS b FROM log)")
def j13(spark, d):
    from pyspark.sql import Window

    b = F.lag("level").over(Window.partitionBy("entity").orderBy("observed_at"))
    return adapted(spark, d, "log").withColumn("b", b).agg(F.count_if(joins.differs(F.col("level"), F.col("b"))).alias("n"))


@query("x10_legend", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'done' END AS meaning FROM orders")
def x10(spark, d):
    return joins.decoded(read(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"O": "open", "F": "done"}, "meaning").drop("o_orderstatus")


# ---- aggregates, windows, sorts, sets ----
@query("a1_exact_sums", "SELECT l_returnflag, sum(CAST(round(l_extendedprice, 2) AS DECIMAL(18,2)))::DOUBLE AS total, count(*) AS n, min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem GROUP BY 1")
def a1(spark, d):
    return read(spark, d, "lineitem").groupBy("l_returnflag").agg(A.checked_sum(money("l_extendedprice")).alias("total"), F.count("*").alias("n"), F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high"))


@query("a2_filtered_a3_distinct", "SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) FILTER (WHERE l_returnflag = 'R') AS returned, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_linestatus) = 1 AS one_status FROM lineitem GROUP BY 1")
def a2(spark, d):
    return read(spark, d, "lineitem").groupBy(F.date_format(F.date_trunc("month", "l_shipdate"), "yyyy-MM").alias("month")).agg(F.count_if(F.col("l_returnflag") == "R").alias("returned"), F.count_distinct("l_suppkey").alias("suppliers"), (F.count_distinct("l_linestatus") == 1).alias("one_status"))


@query("a4_single_a5_argmax", "SELECT o_custkey, CASE WHEN count(*) = 1 THEN min(o_orderkey) END AS only_order, arg_max(o_orderkey, o_orderkey) AS newest FROM orders GROUP BY 1")
def a4(spark, d):
    return read(spark, d, "orders").groupBy("o_custkey").agg(A.only_if_single(F.col("o_orderkey")).alias("only_order"), F.max_by("o_orderkey", F.struct("o_orderkey", "o_totalprice")).alias("newest"))


@query("a6_median", "SELECT l_returnflag, median(l_quantity) AS mid FROM lineitem WHERE l_quantity > 2 GROUP BY 1")
def a6(spark, d):
    return read(spark, d, "lineitem").where("l_quantity > 2").groupBy("l_returnflag").agg(F.median("l_quantity").alias("mid"))


@query("a7_lists", "SELECT conv_id, bool_or(role = 'system') AS any_system, array_to_string(list(role ORDER BY turn), ',') AS roles, array_to_string(list_sort(list(DISTINCT role)), ',') AS kinds FROM conversations GROUP BY 1")
def a7(spark, d):
    g = read(spark, d, "conversations").groupBy("conv_id").agg(F.bool_or(F.col("role") == "system").alias("any_system"), A.ordered_list("turn", ["role"]).alias("roles"), A.distinct_list("role").alias("kinds"))
    return g.withColumn("roles", F.transform("roles", lambda x: x["role"]))


@query("a8_overflow", "SELECT o_custkey, count(*) AS n, sum(CASE WHEN o_totalprice > 200000 THEN 6 ELSE 1 END) >= 10 AS overflowed FROM orders GROUP BY 1")
def a8(spark, d):
    # ten units of 1e37 don't fit 38 digits: customers with many or dear orders overflow
    amount = F.when(F.col("o_totalprice") > 200000, F.lit("6" + "0" * 37)).otherwise(F.lit("1" + "0" * 37)).cast("decimal(38,0)")
    return read(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), A.checked_sum(amount).isNull().alias("overflowed"))


@query("a9_constant_or_null", "SELECT o_custkey, CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN min(o_orderstatus) END AS status FROM orders GROUP BY 1")
def a9(spark, d):
    return read(spark, d, "orders").groupBy("o_custkey").agg(A.constant_or_null(F.col("o_orderstatus")).alias("status"))


@query("a10_anomaly_groups", "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def a10(spark, d):
    return layout.order_ties(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).withColumnRenamed("rows", "n")


@query("a12_reconciled", "SELECT k, coalesce(a, 0)::DOUBLE AS converted, coalesce(b, 0)::DOUBLE AS reported FROM (SELECT l_orderkey AS k, sum(l_partkey) * 1000000000 AS a FROM lineitem GROUP BY 1) FULL JOIN (SELECT o_orderkey AS k, sum(o_custkey) * 1000000000 AS b FROM orders GROUP BY 1) USING (k) WHERE coalesce(a, 0) <> coalesce(b, 0)")
def a12(spark, d):
    big = F.lit(10**9).cast("decimal(20,0)")
    left = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_partkey").cast("decimal(18,0)").alias("a"))
    right = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey").cast("decimal(18,0)") * big).alias("b"))
    return A.reconciled(left, right, ["k"], "a", "b", "1000000000")


@query("w1_latest_row", "SELECT entity, observed_at, kind FROM log QUALIFY row_number() OVER (PARTITION BY entity ORDER BY observed_at DESC) = 1")
def w1(spark, d):
    return G.newest(adapted(spark, d, "log"), ["entity"]).select("entity", "observed_at", "kind")


@query("w4_history", "SELECT entity, observed_at AS valid_from, lead(observed_at) OVER (PARTITION BY entity ORDER BY observed_at) AS valid_to FROM log")
def w4(spark, d):
    return G.history(adapted(spark, d, "log"), ["entity"]).select("entity", "valid_from", "valid_to")


@query("w5_filled_forward", "SELECT entity, observed_at, last_value(level IGNORE NULLS) OVER (PARTITION BY entity ORDER BY observed_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM log")
def w5(spark, d):
    return A.filled_forward(adapted(spark, d, "log"), ["entity"], "observed_at", ["level"]).select("entity", "observed_at", "level")


@query("v24_current_filled", "SELECT entity, observed_at, lv AS level FROM (SELECT *, last_value(level IGNORE NULLS) OVER (PARTITION BY entity ORDER BY observed_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv FROM log) QUALIFY row_number() OVER (PARTITION BY entity ORDER BY observed_at DESC) = 1")
def v24(spark, d):
    return G.current_filled(adapted(spark, d, "log"), ["entity"], ["level"]).select("entity", "observed_at", "level")


@query("v26_outcome_sides", "SELECT e.entity, i - 1 AS side_index, '#' || (10 * e.entity + i - 1) AS coin FROM (SELECT DISTINCT entity FROM log) e, range(1, 3) t(i)")
def v26(spark, d):
    o = adapted(spark, d, "log").select("entity").distinct().withColumn("side_coins", F.array(*[F.concat(F.lit("#"), (F.col("entity") * 10 + k).cast("string")) for k in (0, 1)]))
    return o.select("entity", F.posexplode("side_coins").alias("side_index", "coin"))


@query("w7_latest_balance", "SELECT address, balance::DOUBLE AS balance FROM (SELECT l_suppkey AS address, l_orderkey * 2 AS o, l_partkey AS balance, 1 AS s FROM lineitem UNION ALL SELECT o_custkey, o_orderkey * 2 + 1, o_orderkey, 2 FROM orders) QUALIFY row_number() OVER (PARTITION BY address ORDER BY o DESC, balance DESC) = 1")
def w7(spark, d):
    a = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("address"), (F.col("l_orderkey") * 2).alias("o"), F.col("l_partkey").alias("balance"))
    b = read(spark, d, "orders").select(F.col("o_custkey").alias("address"), (F.col("o_orderkey") * 2 + 1).alias("o"), F.col("o_orderkey").alias("balance"))
    return forks.latest(a.unionByName(b), ["address"], [F.desc("o"), F.desc("balance")]).select("address", F.col("balance").cast("double").alias("balance"))


@query("o2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20")
def o2(spark, d):
    return read(spark, d, "orders").orderBy(F.desc_nulls_last("o_totalprice"), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("q15_execution_order", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(CASE WHEN turn % 2 = 1 THEN turn - 1 END, turn), turn % 2, turn) AS place FROM conversations")
def q15(spark, d):
    c = read(spark, d, "conversations").withColumns({"parent": F.when(F.col("turn") % 2 == 1, F.col("turn") - 1), "is_inner": F.col("turn") % 2 == 1})
    c = c.withColumn("o", F.struct(F.coalesce("parent", "turn"), "is_inner", "turn"))
    return A.ordinal_in_block(c, "o", "place", ["conv_id"]).select("conv_id", "turn", (F.col("place") + 1).alias("place"))


@query("u3_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def u3(spark, d):
    return read(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct()


# ---- typed parsing ----
_SENT = "('N/A', 'NA', 'NONE', 'NULL', '-', 'XXXX')"
_NUM = "regexp_full_match(t, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)')"


@query("t1_parse_decimal", f"SELECT id, CASE WHEN {_NUM} THEN TRY_CAST(t AS DECIMAL(38,6)) END::DOUBLE AS v, CASE WHEN t = '' THEN NULL WHEN upper(t) IN {_SENT} THEN 'sentinel' WHEN NOT {_NUM} THEN 'unparseable' WHEN TRY_CAST(t AS DECIMAL(38,6)) IS NULL THEN 'out_of_range' WHEN regexp_matches(substr(split_part(t, '.', 2), 7), '[1-9]') THEN 'rounded' END AS issue FROM (SELECT id, trim(number) AS t FROM dirty)")
def t1(spark, d):
    return adapted(spark, d, "dirty").select("id", P.parse_decimal(F.col("number"), 6).alias("p")).select("id", F.col("p.value").alias("v"), "p.issue")


@query("t2_parse_int", f"SELECT id, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+(\\.0*)?') THEN TRY_CAST(split_part(t, '.', 1) AS BIGINT) END AS v, CASE WHEN t = '' THEN NULL WHEN upper(t) IN {_SENT} THEN 'sentinel' WHEN NOT regexp_full_match(t, '[+-]?[0-9]+(\\.0*)?') THEN 'unparseable' WHEN TRY_CAST(split_part(t, '.', 1) AS BIGINT) IS NULL THEN 'out_of_range' END AS issue FROM (SELECT id, trim(number) AS t FROM dirty)")
def t2(spark, d):
    return adapted(spark, d, "dirty").select("id", P.parse_int(F.col("number")).alias("p")).select("id", F.col("p.value").alias("v"), "p.issue")


_ISO = "'([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(Z|[+-][0-9]{2}:[0-9]{2})?'"
_US = "'([0-9]{1,2})([/-])([0-9]{1,2})[/-]([0-9]{4})'"
_DAY = f"""(SELECT id, t, CASE WHEN regexp_full_match(t, {_ISO}) THEN TRY_CAST(printf('%04d-%02d-%02d', CAST(regexp_extract(t, {_ISO}, 1) AS INT), CAST(regexp_extract(t, {_ISO}, 2) AS INT), CAST(regexp_extract(t, {_ISO}, 3) AS INT)) AS DATE)
  WHEN regexp_full_match(t, {_US}) THEN TRY_CAST(printf('%04d-%02d-%02d', CAST(regexp_extract(t, {_US}, 4) AS INT), CAST(regexp_extract(t, {_US}, 1) AS INT), CAST(regexp_extract(t, {_US}, 3) AS INT)) AS DATE) END AS v, regexp_full_match(t, {_ISO}) OR regexp_full_match(t, {_US}) AS good FROM (SELECT id, day AS t FROM dirty))"""


@query("t3_parse_date", f"SELECT id, strftime(CASE WHEN year(v) >= 1000 THEN v END, '%Y-%m-%d') AS v, CASE WHEN upper(t) IN {_SENT} THEN 'sentinel' WHEN NOT good THEN 'unparseable' WHEN v IS NULL OR year(v) < 1000 THEN 'out_of_range' WHEN regexp_matches(t, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$') AND NOT regexp_matches(t, '^[0-9]{{1,2}}[/-]') THEN 'tz_dropped' END AS issue FROM {_DAY}")
def t3(spark, d):
    return adapted(spark, d, "dirty").select("id", P.parse_date(F.col("day")).alias("p")).select("id", F.col("p.value").alias("v"), "p.issue")


@query("t4_parse_yn", "SELECT id, CASE WHEN upper(flag) IN ('Y', 'YES', 'TRUE', '1') THEN true WHEN upper(flag) IN ('N', 'NO', 'FALSE', '0') THEN false END AS v, CASE WHEN flag <> '' AND upper(flag) NOT IN ('Y', 'YES', 'TRUE', '1', 'N', 'NO', 'FALSE', '0') THEN 'unparseable' END AS issue FROM dirty")
def t4(spark, d):
    return adapted(spark, d, "dirty").select("id", P.parse_yn(F.col("flag")).alias("p")).select("id", F.col("p.value").alias("v"), "p.issue")


@query("t5_normalisers", "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS cusip, CASE o_orderkey % 3 WHEN 0 THEN 'PUT' WHEN 1 THEN 'CALL' END AS put_call FROM orders WHERE o_orderkey BETWEEN 100000 AND 999999999 OR false UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey BETWEEN 100000 AND 999999999 THEN 'x' END, CASE o_orderkey % 3 WHEN 0 THEN 'PUT' WHEN 1 THEN 'CALL' END FROM orders WHERE o_orderkey < 100000")
def t5(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.cusip_norm(F.col("o_orderkey").cast("string")).alias("cusip"), P.put_call_norm(F.expr("CASE o_orderkey % 3 WHEN 0 THEN ' put' WHEN 1 THEN 'C' ELSE 'x' END")).alias("put_call"))


@query("t6_seq_numbers", "SELECT o_orderkey, CASE WHEN o_custkey BETWEEN 1 AND 9999 THEN CAST(o_custkey AS VARCHAR) || ',' ELSE '' END || '7' AS numbers FROM orders")
def t6(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.seq_numbers(F.concat(F.lit("0"), F.col("o_custkey").cast("string"), F.lit(", 07,x,0"))).alias("numbers"))


@query("t7_form_types", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '4' ELSE '13F-HR' END AS base, o_orderkey % 3 = 0 AS amended FROM orders")
def t7(spark, d):
    f = F.expr("concat(if(o_orderkey % 2 = 0, '4', '13F-HR'), if(o_orderkey % 3 = 0, '/A', ''))")
    return read(spark, d, "orders").select("o_orderkey", P.base_form_type(f).alias("base"), P.is_amendment(f).alias("amended"))


@query("t8_indefinite", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END::DOUBLE AS v, o_orderkey % 2 <> 0 AS indefinite FROM orders")
def t8(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.amount_or_indefinite(F.expr("if(o_orderkey % 2 = 0, cast(o_custkey AS string), ' Indefinite')")).alias("p")).select("o_orderkey", F.col("p.value").alias("v"), "p.indefinite")


@query("t9_month_end_back", "SELECT o_orderkey, strftime(last_day(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH), '%Y-%m-%d') AS m FROM orders")
def t9(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.month_end_back(F.col("o_orderdate").cast("date"), 2).alias("m"))


@query("t10_parse_issues", f"SELECT id, 'flag' AS column_name, flag AS raw_value, 'unparseable' AS issue FROM dirty WHERE flag <> '' AND upper(flag) NOT IN ('Y', 'YES', 'TRUE', '1', 'N', 'NO', 'FALSE', '0') UNION ALL SELECT id, 'number', number, CASE WHEN upper(t) IN {_SENT} THEN 'sentinel' WHEN NOT {_NUM} THEN 'unparseable' WHEN TRY_CAST(t AS DECIMAL(38,6)) IS NULL THEN 'out_of_range' ELSE 'rounded' END FROM (SELECT id, number, trim(number) AS t FROM dirty) WHERE t <> '' AND (NOT {_NUM} OR TRY_CAST(t AS DECIMAL(38,6)) IS NULL OR regexp_matches(substr(split_part(t, '.', 2), 7), '[1-9]'))")
def t10(spark, d):
    _, issues = P.typed(adapted(spark, d, "dirty").select("id", "number", "flag"), {"number": P.parse_decimal(F.col("number"), 6), "flag": P.parse_yn(F.col("flag"))}, "dirty", ["id"])
    return issues.drop("table_name")


@query("q6_typed_beside_raw", "SELECT id, TRY_CAST(trim(number) AS DECIMAL(38,6))::DOUBLE AS number, number AS raw_value FROM dirty WHERE regexp_full_match(number, '[0-9]+\\.12345678')")
def q6(spark, d):
    rows, issues = P.typed(adapted(spark, d, "dirty").select("id", "number"), {"number": P.parse_decimal(F.col("number"), 6)}, "dirty", ["id"])
    return rows.where("has_parse_issues").join(issues.where("column_name = 'number' AND issue = 'rounded'"), "id").select("id", "number", "raw_value")


@query("t11_exact_decimal", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) || '.5' END AS t FROM orders")
def t11(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.canonical_text(P.exact_decimal(F.expr("concat(cast(o_custkey AS string), if(o_orderkey % 2 = 0, '.50', '.12345678901'))"))).alias("t"))


@query("t12_base_units", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey * 50000000 END AS sats FROM orders")
def t12(spark, d):
    return read(spark, d, "orders").select("o_orderkey", P.base_units(F.expr("if(o_orderkey % 2 = 0, o_custkey * 0.5D, o_custkey + 0.123456789123D)")).alias("sats"))


@query("t13_kv_map", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS VARCHAR) END AS v FROM orders")
def t13(spark, d):
    m = P.kv_map(F.expr("if(o_orderkey % 2 = 0, concat('k:', o_custkey, '|z:a:b'), 'plain text')"))
    return read(spark, d, "orders").select("o_orderkey", m["k"].alias("v"))


@query("t14_event_logs", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'nep141' END AS standard FROM events")
def t14(spark, d):
    line = F.expr("""if(event_id % 2 = 0, concat('EVENT_JSON:', '{"standard":"nep141","event":"x"}'), props)""")
    return read(spark, d, "events").select("event_id", L.event_log(line)["standard"].alias("standard"))


@query("t15_overflow_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events")
def t15(spark, d):
    return read(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("t16_payload_hash", "SELECT event_id, sha256('{\"event_type\":\"' || event_type || '\",\"user_id\":' || user_id || '}') AS h FROM events")
def t16(spark, d):
    return read(spark, d, "events").select("event_id", L.payload_hash(["user_id", "event_type"]).alias("h"))


@query("t17_checked_long", "SELECT o_orderkey, o_custkey AS v FROM orders")
def t17(spark, d):
    return read(spark, d, "orders").select("o_orderkey", S.checked_long(F.col("o_custkey").cast("decimal(20,0)")).alias("v"))


# ---- arrays, labels, time ----
@query("x1_positions", "SELECT doc_id, generate_subscripts(w, 1) - 1 AS place, unnest(w) AS word FROM (SELECT doc_id, split(text, ' ') AS w FROM documents)")
def x1(spark, d):
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("place", "word"))


@query("x1_positions_whole", "SELECT doc_id, generate_subscripts(w, 1) - 1 AS place, unnest(w) AS word FROM (SELECT doc_id, split(text, ' ') AS w FROM documents)")
def x1_whole(spark, d):
    return read(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", " ")).alias("place", "word"))


@query("x2_predicates", "SELECT vec_id, len(list_filter(embedding, lambda x: x > 0)) AS positive, list_contains(list_transform(embedding, lambda x: x > 0), true) AS any_positive FROM embeddings")
def x2(spark, d):
    return read(spark, d, "embeddings").select("vec_id", F.size(F.filter("embedding", lambda x: x > 0)).alias("positive"), F.exists("embedding", lambda x: x > 0).alias("any_positive"))


@query("q14_slashed_validators", "SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN '3,5' ELSE '3' END AS slashed FROM orders")
def q14(spark, d):
    return read(spark, d, "orders").select("o_orderkey", F.array_sort(F.array_intersect(F.array(F.lit(1), F.lit(3), F.lit(5)), F.expr("if(o_custkey % 2 = 0, array(5, 3, 9), array(3, 9))"))).alias("slashed"))


@query("x4_committee_bits", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '0,9' WHEN 1 THEN '7' ELSE '' END AS bits FROM orders")
def x4(spark, d):
    return read(spark, d, "orders").select("o_orderkey", L.committee_indices(F.expr("CASE o_orderkey % 3 WHEN 0 THEN '0x0102' WHEN 1 THEN '0x80' ELSE '0x' END")).alias("bits"))


@query("x6_system_address", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS idx FROM orders")
def x6(spark, d):
    a = F.expr("if(o_orderkey % 2 = 0, concat('0x20', lpad(lower(hex(o_custkey)), 38, '0')), '0xab')")
    return read(spark, d, "orders").select("o_orderkey", L.system_address_index(a).alias("idx"))


@query("x7_votes", "SELECT id, CASE id % 6 WHEN 0 THEN 'FOR' WHEN 1 THEN 'AGAINST' WHEN 2 THEN 'FREQUENCY_1Y' WHEN 3 THEN 'DID_NOT_VOTE' WHEN 4 THEN 'NONE' ELSE 'WITHHOLD' END AS label, CASE WHEN id % 6 IN (0, 1, 5) AND id % 4 IN (0, 1) THEN (id % 6 = 0) <> (id % 4 = 0) END AS against FROM dirty")
def x7(spark, d):
    v = SEC.vote_records_norm(adapted(spark, d, "dirty").select("id", F.col("vote").alias("how_voted"), F.col("advice").alias("management_recommendation")))
    return v.select("id", F.col("how_voted_norm").alias("label"), F.col("voted_against_management").alias("against"))


@query("q3_votes_against", "SELECT id % 20 AS filer, count(*) FILTER (WHERE id % 6 IN (0, 1, 5) AND id % 4 IN (0, 1)) AS decided, count(*) FILTER (WHERE id % 6 IN (0, 1, 5) AND id % 4 IN (0, 1) AND (id % 6 = 0) <> (id % 4 = 0)) AS against FROM dirty GROUP BY 1")
def q3(spark, d):
    v = SEC.vote_records_norm(adapted(spark, d, "dirty").select("id", F.col("vote").alias("how_voted"), F.col("advice").alias("management_recommendation")))
    return v.groupBy((F.col("id") % 20).alias("filer")).agg(F.count("voted_against_management").alias("decided"), F.count_if("voted_against_management").alias("against"))


@query("x9_windows", "SELECT event_id, CAST(floor(epoch(ts) / 600) AS BIGINT) AS w FROM events")
def x9(spark, d):
    return read(spark, d, "events").select("event_id", L.window_number(F.col("ts").cast("timestamp")).alias("w"))


@query("x11_content_id", "SELECT o_orderkey, upper(sha256(CAST(o_orderkey AS VARCHAR))) AS id FROM orders")
def x11(spark, d):
    return read(spark, d, "orders").select("o_orderkey", L.content_id(F.col("o_orderkey").cast("string")).alias("id"))


# ---- filings ----
def filings(spark, d):
    f = adapted(spark, d, "filings")
    return f.withColumns({"accession_number": F.col("acc"), "dissemination_flags": F.when(F.col("corrected"), F.array(F.lit("CORRECTION"))).otherwise(F.array())})


_FIRST = "first AS (SELECT *, count(*) FILTER (WHERE NOT is_deletion_notice) OVER w AS dissemination_count, bool_or(is_deletion_notice) OVER w AS is_deleted, bool_or(corrected AND NOT is_deletion_notice) OVER w AS is_corrected FROM filings WINDOW w AS (PARTITION BY acc)), f1 AS (SELECT * FROM first WHERE NOT is_deletion_notice QUALIFY row_number() OVER (PARTITION BY acc ORDER BY block_num, filing_index) = 1)"


@query("v18_filings_first", "WITH " + _FIRST + " SELECT acc, block_num, dissemination_count, is_deleted, is_corrected, dissemination_count > 1 AS is_redisseminated FROM f1")
def v18(spark, d):
    return SEC.filings_first(filings(spark, d)).select("acc", "block_num", "dissemination_count", "is_deleted", "is_corrected", "is_redisseminated")


def holdings(spark, d):
    return read(spark, d, "lineitem").selectExpr("l_orderkey AS block_num", "0 AS filing_index", "l_partkey AS value", "cast(l_suppkey + 1 AS bigint) AS shares_or_principal_amount", "'SH' AS shares_or_principal_type", "if(l_linenumber = 2, 'PUT', null) AS put_call_norm")


def reports(spark, d):
    h = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("block_num")).agg(F.sum("l_partkey").alias("holdings_value_sum"))
    return h.selectExpr("block_num", "0 AS filing_index", "if(block_num % 2 = 0, 1000, 1) AS value_multiplier_rule", "holdings_value_sum", "CASE block_num % 3 WHEN 0 THEN holdings_value_sum * 1000 WHEN 1 THEN holdings_value_sum ELSE null END AS table_value_total")


_UNITS = """u0 AS (SELECT l_orderkey AS b, sum(l_partkey) AS s, count(*) FILTER (WHERE l_linenumber <> 2 AND l_partkey > 0 AND l_suppkey + 1 > 0) AS n, median(l_partkey::DOUBLE / (l_suppkey + 1)) FILTER (WHERE l_linenumber <> 2 AND l_partkey > 0 AND l_suppkey + 1 > 0) AS mid FROM lineitem GROUP BY 1),
u1 AS (SELECT *, CASE WHEN b % 2 = 0 THEN 1000 ELSE 1 END AS rule, CASE WHEN b % 2 = 0 AND mid >= 2 THEN 1 WHEN b % 2 <> 0 AND mid < 0.5 THEN 1000 END AS other, CASE WHEN s > 0 THEN CASE b % 3 WHEN 0 THEN 1000.0 WHEN 1 THEN 1.0 END END AS ratio FROM u0),
u2 AS (SELECT *, CASE WHEN n >= 5 AND other IS NOT NULL THEN 'median_override' WHEN n > 0 AND other = 1000 AND ratio = 1000 THEN 'median_and_total_override' WHEN n >= 5 AND mid >= 0.5 AND mid < 2 THEN 'ambiguous' ELSE 'filing_date_rule' END AS source FROM u1),
u3 AS (SELECT *, CASE WHEN source LIKE 'median%' THEN other ELSE rule END AS mult FROM u2)"""


@query("v19_units_13f", "WITH " + _UNITS + " SELECT b AS block_num, n AS qualifying_rows, source AS value_unit_source, mult::BIGINT AS value_multiplier, (CASE WHEN ratio = 1000 AND mult = 1000 THEN 1 ELSE mult END)::BIGINT AS table_value_multiplier FROM u3")
def v19(spark, d):
    return SEC.units_13f(reports(spark, d), holdings(spark, d)).select("block_num", "qualifying_rows", "value_unit_source", "value_multiplier", "table_value_multiplier")


@query("v20_holdings_usd", "WITH " + _UNITS + " SELECT l_orderkey AS block_num, sum(l_partkey * mult)::BIGINT AS value_usd FROM lineitem JOIN u3 ON b = l_orderkey GROUP BY 1")
def v20(spark, d):
    return SEC.holdings_usd(holdings(spark, d), SEC.units_13f(reports(spark, d), holdings(spark, d))).groupBy("block_num").agg(F.sum("value_usd").alias("value_usd"))


@query("q2_holders_by_period", "WITH " + _UNITS + " SELECT l_orderkey % 8 AS quarter, count(DISTINCT l_orderkey % 50) AS managers, sum(l_suppkey + 1)::BIGINT AS shares, sum(l_partkey * mult)::BIGINT AS value_usd, count(*) FILTER (WHERE source <> 'filing_date_rule') AS overridden FROM lineitem JOIN u3 ON b = l_orderkey WHERE l_linenumber <> 2 AND l_partkey % 3 = 0 GROUP BY 1")
def q2(spark, d):
    h = SEC.holdings_usd(holdings(spark, d), SEC.units_13f(reports(spark, d), holdings(spark, d))).where("put_call_norm is null and value % 3 = 0")
    return h.groupBy((F.col("block_num") % 8).alias("quarter")).agg(F.count_distinct(F.col("block_num") % 50).alias("managers"), F.sum("shares_or_principal_amount").alias("shares"), F.sum("value_usd").alias("value_usd"), F.count_if(F.col("value_unit_source") != "filing_date_rule").alias("overridden"))


_EFF = "r AS (SELECT f.* FROM filings f WHERE EXISTS (SELECT 1 FROM f1 WHERE f1.block_num = f.block_num) AND report_type <> '13F NOTICE'), base AS (SELECT * FROM r WHERE coalesce(amendment_type, '') <> 'NEW HOLDINGS' QUALIFY row_number() OVER (PARTITION BY manager_cik, period_of_report ORDER BY acceptance_datetime DESC, block_num DESC) = 1)"


@query("v21_effective_reports_13f", "WITH " + _FIRST + ", " + _EFF + " SELECT block_num, manager_cik, 'base' AS effective_role FROM base UNION ALL SELECT r.block_num, r.manager_cik, 'new_holdings' FROM r JOIN base b USING (manager_cik, period_of_report) WHERE r.amendment_type = 'NEW HOLDINGS' AND r.acceptance_datetime > b.acceptance_datetime")
def v21(spark, d):
    f = filings(spark, d)
    return SEC.effective_reports_13f(f, SEC.filings_first(f)).select("block_num", "manager_cik", "effective_role")


@query("v23_effective_reports_nport", "WITH " + _FIRST + " SELECT block_num, series_id FROM (SELECT f.* FROM filings f WHERE EXISTS (SELECT 1 FROM f1 WHERE f1.block_num = f.block_num)) QUALIFY row_number() OVER (PARTITION BY manager_cik, series_id, period_of_report ORDER BY acceptance_datetime DESC, block_num DESC) = 1")
def v23(spark, d):
    f = filings(spark, d).withColumns({"filer_cik": F.col("manager_cik"), "series_name": F.lit(None).cast("string"), "as_of_date": F.col("period_of_report")})
    return SEC.effective_reports_nport(f, SEC.filings_first(f)).select("block_num", "series_id")


@query("q1_officer_purchases", "SELECT o_orderkey, (o_custkey * CAST(round(o_totalprice, 2) AS DECIMAL(18,2)))::DOUBLE AS value_usd FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 5 = 0 AND o_orderkey % 3 = 0 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10")
def q1(spark, d):
    t = read(spark, d, "orders").where("o_orderkey % 2 = 0 and o_orderkey % 5 = 0 and o_orderkey % 3 = 0")
    return t.select("o_orderkey", F.try_multiply(F.col("o_custkey").cast("decimal(18,0)"), F.round("o_totalprice", 2).cast("decimal(18,2)")).alias("value_usd")).orderBy(F.desc_nulls_last("value_usd"), "o_orderkey").limit(10)


@query("q4_holders_any_identifier", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND (l_suppkey = 3 OR l_partkey IN (SELECT DISTINCT l_partkey FROM lineitem WHERE l_suppkey = 3))")
def q4(spark, d):
    li = read(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag")
    ids = li.where("l_suppkey = 3").select("l_partkey").distinct().withColumn("_in", F.lit(True))
    return li.where("l_returnflag = 'R'").join(ids, "l_partkey", "left").where("l_suppkey = 3 OR _in").select("l_orderkey", "l_partkey")


@query("q5_raise_totals", "SELECT o_orderpriority AS industry_group, strftime(date_trunc('month', o_orderdate), '%Y-%m') AS month, count(*) AS n, sum(CAST(round(o_totalprice, 2) AS DECIMAL(18,2)))::DOUBLE AS sold, count(*) FILTER (WHERE o_orderstatus = 'P') AS indefinite FROM orders GROUP BY ALL")
def q5(spark, d):
    return read(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("industry_group"), F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("sold"), F.count_if(F.col("o_orderstatus") == "P").alias("indefinite"))


# ---- reference joins ----
@query("r1_pair_names", "WITH " + _FACTS + " SELECT f.block_num, f.fill_index, p.p_name FROM facts f LEFT JOIN (SELECT '@' || p_partkey AS coin, p_name FROM part WHERE p_partkey % 2 = 0) p USING (coin) WHERE market_type = 'spot'")
def r1(spark, d):
    p = read(spark, d, "part").where("p_partkey % 2 = 0").select(F.concat(F.lit("@"), F.col("p_partkey").cast("string")).alias("coin"), "p_name")
    return M.with_market(adapted(spark, d, "fills")).where("market_type = 'spot'").join(p, "coin", "left").select("block_num", "fill_index", "p_name")


@query("r2_outcome_labels", "WITH " + _FACTS + ", " + _LEGS + ", " + _SETTLED + " SELECT l.block_num, l.fill_index, CASE WHEN l.outcome_id % 2 = 0 THEN 'side' || l.side_index END AS side_label, s.settle_fraction::DOUBLE AS settle_fraction FROM legs4 l LEFT JOIN settled s USING (outcome_id)")
def r2(spark, d):
    legs = outcome_legs(spark, d)
    names = legs.select("outcome_id").distinct().where("outcome_id % 2 = 0").withColumn("side_names", F.array(F.lit("side0"), F.lit("side1")))
    return legs.join(names, "outcome_id", "left").join(M.outcome_settlements(legs), "outcome_id", "left").select("block_num", "fill_index", F.get("side_names", F.col("side_index").cast("int")).alias("side_label"), "settle_fraction")


@query("r3_funding_premium", "WITH log1 AS (SELECT DISTINCT 'C' || (entity % 4) AS coin, observed_at AS block_num FROM log) SELECT d.block_num, d.event_index, d.coin, count(*) AS n, any_value(l.block_num IS NOT NULL) AS has_premium FROM funding_deltas d LEFT JOIN log1 l ON l.coin = d.coin AND l.block_num = d.block_num GROUP BY ALL")
def r3(spark, d):
    h = adapted(spark, d, "log").select(F.concat(F.lit("C"), (F.col("entity") % 4).cast("string")).alias("coin"), F.col("observed_at").alias("block_num")).distinct().withColumn("_p", F.lit(True))
    return rates(spark, d).join(h, ["coin", "block_num"], "left").select("block_num", "event_index", "coin", F.col("positions").alias("n"), F.col("_p").isNotNull().alias("has_premium"))


# ---- quality ----
_PREV = "p AS (SELECT *, lag(block_num) OVER w AS pn, lag(block_id) OVER w AS pid, last_value(ts IGNORE NULLS) OVER (ORDER BY block_num, block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt FROM blocks WINDOW w AS (ORDER BY block_num, block_id))"
_PROBLEMS = _PREV + ", problems AS (SELECT 'duplicate' AS kind, block_num, pn AS previous FROM p WHERE block_num = pn UNION ALL SELECT 'gap', block_num, pn FROM p WHERE block_num > pn + 1 UNION ALL SELECT 'broken_parent', block_num, pn FROM p WHERE block_num = pn + 1 AND parent_id IS DISTINCT FROM pid UNION ALL SELECT 'time_reversal', block_num, pn FROM p WHERE ts < pt)"


@query("k1_validate_blocks", "WITH " + _PROBLEMS + " SELECT kind, block_num, previous, CASE kind WHEN 'time_reversal' THEN 'warning' ELSE 'error' END AS severity FROM problems")
def k1(spark, d):
    return quality.validate_blocks(adapted(spark, d, "blocks"), width=1000)


@query("k2_block_runs", "SELECT min(block_num) AS first, max(block_num) AS last FROM (SELECT block_num, block_num - dense_rank() OVER (ORDER BY block_num) AS g FROM blocks) GROUP BY g")
def k2(spark, d):
    return quality.block_runs(adapted(spark, d, "blocks"), width=1000)


@query("k2_seal_range", "WITH " + _PROBLEMS.replace("FROM blocks", "FROM (SELECT * FROM blocks WHERE block_num >= 10 AND block_num < (SELECT max(block_num) - 10 FROM blocks))") + " SELECT kind, block_num FROM problems WHERE kind <> 'time_reversal' UNION ALL SELECT 'below_start', min(block_num) FROM blocks HAVING min(block_num) < 10 UNION ALL SELECT 'beyond_end', max(block_num) FROM blocks UNION ALL SELECT 'missing_start', 10 FROM blocks HAVING min(block_num) > 10")
def k2s(spark, d):
    b = adapted(spark, d, "blocks")
    return quality.seal_range(b, 10, b.agg(F.max("block_num")).first()[0] - 10, width=100)


@query("k3_lanes", "SELECT i AS lane, i * 128 AS first, least(i * 128 + 128, s) AS stop, count(DISTINCT block_num) AS done, count(DISTINCT block_num) = least(i * 128 + 128, s) - i * 128 AS complete FROM (SELECT unnest(range(0, (s + 127) // 128)) AS i, s FROM (SELECT max(block_num) + 1 AS s FROM blocks)) LEFT JOIN blocks ON block_num >= 0 AND block_num // 128 = i GROUP BY i, s")
def k3(spark, d):
    b = adapted(spark, d, "blocks")
    stop = b.agg(F.max("block_num")).first()[0] + 1
    return quality.lane_progress(b, quality.plan_lanes(spark, 0, stop, 128), 0, 128).drop("newest")


# Odd values here and there beside what the adapters have, in SQL that both engines compute alike, so that every monitor finds some.
_ODD_HASH = "CASE WHEN block_num % 3 = 0 THEN hash ELSE concat('0x', repeat('0', 20), '04', lpad(lower(hex({b})), 8, '0'), lpad(CAST({i} AS STRING), 34, '0')) END"
_ODD_FILLS = f"""SELECT block_num, fill_index, coin, user, price, size, side, transaction_id, crossed, liquidated_user, liquidation_method, builder, ts AS block_ts,
  CASE WHEN block_num % 101 = 0 AND fill_index = 0 THEN ts + 1 ELSE ts END AS filled, {_ODD_HASH.format(b="block_num", i="CAST(floor(fill_index / 2) AS BIGINT)")} AS hash,
  CASE WHEN block_num % 103 = 0 THEN '0x12' WHEN fill_index = 1 THEN concat('0x', repeat('0', 32)) END AS client_order_id, CASE WHEN block_num % 997 = 0 THEN '{{}}' END AS extra_json FROM fills"""
_ODD_EVENTS = f"""SELECT block_num, event_index, event_type, ledger_type, {_ODD_HASH.format(b="block_num", i="event_index")} AS hash, users, user, destination, vault, token, fee, fee_token, CAST(NULL AS BIGINT) AS item_count,
  CASE WHEN event_type LIKE 'gossip%' AND event_index % 2 = 0 THEN 'ip' END AS previous_winner_ip, CASE WHEN event_type LIKE 'gossip%' AND event_index % 3 = 0 THEN 1 END AS end_gas, event_index = 3 AS astray FROM ledger
UNION ALL SELECT block_num, event_index, 'funding', NULL, '{L.ZERO_HASH}', NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN block_num % 60 = 0 THEN item_count + 1 ELSE item_count END, NULL, NULL, false FROM funding_headers"""


def monitored(spark, d):
    """The tables that monitors read, stored once, with what they read alone; matches are looked at in the pass that pairs the fills."""
    start = 1767225600
    f = spark.sql(_ODD_FILLS.replace("FROM fills", "FROM {fills}").replace("'{}'", "'{{}}'"), fills=adapted(spark, d, "fills"))
    f = with_match(M.with_counterparty(M.with_market(f.withColumn("direction", F.lit(""))))).withColumns({"timestamp": F.timestamp_seconds("block_ts"), "fill_time": F.timestamp_seconds("filled")})
    f = f.withColumn("market_type", F.when(F.expr("block_num % 211 = 0 AND fill_index = 0"), "spot").otherwise(F.col("market_type")))
    f = ST.stored_table(f.drop("block_ts", "filled", "direction", "counterparty_direction", "counterparty_fill_index"), "monitored-fills")
    e = spark.sql(_ODD_EVENTS.replace("FROM ledger", "FROM {ledger}").replace("FROM funding_headers", "FROM {headers}"), ledger=adapted(spark, d, "ledger"), headers=adapted(spark, d, "funding_headers"))
    own = L.event_table(F.col("event_type"), F.col("ledger_type"))
    e = e.withColumns({"table_name": F.when(F.col("astray"), F.lit("transfers")).otherwise(own), "validator": F.lit(None).cast("string"), "sub_account": F.lit(None).cast("string"), "extra_json": F.expr("CASE WHEN block_num % 499 = 0 THEN 'x' END"),
                       "event_time_ns": (F.lit(start) + F.col("block_num") * 60) * 1_000_000_000 + F.expr("CASE WHEN block_num % 40 = 0 AND event_index = 0 THEN 1 ELSE 0 END")})
    e = ST.stored_table(e, "monitored-events")
    b = f.groupBy("block_num").agg(F.count("*").alias("fill_count"), F.lit(0).cast("long").alias("event_count")).unionByName(e.groupBy("block_num").agg(F.lit(0).cast("long").alias("fill_count"), F.count("*").alias("event_count")))
    b = b.groupBy("block_num").agg(F.sum("fill_count").alias("fill_count"), F.sum("event_count").alias("event_count"))
    b = b.withColumns({"fill_count": F.expr("fill_count + CASE WHEN block_num % 50 = 0 THEN 1 ELSE 0 END"), "event_count": F.expr("event_count + CASE WHEN block_num % 70 = 0 THEN 1 ELSE 0 END"), "block_time_ns": (F.lit(start) + F.col("block_num") * 60) * 1_000_000_000, "extra_json": F.lit(None).cast("string")})
    b = ST.stored_table(b, "monitored-blocks")
    r = rates(spark, d).withColumns({"coin": F.regexp_replace("coin", "C0", "BTC"), "timestamp": F.timestamp_seconds(F.lit(start) + F.col("block_num") * 60), "extra_json": F.lit(None).cast("string"), "dex": F.expr("CASE WHEN block_num % 2 = 0 THEN '' ELSE 'xyz' END")})
    r = r.select("block_num", "coin", "dex_index", "dex", "timestamp", "funding_rate", "open_interest", "long_size", "short_size", "extra_json")
    items = adapted(spark, d, "funding_deltas")
    return {"blocks": b, "fills": f, "events": e, "funding_rates": ST.stored_table(r, "monitored-rates"), "items": items.select("block_num", "event_index"),
            "links": e.where("ledger_type = 'liquidation' AND event_index % 2 = 0").select("block_num", F.col("event_index").alias("ledger_event_index")), "funding_deltas": (items.withColumn("extra_json", F.expr("CASE WHEN block_num % 1009 = 0 THEN 'x' END")), "event_index")}


_MON = f"""odd AS ({_ODD_FILLS}), odd_events AS ({_ODD_EVENTS}),
matches AS (SELECT block_num, coin, transaction_id FROM fills WHERE transaction_id <> 0 GROUP BY ALL HAVING count(*) = 2 AND count(DISTINCT side) = 2),
f AS (SELECT o.*, x.user AS counterparty, x.fill_index AS other, x.price AS op, x.size AS os, x.hash AS oh, x.crossed AS oc, CASE WHEN o.block_num % 211 = 0 AND o.fill_index = 0 THEN 'spot' ELSE facts.market_type END AS market_type, facts.market_type AS true_type
  FROM odd o JOIN (SELECT block_num, fill_index, market_type FROM facts) facts ON facts.block_num = o.block_num AND facts.fill_index = o.fill_index LEFT JOIN matches g ON g.block_num = o.block_num AND g.coin = o.coin AND g.transaction_id = o.transaction_id
  LEFT JOIN odd x ON g.block_num IS NOT NULL AND x.block_num = o.block_num AND x.coin = o.coin AND x.transaction_id = o.transaction_id AND x.fill_index <> o.fill_index),
r AS (SELECT * REPLACE (replace(coin, 'C0', 'BTC') AS coin), CASE WHEN block_num % 2 = 0 THEN '' ELSE 'xyz' END AS dex FROM rates),
heads AS (SELECT block_num, count(*) AS n, max(event_index) AS top FROM odd_events WHERE event_type = 'funding' GROUP BY 1),
m AS (SELECT 'M1' AS monitor, block_num FROM f WHERE filled <> block_ts
UNION ALL SELECT 'M2', block_num FROM odd_events WHERE block_num % 40 = 0 AND event_index = 0
UNION ALL SELECT 'M3', block_num FROM heads WHERE top <> n - 1
UNION ALL SELECT 'M4', block_num FROM f WHERE hash <> '{L.ZERO_HASH}' AND (substr(hash, 23, 2) <> '04' OR substr(hash, 25, 8) <> lpad(lower(hex(block_num)), 8, '0'))
UNION ALL SELECT 'M4e', block_num FROM odd_events WHERE hash <> '{L.ZERO_HASH}' AND coalesce(ledger_type, '') NOT IN ('deposit', 'withdraw') AND (substr(hash, 23, 2) <> '04' OR substr(hash, 25, 8) <> lpad(lower(hex(block_num)), 8, '0'))
UNION ALL SELECT 'M5', block_num FROM f WHERE coalesce(length("user") <> 42, false) OR coalesce(length(hash) <> 66, false) OR coalesce(length(client_order_id) <> 34, false) OR coalesce(length(liquidated_user) <> 42, false) OR coalesce(length(counterparty) <> 42, false)
UNION ALL SELECT 'M5e', block_num FROM odd_events WHERE coalesce(length(hash) <> 66, false) OR coalesce(length("user") <> 42, false) OR coalesce(length(destination) <> 42, false) OR coalesce(length(vault) <> 42, false) OR coalesce(len(list_filter(users, lambda u: length(u) <> 42)) > 0, false)
UNION ALL SELECT 'M6', block_num FROM odd_events WHERE event_type = 'ledger_update' AND len(users) NOT IN (1, 2)
UNION ALL SELECT 'M7', block_num FROM f WHERE builder IS NOT NULL AND NOT regexp_full_match(builder, '0x[0-9a-f]{{40}}')
UNION ALL SELECT 'M8f', block_num FROM (SELECT block_num FROM odd UNION SELECT block_num FROM odd_events) WHERE block_num % 50 = 0
UNION ALL SELECT 'M8e', block_num FROM (SELECT block_num FROM odd UNION SELECT block_num FROM odd_events) WHERE block_num % 70 = 0
UNION ALL SELECT 'M8i', e.block_num FROM odd_events e LEFT JOIN (SELECT block_num, event_index, count(*) AS n FROM funding_deltas GROUP BY ALL) c USING (block_num, event_index) WHERE e.item_count <> coalesce(n, 0)
UNION ALL SELECT 'M9', block_num FROM f WHERE transaction_id <> 0 AND market_type IS DISTINCT FROM 'outcome' GROUP BY block_num, transaction_id HAVING count(*) <> 2 OR count(*) FILTER (WHERE crossed) <> 1 OR arg_min(side, fill_index) <> 'BUY' OR max(fill_index) - min(fill_index) <> 1
UNION ALL SELECT 'M10', block_num FROM odd_events WHERE event_type = 'gossip_priority_auction_restart' AND (previous_winner_ip IS NULL) <> (end_gas IS NULL)
UNION ALL SELECT 'M11', block_num FROM f WHERE liquidation_method IS NOT NULL AND liquidated_user IS NULL
UNION ALL SELECT 'M12', block_num FROM odd_events WHERE ledger_type IN ('send', 'spot_transfer') AND (fee_token IS NULL) <> (fee = 0)
UNION ALL SELECT 'M13', block_num FROM f WHERE block_num % 997 = 0 UNION ALL SELECT 'M13', block_num FROM odd_events WHERE block_num % 499 = 0 UNION ALL SELECT 'M13', block_num FROM funding_deltas WHERE block_num % 1009 = 0
UNION ALL SELECT 'M14', block_num FROM f WHERE counterparty IS NOT NULL AND (price <> op OR size <> os OR hash <> oh OR crossed = oc OR abs(fill_index - other) <> 1)
UNION ALL SELECT 'M15', block_num FROM f WHERE transaction_id <> 0 AND counterparty IS NULL AND market_type IS DISTINCT FROM 'outcome'
UNION ALL SELECT 'M16', block_num FROM f WHERE liquidation_method IS NOT NULL AND transaction_id <> 0 GROUP BY block_num, coin, transaction_id HAVING count(*) FILTER (WHERE "user" = liquidated_user) <> 1
UNION ALL SELECT 'M16e', block_num FROM odd_events WHERE ledger_type = 'liquidation' AND event_index % 2 <> 0
UNION ALL SELECT 'M17', block_num FROM r WHERE funding_rate IS NULL
UNION ALL SELECT 'M18', min(block_num) FROM r GROUP BY dex_index HAVING count(DISTINCT dex) > 1
UNION ALL SELECT 'M19', block_num FROM f WHERE market_type IS NULL OR market_type IS DISTINCT FROM true_type
UNION ALL SELECT 'M20', block_num FROM r WHERE abs(long_size - short_size) > open_interest * 0.000001
UNION ALL SELECT 'M21', block_num FROM odd_events WHERE astray AND NOT (event_type = 'ledger_update' AND ledger_type IN ('send', 'spot_transfer', 'internal_transfer', 'sub_account_transfer', 'account_class_transfer'))
UNION ALL SELECT 'M22', block_num FROM (SELECT DISTINCT p.block_num, f.coin FROM (SELECT DISTINCT block_num FROM r) p JOIN (SELECT DISTINCT block_ts, coin FROM f WHERE market_type = 'perp') f ON f.block_ts >= 1767225600 + p.block_num * 60 - 3600 AND f.block_ts < 1767225600 + p.block_num * 60) t WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.block_num = t.block_num AND r.coin = t.coin)
UNION ALL SELECT 'M23', block_num FROM odd_events WHERE regexp_full_match(token, '[+#][0-9]+'))"""


@query("k4_monitors", "WITH " + _FACTS + ", " + _RATES + ", " + _MON + " SELECT monitor, count(*) AS violations, min(block_num) AS first_block FROM m GROUP BY 1")
def k4(spark, d):
    return monitors(monitored(spark, d)).groupBy("monitor").agg(F.count("*").alias("violations"), F.min("block_num").alias("first_block"))


@query("k5_cross_checks", "SELECT coin, array_to_string(list_sort(list(DISTINCT fee_token) FILTER (WHERE side = 'BUY')), ',') AS base, array_to_string(list_sort(list(DISTINCT fee_token) FILTER (WHERE side = 'ASK')), ',') AS quote FROM fills GROUP BY 1 HAVING list_contains(list(DISTINCT fee_token) FILTER (WHERE side = 'BUY'), 'USDC') IS DISTINCT FROM true")
def k5(spark, d):
    g = adapted(spark, d, "fills").groupBy("coin").agg(F.array_sort(F.collect_set(F.when(F.col("side") == "BUY", F.col("fee_token")))).alias("base"), F.array_sort(F.collect_set(F.when(F.col("side") == "ASK", F.col("fee_token")))).alias("quote"))
    g = g.where(~F.array_contains("base", "USDC"))
    return g.select("coin", F.when(F.size("base") > 0, F.array_join("base", ",")).alias("base"), F.when(F.size("quote") > 0, F.array_join("quote", ",")).alias("quote"))


# ---- change logs ----
def logged(spark, d, keep):
    rows = adapted(spark, d, "log").where(keep).select("entity", "observed_at", "kind", "level")
    return G.shaped(forks.latest(rows, ["entity"], [F.desc("observed_at")]), ["entity"], "test")


_SNAP = "(SELECT * FROM log WHERE {} QUALIFY row_number() OVER (PARTITION BY entity ORDER BY observed_at DESC) = 1)"


@query("g1_changes", f"SELECT b.entity, b.observed_at, b.kind FROM {_SNAP.format('entity % 5 <> 0')} b LEFT JOIN {_SNAP.format('observed_at % 3 <> 0')} a USING (entity) WHERE a.entity IS NULL OR a.kind IS DISTINCT FROM b.kind OR a.level IS DISTINCT FROM b.level")
def g1(spark, d):
    return G.changes(logged(spark, d, "observed_at % 3 <> 0"), logged(spark, d, "entity % 5 <> 0"), ["entity"]).select("entity", "observed_at", "kind")


@query("g2_removals", f"SELECT a.entity, a.kind, false AS listed FROM {_SNAP.format('observed_at % 3 <> 0')} a WHERE a.entity % 5 = 0")
def g2(spark, d):
    return G.removals(logged(spark, d, "observed_at % 3 <> 0"), logged(spark, d, "entity % 5 <> 0"), ["entity"], 10**12).select("entity", "kind", "listed")


@query("g3_bounded_removals", f"SELECT a.entity FROM {_SNAP.format('observed_at % 3 <> 0')} a WHERE a.entity % 5 = 0 AND (SELECT count(*) FROM {_SNAP.format('observed_at % 3 <> 0')} WHERE entity % 5 = 0) <= greatest(25.0, 0.2 * (SELECT count(*) FROM {_SNAP.format('observed_at % 3 <> 0')}))")
def g3(spark, d):
    log = logged(spark, d, "observed_at % 3 <> 0")
    return G.bounded_removals(log, G.removals(log, logged(spark, d, "entity % 5 <> 0"), ["entity"], 10**12), ["entity"]).select("entity")


@query("g4_missing_hours", "SELECT entity, observed_at FROM log WHERE observed_at % 4 = 0 AND observed_at <= (SELECT max(observed_at) FROM log WHERE observed_at % 4 <> 0)")
def g4(spark, d):
    log = adapted(spark, d, "log")
    return G.missing_hours(log.where("observed_at % 4 <> 0").select("entity", "observed_at"), log.select("entity", "observed_at"), ["entity"], "observed_at")


@query("g6_stale", "SELECT entity, max(observed_at) AS newest FROM log GROUP BY 1 HAVING (SELECT max(observed_at) FROM log) - max(observed_at) > 50")
def g6(spark, d):
    log = adapted(spark, d, "log")
    top = log.agg(F.max("observed_at")).first()[0]
    return G.stale(log, ["entity"], top, "observed_at", 50).select("entity", "newest")


@query("k6_verify_changelog", "SELECT 'repeated' AS kind, count(*) AS n FROM (SELECT kind = lag(kind) OVER w AND level IS NOT DISTINCT FROM lag(level) OVER w AND lag(observed_at) OVER w IS NOT NULL AS same FROM log WINDOW w AS (PARTITION BY entity ORDER BY observed_at)) WHERE same HAVING count(*) > 0")
def k6(spark, d):
    log = G.shaped(adapted(spark, d, "log").select("entity", "observed_at", "kind", "level"), ["entity"], "test")
    return G.verify(log, ["entity"], ["kind", "level"]).groupBy("kind").agg(F.count("*").alias("n"))


# ---- storage: written to a folder of the session's checkpoint directory, read back ----
def stored(spark, d, name: str):
    root = ST.shared_path(spark, name)
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("block_num"), F.col("o_custkey").alias("index"), F.to_date("o_orderdate").alias("date"))
    ST.write_tables({"transactions": o, "blocks": o.drop("index").distinct()}, root, lookups={"transactions": ["index"]})
    return root


@query("s3_write_read_by_day", "SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, count(*) AS n FROM orders GROUP BY 1")
def s3(spark, d):
    return ST.table(spark, stored(spark, d, "s3"), "transactions").groupBy("date").agg(F.count("*").alias("n"))


@query("s5_frontier", "SELECT count(*) AS n, max(o_orderkey) AS top FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) FROM orders WHERE o_orderkey % 7 = 0)")
def s5(spark, d):
    o = read(spark, d, "orders").withColumnRenamed("o_orderkey", "block_num")
    return ST.read_consistent(o, ST.frontier(o.where("block_num % 7 = 0"))).agg(F.count("*").alias("n"), F.max("block_num").alias("top"))


@query("s6_closed_dates", "SELECT DISTINCT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date FROM orders WHERE CAST(o_orderdate AS DATE) < (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def s6(spark, d):
    return ST.closed_dates(read(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")))


@query("s7_day_block_range", "SELECT min(o_orderkey) AS first_block, max(o_orderkey) AS last_block FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)")
def s7(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("block_num"), F.to_date("o_orderdate").alias("date"))
    return ST.day_block_range(o, o.agg(F.min("date")).first()[0])


@query("s8_table_summary", "SELECT count(*) AS rows, 1::BIGINT AS files FROM orders")
def s8(spark, d):
    return ST.table_summary(read(spark, d, "orders")).select("rows", "files")


@query("l1_compaction", "SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS date, count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) < (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) GROUP BY 1")
def l1(spark, d):
    root = stored(spark, d, "l1")
    days = ST.closed_dates(ST.table(spark, root, "transactions"))
    return layout.compact_closed_dates(spark, root, "transactions", f"{root}/compacted", days).select("date", F.col("rows").alias("n"))


@query("l2_order_ties", "SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def l2(spark, d):
    return layout.order_ties(read(spark, d, "lineitem"), ["l_orderkey", "l_partkey"])


@query("l3_order_breaks", "SELECT count(*) AS n FROM (SELECT l_orderkey, l_partkey, lag(l_orderkey) OVER (ORDER BY file_row_number) AS po, lag(l_partkey) OVER (ORDER BY file_row_number) AS pp FROM (SELECT *, row_number() OVER () AS file_row_number FROM lineitem)) WHERE po > l_orderkey OR (po = l_orderkey AND pp >= l_partkey)")
def l3(spark, d):
    return layout.order_breaks(read(spark, d, "lineitem"), ["l_orderkey", "l_partkey"]).agg(F.count("*").alias("n"))


# ---- family specs over nested blocks ----
def order_blocks(spark, d):
    """Orders as blocks, their lines as transactions with logs, calls and inputs."""
    li = read(spark, d, "lineitem").selectExpr("l_orderkey AS block_num", "named_struct('hash', concat('t', l_partkey), 'txid', concat('t', l_partkey), 'line', l_linenumber, 'receipt', named_struct('logs', array(named_struct('address', concat('s', l_suppkey), 'topics', array(l_returnflag, l_linestatus)))), "
                                               "'vin', array(named_struct('prev_txid', concat('t', l_suppkey)), named_struct('prev_txid', null)), 'calls', array(named_struct('index', 0, 'balance_changes', array(named_struct('address', 'a', 'ordinal', l_partkey))))) AS t")
    return li.groupBy("block_num").agg(F.sort_array(F.collect_list("t")).alias("transactions")).withColumn("tx", F.col("transactions"))


@query("f_evm_logs", "SELECT l_orderkey AS block_num, 't' || l_partkey AS tx_hash, 's' || l_suppkey AS address, l_returnflag AS topic0, l_linestatus AS topic1, 0::BIGINT AS log_index FROM lineitem")
def f_evm(spark, d):
    from blockwright.plans.specs import flatten_family

    return flatten_family(order_blocks(spark, d), "evm", only={"logs"})["logs"].select("block_num", "tx_hash", "address", "topic0", "topic1", "log_index")


@query("f_evm_balance_changes", "SELECT l_orderkey AS block_num, 't' || l_partkey AS tx_hash, 0::BIGINT AS call_index, l_partkey AS ordinal FROM lineitem")
def f_evm_changes(spark, d):
    from blockwright.plans.specs import flatten_family

    return flatten_family(order_blocks(spark, d), "evm", only={"balance_changes"})["balance_changes"].select("block_num", "tx_hash", "call_index", "ordinal")


@query("f_bitcoin_inputs", "SELECT l_orderkey AS block_num, i AS input_index, 't' || l_partkey AS tx_hash, CASE i WHEN 0 THEN 't' || l_suppkey END AS prev_txid FROM lineitem, range(0, 2) t(i)")
def f_bitcoin(spark, d):
    from blockwright.plans.specs import flatten_family

    return flatten_family(order_blocks(spark, d).drop("transactions"), "bitcoin", only={"inputs"})["inputs"].select("block_num", "input_index", "tx_hash", "prev_txid")


@query("g5_sweep", "WITH known AS (SELECT entity, arg_max(listed, observed_at) AS listed, arg_max(level IS NOT NULL, observed_at) AS settled FROM log GROUP BY 1) SELECT entity, 0::BIGINT AS priority FROM known WHERE listed AND entity % 5 = 0 UNION ALL SELECT entity, 1 FROM known WHERE entity % 5 <> 0 AND NOT settled UNION ALL SELECT i, 2 FROM range(0, (SELECT max(entity) + 4 FROM log)) t(i) WHERE i NOT IN (SELECT entity FROM log)")
def g5(spark, d):
    log = adapted(spark, d, "log").withColumn("settled", F.col("level").isNotNull())
    snapshot = log.where("entity % 5 <> 0").select("entity").distinct()
    return G.sweep_candidates(log, snapshot, "entity", "settled", ahead=3)


@query("o4_global_order", "SELECT 'log' AS kind, l_orderkey AS block_num, l_partkey AS ordinal FROM lineitem UNION ALL SELECT 'change', o_orderkey, o_custkey FROM orders")
def o4(spark, d):
    a = read(spark, d, "lineitem").select(F.lit("log").alias("kind"), F.col("l_orderkey").alias("block_num"), F.col("l_partkey").alias("ordinal"))
    b = read(spark, d, "orders").select(F.lit("change").alias("kind"), F.col("o_orderkey").alias("block_num"), F.col("o_custkey").alias("ordinal"))
    return a.unionByName(b).orderBy("block_num", "ordinal", "kind")


@query("q16_index_expansion", "SELECT doc_id, i AS place, list_value('a', 'b', 'c')[i + 1] AS account FROM documents, range(0, 3) t(i) WHERE i <= doc_id % 3")
def q16(spark, d):
    keys = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    rows = read(spark, d, "documents").select("doc_id", F.posexplode(F.sequence(F.lit(0), (F.col("doc_id") % 3).cast("int"))).alias("place", "i"))
    return rows.select("doc_id", "place", F.get(keys, F.col("i")).alias("account"))


@query("q8_system_contracts", "SELECT e.event_id, r.lo AS call FROM events e JOIN (SELECT DISTINCT event_id - event_id % 100 AS lo FROM events) r ON e.event_id BETWEEN r.lo AND r.lo + 9")
def q8(spark, d):
    e = read(spark, d, "events").select("event_id", F.floor(F.col("event_id") / 1000).alias("block"))
    calls = e.select("block", (F.col("event_id") - F.col("event_id") % 100).alias("lo")).distinct().withColumn("hi", F.col("lo") + 9)
    return joins.band_join(e, calls, ["block"], "event_id", "lo", "hi").select("event_id", F.col("lo").alias("call"))


@query("q13_exact_satoshis", "SELECT l_orderkey, sum(CAST(round(l_quantity, 2) * 100 AS BIGINT))::BIGINT AS sats FROM lineitem GROUP BY 1")
def q13(spark, d):
    return read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum((F.round("l_quantity", 2).cast("decimal(18,2)") * 100).cast("long")).alias("sats"))
